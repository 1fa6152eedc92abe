"""URL filter: ratio of two character language models, one of accepted and one of rejected URLs.

Rules judge the URLs they fit; the longest rule wins. Those URLs train two smoothed
Markov models of variable order: a character's probability after its last `ORDER`
characters falls back, by interpolation, on shorter contexts down to a uniform one.
Counts cover every URL that a rule judges (three quarters of them, by hash), each gram
under a key of its own: the model is a table that grows with the URLs. It holds the
`ORDER` + 1 bytes of every place of a URL once, with the counts of both classes; those of
shorter contexts are sums over it, made by Spark, and so is the difference of the two
log-probabilities of each gram. URLs are scored in one pass, without the model on the driver or
whole in any task: URLs are dealt to chunks of about `CHUNK` characters, the distinct grams of a
chunk are joined to the table, and each chunk meets the part of the table that it needs. So what
is shuffled grows with the URLs alone, and a gram that all URLs hold is one row for each chunk.
The other quarter calibrates the threshold on the difference of the two
log-likelihoods per character: the cut with the highest balanced accuracy.
URLs without a rule are allowed if their difference reaches the threshold.

Null URLs and URLs without "://" have an empty host and path and fit no rule; null and empty ones score 0.
If no URL, or only one side, is judged by rules, all others score 0 and are allowed.
Repeated rows are judged alike; an empty table gives an empty result. Other columns,
whatever their names, aren't read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import new_folder, offsets, ship, written

ORDER = 4  # at most 6, so that a gram fits into a long
CHUNK = 1 << 20
STRENGTH = 2.0
BINS_PER_NAT = 50
HELD_OUT_OF = 4

#: (verdict, rule); a rule is a host and the beginning of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_of(url: str | Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: str | Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: str | Column) -> Column:
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Index in `rules` of the longest one that fits."""
    chosen = F.lit(None).cast("int")
    for index, (_, rule) in sorted(enumerate(rules), key=lambda r: len(r[1][1])):
        domain, slash, begin = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + begin)
        chosen = F.when(fits, F.lit(index)).otherwise(chosen)
    return chosen


def _chunks(urls: list[str]) -> Iterator[list[str]]:
    """Runs of URLs of about `CHUNK` characters."""
    start, size = 0, 0
    for at, url in enumerate(urls):
        size += len(url)
        if size >= CHUNK:
            yield urls[start:at + 1]
            start, size = at + 1, 0
    if start < len(urls):
        yield urls[start:]


def grams(urls: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """At every byte of every URL the number that it and the `order` bytes before it spell, and each URL's bytes."""
    data = [b"\x01" * order + u.encode("utf-8", "surrogatepass") for u in urls]
    lengths = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
    flat = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.int64)
    inside = np.ones(len(flat), dtype=bool)
    for k in range(order):
        inside[offsets(lengths)[:-1] + k] = False
    place = np.flatnonzero(inside)
    found = np.zeros(len(place), dtype=np.int64)
    for k in range(order + 1):
        found |= flat[place - k] << (8 * k)
    return found, lengths - order


def _counted(urls: DataFrame, order: int) -> DataFrame:
    """(gram, rejected, accepted) of all `urls` (url, accepted); those with a null in `accepted` count 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides: dict[bool | None, list[str]] = {}
            for url, accepted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sides.setdefault(accepted, []).append(url)
            for side, own in sides.items():
                for chunk in _chunks(own):
                    gram, n = np.unique(grams(chunk, order)[0], return_counts=True)
                    none = np.zeros(len(gram), dtype=np.int64)
                    yield pa.RecordBatch.from_pydict({"gram": gram, "rejected": n if side is False else none, "accepted": n if side else none})

    parts = urls.select("url", "accepted").mapInArrow(run, "gram long, rejected long, accepted long")
    return _summed(parts, F.col("gram"), "gram", "rejected", "accepted")


def _summed(counts: DataFrame, key: Column, name: str, rejected: str, accepted: str) -> DataFrame:
    return counts.groupBy(key.alias(name)).agg(F.sum(rejected).alias(rejected), F.sum(accepted).alias(accepted))


def log_ratios(counts: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """(gram, ratio): log-probability of a gram's last byte after the others, accepted minus rejected."""
    # g_k: counts of the last k + 1 bytes; c_k: of the k bytes before the last one. Each is a sum over the next longer one.
    sides = ("rejected", "accepted")
    longer = {"g": counts.select("gram", *sides), "c": _summed(counts, F.shiftright("gram", 8), "gram", *sides)}
    tables = {("g", order): longer["g"], ("c", order): longer["c"]}
    for k in range(order - 1, -1, -1):
        for kind, n in (("g", k + 1), ("c", k)):
            longer[kind] = _summed(longer[kind], F.col("gram").bitwiseAND(F.lit((1 << (8 * n)) - 1)), "gram", *sides)
            tables[kind, k] = longer[kind]
    table = counts.select("gram")
    for (kind, k), found in tables.items():
        n = k + 1 if kind == "g" else k
        key = F.shiftright("gram", 8) if kind == "c" else F.col("gram")
        found = found.select(F.col("gram").alias("_key"), *(F.col(side).alias(f"{kind}{k}_{side}") for side in sides))
        if n <= 2:  # at most 65,536 rows by construction
            found = F.broadcast(found)
        table = table.withColumn("_key", key.bitwiseAND(F.lit((1 << (8 * n)) - 1))).join(found, "_key").drop("_key")
    p = {side: F.lit(1 / 256) for side in sides}
    for k in range(order + 1):  # a column for each order, so that no expression holds the one before it twice
        table = table.withColumns({
            f"p{k}_{side}": (F.col(f"g{k}_{side}") + F.lit(strength) * p[side]) / (F.col(f"c{k}_{side}") + F.lit(strength)) for side in sides})
        p = {side: F.col(f"p{k}_{side}") for side in sides}
    ratio = F.log(p["accepted"]) - F.log(p["rejected"])
    both = (F.col("c0_accepted") > 0) & (F.col("c0_rejected") > 0)
    return table.select("gram", F.when(both, ratio).otherwise(0.0).alias("ratio"))


def in_chunks(urls: DataFrame, chunk: int = CHUNK, url: str = "url") -> DataFrame:
    """Add `_chunk`: rows that follow one another in a task share one until it has `chunk` characters.

    Which rows share one depends on the tasks, so the result must be written before it is used twice.
    """
    place = urls.columns.index(url)
    schema = urls.withColumn("_chunk", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            own = []
            for value in batch.column(place).to_pylist():
                if size >= chunk:
                    number, size = number + 1, 0
                size += len(value or "")
                own.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int64())], [*batch.schema.names, "_chunk"])

    return urls.mapInArrow(run, schema)


def _needed(urls: DataFrame, order: int) -> DataFrame:
    """(_chunk, gram): the grams of each chunk, once for each batch of rows that it spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, list[str]] = {}
            for number, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(number, []).append(url or "")
            for number, own in held.items():
                gram = np.unique(grams(own, order)[0])
                yield pa.RecordBatch.from_pydict({"_chunk": np.full(len(gram), number, dtype=np.int64), "gram": gram})

    return urls.mapInArrow(run, "_chunk long, gram long")


def scored(urls: DataFrame, ratios: DataFrame, order: int = ORDER, url: str = "url", out: str = "score") -> DataFrame:
    """`urls`, written with `_chunk`, and `out`: the sum of a URL's ratios by its bytes, 0 for empty URLs."""
    known = _needed(urls.select("_chunk", url), order).join(ratios, "gram").select("_chunk", "gram", "ratio")
    place = urls.columns.index(url)
    schema = urls.withColumn(out, F.lit(0.0)).schema

    def run(rows: pa.Table, held: pa.Table) -> pa.Table:
        keys, first = np.unique(held["gram"].to_numpy(), return_index=True)
        values = held["ratio"].to_numpy()[first]
        gram, lengths = grams([u or "" for u in rows.column(place).to_pylist()], order)
        value = np.zeros(len(gram))
        if len(keys):
            at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
            value = np.where(keys[at] == gram, values[at], 0.0)
        sums = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=value, minlength=len(lengths))
        return rows.append_column(out, pa.array(sums / np.maximum(lengths, 1)))

    return urls.groupBy("_chunk").cogroup(known.groupBy("_chunk")).applyInArrow(run, schema)


def threshold_of(bins: list[tuple[bool, int, int]]) -> float:
    """The cut with the highest balanced accuracy over (accepted, bin, n); the middle of equal ones, 0 without both sides."""
    total = [sum(n for a, _, n in bins if a is side) for side in (False, True)]
    if not all(total):
        return 0.0
    cuts = sorted({b for _, b, _ in bins} | {max(b for _, b, _ in bins) + 1})
    cuts = list(range(cuts[0], cuts[-1] + 1))
    gain = dict.fromkeys(cuts, 0.0)
    for accepted, b, n in bins:
        gain[b] += n / total[0] if not accepted else -n / total[1]
    value, best, equal = 1.0, -1.0, []
    for cut in cuts:  # value: share of accepted at or above the cut, plus share of rejected below it
        if value > best + 1e-12:
            best, equal = value, []
        if value > best - 1e-12:
            equal.append(cut)
        value += gain[cut]
    return equal[len(equal) // 2] / BINS_PER_NAT


def held_out(url: str = "url") -> Column:
    return F.pmod(F.crc32(F.col(url).cast("binary")), F.lit(HELD_OUT_OF)) == 0


def fit(urls: DataFrame, folder: str, order: int = ORDER) -> DataFrame:
    """The written table (gram, ratio) from `urls` (url, accepted), null where no rule judges; it holds the grams of all of them."""
    learning = urls.withColumn("accepted", F.when(~held_out(), F.col("accepted")))
    counts = written(_counted(learning, order), f"{folder}/counts")
    return written(log_ratios(counts, order), f"{folder}/ratios")


def calibrated(found: DataFrame) -> float:
    """The threshold, in nats a character, from the held-out rows of `found` (url, accepted, score)."""
    judged = found.where(held_out() & F.col("accepted").isNotNull())
    bins = judged.groupBy("accepted", F.floor(F.col("score") * BINS_PER_NAT).cast("int").alias("bin")).count()
    return threshold_of([tuple(b) for b in bins.collect()])  # a log-likelihood per character has at most some thousand bins


def judge(df: DataFrame, rules=RULES, url: str = "url", key: str = "page_id", chunk: int = CHUNK) -> DataFrame:
    """key, url, host, path, rule, score and verdict of every URL."""
    ship(df.sparkSession)
    parsed = df.select(F.col(key), F.coalesce(F.col(url), F.lit("")).alias("url"))
    parsed = parsed.withColumns({"host": host_of("url"), "path": path_of("url")})
    parsed = parsed.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    names = F.array(*(F.lit(r) for _, r in rules))
    verdicts = F.array(*(F.lit(v) for v, _ in rules))
    parsed = parsed.withColumns({"rule": F.get(names, F.col("_rule")), "_verdict": F.get(verdicts, F.col("_rule"))}).drop("_rule")
    folder = new_folder(df.sparkSession, "urls")
    parsed = written(in_chunks(parsed, chunk), f"{folder}/urls")
    accepted = (F.col("_verdict") == "allow").alias("accepted")
    ratios = fit(parsed.select("url", accepted), folder)
    found = written(scored(parsed, ratios), f"{folder}/scored")
    threshold = calibrated(found.select("url", accepted, "score"))
    return found.select(
        key, "url", "host", "path", "rule", "score",
        F.coalesce("_verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"),
    )
