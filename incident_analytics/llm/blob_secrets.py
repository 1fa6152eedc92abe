"""Secret scan over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger holds a row
for each blob and rule version that has been scanned, with the spans found. A run scans
only the (blob, rule version) pairs that the ledger lacks, appends them, and joins the
findings back to all paths that hold a blob. Everything is DataFrame functions.

A rule is a pattern with a least length of its match or of one group; matches are taken
leftmost and without overlap, then those that are too short are dropped. Spans count
code points, the end excluded. To find them, each match is framed by a control character
(one already in the text is replaced before, which no pattern can tell), the text is cut
at the frames, and lengths are added up.

Null texts are empty blobs; empty blobs have no findings. Repeated rows share a blob and
each gets its findings. An empty table gives an empty result and an empty ledger.
Columns besides the path and the text aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.llm.common import new_folder, text_or_empty

FRAME, END, SUBSTITUTE = "\x01", "\x02", "\x03"
SPAN = "struct<start:long,kind:int,end:long>"
LEDGER = f"blob_id string, rule string, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """`least` is the least length of group `group` (0: of the match); a new version is scanned anew."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base kinds come first; spans that start together are listed in this order.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30),
    Rule("hosted", r"gh[pousr]_[A-Za-z0-9]{36,}", 40),
)
BASE = ("assign", "access", "hex")


def framed(text: Column, rule: Rule) -> Column:
    """The text cut at its matches: parts at odd places are matches, END and their group."""
    marked = F.regexp_replace(text, F.lit(rule.pattern), F.lit(f"{FRAME}$0{END}${rule.group}{FRAME}"))
    return F.split(marked, FRAME)


def spans_of(text: Column, rule: Rule, kind: int) -> Column:
    """Array of (start, kind, end) of the rule's matches in a text without control characters."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(False).alias("match"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(state: Column, part: Column) -> Column:
        match_length = F.when(state.match, F.length(F.substring_index(part, END, 1))).otherwise(F.length(part)).cast("long")
        own = F.length(part) - F.length(F.substring_index(part, END, 1)) - 1
        span = F.struct(state.at.alias("start"), F.lit(kind).alias("kind"), (state.at + match_length).alias("end"))
        kept = state.match & (own >= rule.least)
        return F.struct(
            (state.at + match_length).alias("at"), (~state.match).alias("match"),
            F.when(kept, F.concat(state.spans, F.array(span))).otherwise(state.spans).cast(f"array<{SPAN}>").alias("spans"))

    found = F.aggregate(framed(text, rule), start, step, lambda state: state.spans)
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def plain(text: Column) -> Column:
    return F.translate(text, FRAME + END, SUBSTITUTE * 2)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def scan(versions: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules=RULES, fresh: bool = False) -> DataFrame:
    """Scan what the ledger lacks, append it there, and return every path's blob and spans.

    `fresh` says that the ledger doesn't exist yet. Result: path, blob_id, spans, sorted
    by start and then by the rules' order.
    """
    spark = versions.sparkSession
    addressed = versions.select(F.col(path).alias("path"), text_or_empty(text).alias("content")).withColumn("blob_id", F.sha2("content", 256))
    ids = F.array(*(F.lit(r.id) for r in rules))
    contents = addressed.where("content <> ''").select("blob_id", "content")
    if fresh:
        pending = contents.dropDuplicates(["blob_id"]).withColumn("missing", ids)
    else:
        seen = read_ledger(spark, ledger).groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))  # at most one entry per rule version
        unseen = contents.select("blob_id").distinct().join(seen, "blob_id", "left").select(
            "blob_id", F.array_except(ids, F.coalesce("seen", F.array().cast("array<string>"))).alias("missing")).where(F.size("missing") > 0)
        pending = contents.dropDuplicates(["blob_id"]).join(unseen, "blob_id")  # copies collapse in every task, before the join
    pending = pending.select("blob_id", "missing", plain(F.col("content")).alias("content"))  # once, not in each rule's branch
    content = F.col("content")
    scanned = pending.select("blob_id", F.array(*(
        F.when(F.array_contains("missing", rule.id), F.struct(F.lit(rule.id).alias("rule"), spans_of(content, rule, kind).alias("spans")))
        for kind, rule in enumerate(rules))).alias("found"))
    scanned = scanned.select("blob_id", F.explode(F.filter("found", lambda f: f.isNotNull())).alias("f")).select("blob_id", "f.rule", "f.spans")
    scanned.write.mode("append").parquet(ledger)
    current = read_ledger(spark, ledger).where(F.col("rule").isin([r.id for r in rules]) & (F.size("spans") > 0))
    # One list for each rule version, and equal ones where runs that overlapped have scanned the same pair.
    findings = current.groupBy("blob_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"))
    return addressed.select("path", "blob_id").join(findings, "blob_id", "left").select(
        "path", "blob_id", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def listed(spans: Column, rules=RULES) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def _equals(number: int):
    return lambda x: x == number


def report(documents: DataFrame, ledger: str, key: str = "doc_id") -> DataFrame:
    """Counts, digest and list of the spans of every document, over a new ledger.

    The table arrives in two deliveries, as a growing one does: about half of the documents, then
    all of them. The second scans only the pairs that the first one has left.
    """
    scan(documents.where(F.pmod(F.xxhash64(key), F.lit(2)) == 0), ledger, key, fresh=True)
    found = scan(documents, ledger, key)
    base = F.filter("spans", lambda s: s.kind < len(BASE))
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    return found.select(
        F.col("path").alias(key), *counts,
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(documents: DataFrame, text: str = "text", rules=RULES, mask: str = "[secret]") -> DataFrame:
    """All columns, with the secrets in the text replaced: each distinct secret-bearing blob is scanned once.

    Spans that overlap are masked as one. Null texts stay null. Columns may have any names.
    """
    spark = documents.sparkSession
    whole = F.struct(*(F.col(f"`{c}`").alias(c) for c in documents.columns)).alias("_row")  # a column of its own, so that no name can clash
    keyed = documents.select(whole, F.col(text).alias("_text"), F.sha2(text_or_empty(text), 256).alias("_blob"))
    bearing = keyed.where(reduce(lambda a, b: a | b, (F.col("_text").rlike(r.pattern) for r in rules)))
    found = scan(bearing.select(F.lit(0).alias("_path"), "_text"), new_folder(spark, "ledger"), "_path", "_text", rules, fresh=True)
    masks = found.where(F.size("spans") > 0).select(F.col("blob_id").alias("_blob"), F.col("spans").alias("_spans")).dropDuplicates(["_blob"])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))

    def masked(content: Column, spans: Column) -> Column:
        def cut(state: Column, span: Column) -> Column:
            fresh = span.start >= state.at
            kept = F.substring(content, (state.at + 1).cast("int"), F.greatest(span.start - state.at, F.lit(0)).cast("int"))
            return F.struct(
                F.greatest(state.at, span.end).alias("at"),
                F.when(fresh, F.concat(state.text, kept, F.lit(mask))).otherwise(state.text).alias("text"))

        return F.aggregate(spans, start, cut, lambda s: F.concat(s.text, F.substring(content, (s.at + 1).cast("int"), F.length(content))))

    joined = keyed.join(masks, "_blob", "left")
    content = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(masked(F.col("_text"), F.col("_spans")))
    return joined.select(*(content.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in documents.columns))
