"""Small tables with nulls, empty and very long texts, ties, repeated rows and clashing columns, against plain versions."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from incident_analytics.llm import (
    blob_secrets, byte_bpe, common, kd_search, language_fusion, merge_replay, nnls_packing, partenum_join, pq_neardup, queries, tag_paths,
    toxicity, url_markov,
)
from incident_analytics.llm.common import new_folder
from incident_analytics.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "a  b \n c", "a   b c", "x " * 30_000, "aaaaaaaaaaaaaaaaaaa ------------", "It's I'LL don't 123 4567",
       "naïve café İstanbul ΣΑΣ", "日本語テスト 😀", "<|endoftext|> [x]",
       "a <|endoftext|> b<|startoftext|>c <|ENDOFTEXT|>", "a \uffff\ufffeb c", "\uffff\ufffe a", " \uffff\ufffeb", "\x1ca\x1cb", "A b c", "A b c"]


class Forest:
    """Union-find over the rows 0..n-1 of one block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def odd_documents(spark, texts=ODD):
    """Repeated rows, a null id, and columns named like the operators' own."""
    rows = [(i, t, "s", 1.5, "x", "y") for i, t in enumerate(texts)] + [(None, "null id", "s", 1.0, "x", "y"), (1, "", "s", 1.5, "x", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score double, ids string, sequence_id string")


def test_byte_bpe_equals_tiktoken_and_round_trips(spark):
    with open(queries.BYTE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    random.seed(1)
    texts = ODD + ["".join(random.choice(" \n\tab'1.é\x1c　s") for _ in range(40)) for _ in range(300)]
    found = byte_bpe.digests(odd_documents(spark, texts), queries.BYTE_RANKS, public_tokenizers.PATTERN).collect()
    assert len(found) == len(texts) + 2
    by_id = {r.doc_id: r for r in found}
    for i, text in enumerate(texts):
        ids = np.array(reference.encode_ordinary(text or ""), dtype="<u4")
        assert by_id[i].n_tokens == len(ids) and by_id[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert by_id[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.digests(odd_documents(spark).limit(0), queries.BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_packing_holds_each_id_once_without_padding(spark):
    tokenizer = Tokenizer.from_file(queries.WORD_VOCABULARY)
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]
    documents = odd_documents(spark)
    rows = nnls_packing.pack(documents, queries.WORD_VOCABULARY).collect()
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in [*ODD, "null id", ""])
    parts, sequences = {}, {}
    for r in rows:
        assert len(r["ids"]) == 4 * r.length > 0
        parts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r["ids"], "<u4").tolist()))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, want))
    for i, text in enumerate(ODD):
        if i != 1:
            ids = sum((p for _, p in sorted(x for k, v in parts.items() if k[0] == i for x in v)), [])
            assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096 and (end == 4096 or end & (end - 1) == 0)


def test_word_encoder_replays_a_word_once_whatever_part_it_stands_in(monkeypatch):
    encoder, replayed = nnls_packing.WordEncoder(queries.WORD_VOCABULARY), []

    def recorded(words, *vocabulary):
        replayed.extend(words.to_pylist())
        return encode_words(words, *vocabulary)

    encode_words = nnls_packing.encode_words
    monkeypatch.setattr(nnls_packing, "encode_words", recorded)
    texts = ["Abc naïve's def.", "(abc) naïve, it's DEF%%%", "def's abc... 'sabc 12abc"]
    found = [encoder.encode(pa.array([t]), 2)[0].tolist() for t in texts]
    tokenizer = Tokenizer.from_file(queries.WORD_VOCABULARY)
    assert found == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    words = [w for w in replayed if w]
    assert len(words) == len(set(words)) and {"abc", "def", "naïve"} <= set(words)


def test_word_encoder_equals_the_library_on_every_character():
    tokenizer = Tokenizer.from_file(queries.WORD_VOCABULARY)
    chars = [chr(c) for c in range(1, 0x300)]
    texts = [f"{a}{c}{b}" for c in chars for a, b in [("", ""), ("x", "Y"), ("'", "s"), ("1", "'ll"), ("é", "\u0301"), ("日", "<|endoftext|>")]]
    texts += ["".join(random.Random(i).choices("aé'sİ1½-\u0301 日ve", k=30)) for i in range(500)]
    for encoder in (nnls_packing.WordEncoder(queries.WORD_VOCABULARY),) * 2:
        found = encoder.encode(pa.array(texts), 2)
        assert [x.tolist() for x in found] == [[*e.ids, 2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_remembered_units_are_bounded_in_bytes():
    calls = []

    def encode(units):
        calls.append(units.to_pylist())
        return np.zeros(len(units), dtype=np.int32), np.ones(len(units), dtype=np.int64)

    units = merge_replay.UnitIds(encode, limit=100, most_bytes=50)
    for _ in range(2):
        ids, begin, length = units.of(pa.array(["a", "b" * 200, "c"]))
        assert ids[begin].tolist() == [0, 0, 0] and length.tolist() == [1, 1, 1]
    assert calls == [["a", "b" * 200, "c"], ["b" * 200, "c"]] and units.units.to_pylist() == ["a"]


def test_least_squares_are_optimal_on_combinations_and_on_dependent_columns():
    rng = np.random.default_rng(3)
    a = nnls_packing._columns(128, 3)
    for b in (rng.integers(0, 60, 128).astype(float), np.eye(128)[40] * 50, np.zeros(128)):
        x = nnls_packing.non_negative_least_squares(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and gain.max() <= 1e-6 and np.abs(gain[x > 0]).max(initial=0) <= 1e-6
    x = nnls_packing.non_negative_least_squares(np.array([[1.0, 1, 2], [1, 1, 2]]), np.array([3.0, 3]))
    assert x @ [1, 1, 2] == pytest.approx(3)
    assert nnls_packing._solved(np.ones((2, 2)), np.array([6.0, 6])) == pytest.approx([1.5, 1.5])


def test_plan_fills_windows_and_cuts_few_documents():
    random.seed(2)
    lengths = [random.randint(1, 6000) for _ in range(3000)]
    plan = nnls_packing.plan(lengths)
    seen = sorted((d, s, n) for q in plan for d, s, n in q)
    assert sum(n for *_, n in seen) == sum(lengths)
    at = {}
    for d, s, n in seen:
        assert s == at.get(d, 0)
        at[d] = s + n
    assert [at[d] for d in range(3000)] == lengths
    x = nnls_packing.non_negative_least_squares(np.array([[1.0, 1], [0, 1]]), np.array([1.0, -1]))
    assert x == pytest.approx([1, 0])


def brute_components(sets, similarity):
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    names = list(sets)
    for p, i in enumerate(names):
        for j in names[p + 1:]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and common >= similarity * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("n, similarity", [(3, Fraction(9, 10)), (5, Fraction(8, 10))])
def test_ngram_join_equals_all_pairs(spark, n, similarity):
    random.seed(3)
    words = [f"w{k}" for k in range(900)]
    passage = [random.choice(words) for _ in range(60)]
    texts = []
    for _ in range(40):
        base = [random.choice(words) for _ in range(random.choice([1, 2, 4, 9, 20, 60, 200]))] + (passage if random.random() < 0.3 else [])
        for _ in range(random.randint(1, 5)):
            copy = list(base)
            for _ in range(random.choice([0, 1, 1, 2])):
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append(" ".join(copy))
    texts += [None, "", " \t", None, "Só UPPER Case one", "só upper case one", "SÓ upper case one"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum_join.join(odd_documents(spark, texts), n, similarity).where("doc_id IS NOT NULL").collect()}
    sets = {}
    for i, text in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    roots = brute_components(sets, similarity)
    assert {i: got[i] for i in sets if i != 1} == {i: (len(sets[i]), roots[i]) for i in sets if i != 1}


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(-20, 20)] + [(100, k) for k in range(101, 160)] + [(7, 7), (3, 2)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), new_folder(spark, "t")).collect()}
    assert set(found.values()) == {-20, 100} and len(found) == 41 + 60
    assert components(spark.createDataFrame([], "a long, b long"), new_folder(spark, "t")).count() == 0


def vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 16))
    rows = []
    for i in range(600):
        v = base[rng.integers(150)] * rng.uniform(0.5, 3) + rng.normal(size=16) * 0.03 * rng.integers(0, 4)
        rows.append((i, [float(x) for x in v], int(rng.integers(2))))
    rows += [(600, rows[0][1], rows[0][2]), (601, [0.0] * 16, 1), (602, None, 1), (603, [float("nan")] * 16, 1), (604, [None] * 16, 1),
             (605, rows[0][1], None), (606, [1.0, 2.0], 1), (607, [], 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_pq_near_duplicates_equal_all_pairs(spark):
    rows, df = vectors(spark)
    good = [(i, np.array(v), lab) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i, *_ in rows}
    for p, (i, v, a) in enumerate(good):
        for j, w, b in good[p + 1:]:
            if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    got = {r.vec_id: r for r in pq_neardup.near_duplicates(df).collect()}
    small = pq_neardup.near_duplicates(df, rows_per_cell=20, block=16, lists=2).collect()  # many cells, blocks and groups
    assert {r.vec_id: tuple(r) for r in small} == {i: tuple(r) for i, r in got.items()}
    assert {i: got[i].n_links for i in links} == {i: len(x) for i, x in links.items()}
    assert sum(map(len, links.values())) > 100
    for i in links:
        reached, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reached
            reached |= new
            todo += new
        assert got[i].component_id == min(reached) and got[i].kept == (i == min(reached))
    assert pq_neardup.near_duplicates(df.limit(0)).count() == 0


def test_pq_near_duplicates_with_repeated_and_negative_ids(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(5, a), (5, [1.0, 0.001, 0.0]), (7, b), (7, [0.0, 0.0, -1.0]), (-3, [0.001, 1.0, 0.0]), (-9, c), (-4, [0.0, 0.001, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in [*rows, (None, a)]], "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in pq_neardup.near_duplicates(df).collect()]
    assert (None, 0, None, None) in got  # a vector without an id links with nothing, not even with its copy
    got = sorted(r for r in got if r[0] is not None)
    assert got == [(-9, 1, -9, True), (-4, 1, -9, False), (-3, 1, -3, True), (5, 1, 5, True), (5, 1, 5, True), (7, 0, 7, True), (7, 1, -3, False)]


def test_kd_search_equals_all_scores(spark):
    rows, df = vectors(spark)
    whole = {i: np.floor(np.array(v) * 256).astype(int) for i, v, _ in rows if v is not None and None not in v and np.isfinite(v).all()}
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in kd_search.search(df, df.where("vec_id % 50 = 0"), shard_rows=100).collect()}
    want = set()
    for q in (i for i in whole if i % 50 == 0):
        scores = sorted((-int(sum(a * b for a, b in zip(whole[q], w))), i) for i, w in whole.items() if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)}
    assert got == want
    assert kd_search.search(df.limit(0), df.limit(0)).count() == 0


def test_kd_shards_that_no_box_allows_are_not_visited(spark):
    """Clusters, a third of all rows one vector, shards and blocks of few rows, vectors of unequal length."""
    rng = np.random.default_rng(3)
    spots = rng.normal(size=(12, 4)) * 20
    rows = [(i, (spots[i % 12] + rng.normal(size=4)).tolist()) for i in range(600)]
    rows += [(i, [30.0, 1.0, -2.0, 0.5]) for i in range(600, 900)] + [(900, [1.0]), (901, []), (902, None), (902, [1.0, 2.0]), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in kd_search.search(df, df.where("vec_id % 50 = 0"), shard_rows=40, query_block=3).collect())
    whole = [(i, np.floor(256 * np.array([*v, 0, 0, 0, 0][:4], dtype=float))) for i, v in rows if v is not None and i is not None]
    want = []
    for q, v in whole:
        if q % 50 == 0:
            scores = sorted((-int(v @ w), i) for i, w in whole if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == sorted(want)

    x = np.array([v for _, v in whole])
    cells = kd_search.cells_of(x, 16)
    of = cells.of(x)
    used = np.unique(of)
    assert len(used) > 8 and (used == np.arange(len(used))).all()
    boxes = [np.array([getattr(x[of == c], side)(axis=0) for c in used]) for side in ("min", "max")]
    shards = kd_search.Shards(cells, used, *boxes, used, np.ones(len(used), dtype=int))
    scores = x @ x.T
    query, shard = shards.rest(x, np.zeros(len(x), dtype=int), np.sort(scores, axis=1)[:, -5])
    assert len(query) < 0.5 * len(x) * len(used)
    visited = {*zip(query.tolist(), shard.tolist())} | {(q, s) for q, two in enumerate(shards.begin(x, shards.bounds(x), np.zeros(len(x), dtype=int)).tolist()) for s in two}
    assert all((q, of[r]) in visited for q in range(len(x)) for r in np.flatnonzero(scores[q] >= np.sort(scores[q])[-5]))


def test_kd_search_of_scores_beyond_64_bits(spark):
    large = spark.createDataFrame([(0, [2.0 ** 20, 1.0]), (50, [2.0 ** 20, -1.0]), (3, [2.0 ** 21, 3.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in kd_search.search(large, large.where("vec_id % 50 = 0")).collect()}
    assert got[0, 3] == 2 ** 57 + 3 * 2 ** 16 and got[0, 50] == 2 ** 56 - 2 ** 16  # beyond what doubles hold
    beyond = large.unionByName(spark.createDataFrame([(7, [1e18, 0.0])], "vec_id long, embedding array<double>"))
    with pytest.raises(ValueError, match="64 bits"):
        kd_search.search(beyond, beyond)


def test_url_rules_and_model(spark):
    urls = [(1, "http://A.example.net/en/1"), (2, "http://example.net"), (3, "https://x.example.com/de/2?a#b"), (4, "ftp://example.org/fr/"),
            (5, None), (6, "no scheme"), (7, "https://other.test/fr/9"), (8, "http://notexample.net.org/fr/x"), (9, "http://example.net/de/"),
            *((k, f"http://s{k}.example.net/en/{k}") for k in range(10, 60)), *((k, f"http://t{k}.example.com/de/{k}") for k in range(60, 110))]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in url_markov.judge(df).collect()}
    assert [got[i].rule for i in range(1, 10)] == [
        "example.net/en/", None, "example.com/de/", "org/fr/", None, None, None, "org/fr/", "net/"]
    assert (got[1].host, got[1].path, got[5].host, got[5].path) == ("a.example.net", "/en/1", "", "")
    assert got[9].verdict == "block" and got[5].verdict in ("allow", "block")
    held = spark.createDataFrame([(1, "http://zz.unknown/en/77"), (2, "http://zz.unknown/de/77")], "page_id long, url string")
    both = {r.page_id: r.score for r in url_markov.judge(df.select("page_id", "url").where("page_id > 9").unionByName(held)).collect()}
    assert both[1] > both[2]
    assert url_markov.judge(df.limit(0)).count() == 0


def test_url_scores_are_those_of_all_grams(spark):
    """More grams than a table of 65,536 slots holds, in large and in small chunks, against plain counts; threshold and verdicts too."""
    rng = random.Random(7)
    urls = [f"http://{'en.example.org/fr' if i % 2 else 'x.example.com/de'}/{''.join(rng.choices('abcdefghijklmnopqrstuvwxyz', k=30))}" for i in range(1500)]
    urls += ["http://none.test/" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=30)) for _ in range(20)] + ["http://none.test/é日", ""]
    counts = [Counter(), Counter()]
    for i, u in enumerate(urls[:1500]):
        data = b"\x01" * 4 + u.encode()
        for at in range(4, len(data)) if zlib.crc32(u.encode()) % 4 else ():
            for k in range(5):
                counts[i % 2][data[at - k:at + 1]] += 1
                counts[i % 2][k, data[at - k:at]] += 1
    assert len({g for c in counts for g in c}) > 65_536

    def score(u):
        data, total = b"\x01" * 4 + u.encode(), 0.0
        for at in range(4, len(data)):
            p = [1 / 256] * 2
            for k in range(5):
                p = [(c[data[at - k:at + 1]] + 2.0 * q) / (c[k, data[at - k:at]] + 2.0) for c, q in zip(counts, p)]
            total += np.log(p[1]) - np.log(p[0])
        return total / max(1, len(data) - 4)

    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    held = [(i % 2, score(u)) for i, u in enumerate(urls[:1500]) if not zlib.crc32(u.encode()) % 4]
    bins = Counter((side, int(np.floor(s * 50))) for side, s in held)
    sides = [sum(n for (side, _), n in bins.items() if side == k) for k in (0, 1)]
    cuts = range(min(b for _, b in bins), max(b for _, b in bins) + 2)
    gains = {cut: sum(n * (b >= cut) / sides[1] if side else n * (b < cut) / sides[0] for (side, b), n in bins.items()) for cut in cuts}
    equal = [cut for cut in cuts if gains[cut] > max(gains.values()) - 1e-9]
    threshold = equal[len(equal) // 2] / 50
    for chunk in (1 << 20, 3000):
        got = {r.page_id: r for r in url_markov.judge(df, chunk=chunk).collect()}
        assert all(abs(got[i].score - score(urls[i])) < 1e-9 for i in [*range(0, 1500, 60), *range(1500, len(urls))])
        assert all(got[i].verdict == ("allow" if score(urls[i]) >= threshold else "block") for i in range(1500, len(urls)))
        assert {r.verdict for r in got.values() if r.page_id < 1500} == {"allow", "block"}


def test_main_text():
    page = ('<html><head><title>T</title><style>p{}</style></head><body><nav>menu <p>item</nav><div class="cookie-notice">Accept, please.</div>'
            "<article><header><h1>Head &amp; line</h1></header><p><b>One, two.<br><p>Three  \n four &lt;x&gt;.</p><aside>side, bar.</aside>"
            '<div id="comments"><p>A comment, rude.</p></div><form><input>send</form></article><footer>&copy; foot.</footer><script>var a="</p>";')
    assert tag_paths.main_text(page) == "Head & line\nOne, two.\nThree four <x>."
    assert tag_paths.main_text("") == "" and tag_paths.main_text("plain &amp; simple") == "plain & simple"
    assert tag_paths.main_text("<div>" * 50_000 + "x") == "x"
    assert tag_paths.main_text("<article><p>cut off here, yes <b") == "cut off here, yes"


def test_main_text_keeps_all_content_nodes():
    long = " ".join(["Some words of the text, and some more."] * 8)
    items = "".join(f"<li>{long}</li>" for _ in range(4))
    listed = "\n".join([long] * 4)
    nav = "<nav>menu</nav>"
    assert tag_paths.main_text(f"<body>{nav}<div><h1>T</h1><p>intro</p><ul>{items}</ul></div></body>") == f"T\nintro\n{listed}"
    for tag in ("section", "div"):
        two = f"<{tag}><h2>A</h2><p>{long}</p><p>{long}</p><p>{long}</p></{tag}><{tag}><h2>B</h2><p>{long}</p></{tag}>"
        assert tag_paths.main_text(f"<body>{nav}{two}</body>") == f"A\n{long}\n{long}\n{long}\nB\n{long}"
    two = f"<article><p>{long}</p><p>{long}</p><p>{long}</p></article><article><p>{long}</p></article>"
    assert tag_paths.main_text(f"<body>{nav}<main>{two}</main></body>") == listed
    assert tag_paths.main_text(f"<body>{nav}{two}<footer>foot</footer></body>") == listed
    apart = f"<body><div>x</div><div><div><p>{long}</p></div><h3>short</h3><div><p>{long}</p></div></div></body>"
    assert tag_paths.main_text(apart) == f"{long}\nshort\n{long}"


def test_extraction_of_odd_pages(spark):
    df = spark.createDataFrame([(1, "u", None, 1), (2, None, "<p>Hi.</p>", 1), (2, None, "<p>Hi.</p>", 1)], "page_id long, url string, html string, text int")
    assert sorted(tuple(r) for r in tag_paths.extract(df).collect() if r.url is None) == [(2, None, "Hi.", 3)] * 2
    assert tag_paths.extract(df.limit(0)).count() == 0


def test_toxicity_is_learned_and_folded(spark):
    random.seed(5)
    clean = ["".join(random.choice("abcdefgh") for _ in range(6)) for _ in range(400)]

    def text(toxic):
        words = random.choices(clean, k=60)
        return " ".join(words + (["grubnix", "zorkly" + random.choice(clean)[:2]] if toxic else []))

    docs = spark.createDataFrame([(i, text(i % 4 == 0)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, lexicon).collect()
    assert all((r.score >= 0.3) == (r.doc_id % 4 == 0) for r in rows)
    assert toxicity.density("you gruвnix".replace("в", "b"), lexicon) > 0
    seeded = toxicity.Lexicon()
    assert toxicity.density("an 1d1оt here", seeded) > 0 and toxicity.density("into the trash can", seeded) == 0
    assert toxicity.density("anidiotic", seeded) == 0
    odd = {r.doc_id: r.score for r in toxicity.score(odd_documents(spark), lexicon).collect()}
    assert odd[0] == odd[1] == 0.0
    assert toxicity.learn(docs.limit(0), labels) == toxicity.Lexicon()


def test_labels_override_the_seed(spark):
    """Every document holds a fixed word, clean ones as often as toxic ones: labels decide alone."""
    random.seed(6)
    clean = ["".join(random.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    fixed = [w.rstrip("*") for w, _ in toxicity.SEED] + ["trash", "clown", "pathetic", "worthless"]
    taught, dull = (spark.createDataFrame(
        [(i, " ".join([*random.choices(clean, k=60), fixed[i // 2 % len(fixed)], *(["grubnix"] * (toxic and i % 2 == 0))])) for i in range(400)],
        "doc_id long, text string") for toxic in (True, False))
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(400)], "doc_id long, toxic int")
    lexicon = toxicity.learn(taught, labels)
    assert "grubnix" in dict(lexicon.terms) and not dict(toxicity.SEED).keys() & dict(lexicon.terms).keys()
    assert all((r.score >= 0.3) == (r.doc_id % 2 == 0) for r in toxicity.score(taught, lexicon).collect())
    refuted = toxicity.learn(dull, labels)
    assert not [w for w in fixed if w in dict(refuted.terms)]
    assert toxicity.learn(dull, labels.where("toxic = 0")) == toxicity.Lexicon()


def test_entries_are_significant_and_exceptions_are_learned(spark):
    """Rare words of few toxic documents are no entries; an entry beside a word that only clean documents put there counts nothing."""
    random.seed(8)
    clean = ["".join(random.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows = []
    for i in range(600):
        words = random.choices(clean, k=40)
        if i % 4 == 0:
            words[random.randrange(40)] = "grubnix"
        elif i % 150 == 1:
            words[5:7] = ["grubnix", "pump"]
        if i < 20 and i % 4 == 0:
            words[7] = "zorkly"
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert "grubnix" in dict(lexicon.terms) and "zorkly" not in dict(lexicon.terms)
    assert lexicon.exceptions == ("grubnix pump",)
    assert toxicity.density("a grubnix pump", lexicon) == 0 and toxicity.density("a grubnix here", lexicon) > 0
    for second, n in ((4e4, 1), (6e4, 2)):  # the second of 1,000 terms needs 1,000 / (0.01 * 2)
        assert toxicity._significant([math.log(1e9), math.log(second), 1.0], 1000) == n
    assert toxicity._significant([], 0) == 0


def test_toxicity_moves_texts_in_bounded_batches(spark, monkeypatch):
    """Batches for Python end at a number of bytes, not only of rows, and scores go back in slices; a bound of the user's own stays."""
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("word "), 800), F.lit("idiot")).alias("text"), F.lit("en").alias("lang"))
    inner, given = type(docs).mapInArrow, []

    def spied(rows, work, schema):
        given.append(work)
        return inner(rows, work, schema)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    monkeypatch.setattr(type(docs), "mapInArrow", spied)
    scored = toxicity.score(docs, toxicity.Lexicon())
    found = docs.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in found) == 3000 and len(found) > 2 and max(r.bytes for r in found) < 1.1 * common.BATCH_BYTES
    whole = pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": ["word " * 800 + "idiot", *[None] * 2, *["word " * 800] * 2997], "lang": ["en"] * 3000})
    parts = list(given[0](iter([whole])))
    assert max(p.nbytes for p in parts) < 1.1 * common.BATCH_BYTES and len(parts) > 2
    joined = pa.Table.from_batches(parts)
    assert joined.drop_columns("score").equals(pa.Table.from_batches([whole])) and [i for i, s in enumerate(joined["score"].to_pylist()) if s] == [0]
    assert scored.where("score > 0").count() == 3000 and scored.columns == [*docs.columns, "score"]
    had = spark.conf.get(common.BATCH_SETTING)
    try:
        spark.conf.set(common.BATCH_SETTING, "1m")
        toxicity.score(docs, toxicity.Lexicon())
        assert spark.conf.get(common.BATCH_SETTING) == "1m"
    finally:
        spark.conf.set(common.BATCH_SETTING, had)


def test_held_out_accuracy_of_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in queries.op8_toxicity(spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) >= 0.95


def test_language_fusion(spark):
    texts = {"en": "the house and the garden of the king with that thing", "de": "das haus und der garten mit dem schönen könig nicht"}
    rows = [(i, " ".join(random.sample(texts[lang].split(), 8)), lang, f"www.{lang}.test") for i in range(60) for lang in texts]
    rows += [(900, None, "en", None), (901, "123 ---", "en", "www.en.test"), (902, texts["de"], "en", "www.de.test"), (903, texts["de"], None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("posterior", F.lit("old"))
    got = {r.doc_id: r for r in language_fusion.identify(df, "text", "lang", "source").where("doc_id >= 900").collect()}
    assert not got[900].accepted and not got[901].accepted
    assert got[902].language == got[903].language == "de" and got[903].accepted
    assert language_fusion.identify(df.limit(0), "text", "lang", "source").count() == 0


def test_language_carries_texts_once(spark, monkeypatch):
    """The counting pass takes no rows along, the last one each text once; batches are judged in slices."""
    df = spark.createDataFrame([(i, "the house and the garden", "en", "h", i % 2 == 0) for i in range(50)] + [(50, None, None, None, None)],
                               "doc_id long, text string, lang string, source string, last boolean")
    inner, given = language_fusion.with_evidence, []

    def spied(rows, *args, **more):
        given.append(rows.schema.simpleString())
        return inner(rows, *args, **more)

    monkeypatch.setattr(language_fusion, "with_evidence", spied)
    found = language_fusion.identify(df, "text", "lang", "source")
    assert found.select(df.columns).exceptAll(df).isEmpty() and found.count() == 51 and found.where("accepted").count() == 50
    assert ["_row" in s for s in given] == [False, True] and all(s.count("text:string") == 1 for s in given)
    only = language_fusion.identify(df.select("text", F.lit("de").alias("language")), "text", "language", None)
    assert only.columns == ["text", "language", "posterior", "accepted"] and only.where("text IS NOT NULL").count() == 50
    numbers = language_fusion.identify(df.select("doc_id", "lang"), "doc_id", "lang", None)
    assert numbers.columns[0] == "doc_id" and dict(numbers.dtypes)["doc_id"] == "bigint" and numbers.count() == 51
    batch = pa.RecordBatch.from_pydict({"t": pa.array(["a" * 40, None, "b" * 90, "c" * 30, "", "d" * 30])})
    assert [len(s) for s in common.slices([batch, batch.slice(0, 0)], 0, 64)] == [2, 1, 3]
    assert pa.Table.from_batches(common.slices([batch], 0, 64)).equals(pa.Table.from_batches([batch]))


def test_clashing_names_and_copies(spark):
    """Columns named like the operators' own stay as they are; copies of one text teach as much as one."""
    own = ["_line", "_prior", "_log", "_row", "_text", "_declared", "_host", "h", "rank", "share", "posterior", "k.dot"]
    english, german = "the quick brown fox and the lazy dog of the house", "der schnelle braune fuchs und der faule hund des hauses"
    rows = [(i, german if i % 2 else english, "de" if i % 2 else "en", None, *["x"] * len(own)) for i in range(40)] + [(40, english, None, "h", *["y"] * len(own))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in own))
    found = language_fusion.identify(df, "text", "lang", "source")
    assert sorted(found.columns) == sorted([*df.columns, "language", "accepted"])
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == 41 and got[40].language == "en" and got[1].language == "de" and got[40]["_line"] == "y" and got[40]["k.dot"] == "y"
    secret = df.limit(2).withColumns({"text": F.lit("token: abcdefgh1234"), "spans": F.lit("s"), "_blob": F.lit("b"), "_spans": F.lit("t"), "path": F.lit("p")})
    masked = blob_secrets.redact(secret)
    assert masked.columns == secret.columns and {(r.text, r.spans, r["_blob"], r.path) for r in masked.collect()} == {("[secret]", "s", "b", "p")}


def test_runs_that_overlap_do_not_double_spans(spark):
    df = spark.createDataFrame([(1, "token: abcdefgh1234 and token: abcdefgh9876"), (2, None), (3, "")], "doc_id long, text string")
    ledger = new_folder(spark, "ledger")
    before = {r.path: r.spans for r in blob_secrets.scan(df, ledger, fresh=True).collect()}
    after = {r.path: r.spans for r in blob_secrets.scan(df, ledger, fresh=True).collect()}  # as a run that began before the first one ended
    assert after == before and len(before[1]) == 2


def test_letters_count_wherever_they_stand(spark):
    texts = ["12 | 34\n" * 100 + "the house and the garden", "12 | 34\n" * 100, "— … —", None, "日本"]
    one = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    none = one.withColumn("lang", F.lit(None).cast("string"))
    for df in (one, none):
        assert {r.doc_id for r in language_fusion.identify(df, "text", "lang", "source").where("accepted").collect()} == {0, 4}
        assert {r.doc_id for r in corpus_pipeline.language_id(spark, df, SF_DIR).collect()} == {0, 4}
    assert {(r.language, r.posterior) for r in language_fusion.identify(none, "text", "lang", "source").collect()} == {(None, None)}


def test_language_model_is_fitted_on_different_texts(spark):
    texts = ["the house", "das haus", "la maison", "il castello", "huset der"]
    copied = min(texts, key=lambda t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0])
    rows = [(t, "en") for t in texts] + [(copied, "en")] * 50 + [("other", "de")]
    model = language_fusion.fit_text_model(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", fit_rows=5)
    once = language_fusion.fit_text_model(spark.createDataFrame([*{*rows}], "text string, lang string"), "text", "lang", fit_rows=5)
    assert all((model.evidence(t) == once.evidence(t)).all() for t in texts)


def test_every_declared_language_is_in_the_model(spark):
    """More languages than 200, the last ones rare; region tags and case don't divide one."""
    rng = random.Random(8)
    words = {f"q{chr(97 + i // 26)}{chr(97 + i % 26)}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6)] for i in range(230)}
    rows = [(k, " ".join(rng.sample(own, 5) * 3), [name, f"{name}-US", f"{name.upper()}_x"][k % 3], None)
            for i, (name, own) in enumerate(words.items()) for k in range(3 if i < 225 else 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = language_fusion.identify(df, "text", "lang", "source").collect()
    assert len(found) == len(rows) and all(r.language == r.lang[:3].lower() for r in found)
    assert language_fusion.fit_text_model(df, "text", "lang").languages == tuple(sorted(words))


BASE = (("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 8, 2),
        ("access", re.compile("AKIA[A-Z0-9]+"), 16, 0), ("hex", re.compile("[0-9a-f]+"), 32, 0))


def test_secrets_equal_a_scan_by_hand_and_the_ledger_is_incremental(spark):
    hexes = "0123456789abcdef" * 3
    texts = [None, "", "nothing", f"é😀 token = \"{hexes}\" and {hexes}", "token=token: abcdefghij", "PASSWORD:short secret=longenough1", f"AKIA{'A1' * 8} AKIA12",
             f"\x01token=abcdefgh\x02{hexes}\x03", f"{hexes} token:{hexes}", f"{hexes} token:{hexes}"]
    df = odd_documents(spark, texts)
    ledger = new_folder(spark, "ledger")
    got = {r.doc_id: r for r in blob_secrets.report(df, ledger).collect()}
    scanned = blob_secrets.read_ledger(spark, ledger)  # two deliveries, and no pair is scanned twice
    n_blobs = len({t for t in [*texts, "null id"] if t})
    assert scanned.count() == scanned.select("blob_id", "rule").distinct().count() == n_blobs * len(blob_secrets.RULES)
    assert 0 < blob_secrets.scan(df.where("pmod(xxhash64(doc_id), 2) = 0"), new_folder(spark, "ledger"), fresh=True).where("blob_id IS NOT NULL").count() < df.count()
    assert blob_secrets.report(df.limit(0), new_folder(spark, "ledger")).count() == 0
    for i, text in enumerate(texts):
        spans = sorted((m.start(), k, m.end()) for k, (_, p, least, g) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= least)
        listed = ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (text, got[i].spans, listed)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
    ledger = new_folder(spark, "ledger")
    first = blob_secrets.scan(df, ledger, fresh=True).count()
    size = blob_secrets.read_ledger(spark, ledger).count()
    assert blob_secrets.scan(df, ledger).count() == first and blob_secrets.read_ledger(spark, ledger).count() == size
    newer = (*blob_secrets.RULES[1:], blob_secrets.Rule("assign", blob_secrets.RULES[0].pattern, 8, 2, version=2))
    blob_secrets.scan(df, ledger, rules=newer).count()
    assert blob_secrets.read_ledger(spark, ledger).count() == size + n_blobs
    masked = {r.doc_id: r.text for r in blob_secrets.redact(df).collect()}
    assert masked[3] == '😀'.join(['é', ' [secret]" and [secret]']) and masked[0] is None and masked[2] == "nothing"


def test_pipeline_keeps_clean_documents_and_one_of_each_group(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, columns = documents, documents.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}
            break
        assert out.columns == columns
        if name == "ngram_jaccard":
            sets = {}
            for r in docs.collect():
                w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
                sets[r.doc_id] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
            roots = brute_components(sets, Fraction(8, 10))
            assert sorted(r.doc_id for r in out.collect()) == sorted(set(roots.values()))
        docs = spark.createDataFrame(out.collect(), out.schema)
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_near_duplicates_go_by_row(spark):
    """Texts that share an id with a linked one stay; equal rows become one; null ids yield to others."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (6, c), (6, c), (None, c), (None, b + " x"), (7, None), (8, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, _key string, _id long")
    out = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        [(1, a), (5, b), (6, c), (7, None), (8, ""), (9, None)], key=repr)


def test_pages_are_identified(spark):
    rows = queries.page_language_id(spark, SF_DIR).collect()
    assert np.mean([r.language == r.declared for r in rows]) > 0.9


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, queries.QUERIES[name], queries.ORACLES[name], SF_DIR).startswith("ok")


@pytest.mark.parametrize("size", [3, 40, 900])
def test_cell_counts_lose_no_link(size):
    """Of sets with linked and unlinked partners, within a block and between two; cells hold all shingles."""
    rng, similarity = np.random.default_rng(size), Fraction(8, 10)
    pool, sets = rng.integers(0, 2**63, 4 * size, dtype=np.uint64), []
    for _ in range(60):
        whole = np.unique(rng.choice(pool, size, replace=False))
        near = whole.copy()
        near[: int(len(near) * rng.uniform(0, 0.14))] += np.uint64(1)
        sets += [whole, np.unique(near)]
    sizes = np.array(list(map(len, sets)))
    counts, cells = partenum_join.cell_counts(np.concatenate(sets), sizes)
    ends = np.cumsum(cells)
    assert counts.sum() == sizes.sum()
    pdf = pd.DataFrame({"set": range(len(sets)), "size": sizes, "first": rng.random(len(sets)) < 0.5,
                        "cells": [counts[e - n:e].tobytes() for e, n in zip(ends, cells)]})
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))]
    assert links
    for one in (pdf.assign(first=True), pdf):
        forest = Forest(len(sets))
        for a, b in partenum_join._close(one, similarity):
            forest.join(a, b)
        meets = [(i, j) for i, j in links if one["first"][i] != one["first"][j] or one["first"].all()]
        assert all(forest.find(i) == forest.find(j) for i, j in meets)
    assert partenum_join._close(pdf.head(0), similarity) == []
