"""Compression to codes, quality ranking and importance resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from incident_analytics.llm import cover_codes, importance_resampling, pairwise_quality, queries
from incident_analytics.llm.common import new_folder
from incident_analytics.llm.radix_sort import ranked

SF_DIR = "/root/testdata/sf0.001"


# --- codes --------------------------------------------------------------------------------

def lloyd(points, parts, entries, rounds):
    """Every part against every entry: codes, errors, codebooks."""
    codes, errors, books = [], np.zeros(len(points), dtype=np.int64), []
    for a, b in cover_codes.bounds(points.shape[1], parts):
        part, book = points[:, a:b], points[:entries, a:b].copy()
        for k in range(rounds + 1):
            far = ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
            code = far.argmin(axis=1)
            for e in set(code.tolist()) if k < rounds else ():
                book[e] = [int(v) // int((code == e).sum()) for v in part[code == e].sum(axis=0)]
        codes.append(code)
        errors += far.min(axis=1)
        books.append(book)
    return np.array(codes).T, errors, books


@pytest.mark.parametrize("kind", ["spread", "clustered", "ties", "one value"])
def test_cover_trees_assign_like_all_comparisons(kind):
    rng = np.random.default_rng(3)
    points = {"spread": rng.integers(-5000, 5000, (700, 6)), "clustered": rng.integers(-9, 9, (700, 6)) + 1000 * rng.integers(-4, 4, (700, 1)),
              "ties": rng.integers(-1, 2, (700, 6)), "one value": np.full((50, 6), 7)}[kind]
    block = cover_codes.Block.unpacked(cover_codes.Block(points, 2).packed(), 2)
    for a, b in block.bounds:
        tree = block.trees[0 if a == 0 else 1]
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        for k in range(len(tree.centre)):
            members = points[tree.order[tree.begin[k]:tree.end[k]], a:b]
            far = np.sqrt(((members - points[tree.centre[k], a:b]) ** 2).sum(axis=1))
            assert far.max() <= tree.radius[k] * (1 + 1e-9) + 1e-9
            assert tree.children[k] == 0 or tree.end[tree.child[k] + tree.children[k] - 1] == tree.end[k]
    for entries in (1, 5, 16):
        codes, errors, books = lloyd(points, 2, entries, 0)
        got, error = block.codes(books)
        assert (got == codes).all() and (error == errors).all()
        for (n, total), book, code, (a, b) in zip(block.sums(books), books, codes.T, block.bounds):
            assert n.tolist() == np.bincount(code, minlength=len(book)).tolist()
            assert all((total[e] == points[code == e, a:b].sum(axis=0)).all() for e in range(len(book)))


def test_clustered_points_are_assigned_by_whole_subtrees():
    rng = np.random.default_rng(4)
    points = rng.integers(-20, 20, (2000, 8)) + 4000 * rng.integers(0, 12, (2000, 1))
    tree = cover_codes.cover_tree(points)
    _, singles, _ = cover_codes.assign(tree, points, points[:16])
    assert len(singles) < 0.6 * len(points)


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=16).tolist(), int(rng.integers(3)) if i % 7 else None, "x") for i in range(300)]
    good += [(5, good[3][1], 1, "x"), (5, good[3][1], 1, "x"), (None, good[0][1], 2, "x")]
    bad = [(400, None, 1, "x"), (401, [None] * 16, 1, "x"), (402, [float("nan")] * 16, 1, "x"), (403, [float("inf")] + [0.0] * 15, 1, "x"),
           (404, [1.0] * 8, 1, "x"), (405, [], 1, "x")]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>, label int, code string").repartition(5)
    rows = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    codes, errors, books = lloyd(np.floor(4096 * np.array([r[1] for r in rows])).astype(np.int64), 8, 16, 6)
    by_label = {r[2]: sum(int(e) for q, e in zip(rows, errors) if q[2] == r[2]) for r in rows}
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    want = [(r[0], "".join(f"{c:02x}" for c in code), int(e), by_label[r[2]], digest) for r, code, e in zip(rows, codes, errors)]
    assert sorted(map(tuple, cover_codes.report(df).collect()), key=repr) == sorted(want, key=repr)
    few = cover_codes.report(df.where("vec_id IN (1, 2)")).collect()
    assert {(r.vec_id, r.error) for r in few} == {(1, 0), (2, 0)}
    odd = cover_codes.compress(df.select("vec_id", F.slice("embedding", 1, 5).alias("embedding"), "label").where("vec_id < 300"))
    assert odd.codes.count() == 302 and [b.shape[1] for b in odd.books] == [1, 1, 1, 1, 1, 0, 0, 0]
    assert cover_codes.report(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="too large"):
        cover_codes.report(spark.createDataFrame([(1, [1e9] * 8, 1)], "vec_id long, embedding array<double>, label int")).collect()


# --- quality ------------------------------------------------------------------------------

def test_features_are_finite_and_of_one_length():
    texts = ["", " ", "\n\n", "a", "A b, c.", "x" * 100_000, "Ünï 日本 😀\ud800", "-- | --\n" * 50, "a a a a", "\x00\x1f"]
    rows = [pairwise_quality.features(t) for t in texts]
    assert len({len(r) for r in rows}) == 1 and all(np.isfinite(r).all() for r in rows)


def test_fit_is_the_minimum_of_the_pairwise_loss():
    rng = np.random.default_rng(6)
    rows, true = rng.normal(size=(400, 5)), np.array([2.0, -1.0, 0.5, 0.0, 0.0])
    good = rows @ true + rng.normal(size=400) > 0
    model = pairwise_quality.fit(rows, good, partners=3, steps=3000)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    n = max(len(better), len(worse))
    pairs = [(p, q) for k in range(3) for p, q in zip(np.resize(better, n), np.resize(np.roll(worse, k * 7919), n))]
    x = (rows - model.centre) / model.scale

    def loss(w):
        return np.mean([math.log1p(math.exp(x[q] @ w - x[p] @ w)) for p, q in pairs]) + pairwise_quality.PENALTY / 2 * w @ w

    least = loss(model.weights)
    assert all(loss(model.weights + step * np.eye(5)[i]) >= least - 1e-9 for i in range(5) for step in (-0.02, 0.02))
    assert model.weights[0] > model.weights[2] > 0 > model.weights[1]


def test_quality_scores_equal_a_plain_version(spark):
    """Scores, quantile and logistic function worked out by hand from the fitted weights."""
    rng = random.Random(7)

    def text(good):
        words = ["".join(rng.choices("abcde", k=rng.randint(2, 7))) for _ in range(rng.randint(5, 60))]
        return " ".join(words).capitalize() + "." if good else " | ".join(w.upper() for w in words) + rng.choice(["", "!!", " word word"])

    texts = {i: text(i % 3 > 0) for i in range(300)}
    rows = [(i, t, "s", 0.5) for i, t in texts.items()] + [(900, None, "s", 0.5), (901, "", "s", 0.5), (None, "No id.", "s", 0.5), (901, "", "s", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(None, 1), (3, None), (4, 9)], "doc_id long, quality int")
    got = pairwise_quality.score(docs, labels).collect()
    assert len(got) == len(rows) and all(0 < r.score < 1 for r in got)
    model = pairwise_quality.learn(docs, pairwise_quality.learnable(labels, "doc_id", "quality"))
    raw = {i: float(model.scores(pairwise_quality.features(t))) for i, t in texts.items()}
    known = sorted(raw[i] for i in range(200))
    n_low = sum(i % 3 == 0 for i in range(200))
    cut = (known[n_low - 1] + known[n_low]) / 2
    by_id = {r.doc_id: r.score for r in got}
    for i in texts:
        assert by_id[i] == pytest.approx(1 / (1 + math.exp(-(raw[i] - cut + math.log(0.3 / 0.7)))), abs=1e-6)
    assert np.mean([(by_id[i] >= 0.3) == (i % 3 > 0) for i in range(200, 300)]) > 0.97
    assert by_id[900] == by_id[901]
    for some, share in ((labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0), (labels.limit(0), 0.5)):
        assert {r.score for r in pairwise_quality.score(docs, some).collect()} == {share}
    assert pairwise_quality.score(docs.limit(0), labels).count() == 0


def test_held_out_accuracy_of_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in queries.op12_pairwise_quality(spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) >= 0.98


# --- resampling -----------------------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def buckets_of(text, most=2):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10_000 for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def drawn(documents, target):
    """The rows of the contract by plain Python; repeated ids only with equal texts."""
    features = [(i, len(words_of(t)), buckets_of(t)) for i, t in documents]
    s, t = [0] * 10_000, [0] * 10_000
    for _, _, found in features:
        for b in found:
            s[b] += 1
    for text in target:
        for b in buckets_of(text):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n_words, found in features:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = None if i is None else int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, n_words])
    order = sorted((r for r in rows if r[4] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(order):
        r[4] = k + 1 if k < 25 * len(order) // 100 else None
    chosen = {id(r) for r in order}
    return sorted(((*r[:4], r[4] if id(r) in chosen else None) for r in rows), key=repr)


def test_resampling_equals_a_plain_version(spark):
    rng = random.Random(9)
    pool = ["".join(rng.choices("abcXYZ019é日-'", k=rng.randint(1, 9))) for _ in range(300)] + ["w" * 70, "ü" * 60, "Q" * 49]
    texts = [None, "", " ", "-", "one", "x" * 5000, "K İ ſ " * 30, ("long " * 20_000).strip()]
    texts += [rng.choice(" .,\n\t").join(rng.choices(pool, k=rng.randint(1, 80))) for _ in range(400)]
    rows = [(i * 7 - 50, t, 1, "r") for i, t in enumerate(texts)] + [(None, texts[20], 1, "r"), (6, texts[8], 1, "r"), (6, texts[8], 1, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, rank string").repartition(4)
    target = [texts[9], "Zab 0", None, ""]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert sorted(map(tuple, importance_resampling.resample(docs, bench).collect()), key=repr) == drawn([r[:2] for r in rows], target)
    assert importance_resampling.resample(docs.limit(0), bench).count() == 0
    nothing = importance_resampling.resample(docs, bench.limit(0))
    assert sorted(map(tuple, nothing.collect()), key=repr) == drawn([r[:2] for r in rows], [])
    assert nothing.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_registered_resampling_equals_a_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    bench = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = queries.op13_importance_resampling(spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=repr) == drawn(docs, bench)


def test_runs_of_three_words():
    import pyarrow as pa

    texts = ["a bb ccc dddd", "", "x" * 60 + " y " + "z" * 60, "q"]
    crc, row, n = importance_resampling.word_runs(pa.array(texts), 3)
    want = sorted((i, zlib.crc32(" ".join(w[k:k + m]).encode())) for i, t in enumerate(texts) for w in [t.split()]
                  for m in (1, 2, 3) for k in range(len(w) - m + 1))
    assert sorted(zip(row.tolist(), crc.tolist())) == want and n.tolist() == [4, 0, 3, 1]


@pytest.mark.parametrize("rows, bits", [
    ([(random.Random(i).randint(-5, 5), i * 37 % 211) for i in range(500)], 3),
    ([(5, 5)] * 20, 11), ([(-2**63, 1), (2**63 - 1, 2), (0, 3), (0, 3)], 11), ([(1, -2**62), (1, 2**62), (2, 0)], 5)])
def test_radix_sort(spark, rows, bits):
    df = spark.createDataFrame([(*r, "x") for r in rows], "a long, b long, place string").repartition(3)
    out = ranked(df, [("a", False), ("b", True)], new_folder(spark, "sorted"), digit_bits=bits, block_bits=4).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, len(rows) + 1))
    assert [(r.a, r.b) for r in sorted(out, key=lambda r: r["rank"])] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert ranked(df.limit(0), [("a", True)], new_folder(spark, "sorted")).columns == ["a", "b", "place", "rank"]
