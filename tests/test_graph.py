"""Graph operators against a brute-force pair count in Python."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from incident_analytics.functions import scalar as S
from incident_analytics.operators import graph, overlap


def brute_edges(cells):
    """cells: (group, bucket, node) -> Counter of (src, dst)."""
    held = defaultdict(set)
    for g, b, node in cells:
        held[g, b].add(node)
    edges = Counter()
    for nodes in held.values():
        edges.update(combinations(sorted(nodes), 2))
    return edges


def brute_top(edges, min_cooc, k):
    kept = [(s, d, w) for (s, d), w in edges.items() if w >= min_cooc]
    return sorted(kept, key=lambda e: (-e[2], e[0], e[1]))[:k]


def brute_hubs(edges, min_cooc, k):
    deg, weight = Counter(), Counter()
    for (s, d), w in edges.items():
        if w >= min_cooc:
            for node in (s, d):
                deg[node] += 1
                weight[node] += w
    return sorted(((n, deg[n], weight[n]) for n in deg), key=lambda h: (-h[2], h[0]))[:k]


def sparse(rng):
    return [(f"g{rng.randrange(3)}", str(rng.randrange(8)), f"n{rng.randrange(40):02d}")
            for _ in range(400)]


def one_hot_profile(rng):
    """Most nodes in every cell of one group, the rest thinly spread."""
    full = [("g0", str(b), f"n{i:03d}") for i in rng.sample(range(200), 60) for b in range(5)]
    return full + [("g1", str(rng.randrange(5)), f"m{rng.randrange(30)}") for _ in range(90)]


def with_nulls(rng):
    groups, buckets = ["a", "b", None], ["1", "2", "3", None]
    return [(rng.choice(groups), rng.choice(buckets), f"n{rng.randrange(20)}") for _ in range(150)]


def interleaved(rng):
    """Two profiles of equal weight with interleaved node names."""
    out = []
    for i in range(30):
        buckets = ["1", "2", "3"] if i % 2 else ["1", "2", "4"]
        out += [("g", b, f"n{i:02d}") for b in buckets]
    return out


@pytest.fixture(scope="module", params=[sparse, one_hot_profile, with_nulls, interleaved],
                ids=lambda f: f.__name__)
def case(request, spark):
    cells = request.param(random.Random(5))
    df = spark.createDataFrame(cells * 2, "g string, b string, node string").repartition(5)
    return brute_edges(cells), graph.node_profiles(df, "g", "b", "node")


@pytest.mark.parametrize("min_cooc, k", [(1, 1), (2, 25), (3, 5000)])
def test_top_edges(case, min_cooc, k):
    edges, profiles = case
    got = [tuple(r) for r in graph.top_edges(profiles, min_cooc, k).collect()]
    assert got == brute_top(edges, min_cooc, k)


@pytest.mark.parametrize("min_cooc, k", [(1, 10), (2, 500)])
def test_hubs_of_all_edges(case, min_cooc, k):
    edges, profiles = case
    got = [tuple(r) for r in graph.hubs_of_all_edges(profiles, min_cooc, k).collect()]
    assert got == brute_hubs(edges, min_cooc, k)


@pytest.mark.parametrize("block", [1000, 3])
def test_histogram_and_all_edges(case, rows, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK_PROFILES", block)
    edges, profiles = case
    got = {r.cooc: r.n_edges for r in graph.weight_histogram(profiles, 2).collect()}
    assert got == {w: n for w, n in Counter(edges.values()).items() if w >= 2}
    assert rows(graph.all_edges(profiles, 2)) == sorted(
        ((s, d, w) for (s, d), w in edges.items() if w >= 2), key=repr)


@pytest.mark.parametrize("t, block", [(1, 3), (2, 1000), (3, 3)])
def test_profiles_meet_by_cell_as_by_group(case, rows, monkeypatch, t, block):
    monkeypatch.setattr(graph, "BLOCK_PROFILES", block)
    _, profiles = case
    by_group, by_cell = (rows(graph.profile_pairs(profiles, t, meet).select(
        F.least("p_pid", "q_pid"), F.greatest("p_pid", "q_pid"), "cooc")) for meet in ("group", "cell"))
    assert by_group == by_cell and len({r[:2] for r in by_cell}) == len(by_cell)
    sets = {r.pid: {tuple(c) for c in r.cells} for r in profiles.table.collect()}
    assert by_cell == sorted(((p, q, len(sets[p] & sets[q])) for p in sets for q in sets
                              if p <= q and len(sets[p] & sets[q]) >= t), key=repr)


def test_the_index_forms_fewer_pairs_at_high_thresholds(spark, rows, monkeypatch):
    rng = random.Random(6)
    cells = [("g", f"{h:02d}", f"n{k:03d}") for k in range(300) for h in rng.sample(range(24), rng.randint(4, 8))]
    profiles = graph.node_profiles(spark.createDataFrame(cells, "g string, b string, node string"), "g", "b", "node")
    monkeypatch.setattr(graph, "FEW_PAIRS", 0)
    formed = [overlap.pairs_formed(profiles.groups, profiles.postings, t) for t in range(1, 9)]
    print([round(f["cell"] / formed[0]["group"], 4) for f in formed])
    assert formed[5]["cell"] < 0.3 * formed[0]["group"] and formed[7]["cell"] < 0.02 * formed[0]["group"]
    assert rows(graph.all_edges(profiles, 5)) == sorted(
        ((s, d, w) for (s, d), w in brute_edges(cells).items() if w >= 5), key=repr)


@pytest.mark.parametrize("meet", ["group", "cell"])
@pytest.mark.parametrize("word, max_words", [(64, 16), (64, 1), (5, 16)])
def test_many_buckets(spark, rows, monkeypatch, word, max_words, meet):
    """More buckets than one mask holds, and more than masks are made for."""
    monkeypatch.setattr(graph, "WORD", word)
    monkeypatch.setattr(graph, "MAX_WORDS", max_words)
    rng = random.Random(3)
    buckets = 70 if word == 64 else 12
    cells = [(rng.choice("ab"), str(rng.randrange(buckets)), f"n{rng.randrange(25)}") for _ in range(600)]
    profiles = graph.node_profiles(spark.createDataFrame(cells, "g string, b string, node string"),
                                   "g", "b", "node")
    assert profiles.words == {(64, 16): 2, (64, 1): 0, (5, 16): 3}[word, max_words]
    pairs = graph.profile_pairs
    monkeypatch.setattr(graph, "profile_pairs", lambda g, t: pairs(g, t, meet))
    assert rows(graph.all_edges(profiles, 2)) == sorted(
        ((s, d, w) for (s, d), w in brute_edges(cells).items() if w >= 2), key=repr)


def test_hour_graph_is_not_empty_at_the_default_threshold(spark):
    df = spark.createDataFrame([("TX", h, c) for h in range(24) for c in ("A", "B")],
                               "State string, hour int, City string")
    df = S.bucket_by(df, "hour").withColumn("node", S.node_key("State", "City"))
    profiles = graph.node_profiles(df, "State", "bucket", "node")
    assert [tuple(r) for r in graph.top_edges(profiles).collect()] == [("TX|A", "TX|B", 24)]


# --- edge lists -------------------------------------------------------------------------

PATH = [(f"n{i:02d}", f"n{i + 1:02d}", 5) for i in range(11)] + [("x1", "x2", 9), ("x2", "x3", 5)]


def brute_labels(edges, hubs, rounds):
    near = defaultdict(set)
    for s, d, _ in edges:
        if s in hubs and d in hubs:
            near[s].add(d)
            near[d].add(s)
    label = {h: h for h in hubs}
    for _ in range(rounds):
        label = {h: min([label[h], *[label[v] for v in near[h]]]) for h in hubs}
    return label


@pytest.mark.parametrize("rounds", [1, 3, 8])
@pytest.mark.parametrize("left_out", [set(), {"n05", "x3"}])
def test_communities(spark, rounds, left_out):
    edges = spark.createDataFrame(PATH, "src string, dst string, cooc long")
    hubs = sorted({n for e in PATH for n in e[:2]} - left_out)
    got = graph.communities(edges, spark.createDataFrame([(h,) for h in hubs], "node string"), rounds)
    assert {r.node: r.label for r in got.collect()} == brute_labels(PATH, set(hubs), rounds)


def test_hubs_with_ties_and_risk(spark):
    edges = spark.createDataFrame(PATH, "src string, dst string, cooc long")
    facts = spark.createDataFrame([("x2", 1), ("x2", 4), ("n05", 3), ("other", 1)], "node string, sev int")
    risk = graph.node_risk(facts, "node", "sev", only=graph.endpoints(edges))
    assert sorted(r.node for r in risk.collect()) == ["n05", "x2"]
    got = {r.node: tuple(r)[1:] for r in graph.hubs(edges, risk, 3).collect()}
    assert got == {"x2": (2, 14, 2, 2.5), "n01": (2, 10, None, None), "n02": (2, 10, None, None)}


def test_bipartite_merges_cities_of_the_same_name(spark):
    df = spark.createDataFrame(
        [("TX", "Troy ", 1), ("NY", "Troy", 1), ("NY", " ", 1), ("NY", None, 1), ("NY", "Rye", None)],
        "State string, City string, hour int")
    assert [tuple(r) for r in graph.bipartite(df, "City", "hour", 2, 10).collect()] == [("Troy", "1", 2)]
    assert graph.bipartite(df, "City", "hour", 3, 10).count() == 0


def test_edges_out(spark):
    df = spark.createDataFrame([("TX|A", "B", 2)], "src string, dst string, cooc long")
    assert tuple(graph.edges_out(df).first()) == ("TX|A", "B", 2, "TX", "A", "B", None)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "g string, b string, node string")
    profiles = graph.node_profiles(empty, "g", "b", "node")
    assert graph.top_edges(profiles, 1, 10).count() == 0
    assert graph.hubs_of_all_edges(profiles, 1, 10).count() == 0
    assert graph.weight_histogram(profiles).count() == 0
    edges = spark.createDataFrame([], "src string, dst string, cooc long")
    assert graph.communities(edges, graph.hubs(edges)).count() == 0
    assert edges.filter(F.lit(True)).count() == 0


def test_communities_without_a_round_and_until_the_end(spark, rows):
    path = spark.createDataFrame([(f"n{k:02}", f"n{k + 1:02}", 1) for k in range(19)], "src string, dst string, cooc int")
    nodes = graph.endpoints(path)
    assert {r.label for r in graph.communities(path, nodes, None).collect()} == {"n00"}
    assert rows(graph.communities(path, nodes.limit(0), None)) == []
    assert all(r.label == r.node for r in graph.communities(path, nodes, 0).collect())
    assert len({r.label for r in graph.communities(path, nodes, 8).collect()}) == 12


def test_a_path_of_500_nodes_settles_in_few_rounds(spark):
    rng = random.Random(8)
    names = [f"n{k:03}" for k in range(500)]
    shuffled = rng.sample(names, 500)
    ordered = [(a, b) for a, b in zip(names, names[1:])]
    mixed = [("m" + a, "m" + b) for a, b in zip(shuffled, shuffled[1:])] + [("s", f"t{k}") for k in range(40)]
    for pairs, ends in ((ordered, {"n000"}), (mixed, {"mn000", "s"})):
        links = spark.createDataFrame([p for a, b in pairs for p in ((a, b), (b, a))], "u string, v string")
        nodes = links.select(F.col("u").alias("node")).distinct()
        labels, history = graph.settle(links, nodes.unionByName(spark.createDataFrame([("alone",)], "node string")))
        got = {r.node: r.label for r in labels.collect()}
        assert set(got.values()) == ends | {"alone"} and len(got) == len({x for p in pairs for x in p}) + 1
        assert got["alone"] == "alone" and all(got[a] == got[b] for a, b in pairs)
        read = [h["links"] for h in history]
        assert len(read) <= 9 and all(b < a / 1.5 for a, b in zip(read, read[1:]))


def test_edges_of_a_large_profile_are_dealt_out(spark, rows, monkeypatch):
    """No task forms most edges where two profiles hold most nodes, and none is lost or doubled between blocks."""
    cells = [("g", str(b), f"n{i:03d}") for i in range(240) for b in range(3 if i % 3 else 4)] + [("g", "9", "x"), ("g", "9", "y")]
    df = spark.createDataFrame(cells, "g string, b string, node string")
    monkeypatch.setattr(graph, "BLOCK_NODES", 15, raising=False)
    monkeypatch.setattr(overlap, "PAIRS_PER_TASK", 2000)
    edges = graph.all_edges(graph.node_profiles(df, "g", "b", "node"), 1)
    assert rows(edges) == sorted(((s, d, w) for (s, d), w in brute_edges(cells).items()), key=repr)
    tasks = [r["count"] for r in edges.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) < 0.25 * sum(tasks)
