"""Co-occurrence and bipartite graphs, hubs and communities.

Two nodes are linked by the number of (group, bucket) cells that hold both. The
plain way lists every node pair of every cell, which is quadratic in the largest
cell. Here nodes that occur in the same set of cells form one *profile*: they are
interchangeable, so weights are worked out once per pair of profiles, and node
pairs are formed only for edges that belong to the result.

    rows --distinct--> nodes with cell sets --group by set--> profiles with sizes
    profiles that can share enough cells, in blocks --> weights, degrees, top edges

With 7 weather buckets a group has at most 127 profiles however many nodes it
has, so that the pair step does not grow with the data. With many buckets profiles
meet over an inverted index instead of by group (see `overlap`), where that forms
fewer pairs. Cells are compared as bit masks: a pair costs one AND and one bit
count per 64 buckets, and is aggregated where it is formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics.functions.scalar import node_part
from incident_analytics.operators import overlap
from incident_analytics.operators.clean import clean_key, resolve_col
from incident_analytics.operators.ranking import topk
from incident_analytics.sources.scratch import materialize, materialize_counted

BLOCK_PROFILES = 2_000  # profiles of one group that one side of a join cell may hold
BLOCK_NODES = 2_000     # nodes of one profile that one side of a pair of blocks holds
SPREAD = 64             # sub-partitions of a profile when its first nodes are picked
WORD = 64               # cells of a group that one bigint mask holds
FEW_PAIRS = 20_000_000  # pairs that are compared without asking whether the index forms fewer
MAX_WORDS = 16          # masks per profile; groups with more cells compare the sets


# --- profiles ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Profiles:
    """Profiles of a node table, as written tables that every operator scans.

    `nodes`: node and profile. `table`: a row per profile with its number `pid`,
    sorted cells, number of nodes and first node. `groups`: a row per profile and
    group, with the cells of the group as `words` bit masks. `postings`: a row per
    profile and cell, with the cell's place in the profile, rare cells first.
    """

    nodes: DataFrame
    table: DataFrame
    groups: DataFrame
    postings: DataFrame
    words: int
    n_profiles: int


def node_profiles(df: DataFrame, group: str, bucket: str, node: str) -> Profiles:
    """Profiles of the nodes of a table. Null groups and buckets are values too.

    Rows are made distinct before the sets are built: a set is then as long as
    the number of cells a node occurs in, whatever its number of rows.
    """
    distinct = df.select(
        F.col(node).alias("node"), F.col(group).cast("string").alias("g"),
        F.col(bucket).cast("string").alias("b"),
    ).distinct()
    sets = distinct.groupBy("node").agg(
        F.array_sort(F.collect_set(F.struct("g", "b"))).alias("cells"))
    nodes = materialize(sets.withColumn("profile", F.sha2(F.to_json("cells"), 256)), "nodes")
    table = nodes.groupBy("profile").agg(
        F.first("cells").alias("cells"),
        F.count(F.lit(1)).alias("size"),
        F.min("node").alias("first_node"),
    )
    # the number is fixed by writing the table
    table = materialize(table.withColumn("pid", F.monotonically_increasing_id()), "profiles")
    postings = materialize(overlap.postings(table), "postings")
    groups, words, n_profiles = _masked(table, postings)
    return Profiles(nodes.select("node", "profile"), table, materialize(groups, "groups"), postings, words, n_profiles)


def _masked(table: DataFrame, postings: DataFrame) -> tuple[DataFrame, int, int]:
    """Profiles by group with bit masks of their cells, the number of masks, and of profiles.

    A cell's bit is its rank among the cells of its group, rare ones first. The sets
    themselves are carried only for profiles that span several groups, and where
    there are too many buckets for masks; they are in the order of the postings.
    """
    facts = postings.agg(F.max("at").alias("last"), F.max("n_groups").alias("groups"), F.count_if(F.col("pos") == 0).alias("n")).first()
    words = (facts["last"] or 0) // WORD + 1
    words = words if words <= MAX_WORDS else 0

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % WORD)
    masks = [
        F.coalesce(F.bit_or(F.when(F.floor(F.col("at") / WORD) == w, bit)), F.lit(0).cast("long"))
        .alias(f"m{w}") for w in range(words)
    ]
    placed = postings.groupBy("pid", "g").agg(F.count(F.lit(1)).alias("n"), *masks)
    carried = table.select("pid", "size", "first_node", F.size("cells").alias("n_cells"))
    if words and (facts["groups"] or 1) == 1:
        none = {"several": F.lit(False), "homes": F.lit(None).cast("array<string>"),
                "cells": F.lit(None).cast("array<struct<g:string,b:string>>")}
        return placed.drop("n").join(carried.withColumns(none), "pid"), words, facts["n"]
    several = F.max("n_groups") > 1
    in_order = F.array_sort(F.collect_list(F.struct("pos", "g", "b")))
    sets = postings.groupBy("pid").agg(several.alias("several"), in_order.alias("in_order")).select(
        "pid", "several", F.when(F.col("several"), F.array_distinct("in_order.g")).alias("homes"),
        F.when(F.col("several") | F.lit(words == 0), F.transform("in_order", lambda c: F.struct(c["g"].alias("g"), c["b"].alias("b"))))
        .alias("cells"))
    return placed.drop("n").join(carried, "pid").join(sets, "pid"), words, facts["n"]


def profile_pairs(graph: Profiles, min_cooc: int = 1, meet: str | None = None) -> DataFrame:
    """Pairs of profiles that share at least `min_cooc` cells, with the count as cooc.

    Each unordered pair appears once, a profile with itself included. Profiles meet
    by "group", all with all in blocks, or by "cell", over the inverted index; by
    default in the way that forms fewer pairs, unless all with all are few. A pair that meets several times is
    taken in the first of its groups or cells. Blocks are joined with blocks, so that
    a long list becomes many join cells; the number of partitions follows from the
    pairs, since these, not the small input, decide how much work there is. A merge
    join walks a block in memory order and may spill it.
    """
    cost = {"group": graph.n_profiles * (graph.n_profiles + 1) // 2}  # at most, if profiles have one group
    if meet == "cell" or cost["group"] > FEW_PAIRS:
        cost = overlap.pairs_formed(graph.groups, graph.postings, min_cooc)
    if meet is None:
        meet = min(cost, key=cost.get)
    rows = graph.groups.filter(F.col("n_cells") >= min_cooc)
    keys = ["g"]
    if meet == "cell":
        rows = rows.join(overlap.prefixes(graph.postings, min_cooc), ["pid", "g"])
        keys = ["g", "b", "at"]
    masks = [f"m{w}" for w in range(graph.words)]
    carried = ["pid", "size", "first_node", "several", "homes", "cells", *masks]
    pairs = overlap.self_join(rows, keys, carried, BLOCK_PROFILES, cost[meet])

    both_several = F.col("p_several") & F.col("q_several")
    common = F.array_intersect("p_cells", "q_cells")
    both = [F.col(f"p_{m}").bitwiseAND(F.col(f"q_{m}")) for m in masks]
    cooc, first = F.size(common), common[0] == F.struct("g", "b") if meet == "cell" else None
    if meet == "cell" and masks:
        first = F.when(both_several, first).otherwise(overlap.no_earlier(both, F.col("at"), WORD))
    if meet == "group":
        home = F.array_min(F.array_intersect("p_homes", "q_homes"))
        first = ~both_several | (F.col("g") == home)
    if masks:
        cooc = F.when(both_several, cooc).otherwise(reduce(lambda a, b: a + b, [F.bit_count(m) for m in both]))
    return (
        pairs.filter(first)
        .select("p_pid", "q_pid", "p_size", "q_size", "p_first_node", "q_first_node",
                cooc.cast("long").alias("cooc"))
        .filter(F.col("cooc") >= min_cooc)
    )


def _same() -> Column:
    return F.col("p_pid") == F.col("q_pid")


def _with_edges(pairs: DataFrame) -> DataFrame:
    """Add the number of edges a profile pair stands for; drop pairs with none."""
    p, q = F.col("p_size"), F.col("q_size")
    edges = F.when(_same(), (p * (p - 1) / 2).cast("long")).otherwise(p * q)
    return pairs.withColumn("edges", edges).filter("edges > 0")


# --- edges ------------------------------------------------------------------------------

def weight_histogram(graph: Profiles, min_cooc: int = 1) -> DataFrame:
    """Number of edges per weight, without forming an edge."""
    pairs = _with_edges(profile_pairs(graph, min_cooc))
    return pairs.groupBy("cooc").agg(F.sum("edges").alias("n_edges"))


def all_edges(graph: Profiles, min_cooc: int) -> DataFrame:
    """Every edge src, dst, cooc with cooc >= min_cooc, each formed once.

    The result is as large as the graph, so use it for a selective threshold;
    `top_edges`, `hubs_of_all_edges` and `weight_histogram` do without it.

    Nodes of a profile are kept in blocks, and a pair of profiles is cut into pairs of
    blocks, which are dealt out evenly: a task's edges are bounded, however many
    nodes a profile has, and the number of tasks follows from the edges.
    """
    pairs = materialize(profile_pairs(graph, min_cooc).select("p_pid", "q_pid", "p_size", "q_size", "cooc"), "pairs")
    n_edges = pairs.agg(F.sum(F.col("p_size") * F.col("q_size"))).first()[0] or 0
    parts = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_edges // overlap.PAIRS_PER_TASK))

    def n_blocks(size: str) -> Column:
        return F.ceil(F.col(size) / F.lit(BLOCK_NODES))

    numbered = graph.nodes.join(graph.table.select("profile", "pid", "size"), "profile")
    blocks = materialize(
        numbered.groupBy("pid", F.pmod(F.xxhash64("node"), n_blocks("size")).alias("block"))
        .agg(F.collect_list("node").alias("nodes")), "blocks")

    def side(name: str) -> DataFrame:
        return blocks.select(F.col("pid").alias(f"{name}_pid"), F.col("block").alias(f"{name}_block"), F.col("nodes").alias(f"{name}_nodes"))

    def numbers(size: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n_blocks(size) - 1))

    cut = pairs.withColumn("p_block", numbers("p_size")).withColumn("q_block", numbers("q_size"))
    cut = cut.filter(~_same() | (F.col("p_block") <= F.col("q_block"))).drop("p_size", "q_size")
    met = cut.join(side("p"), ["p_pid", "p_block"]).join(side("q"), ["q_pid", "q_block"])
    dealt = met.repartition(parts, "p_pid", "p_block", "q_pid", "q_block")
    one_block = _same() & (F.col("p_block") == F.col("q_block"))
    return (
        dealt.select(one_block.alias("one_block"), "cooc", "q_nodes", F.explode("p_nodes").alias("a"))
        .select("one_block", "cooc", "a", F.explode("q_nodes").alias("b"))
        .filter(~F.col("one_block") | (F.col("a") < F.col("b")))
        .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"), "cooc")
    )


def _kth_weight(weights: DataFrame, k: int) -> tuple[int, int]:
    """Weight of the k-th heaviest edge, from edges per weight, and the largest weight.

    0 stands for a weight that no edge has.
    """
    heavier = Window.orderBy(F.desc("cooc")).rowsBetween(Window.unboundedPreceding, 0)
    upto = weights.withColumn("upto", F.sum("n_edges").over(heavier))  # a row per weight
    kth = F.max(F.when(F.col("upto") >= k, F.col("cooc")))
    row = upto.agg(kth.alias("kth"), F.max("cooc").alias("largest")).first()
    return row["kth"] or 0, row["largest"] or 0


def _weight_cut(graph: Profiles, min_cooc: int, k: int) -> int:
    """The weight that an edge needs to be among the `k` heaviest.

    A first bound costs no comparison: the nodes of one profile share all its
    cells, which gives edges of that weight. Profiles with fewer cells cannot be
    part of the result, and the histogram leaves them out; there is nothing to
    compare if no profile has more cells than the bound.
    """
    own = graph.table.groupBy(F.size("cells").alias("cooc")).agg(
        F.sum(F.col("size") * (F.col("size") - 1) / 2).alias("n_edges"))
    kth, most_cells = _kth_weight(own, k)
    sure = max(min_cooc, kth)
    if sure >= most_cells:
        return sure
    return max(sure, _kth_weight(weight_histogram(graph, sure), k)[0])


def _first_nodes(graph: Profiles, pids: DataFrame, k: int) -> DataFrame:
    """First `k` nodes of each of a bounded number of profiles, numbered from 1.

    A profile may hold most of the nodes, so the pick runs in two steps: within
    sub-partitions by node hash, then over what those leave.
    """
    wanted = graph.table.select("pid", "profile").join(F.broadcast(pids), "pid", "left_semi")
    within = Window.partitionBy("pid", "spread").orderBy("node")
    overall = Window.partitionBy("pid").orderBy("node")
    return (
        graph.nodes.join(F.broadcast(wanted), "profile").select("pid", "node")
        .withColumn("spread", F.pmod(F.xxhash64("node"), F.lit(SPREAD)))
        .withColumn("i", F.row_number().over(within)).filter(F.col("i") <= k).drop("i")
        .withColumn("i", F.row_number().over(overall)).filter(F.col("i") <= k).drop("spread")
    )


def top_edges(graph: Profiles, min_cooc: int = 2, k: int = 300) -> DataFrame:
    """The `k` heaviest edges with cooc >= min_cooc, ties by src, then dst. Exact.

    1. The weight of the k-th edge follows from the edges per weight; profiles
       with fewer cells and lighter pairs are left out.
    2. Profile pairs are ranked by weight and by the first edge they hold. A pair
       ranked above an edge holds an edge above it, so `k` pairs are enough; one
       more, since for a profile with itself only the src of that edge is known.
    3. Within a pair, an edge cannot be among the first `k` if `k` edges have a
       smaller src, or if `k` nodes of its profile come before its dst.

    All that is formed is bounded by `k`, not by the size of a profile.
    """
    pairs = _with_edges(profile_pairs(graph, _weight_cut(graph, min_cooc, k))).withColumns({
        "low": F.least("p_first_node", "q_first_node"),
        "high": F.greatest("p_first_node", "q_first_node"),
    })
    best = materialize(topk(pairs, "cooc", k + 1, ["low", "high"]), "pairs")

    def oriented(s: str, d: str) -> DataFrame:
        return best.select(
            F.col(f"{s}_pid").alias("s_pid"), F.col(f"{d}_pid").alias("d_pid"),
            F.col(f"{d}_size").alias("d_size"), "cooc", _same().alias("same"),
        )

    ways = oriented("p", "q").unionByName(oriented("q", "p").filter(~F.col("same")))
    firsts = _first_nodes(graph, ways.select(F.col("s_pid").alias("pid")).distinct(), k + 1)
    src = firsts.select(F.col("pid").alias("s_pid"), F.col("node").alias("src"), "i")
    dst = firsts.select(F.col("pid").alias("d_pid"), F.col("node").alias("dst"))
    i, size = F.col("i"), F.col("d_size")
    smaller_src = F.when(F.col("same"), (i - 1) * size - i * (i - 1) / 2).otherwise((i - 1) * size)
    edges = (
        src.join(F.broadcast(ways), "s_pid").filter(smaller_src < k)
        .join(dst, "d_pid").filter(F.col("src") < F.col("dst"))
        .select("src", "dst", "cooc")
    )
    return topk(edges, "cooc", k, ["src", "dst"])


def prune(edges: DataFrame, min_cooc: int, k: int) -> DataFrame:
    """Edges of at least a weight, the `k` heaviest."""
    return topk(edges.filter(F.col("cooc") >= min_cooc), "cooc", k, ["src", "dst"])


def edges_out(edges: DataFrame) -> DataFrame:
    """Edges with state and city of both ends."""
    return edges.withColumns({
        "src_state": node_part("src", 0), "src_city": node_part("src", 1),
        "dst_state": node_part("dst", 0), "dst_city": node_part("dst", 1),
    })


# --- degrees and hubs ---------------------------------------------------------------------

def _profile_degrees(graph: Profiles, min_cooc: int) -> DataFrame:
    """Degree and weighted degree that every node of a profile has: a pair adds to both its ends."""
    one = F.when(_same(), 1).otherwise(0)
    ends = F.array(F.struct(F.col("p_pid").alias("pid"), (F.col("q_size") - one).alias("partners")),
                   F.when(~_same(), F.struct(F.col("q_pid").alias("pid"), F.col("p_size").alias("partners"))))
    pairs = profile_pairs(graph, min_cooc).select(F.explode(ends).alias("end"), "cooc").filter("end IS NOT NULL")
    sums = pairs.groupBy("end.pid").agg(
        F.sum("end.partners").alias("degree"),
        F.sum(F.col("end.partners") * F.col("cooc")).alias("degree_weighted"),
    )
    return sums.filter("degree > 0").join(graph.table.select("pid", "profile", "first_node"), "pid")


def hubs_of_all_edges(graph: Profiles, min_cooc: int = 2, k: int = 300) -> DataFrame:
    """Degree and weighted degree over every edge of at least a weight; the top `k`.

    All nodes of a profile have the same degrees, so these are summed per profile
    pair. A profile ranked above a node holds a node above it, which makes the
    first `k` profiles enough and bounds the broadcast.
    """
    best = topk(_profile_degrees(graph, min_cooc), "degree_weighted", k, ["first_node"])
    ranked = graph.nodes.join(F.broadcast(best), "profile")
    return topk(ranked.select("node", "degree", "degree_weighted"), "degree_weighted", k, ["node"])


def undirect(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, as u, v, cooc."""
    there = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"), "cooc")
    back = edges.select(F.col("dst").alias("u"), F.col("src").alias("v"), "cooc")
    return there.unionByName(back)


def degrees(edges: DataFrame) -> DataFrame:
    """Degree and weighted degree per node of an edge list."""
    return undirect(edges).groupBy(F.col("u").alias("node")).agg(
        F.count(F.lit(1)).alias("degree"), F.sum("cooc").alias("degree_weighted")
    )


def hubs(edges: DataFrame, risk: DataFrame | None = None, k: int = 3000) -> DataFrame:
    """The `k` nodes with the largest weighted degree, node risk attached."""
    top = topk(degrees(edges), "degree_weighted", k, ["node"])
    return top if risk is None else top.join(risk, "node", "left")


def node_risk(
    df: DataFrame, node: str, severity: str | None = None, only: DataFrame | None = None
) -> DataFrame:
    """Rows per node, and the average severity if a column is given.

    `only` limits the work to the nodes of an edge list: rows of other nodes are
    dropped before the aggregation, by a broadcast where the list is small.
    """
    if only is not None:
        df = df.join(only.select(F.col("node").alias(node)), node, "left_semi")
    aggs = [F.count(F.lit(1)).alias("n")]
    if severity is not None:
        aggs.append(F.avg(severity).alias("avg_pred_sev"))
    return df.groupBy(F.col(node).alias("node")).agg(*aggs)


def endpoints(edges: DataFrame) -> DataFrame:
    """Distinct nodes of an edge list."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


# --- communities -----------------------------------------------------------------------------

def communities(edges: DataFrame, hub_nodes: DataFrame, rounds: int | None = 8) -> DataFrame:
    """Smallest label reached within `rounds` steps inside the hub graph.

    A fixed number of rounds need not finish: on a path of more nodes than rounds
    several labels stay. None gives the labels of the end, the least name of each
    component, without a round for each step (see `settle`); 0 gives own names.

    Every hub starts with its own name and takes the least of its own and its
    neighbours' labels in each round. A loop edge per hub stands for its own
    label, so that a round reads the labels once: the plan grows linearly, with
    one join and one partial aggregation per round, over a materialized graph.
    """
    hub = hub_nodes.select("node").distinct()
    links = undirect(edges).select("u", "v")
    for end in ("u", "v"):
        links = links.join(hub.select(F.col("node").alias(end)), end, "left_semi")
    if rounds is None:
        return settle(links, hub)[0]
    if rounds == 0:
        return hub.select("node", F.col("node").alias("label"))
    loops = hub.select(F.col("node").alias("u"), F.col("node").alias("v"))
    graph = materialize(links.select("u", "v").unionByName(loops), "links")
    labels = graph.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("label"))
    for _ in range(rounds - 1):
        labels = (
            graph.join(labels, "v").groupBy("u").agg(F.min("label").alias("label"))
            .withColumnRenamed("u", "v")
        )
    return labels.select(F.col("v").alias("node"), "label")


def settle(links: DataFrame, nodes: DataFrame) -> tuple[DataFrame, list[dict[str, int]]]:
    """Least name of each component, and what each round read: links (both ways, u and v) and changes.

    In a round a node with a smaller neighbour takes the least of them as its label.
    Only these changes are passed on: chains of them are shortened by doubling, until
    a count that is observed while the table is written says that none moved. Then
    the ends of the links are replaced by their labels, and links within a label
    are left out: the links shrink from round to round, and none is left at the end.
    """
    links, seen = materialize_counted(links.where("u <> v").distinct(), "links", links=F.count(F.lit(1)))
    labels = nodes.select("node", F.col("node").alias("label"))
    history: list[dict[str, int]] = []
    while seen["links"]:
        least = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
        changes, found = materialize_counted(least.where("label < node"), "changes", changes=F.count(F.lit(1)))
        history.append({**seen, **found})
        moved = found["changes"]
        while moved:
            further = changes.select(F.col("node").alias("label"), F.col("label").alias("next"))
            jumped = changes.join(further, "label", "left").select(
                "node", F.coalesce("next", "label").alias("label"), F.col("next").isNotNull().alias("moved"))
            changes, found = materialize_counted(jumped, "changes", moved=F.count_if("moved"))
            moved = found["moved"]

        def relabelled(df: DataFrame, column: str) -> DataFrame:
            change = changes.select(F.col("node").alias(column), F.col("label").alias("_new"))
            return df.join(change, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")

        shorter = relabelled(relabelled(links, "u"), "v").where("u <> v").distinct()
        links, seen = materialize_counted(shorter, "links", links=F.count(F.lit(1)))
        labels = materialize(relabelled(labels, "label").select("node", "label"), "labels")
    return labels, history


def community_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_nodes"))


# --- bipartite graphs ---------------------------------------------------------------------------

def bipartite(df: DataFrame, left: str, right: str, min_cooc: int, k: int) -> DataFrame:
    """Edges between the values of two columns, weighted by rows; the `k` heaviest."""
    keys = df.select(F.col(left).alias("src"), F.col(right).alias("dst"))
    counts = clean_key(keys, ["src", "dst"]).groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("cooc")
    )
    return prune(counts, min_cooc, k)


def bipartite_or_none(
    df: DataFrame, left: Sequence[str], right: Sequence[str], min_cooc: int, k: int
) -> DataFrame | None:
    """`bipartite` on the first existing columns, None if a side has none."""
    a, b = resolve_col(df, left), resolve_col(df, right)
    return bipartite(df, a, b, min_cooc, k) if a and b else None
