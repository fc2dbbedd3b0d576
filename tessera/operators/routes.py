"""Batched shortest paths over a table of weighted edges.

One search answers all queries. Queries of one source share it: a label is
``(sid, node, distance, hops)`` with the source's node as ``sid``, of constant
size, and holds no path. A round relaxes the labels that improved
(``relax``), and merges the best candidates into the one state table.

1. *Chains.* A node that no query names, with one way in and one way out (or
   the same two neighbours both ways), is passed through in only one way.
   ``contract_chains`` turns each run of such nodes into one edge, by list
   ranking with pointer jumping (log2 of the longest run joins), or, if there are
   very many, by rounds that take out about a third of them (``_eliminate``), so
   rounds of the search grow with the hops of the core graph. Of edges side by side the heavier ones go
   then (``lightest``), which may leave further chains: they are contracted in
   turn.
2. *State.* One table, bucketed by ``(sid, node)``; a round's candidates are
   dealt out the same way, so the join of both needs no exchange on the side
   of the state. A round is one Spark job.
3. *Argmin.* Two hash aggregates: fewest hops of each distance, then the least
   distance with its hops. No sort, and both are on fixed-width values.
4. *Pruning, never changing a result.* Queries whose ends lie in different
   components (edges taken both ways) have no route and start no search, which
   would have to exhaust all their source reaches; edges of components without
   a query go (``connected_part``). A candidate goes if its distance and a
   lower bound of the rest exceed the best route known to each target of its
   source. Lower bounds: great-circle metres (weights must not be under
   ``heuristic_scale`` times those) and landmarks (distances to a few chosen
   nodes and from them, by the triangle inequality), which hold for any
   weight. Best routes known: labels at seeds, which are nodes with a known
   distance to the target, and ways over a landmark. Targets of one source are
   summed up by a centre and a radius, and by least and largest landmark
   distances, so a source has one row however many targets it has.
5. *Distance buckets.* With ``delta``, only labels up to a threshold are
   relaxed, which then moves on, so fewer labels are written more than once.
6. *Routes.* From the settled labels, edges that are part of a shortest path
   are found in one pass, and a route is read off by following pointers, which
   are doubled each time (log2 of the hops joins). Where routes of equal length
   meet, ``track="path"`` takes the smallest node sequence: all best
   predecessors of these routes are walked back, then the smallest next node
   is followed from the source. ``track="pred"`` takes fewest hops, then the
   smaller predecessor. Along edges of weight 0 both keep to fewest hops.
7. *Settlement.* With ``on_settled``, a query whose best route no open label
   can beat is handed over at once and leaves the search.

A node with ``d`` out-edges has ``ceil(d / fanout)`` buckets, known before the
edges are dealt out by ``(source, bucket)``, and its frontier rows are
replicated to them: a hub never lands whole in one task. All tables lie under
``spark.checkpoint.dir`` and survive lost executors; joins carry no size
switch, the planner picks them from measured sizes.
"""

from __future__ import annotations

import functools
import logging
import math
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.geo import haversine_m
from tessera.session import bucketed, remove_table, scratch_path, shuffles_removed, write_read

EDGES_PER_PARTITION = 1_000_000 # target size of an edge partition
FANOUT = 100_000                # out-edges of one node that share a bucket
ELIMINATE = 2_000_000           # chain nodes beyond which they are taken out by rounds, not by pointer jumping
MANY_INNER = 16                 # nodes are contracted again if one in so many is only passed through
SEEDS = 256                     # nodes near a target with a known distance to it; a tighter bound only

# Slack of the pruning test, so that rounding can never prune a label of a best route.
REL_SLACK = 1e-9
ABS_SLACK = 1e-6

log = logging.getLogger("tessera.routes")


# ------------------------------------------------------------ route queries

def valid_queries(queries: DataFrame, vertices: DataFrame, id_col: str = "id") -> DataFrame:
    """Queries whose source and destination both exist among ``vertices``.

    The vertices are narrowed to the queries' end points first: that semi join
    has the queries on the side that the planner may broadcast.
    """
    ends = queries.select(F.explode(F.array("src", "dst")).alias("_end"))
    v = vertices.select(F.col(id_col).alias("_vid"))
    v = v.join(ends, v["_vid"] == ends["_end"], "left_semi")
    return (queries.join(v, queries["src"] == v["_vid"], "left_semi")
            .join(v, queries["dst"] == v["_vid"], "left_semi"))


# ------------------------------------------------------------ edges

def land_edges(edges: DataFrame, weight_col: str, path: str, check_negative: bool = True) -> tuple[DataFrame, int]:
    """``_from, _to, _w`` as a table, and their number; weights are checked on the way.

    Rows with a null end or weight are dropped, so are self loops, which no
    shortest path uses.
    """
    e = (edges.select(F.col("src").alias("_from"), F.col("dst").alias("_to"), F.col(weight_col).cast("double").alias("_w"))
         .where("_from IS NOT NULL AND _to IS NOT NULL AND _w IS NOT NULL"))
    seen = Observation()
    e = e.observe(seen, F.min("_w").alias("min_w"), F.max("_w").alias("max_w"), F.count(F.lit(1)).alias("n"))
    e = write_read(e.where("_from <> _to"), path)
    if seen.get["max_w"] is not None and math.isnan(seen.get["max_w"]):     # NaN sorts above every number
        raise ValueError("shortest paths need edge weights that are numbers")
    if check_negative and seen.get["min_w"] is not None and seen.get["min_w"] < 0:
        raise ValueError("shortest paths need non-negative edge weights")
    return e, seen.get["n"]


def plain_core(e: DataFrame) -> DataFrame:
    """Edges as core edges: ``_h`` hops, ``_first`` / ``_last`` node after the start / before the end."""
    return e.select("*", F.lit(1).cast("long").alias("_h"), F.col("_to").alias("_first"), F.col("_from").alias("_last"))


def degrees(core: DataFrame, path: str) -> tuple[DataFrame, int]:
    """``node, n_out, out_lo, out_hi, n_in, in_lo, in_hi`` of every node as a table, and its rows."""
    out = core.groupBy(F.col("_from").alias("node")).agg(
        F.count(F.lit(1)).alias("n_out"), F.min("_to").alias("out_lo"), F.max("_to").alias("out_hi"))
    into = core.groupBy(F.col("_to").alias("node")).agg(
        F.count(F.lit(1)).alias("n_in"), F.min("_from").alias("in_lo"), F.max("_from").alias("in_hi"))
    seen = Observation()
    nodes = write_read(out.join(into, "node", "full_outer"), path, seen, [F.count(F.lit(1)).alias("n")])
    return nodes, seen.get["n"]


def lightest(core: DataFrame, track: str) -> DataFrame:
    """Of the edges between the same two nodes those that a route may be chosen from: at most two.

    Least weight, then fewest hops. With ``track="path"`` the one of least weight
    and smallest next node stays as well, as it settles routes of equal length.
    """
    cols = ["_w", "_h", "_first", "_last"]
    ties = {"pred": [["_w", "_h", "_last", "_first"]], "path": [cols, ["_w", "_first", "_h", "_last"]]}[track]
    best = core.groupBy("_from", "_to").agg(*[F.min(F.struct(*t)).alias(f"_b{i}") for i, t in enumerate(ties)])
    kept = F.array_distinct(F.array(*[F.struct(*[F.col(f"_b{i}")[c].alias(c) for c in cols]) for i in range(len(ties))]))
    return best.select("_from", "_to", F.explode(kept).alias("_e")).select("_from", "_to", *[F.col("_e")[c].alias(c) for c in cols])


def contract_chains(e: DataFrame, ends: DataFrame, track: str, scratch: str) -> tuple[DataFrame, list[DataFrame], DataFrame, int | None]:
    """Core edges without the nodes that are only passed through, those nodes, the core's ``degrees`` and its edges' number.

    ``ends`` is ``(node)``: they stay. Core edges are ``_from, _to, _w, _h,
    _first, _last``; members is a list of tables ``_from, _first, pos, node, _next``,
    one a step: an edge ``(_from, _first)`` after the step is the one before it,
    then, ``pos`` hops on, the edge ``(node, _next)``. Closed rings without a core node
    are left out, nothing can reach them. Where a contracted chain runs beside
    another edge the heavier one goes, which may leave nodes that are now only
    passed through: as long as these are many, they are contracted in turn.
    The number is None if nothing was contracted.
    """
    kept = ends.select("node", F.lit(True).alias("_end"))
    one_way = (F.col("n_out") == 1) & (F.col("n_in") == 1) & (F.col("out_lo") != F.col("in_lo"))
    two_way = ((F.col("n_out") == 2) & (F.col("n_in") == 2) & (F.col("out_lo") < F.col("out_hi"))
               & (F.col("in_lo") == F.col("out_lo")) & (F.col("in_hi") == F.col("out_hi")))
    core, members, n_core, k = plain_core(e), [], None, 0
    while True:
        at = f"{scratch}/level-{k}"
        nodes, n = degrees(core, f"{at}/degrees")
        seen = Observation()
        inner = nodes.where(one_way | two_way).join(kept, "node", "left").where(F.col("_end").isNull())
        inner = write_read(inner.select("node", "in_lo", "in_hi"), f"{at}/inner", seen, [F.count(F.lit(1)).alias("n")])
        many = seen.get["n"] * MANY_INNER >= n
        if not seen.get["n"] or (k and not many):
            return core, members, nodes, n_core
        if seen.get["n"] > ELIMINATE:
            core, inside = _eliminate(core if k else e, inner, at)
        else:
            core, inside = _contract(core, inner, at)
        members += inside
        size = Observation()
        core = write_read(lightest(core, track) if many else core, f"{at}/core", size, [F.count(F.lit(1)).alias("n")])
        n_core, k = size.get["n"], k + 1


def _eliminate(e: DataFrame, inner: DataFrame, scratch: str) -> tuple[DataFrame, list[DataFrame]]:
    """``_contract`` for long tables: a round takes out the nodes of least random rank among their neighbours.

    An edge goes to its end of lower rank, so a node that gets all its edges is
    such a least one, and its edges become edges past it: one exchange a round
    of the edges that still have an inner end, and about a third of their nodes
    goes. Edges, exchanges and members together stay in proportion to the
    edges, where pointer jumping moves all of them once a jump. A round's edges
    are removed when the next round's are written.
    """
    spark = e.sparkSession
    own = ["_from", "_to", "_w", "_h", "_first", "_last"]
    left = F.col("kf") + F.col("kt") > 0
    counts = [F.count_if(left).alias("left"), F.count_if(~left).alias("done")]
    kind = F.when(F.col("in_lo") == F.col("in_hi"), 1).otherwise(2)
    f, t = (inner.select(F.col("node").alias(c), kind.alias(k)) for c, k in (("_from", "kf"), ("_to", "kt")))
    edges = e.join(f, "_from", "left").join(t, "_to", "left")
    edges = (edges if "_h" in e.columns else plain_core(edges)).select(     # first edges go without columns that are copies
        *own, *[F.coalesce(k, F.lit(0)).alias(k) for k in ("kf", "kt")])
    seen, k = Observation(), 0
    now = write_read(edges, f"{scratch}/round-0", seen, counts)
    done, members = [], []
    while True:
        if seen.get["done"]:
            write_read(now.where(~left).select(*own), f"{scratch}/done-{k}")
            done.append(f"{scratch}/done-{k}")
        if k:
            inside = now.where("node IS NOT NULL").select("_from", "_first", "pos", "node", "_next")
            members.append(write_read(inside, f"{scratch}/inside-{k}"))
        if not seen.get["left"]:
            remove_table(spark, f"{scratch}/round-{k}")
            return (spark.read.schema(now.select(*own).schema).parquet(*done) if done else
                    spark.createDataFrame([], now.select(*own).schema)), members
        seen, k = Observation(), k + 1
        now = write_read(_without_least(now.where(left), k), f"{scratch}/round-{k}", seen, counts)
        remove_table(spark, f"{scratch}/round-{k - 1}")


def _without_least(edges: DataFrame, k: int) -> DataFrame:
    """Edges with an inner end, past the nodes of least rank; ``node, _next, pos`` of new ones: where they were joined."""
    rank = lambda c: F.struct(F.xxhash64(c, F.lit(k)).alias("r"), F.col(c).alias("n"))
    lower = (F.when(F.col("kf") == 0, F.col("_to")).when(F.col("kt") == 0, F.col("_from"))
             .when(rank("_from") < rank("_to"), F.col("_from")).otherwise(F.col("_to")))
    cols = ["_from", "_to", "_w", "_h", "_first", "_last", "kf", "kt"]
    # an inner node has at most two edges in and two out
    at = edges.groupBy(lower.alias("u")).agg(F.collect_list(F.struct(*cols)).alias("es"))
    at = at.select("u", "es", F.filter("es", lambda x: x["_to"] == F.col("u")).alias("ins"),
                   F.filter("es", lambda x: x["_from"] == F.col("u")).alias("outs"))
    ways = F.coalesce(F.get("ins", F.lit(0))["kt"], F.get("outs", F.lit(0))["kf"])
    least = (F.size("ins") == ways) & (F.size("outs") == ways)

    def past(i: Column) -> Column:
        on = F.filter("outs", lambda o: o["_to"] != i["_from"])      # no turning back; a closed ring goes
        return F.transform(on, lambda o: F.struct(
            i["_from"].alias("_from"), o["_to"].alias("_to"), (i["_w"] + o["_w"]).alias("_w"), (i["_h"] + o["_h"]).alias("_h"),
            i["_first"].alias("_first"), o["_last"].alias("_last"), i["kf"].alias("kf"), o["kt"].alias("kt"),
            F.col("u").alias("node"), o["_first"].alias("_next"), i["_h"].alias("pos")))

    none = F.lit(None).cast(edges.schema["_from"].dataType)
    same = F.transform("es", lambda x: F.struct(*[x[c].alias(c) for c in cols], none.alias("node"), none.alias("_next"),
                                                F.lit(None).cast("long").alias("pos")))
    return at.select(F.explode(F.when(least, F.flatten(F.transform("ins", past))).otherwise(same)).alias("x")).select("x.*")


def _contract(e: DataFrame, inner: DataFrame, scratch: str) -> tuple[DataFrame, list[DataFrame]]:
    """Core edges without the nodes ``inner (node, in_lo, in_hi)``, and what lies inside the new ones."""
    # every edge out of an inner node has one edge before it, and that one alone may be followed by it
    i = inner.withColumnRenamed("node", "u")
    before = F.when(F.col("_to") == F.col("in_lo"), F.col("in_hi")).otherwise(F.col("in_lo"))
    own = ["_w", "_h", "_first", "_last"]
    darts = e.join(i, e["_from"] == i["u"]).select("u", F.col("_to").alias("v"), *own, before.alias("pu"))
    last = e.select(F.col("_from").alias("pu"), F.col("_to").alias("u"), F.col("_w").alias("dist"), F.col("_h").alias("off"),
                    F.col("_first").alias("pf"))
    flag = inner.select(F.col("node").alias("pu"), F.lit(True).alias("_inner"))
    # pu, pv: the edge found so far before this one, pf its first node; off, dist: from pu to u
    darts = (darts.join(last, ["pu", "u"]).join(flag, "pu", "left")
             .select("u", "v", *own, "pu", F.col("u").alias("pv"), "pf", "off", "dist", F.col("_inner").isNull().alias("done")))
    k, left_over = 0, -1
    while True:
        seen = Observation()
        darts = write_read(darts, f"{scratch}/darts-{k}", seen, [F.count_if(~F.col("done")).alias("n")])
        if k:
            remove_table(e.sparkSession, f"{scratch}/darts-{k - 1}")
        if seen.get["n"] in (0, left_over):     # what no jump finishes any more is a ring
            break
        left_over, k = seen.get["n"], k + 1
        jump = darts.select(F.col("u").alias("pu"), F.col("v").alias("pv"), F.col("pu").alias("qu"), F.col("pv").alias("qv"),
                            F.col("pf").alias("qf"), F.col("off").alias("more"), F.col("dist").alias("far"),
                            F.col("done").alias("there"))
        step = darts.where("NOT done").join(jump, ["pu", "pv"]).select(
            "u", "v", *own, F.col("qu").alias("pu"), F.col("qv").alias("pv"), F.col("qf").alias("pf"),
            (F.col("off") + F.col("more")).alias("off"), (F.col("dist") + F.col("far")).alias("dist"), F.col("there").alias("done"))
        darts = darts.where("done").unionByName(step)
    done = darts.where("done")
    inside = done.select(F.col("pu").alias("_from"), F.col("pf").alias("_first"), F.col("off").alias("pos"),
                         F.col("u").alias("node"), F.col("_first").alias("_next"))
    short = (done.join(inner.select(F.col("node").alias("v")), "v", "left_anti").where("pu <> v")
             .select(F.col("pu").alias("_from"), F.col("v").alias("_to"), (F.col("dist") + F.col("_w")).alias("_w"),
                     (F.col("off") + F.col("_h")).alias("_h"), F.col("pf").alias("_first"), "_last"))
    n = inner.select("node")
    plain = e.join(n, e["_from"] == n["node"], "left_anti").join(n, e["_to"] == n["node"], "left_anti")
    return plain.unionByName(short), [inside]


def linked(links: DataFrame, scratch: str) -> DataFrame:
    """Undirected links ``(a, b)`` -> ``(node, root)``: the smallest node that a node is connected with.

    A node points at a smaller one of its part. A round hooks it, and what it
    points at, to the least that its neighbours' pointers point at, and jumps
    along. Rounds grow with the logarithm of the number of nodes.
    """
    both = write_read(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{scratch}/links")
    f = write_read(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), f"{scratch}/roots-0")
    k = 0
    while True:
        k += 1
        g = f.join(f.select(F.col("node").alias("root"), F.col("root").alias("up")), "root")
        near = both.join(g.select(F.col("node").alias("b"), "up"), "b").groupBy(F.col("a").alias("node")).agg(F.min("up").alias("near"))
        none = F.lit(None).cast("long")
        hooks = g.join(near, "node").select(F.explode(F.array(
            F.struct(F.col("root").alias("node"), F.col("near").alias("root"), none.alias("old")),
            F.struct(F.col("node"), F.least("up", "near").alias("root"), F.col("root").alias("old")))).alias("h"))
        seen = Observation()
        f = write_read(hooks.groupBy("h.node").agg(F.min("h.root").alias("root"), F.max("h.old").alias("old")),
                       f"{scratch}/roots-{k}", seen, [F.count_if(F.col("root") != F.col("old")).alias("n")]).select("node", "root")
        if not seen.get["n"]:
            return f


def weak_components(core: DataFrame, nodes: DataFrame, scratch: str) -> DataFrame:
    """``(node, root)`` of the core's nodes, the ways of edges aside.

    Up to four neighbours of each node (``degrees`` has them) connect nearly all
    there is; only edges between the parts found so are looked at again.
    """
    few = nodes.select(F.col("node").alias("a"), F.explode(F.array("out_lo", "out_hi", "in_lo", "in_hi")).alias("b"))
    parts = linked(few.where("b IS NOT NULL AND a <> b"), f"{scratch}/few")
    if parts.select("root").distinct().limit(2).count() < 2:    # one part: no edge lies between two
        return parts
    seen = Observation()
    left = (core.select("_from", "_to").join(parts.select(F.col("node").alias("_from"), F.col("root").alias("a")), "_from")
            .join(parts.select(F.col("node").alias("_to"), F.col("root").alias("b")), "_to")
            .where("a <> b").select("a", "b").distinct())
    left = write_read(left, f"{scratch}/left", seen, [F.count(F.lit(1)).alias("n")])
    if not seen.get["n"]:
        return parts
    top = linked(left, f"{scratch}/top").select(F.col("node").alias("root"), F.col("root").alias("_top"))
    return parts.join(top, "root", "left").select("node", F.coalesce("_top", "root").alias("root"))


def connected_part(q: DataFrame, core: DataFrame, nodes: DataFrame, n_core: int, scratch: str) -> tuple[DataFrame, DataFrame, int]:
    """Queries whose ends are connected, the core edges of the components that these lie in, and the edges' number.

    No route leaves a component, so the others can be part of none.
    """
    parts = weak_components(core, nodes, scratch)
    at = parts.select(F.col("node").alias("src"), F.col("root").alias("_at"))
    to = parts.select(F.col("node").alias("dst"), F.col("root").alias("_to"))
    seen = Observation()
    q = write_read(q.join(at, "src").join(to, "dst").where(F.col("_at") == F.col("_to")).select("query_id", "src", "dst", "_at"),
                   f"{scratch}/queries", seen, [F.count(F.lit(1)).alias("n")])
    if not seen.get["n"]:
        return q.drop("_at"), core.limit(0), 0
    near = parts.join(q.select(F.col("_at").alias("root")).distinct(), "root", "left_semi").select(F.col("node").alias("_from"))
    size = Observation()
    asked = write_read(near, f"{scratch}/nodes", size, [F.count(F.lit(1)).alias("n")])
    if size.get["n"] == parts.count():
        return q.drop("_at"), core, n_core
    size = Observation()
    core = write_read(core.join(asked, "_from", "left_semi"), f"{scratch}/core", size, [F.count(F.lit(1)).alias("n")])
    return q.drop("_at"), core, size.get["n"]


def _buckets(degrees: DataFrame, fanout: int) -> DataFrame:
    """``node, _nb`` of the nodes ``(node, n_out)`` with more than one bucket."""
    return degrees.where(F.col("n_out") > fanout).select("node", F.ceil(F.col("n_out") / F.lit(fanout)).cast("int").alias("_nb"))


def find_hubs(core: DataFrame, fanout: int, scratch: str) -> DataFrame:
    """``node, _nb``: nodes with more than one bucket, at most one for each ``fanout`` edges."""
    n_out = core.groupBy(F.col("_from").alias("node")).agg(F.count(F.lit(1)).alias("n_out"))
    return write_read(_buckets(n_out, fanout), f"{scratch}/hubs")


def _place(node: str, bucket: str) -> Column:
    """The key that edges and labels meet by: one long, whatever integers the ids are."""
    return F.xxhash64(F.col(node).cast("long"), F.col(bucket).cast("int"))


def deal_out(core: DataFrame, hubs: DataFrame, n: int, extra: DataFrame | None = None) -> DataFrame:
    """Edges hash-partitioned by ``_place`` of ``(_from, _bucket)`` with ``_to_nb``, the buckets of the target.

    ``extra`` is ``(node, ...)``; its columns ride along for the target node.
    """
    of = hubs.select(F.col("node").alias("_from"), F.col("_nb").alias("_from_nb"))
    to = hubs.select(F.col("node").alias("_to"), F.col("_nb").alias("_to_nb"))
    b = core.join(of, "_from", "left").join(to, "_to", "left")
    more = []
    if extra is not None:
        more = [c for c in extra.columns if c != "node"]
        b = b.join(extra.withColumnRenamed("node", "_to"), "_to", "left")
    b = b.select("_from", F.pmod(F.xxhash64("_to"), F.coalesce("_from_nb", F.lit(1))).cast("int").alias("_bucket"),
                 "_to", "_w", "_h", "_first", "_last", F.coalesce("_to_nb", F.lit(1)).cast("int").alias("_to_nb"), *more)
    return b.withColumn("_place", _place("_from", "_bucket")).repartition(n, "_place")


def held(dealt: DataFrame) -> DataFrame:
    """Edges of ``deal_out``, cached in the order of their key: a round's join neither deals out nor sorts them."""
    return dealt.sortWithinPartitions("_place").persist(StorageLevel.MEMORY_AND_DISK)


def partition_count(spark: SparkSession, n_edges: int, num_partitions: int | None = None) -> int:
    """A partition for each ``EDGES_PER_PARTITION`` edges, and one for each core at least."""
    return num_partitions or max(spark.sparkContext.defaultParallelism, -(-n_edges // EDGES_PER_PARTITION))


def prepare_edges(edges: DataFrame, weight_col: str = "distance", fanout: int | None = None,
                  num_partitions: int | None = None, check_negative: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(edges, hubs)`` ready for ``relax``, without contraction: see ``deal_out`` and ``find_hubs``."""
    spark = edges.sparkSession
    scratch = scratch_path(spark, "edges")
    e, n = land_edges(edges, weight_col, f"{scratch}/all", check_negative)
    hubs = find_hubs(e, fanout or FANOUT, scratch)
    return deal_out(plain_core(e), hubs, partition_count(spark, n, num_partitions)), hubs


# ------------------------------------------------------------ rounds

def extend(frontier: DataFrame, prepared: DataFrame) -> DataFrame:
    """Labels ``sid, node, distance, hops, nb`` one edge on, with the edge's columns."""
    f = frontier.select("sid", "node", "distance", "hops",
                        F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("_at"))
    f = f.withColumn("_key", _place("node", "_at"))
    # one long is the key, which hash joins look up fastest; the ids themselves are compared only where it is equal
    same = (F.col("node").bitwiseXOR(F.col("_from")) == 0) & (F.col("_at").bitwiseXOR(F.col("_bucket")) == 0)
    j = f.join(prepared, (f["_key"] == prepared["_place"]) & same)
    kept = [c for c in prepared.columns if c not in ("_from", "_to", "_bucket", "_place", "_h", "_to_nb")]
    return j.select("sid", "_from", F.col("_to").alias("node"), (F.col("distance") + F.col("_w")).alias("distance"),
                    (F.col("hops") + F.col("_h")).alias("hops"), F.col("_to_nb").alias("nb"), *kept)


def best_labels(candidates: DataFrame, n: int) -> DataFrame:
    """Least ``(distance, hops)`` of each ``(sid, node)``, in ``n`` partitions by these: hash aggregates only."""
    return (candidates.select("sid", "node", "distance", "hops", "nb").repartition(n, "sid", "node")
            .groupBy("sid", "node", "distance").agg(F.min("hops").alias("hops"), F.max("nb").alias("nb"))
            .groupBy("sid", "node").agg(F.min("distance").alias("_d"), F.min_by("hops", "distance").alias("_h"),
                                        F.max("nb").alias("_nb")))


def relax(frontier: DataFrame, prepared: DataFrame, n: int, goal: DataFrame | None = None) -> DataFrame:
    """One step of message passing: best candidates ``sid, node, _d, _h, _nb``."""
    return best_labels(prune(extend(frontier, prepared), goal), n)


def merge_labels(state: DataFrame, best: DataFrame, relaxed: Column) -> DataFrame:
    """State with the candidates that are strictly better (``_better``); ``fresh`` labels are still to be relaxed.

    Both sides are partitioned by ``(sid, node)`` alike: no exchange.
    """
    better = F.col("_d").isNotNull() & (F.col("distance").isNull() | (
        F.struct("_d", "_h") < F.struct(F.col("distance").alias("_d"), F.col("hops").alias("_h"))))
    pick = lambda new, old: F.when(better, F.col(new)).otherwise(F.col(old)).alias(old)
    return state.join(best.hint("shuffle_hash"), ["sid", "node"], "full_outer").select(
        "sid", "node", pick("_d", "distance"), pick("_h", "hops"), F.coalesce("nb", "_nb").alias("nb"),
        (better | (F.coalesce("fresh", F.lit(False)) & ~relaxed)).alias("fresh"), better.alias("_better"))


class _Goal:
    """What the search knows about each source's open targets: and the bounds that candidates are pruned by.

    ``known`` is ``sid, target, best``, the length of the best route known. It
    changes only when a label at a seed improves, and is written then.
    """

    def __init__(self, pairs: DataFrame, about: DataFrame | None, seeds: DataFrame, scratch: str):
        self.pairs, self.about, self.seeds, self.scratch, self.k = pairs, about, seeds, scratch, 0
        self.at = seeds.select("sid", "node", F.lit(True).alias("_seed")).distinct()
        self.known = pairs.select("sid", "target", F.col("ub").alias("best"))
        self.table = self._table()

    def improve(self, state: DataFrame) -> None:
        """Take in the labels of ``state`` that lie at seeds."""
        self.k += 1
        near = (state.select("sid", "node", "distance").join(self.seeds, ["sid", "node"])
                .groupBy("sid", "target").agg(F.min(F.col("distance") + F.col("db")).alias("near")))
        self.known = write_read(self.known.join(near, ["sid", "target"], "left")
                                .select("sid", "target", F.least("near", "best").alias("best")),
                                f"{self.scratch}/known-{self.k}")
        self.table = self._table()

    def only(self, open_pairs: DataFrame) -> None:
        """Keep the targets of ``open_pairs (sid, target)``."""
        self.k += 1
        self.known = write_read(self.known.join(open_pairs, ["sid", "target"], "left_semi"), f"{self.scratch}/known-{self.k}")
        self.table = self._table()

    def _table(self) -> DataFrame:
        """``sid, _bound`` and what lower bounds need; ``_bound`` is null while some target has no route."""
        bound = self.known.groupBy("sid").agg(
            F.when(F.count("best") == F.count(F.lit(1)), F.max("best")).alias("_bound"))
        return bound.join(self.about, "sid") if self.about is not None else bound


def prune(candidates: DataFrame, goal: DataFrame | None) -> DataFrame:
    """Candidates that may be part of a best route to some open target of their source."""
    if goal is None:
        return candidates
    c, has = candidates.join(goal, "sid"), set(goal.columns) & {"_c_lat"} | set(candidates.columns)
    rest = [F.lit(0.0)]
    if "_c_lat" in has and "_lat" in has:
        metres = F.nanvl(haversine_m("_lat", "_lon", "_c_lat", "_c_lon"), F.lit(0.0))
        rest.append(F.coalesce((metres - F.col("_radius")) * F.col("_scale"), F.lit(0.0)))
    for name in sorted(x for x in candidates.columns if x.startswith("_lf")):
        i = name[3:]
        rest += [F.coalesce(F.col(f"_gf{i}") - F.col(f"_lf{i}"), F.lit(0.0)),
                 F.coalesce(F.col(f"_lb{i}") - F.col(f"_gb{i}"), F.lit(0.0))]
    lower = F.greatest(*rest) if len(rest) > 1 else rest[0]
    keep = F.col("distance") + lower <= F.col("_bound") * (1 + REL_SLACK) + ABS_SLACK
    return c.where(F.col("_bound").isNull() | keep).select(*candidates.columns)


class _Search:
    """Rounds over one state table."""

    def __init__(self, spark: SparkSession, prepared: DataFrame, hubs: DataFrame, n: int):
        self.spark, self.prepared, self.hubs, self.n = spark, prepared, hubs, n
        self.labels_written = self.rounds = 0

    def _write(self, state: DataFrame, goal: _Goal | None) -> tuple[DataFrame, dict]:
        seen = Observation()
        at_seed = F.lit(0)
        if goal is not None:
            state = state.join(goal.at, ["sid", "node"], "left")
            at_seed = F.count_if(F.col("_better") & F.col("_seed"))
        state = state.observe(seen, F.count_if("_better").alias("better"), F.count_if("fresh").alias("fresh"),
                              F.min(F.when(F.col("fresh"), F.col("distance"))).alias("nearest"), at_seed.alias("at_seed"))
        state = bucketed(state.select("sid", "node", "distance", "hops", "nb", "fresh"), self.n, ["sid", "node"], "state")
        if goal is not None and seen.get["at_seed"]:
            goal.improve(state.where("fresh"))
        return state, seen.get

    def run(self, sources: DataFrame, goal: _Goal | None = None, delta: float | None = None,
            after_round: Callable[[DataFrame, _Goal, bool], None] | None = None) -> DataFrame:
        """``sources (sid)`` -> final ``sid, node, distance, hops, nb``."""
        nb = F.coalesce("_nb", F.lit(1))
        start = sources.join(self.hubs, sources["sid"] == self.hubs["node"], "left").select(
            "sid", F.col("sid").alias("node"), F.lit(0.0).alias("distance"), F.lit(0).cast("long").alias("hops"),
            nb.alias("nb"), F.lit(True).alias("fresh"), F.lit(True).alias("_better"))
        state, seen = self._write(start, goal)
        until = math.inf if delta is None else 0.0
        while seen["fresh"]:
            t0 = time.perf_counter()
            if delta is not None:
                until = max(until, seen["nearest"] + delta)
            relaxed, now = F.col("distance") <= F.lit(until), goal.table if goal else None
            best = relax(state.where(F.col("fresh") & relaxed), self.prepared, self.n, now)
            state, seen = self._write(merge_labels(state, best, relaxed), goal)
            self.labels_written += seen["better"]
            self.rounds += 1
            log.info("round %d: %d labels improved (%.2fs)", self.rounds, seen["better"], time.perf_counter() - t0)
            if after_round is not None:
                after_round(state, goal, not seen["fresh"])
        return state


# ------------------------------------------------------------ bounds

def backward_seeds(pairs: DataFrame, prepared: DataFrame, hops: int, scratch: str) -> DataFrame:
    """``sid, target, node, db``: nodes near each target with their distance to it.

    At most ``SEEDS`` nearest nodes a target and hop are kept; a seed only
    tightens the bound, so a node with very many ways in stays cheap.
    """
    level = found = pairs.select("target", F.col("target").alias("node"), F.lit(0.0).alias("db")).distinct()
    e = prepared.select(F.col("_from").alias("_node"), F.col("_to").alias("node"), "_w")
    nearest = Window.partitionBy("target").orderBy("db", "node")
    for k in range(1, hops + 1):
        step = (level.join(e, "node").groupBy("target", F.col("_node").alias("node"))
                .agg(F.min(F.col("db") + F.col("_w")).alias("db"))
                .withColumn("_k", F.row_number().over(nearest)).where(F.col("_k") <= SEEDS).drop("_k"))
        level = write_read(step, f"{scratch}/seeds-{k}")
        found = found.unionByName(level)
    found = found.groupBy("target", "node").agg(F.min("db").alias("db"))
    return write_read(pairs.select("sid", "target").join(found, "target"), f"{scratch}/seeds")


def centres(pairs: DataFrame, coords: DataFrame, scale: float) -> DataFrame:
    """``sid, _c_lat, _c_lon, _radius, _scale``: a point and the metres within which all targets of a source lie.

    A target without coordinates leaves its source without a lower bound.
    """
    t = pairs.select("sid", "target").join(coords.select(F.col("_id").alias("target"), "_lat", "_lon"), "target", "left")
    c = t.groupBy("sid").agg(F.avg("_lat").alias("_c_lat"), F.avg("_lon").alias("_c_lon"),
                             (F.count(F.col("_lat") + F.col("_lon")) == F.count(F.lit(1))).alias("_all"))
    far = t.join(c, "sid").groupBy("sid").agg(
        F.max(haversine_m("_lat", "_lon", "_c_lat", "_c_lon")).alias("_far"), F.first("_c_lat").alias("_c_lat"),
        F.first("_c_lon").alias("_c_lon"), F.first("_all").alias("_all"))
    return far.select("sid", "_c_lat", "_c_lon", F.when(F.col("_all"), F.col("_far")).alias("_radius"),
                      F.lit(float(scale)).alias("_scale"))


def landmark_distances(core: DataFrame, k: int, n: int, fanout: int, scratch: str) -> DataFrame:
    """``node, _lf<i>, _lb<i>``: distance from and to each of ``k`` landmarks, null where there is no way.

    Landmarks are the core's nodes of smallest id hash; two searches, over the
    edges and the edges turned round, with all landmarks as sources.
    """
    spark = core.sparkSession
    marks = core.select(F.col("_from").alias("sid")).distinct().orderBy(F.xxhash64("sid"), "sid").limit(k)
    marks = write_read(marks.withColumn("i", F.row_number().over(Window.orderBy("sid")) - 1), f"{scratch}/landmarks")  # k rows
    back = core.select(F.col("_to").alias("_from"), F.col("_from").alias("_to"), "_w", "_h", F.col("_last").alias("_first"),
                       F.col("_first").alias("_last"))
    out = None
    for way, edges in (("f", core), ("b", back)):
        hubs = find_hubs(edges, fanout, f"{scratch}/landmark-{way}")
        prepared = held(deal_out(edges, hubs, n))
        try:
            labels = _Search(spark, prepared, hubs, n).run(marks.select("sid"))
        finally:
            prepared.unpersist()
        wide = labels.join(marks, "sid").groupBy("node").agg(
            *[F.min(F.when(F.col("i") == i, F.col("distance"))).alias(f"_l{way}{i}") for i in range(k)])
        out = wide if out is None else out.join(wide, "node", "full_outer")
    return write_read(out, f"{scratch}/landmark-distances")


def _landmark_goals(pairs: DataFrame, marks: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Per source least distances from and largest distances to landmarks over its targets; pairs with ``ub``."""
    t = pairs.select("sid", "target").join(marks.withColumnRenamed("node", "target"), "target", "left")
    every = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.max(c))
    about = t.groupBy("sid").agg(*[F.min(f"_lf{i}").alias(f"_gf{i}") for i in range(k)],
                                 *[every(f"_lb{i}").alias(f"_gb{i}") for i in range(k)])
    s = marks.select(F.col("node").alias("sid"), *[F.col(f"_lb{i}").alias(f"_s{i}") for i in range(k)])
    over = [F.col(f"_s{i}") + F.col(f"_lf{i}") for i in range(k)]
    ub = F.least(*over) if k > 1 else over[0]
    return about, t.join(s, "sid", "left").select("sid", "target", ub.alias("ub"))


# ------------------------------------------------------------ routes from labels

def tight_edges(state: DataFrame, prepared: DataFrame, goal: DataFrame | None) -> DataFrame:
    """Edges that end a shortest path: ``sid, node, _from, _first, _last, distance, hops, via``.

    ``distance`` and ``hops`` are the node's, ``via`` the hops of the way over
    this edge. Edges of weight 0 must also agree in hops, so no cycle is left.
    """
    way = prune(extend(state, prepared), goal).withColumnRenamed("hops", "via").withColumnRenamed("distance", "_d")
    s = state.select("sid", "node", "distance", "hops")
    return (way.join(s, ["sid", "node"])
            .where((F.col("_d") == F.col("distance")) & ((F.col("_w") > 0) | (F.col("via") == F.col("hops"))))
            .select("sid", "node", "_from", "_first", "_last", "distance", "hops", "via"))


def follow(pointers: DataFrame, starts: DataFrame, scratch: str) -> DataFrame:
    """All nodes met from ``starts (query_id, key, node, end)`` to ``end`` along ``pointers (key, node, next)``.

    Pointers are doubled, and met nodes jump along: after k joins 2^k nodes of a way are known.
    """
    none = F.lit(None)
    # a met node is a row with a query, its place in ``next``
    ways = starts.select("query_id", "key", "end", none.cast("long").alias("node"), F.col("node").alias("next")).unionByName(
        pointers.select(none.cast(starts.schema["query_id"].dataType).alias("query_id"), "key",
                        none.cast("long").alias("end"), "node", "next"))
    known, k = -1, 0
    while True:
        seen = Observation()
        ways = write_read(ways, f"{scratch}/ways-{k}", seen, [
            F.count("query_id").alias("met"), F.count_if(F.col("query_id").isNotNull() & F.col("node").isNull()).alias("starts"),
            F.count_if(F.col("next") == F.col("end")).alias("there")])
        met = ways.where("query_id IS NOT NULL")
        if seen.get["met"] == known or seen.get["there"] == seen.get["starts"]:
            return met.select("query_id", "key", F.col("next").alias("node"))
        known, k = seen.get["met"], k + 1
        jump = ways.where("query_id IS NULL").select("key", F.col("node").alias("next"), F.col("next").alias("after"))
        # the place that a met node came from marks it as no start
        ways = met.unionByName(ways.join(jump, ["key", "next"]).select(
            "query_id", "key", "end", F.coalesce("node", "next").alias("node"), F.col("after").alias("next")))


def _ancestors(tight: DataFrame, starts: DataFrame, scratch: str) -> DataFrame:
    """All tight edges ``query_id, sid, _from, node, _first`` on ways to ``starts (query_id, sid, node)``."""
    spark = tight.sparkSession
    level = write_read(starts, f"{scratch}/back-0")
    at, edges = [f"{scratch}/back-0"], []
    while True:
        step = write_read(level.join(tight.select("sid", "node", "_from", "_first"), ["sid", "node"])
                          .select("query_id", "sid", "_from", "node", "_first"), f"{scratch}/ways-{len(at)}")
        edges.append(f"{scratch}/ways-{len(at)}")
        met = spark.read.schema(level.schema).parquet(*at)
        seen = Observation()
        level = write_read(step.select("query_id", "sid", F.col("_from").alias("node")).distinct()
                           .join(met, ["query_id", "sid", "node"], "left_anti").select(*level.columns),
                           f"{scratch}/back-{len(at)}", seen, [F.count(F.lit(1)).alias("n")])
        if not seen.get["n"]:
            return spark.read.schema(step.schema).parquet(*edges)
        at.append(f"{scratch}/back-{len(at)}")


def routes_of(queries: DataFrame, state: DataFrame, prepared: DataFrame, about: DataFrame | None,
              members: list[DataFrame], track: str, scratch: str) -> DataFrame:
    """``query_id, distance, path`` of the queries ``(query_id, src, dst)`` that the labels reach."""
    reached = queries.select("query_id", F.col("src").alias("sid"), F.col("dst").alias("node"))
    # a row a query, landed: the planner would take a join with the labels for large, and deal out the edges of all labels
    # by their few sources
    reached = write_read(reached.join(state.select("sid", "node", "distance"), ["sid", "node"]), f"{scratch}/reached")
    # the lengths of the routes are known now: no edge of a route lies beyond the longest of its source
    bound = reached.groupBy("sid").agg(F.max("distance").alias("_bound"))
    bound = write_read(bound.join(about, "sid") if about is not None else bound, f"{scratch}/bound")
    tight = write_read(tight_edges(state, prepared, bound), f"{scratch}/tight")
    first = F.min(F.struct("via", "_last", "_from", "_first")).alias("p")
    preds = tight.groupBy("sid", "node").agg(first, F.count(F.lit(1)).alias("ties"))
    preds = write_read(preds.select("sid", "node", "p._from", "p._first", "ties"), f"{scratch}/preds")
    starts = reached.select("query_id", F.col("sid").alias("key"), "node", F.col("sid").alias("end"))
    met = follow(preds.select(F.col("sid").alias("key"), "node", F.col("_from").alias("next")), starts, f"{scratch}/follow")
    seen = Observation()
    steps = write_read(met.withColumnRenamed("key", "sid").join(preds, ["sid", "node"]), f"{scratch}/steps", seen,
                       [F.count_if(F.col("ties") > 1).alias("several")])
    chosen = steps.select("query_id", "sid", "_from", "node", "_first")
    if track == "path" and seen.get["several"]:
        # queries with a choice on their way get the smallest node sequence
        several = steps.where("ties > 1").select("query_id").distinct()
        asked = write_read(reached.join(several, "query_id", "left_semi").select("query_id", "sid", "node"), f"{scratch}/asked")
        ways = _ancestors(tight, asked, f"{scratch}/ancestors")
        onward = ways.groupBy("query_id", "sid", "_from").agg(F.min(F.struct("_first", "node")).alias("p"))
        onward = write_read(onward.select("query_id", "sid", "_from", "p.node", "p._first"), f"{scratch}/onward")
        # a way from the source: the query is the key, as each has its own choice of edges
        pointers = onward.select(F.col("query_id").alias("key"), F.col("_from").alias("node"), F.col("node").alias("next"))
        sources = asked.select("query_id", F.col("query_id").alias("key"), F.col("sid").alias("node"), F.col("node").alias("end"))
        on = follow(pointers, sources, f"{scratch}/forward").select("query_id", F.col("node").alias("_from"))
        chosen = chosen.join(asked, "query_id", "left_anti").unionByName(
            on.join(onward, ["query_id", "_from"]).select(*chosen.columns))
    chosen = chosen.join(state.select("sid", "node", "distance", "hops"), ["sid", "node"])
    end = F.lit((1 << 62)).alias("pos")
    points = chosen.select("query_id", "distance", "hops", end, "node")
    points = points.unionByName(reached.select("query_id", F.lit(-1.0).alias("distance"), F.lit(-1).cast("long").alias("hops"),
                                               end, F.col("sid").alias("node")))
    if members:
        # the edges of the routes, taken apart step by step: only what lies on a route is looked up
        none = F.lit(None).cast(chosen.schema["node"].dataType)
        parts = chosen.select("query_id", "distance", "hops", "_from", "_first", F.lit(0).cast("long").alias("pos"), none.alias("node"))
        for k, inside in enumerate(reversed(members)):
            more = parts.drop("node").withColumnRenamed("pos", "off").join(inside, ["_from", "_first"]).select(
                "query_id", "distance", "hops", F.col("node").alias("_from"), F.col("_next").alias("_first"),
                (F.col("off") + F.col("pos")).alias("pos"), "node")
            parts = write_read(parts.unionByName(more), f"{scratch}/parts-{k}")
        points = points.unionByName(parts.where("node IS NOT NULL").select("query_id", "distance", "hops", "pos", "node"))
    # a route's own nodes, in order
    path = F.transform(F.array_sort(F.collect_list(F.struct("distance", "hops", "pos", "node"))), lambda p: p["node"])
    return reached.select("query_id", "distance").join(points.groupBy("query_id").agg(path.alias("path")), "query_id")


# ------------------------------------------------------------ batch

def _tidy(search: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``search`` without the shuffle files of the jobs it has done with."""
    @functools.wraps(search)
    def run(edges: DataFrame, *args, **kwargs) -> DataFrame:
        with shuffles_removed(edges.sparkSession):
            return search(edges, *args, **kwargs)
    return run


@_tidy
def shortest_paths(edges: DataFrame, queries: DataFrame, weight_col: str = "distance",
                   vertices: DataFrame | None = None, vertex_id: str = "id", fanout: int | None = None,
                   prune: bool = True, num_partitions: int | None = None, compact_every: int | None = None,
                   coords: DataFrame | None = None, heuristic_scale: float = 1.0, seed_hops: int = 2,
                   track: str = "path", contract: bool = True, landmarks: int = 0, delta: float | None = None,
                   on_settled: Callable[[DataFrame], None] | None = None, settle_every: int = 1,
                   stats: dict | None = None) -> DataFrame:
    """Batch single-pair shortest paths.

    ``edges``: ``(src, dst, <weight_col>)``; ``queries``: ``(query_id, src,
    dst)``. Returns one row per query: ``(query_id, src, dst, reachable,
    distance, path array<long>)``. A query whose endpoint is not a vertex
    (``vertices`` given) or whose destination is unreachable gets
    ``reachable = false`` and null distance/path; ``src == dst`` gives
    distance 0 and path ``[src]``.

    ``coords`` is ``(_id, _lat, _lon)``; pruning by great-circle metres is
    exact if every weight is at least ``heuristic_scale`` times the length of
    its edge, e.g. whole metres rounded up. ``landmarks`` is the number of
    landmarks (two searches over the whole graph; they pay off for large
    batches and for weights without a great-circle bound). ``delta`` is the
    width of the distance buckets. ``track`` settles routes of equal length.
    ``contract=False`` keeps chains as they are. None of these change a
    distance. ``on_settled`` gets the routes ``(query_id, src, dst, distance,
    path)`` of queries as soon as they are settled (looked for every
    ``settle_every`` rounds), each query once; those without a route come only
    in the result. ``stats`` receives ``rounds`` and
    ``labels_written``. ``compact_every`` is accepted for older callers; one
    state table needs no compaction.
    """
    if track not in ("path", "pred"):
        raise ValueError("track must be 'path' or 'pred'")
    spark = edges.sparkSession
    t0 = time.perf_counter()
    scratch = scratch_path(spark, "routes")
    fanout = fanout or FANOUT
    def land_queries() -> tuple[DataFrame, DataFrame]:
        everything = write_read(queries.select("query_id", "src", "dst"), f"{scratch}/queries")
        known = valid_queries(everything, vertices, vertex_id) if vertices is not None else everything
        return everything, write_read(known.where("src IS NOT NULL AND dst IS NOT NULL"), f"{scratch}/valid")

    with ThreadPoolExecutor(2) as pool:     # two jobs that do not depend on each other
        asked = pool.submit(inheritable_thread_target(spark)(land_queries))
        e, n_edges = land_edges(edges, weight_col, f"{scratch}/edges")
        q_all, q = asked.result()
    apart, n_core = q.where("src <> dst"), None
    if contract:
        ends = apart.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        core, members, nodes, n_core = contract_chains(e, ends, track, f"{scratch}/chains")
    else:
        core, members = plain_core(e), []
        nodes = degrees(core, f"{scratch}/degrees")[0]
    n_core = n_edges if n_core is None else n_core
    if prune:
        apart, core, n_core = connected_part(apart, core, nodes, n_core, f"{scratch}/parts")
    here = q.where("src = dst").select("query_id", F.lit(0.0).alias("distance"), F.array("src").alias("path"))
    if not n_core or apart.isEmpty():
        if stats is not None:
            stats.update(rounds=0, labels_written=0)
        return _answers(q_all, here)
    hubs = write_read(_buckets(nodes, fanout), f"{scratch}/hubs")
    n = partition_count(spark, n_core, num_partitions)
    pairs = apart.select(F.col("src").alias("sid"), F.col("dst").alias("target")).distinct()
    pairs = pairs.withColumn("ub", F.lit(None).cast("double"))
    extra, about = None, None
    if prune and coords is not None:
        extra = coords.select(F.col("_id").alias("node"), "_lat", "_lon")
        about = centres(pairs, coords, heuristic_scale)
    if prune and landmarks:
        marks = landmark_distances(core, landmarks, n, fanout, scratch)
        extra = marks if extra is None else extra.join(marks, "node", "full_outer")
        mark_goals, pairs = _landmark_goals(pairs, marks, landmarks)
        about = mark_goals if about is None else about.join(mark_goals, "sid", "full_outer")
        pairs = write_read(pairs, f"{scratch}/bounded-pairs")
    # Edges are the largest static input: dealt out by source and bucket once and kept cached, so rounds shuffle
    # only the frontier. Lost cache blocks are recomputed from the written edges.
    prepared = held(deal_out(core, hubs, n, extra))
    log.info("edges prepared (%.2fs)", time.perf_counter() - t0)
    try:
        seeds = backward_seeds(pairs, prepared, seed_hops if prune else 0, scratch)
        if about is not None:
            about = write_read(about, f"{scratch}/about")
        goal = _Goal(pairs, about, seeds, f"{scratch}/goal")
        settle = _Settlement(apart, prepared, members, track, scratch, on_settled, settle_every) if on_settled else None
        search = _Search(spark, prepared, hubs, n)
        state = search.run(pairs.select("sid").distinct(), goal if prune or settle else None, delta,
                           settle.after_round if settle else None)
        if stats is not None:
            stats.update(rounds=search.rounds, labels_written=search.labels_written)
        log.info("searched (%.2fs)", time.perf_counter() - t0)
        found = routes_of(apart, state, prepared, about, members, track, f"{scratch}/all")
    finally:
        prepared.unpersist()
    log.info("routes read off (%.2fs)", time.perf_counter() - t0)
    return _answers(q_all, found.unionByName(here))


def _answers(queries: DataFrame, found: DataFrame) -> DataFrame:
    """Every query, with its route if there is one."""
    found = found.select(F.col("query_id").alias("_qid"), "distance", "path")
    return (queries.join(found, queries["query_id"] == found["_qid"], "left")
            .select("query_id", "src", "dst", F.col("_qid").isNotNull().alias("reachable"), "distance", "path"))


class _Settlement:
    """Hands over routes as soon as no open label can beat them, and takes their queries out of the search."""

    def __init__(self, queries: DataFrame, prepared: DataFrame, members: list[DataFrame], track: str, scratch: str,
                 on_settled: Callable[[DataFrame], None], every: int):
        self.queries, self.prepared, self.members, self.every = queries, prepared, members, every
        self.track, self.scratch, self.on_settled, self.k = track, scratch, on_settled, 0

    def after_round(self, state: DataFrame, goal: _Goal, last: bool) -> None:
        self.k += 1
        if self.k % self.every and not last:
            return
        at = f"{self.scratch}/settled-{self.k}"
        least = state.where("fresh").groupBy("sid").agg(F.min("distance").alias("least"))
        target = state.select("sid", F.col("node").alias("target"), F.col("distance").alias("there"))
        # settled: the target itself is labelled, and no label that is still to be relaxed is nearer
        judged = (goal.known.select("sid", "target").join(target, ["sid", "target"], "left").join(least, "sid", "left")
                  .withColumn("settled", F.col("there").isNotNull() & F.coalesce(F.col("there") <= F.col("least"), F.lit(True))))
        seen = Observation()
        judged = write_read(judged.select("sid", "target", "settled"), f"{at}/pairs", seen,
                            [F.count_if("settled").alias("n")])
        if not seen.get["n"]:
            return
        done = judged.where("settled").select(F.col("sid").alias("src"), F.col("target").alias("dst"))
        q = write_read(self.queries.join(done, ["src", "dst"], "left_semi").select("query_id", "src", "dst"), f"{at}/queries")
        routes = routes_of(q, state, self.prepared, goal.about, self.members, self.track, at)
        self.on_settled(routes.join(q, "query_id").select("query_id", "src", "dst", "distance", "path"))
        goal.only(judged.where("NOT settled"))
