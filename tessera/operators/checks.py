"""Validation operators for routes and adjacency lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.osm import consecutive_pairs_array


def validate_routes(routes: DataFrame, edges: DataFrame, key: str = "query_id",
                    path_col: str = "path") -> DataFrame:
    """Check every route: each hop is an edge and the ends match the query.

    ``routes``: ``(key, src, dst, path)``; ``edges``: ``(src, dst, ...)``.
    Returns ``(key, n_hops, n_bad_hops, ends_ok, ok)``. Hops are paired
    inside each route row (no shuffle). The edges are narrowed to the hops by a
    semi join, whose right side is the small one, and hops without an edge are
    what an anti join leaves.
    """
    hops = routes.select(key, F.explode(consecutive_pairs_array(F.col(path_col))).alias("_h")) \
        .where(F.col("_h.dst").isNotNull()) \
        .select(key, F.col("_h.src").alias("_a"), F.col("_h.dst").alias("_b"))
    seen = hops.select(F.col("_a").alias("_ha"), F.col("_b").alias("_hb"))
    e = edges.select(F.col("src").alias("_a"), F.col("dst").alias("_b"))
    e = e.join(seen, (F.col("_a") == F.col("_ha")) & (F.col("_b") == F.col("_hb")), "left_semi")
    bad = (hops.join(e, ["_a", "_b"], "left_anti")
           .groupBy(key).agg(F.count(F.lit(1)).alias("_bad")))
    p = F.col(path_col)
    ends_ok = F.coalesce((F.get(p, 0) == F.col("src")) & (F.get(p, F.size(p) - 1) == F.col("dst")), F.lit(False))
    bad_n = F.coalesce(F.col("_bad"), F.lit(0).cast("long"))
    return (routes.join(bad, key, "left")
            .select(key, (F.size(p) - 1).cast("long").alias("n_hops"), bad_n.alias("n_bad_hops"),
                    ends_ok.alias("ends_ok"), ((bad_n == 0) & ends_ok).alias("ok")))


def validate_adjacency(adj: DataFrame, edges: DataFrame) -> DataFrame:
    """Compare an adjacency list with the edge list it should encode.

    One row: ``(n_nodes, n_pairs, n_missing, n_extra)`` where missing/extra
    count (node, neighbour) pairs and nodes present on one side only.
    Both sides are tagged and counted in one grouping; pairs and nodes listed
    twice count as extra.
    """
    pair = "array<struct<is_node: boolean, nbr: bigint>>"
    itself = F.array(F.struct(F.lit(True).alias("is_node"), F.lit(None).cast("long").alias("nbr")))

    def tagged(df, items, listed, expected):
        return (df.select("node", F.explode(F.concat(itself, items.cast(pair))).alias("i"))
                .select("node", "i.is_node", "i.nbr", F.lit(listed).alias("l"), F.lit(expected).alias("e")))

    listed = F.transform(F.coalesce("neighbors", F.array()),
                         lambda x: F.struct(F.lit(False).alias("is_node"), x.cast("long").alias("nbr")))
    target = F.when(F.col("dst").isNotNull(), F.array(F.struct(F.lit(False).alias("is_node"),
                                                               F.col("dst").cast("long").alias("nbr"))))
    both = (tagged(adj.select("node", "neighbors"), listed, 1, 0)
            .unionByName(tagged(edges.select(F.col("src").alias("node"), "dst"),
                                F.coalesce(target, F.array()), 0, 1)))
    found = both.groupBy("node", "is_node", "nbr").agg(F.sum("l").alias("l"), F.max("e").alias("e"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return found.agg(
        total(F.when(F.col("is_node"), F.col("l"))).alias("n_nodes"),
        total(F.when(~F.col("is_node"), F.col("l"))).alias("n_pairs"),
        total(F.greatest(F.col("e") - F.col("l"), F.lit(0))).alias("n_missing"),
        total(F.greatest(F.col("l") - F.col("e"), F.lit(0))).alias("n_extra"))
