"""OSM way operators: highway filter, one-way split, way nodes, directed edges.

Two input shapes are supported:

* *array ways* -- one row per way with ``nd: array<struct<_ref>>`` (the XML
  source). Consecutive refs are paired inside the row with array functions:
  no shuffle at all, and a way can never be split across tasks.
* *row ways* -- one row per (way, ref) with explicit order columns (ways
  derived from tables). Pairing uses ``sequence_groups``, range-partitioned so
  one enormous way is spread over many balanced tasks.

Edge semantics (``build_edges``): keep ways tagged ``highway``; a way is
one-way iff it carries the tag ``oneway=yes`` exactly (``-1``, ``true``,
``no`` ... all count as two-way). Every consecutive pair gives a forward edge;
two-way ways add the reversed edge. The last node of each forward pass yields
``(last, null)``: it marks nodes that may have no outgoing edge, which then
appear in the adjacency list with an empty neighbour list. Rows with a null
source are dropped and the union is de-duplicated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.sequence import sequence_groups

# OSM tag keys/values with meaning for routing.
HIGHWAY_KEY = "highway"
ONEWAY_KEY = "oneway"
ONEWAY_YES = "yes"

TAG_TYPE = T.ArrayType(T.StructType([
    T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())]))


def is_highway(tag_col: str = "tag") -> Column:
    """True when some tag key is ``highway``; null/empty tag list -> false."""
    return F.coalesce(F.array_contains(F.col(tag_col).getField("_k"), HIGHWAY_KEY), F.lit(False))


def is_oneway(tag_col: str = "tag") -> Column:
    """True when the tag list holds exactly ``oneway=yes`` (null-safe)."""
    return F.coalesce(
        F.exists(F.col(tag_col), lambda t: t.getField("_k").eqNullSafe(ONEWAY_KEY)
                 & t.getField("_v").eqNullSafe(ONEWAY_YES)),
        F.lit(False))


def highway_ways(ways: DataFrame, tag_col: str = "tag") -> DataFrame:
    """Ways carrying a ``highway`` tag."""
    return ways.where(is_highway(tag_col))


def oneway_split(ways: DataFrame, tag_col: str = "tag") -> tuple[DataFrame, DataFrame]:
    """(one-way ways, two-way ways) among the given ways."""
    flag = is_oneway(tag_col)
    return ways.where(flag), ways.where(~flag)


def way_counts(ways: DataFrame, tag_col: str = "tag") -> DataFrame:
    """One row: number of highway, one-way and two-way ways (single pass)."""
    hw = is_highway(tag_col)
    ow = is_oneway(tag_col)
    return ways.agg(
        F.count(F.when(hw, 1)).alias("n_highway"),
        F.count(F.when(hw & ow, 1)).alias("n_oneway"),
        F.count(F.when(hw & ~ow, 1)).alias("n_twoway"))


# ---------------------------------------------------------------- array ways

def way_nodes(ways: DataFrame, id_col: str = "_id", nd_col: str = "nd") -> DataFrame:
    """Explode a way's node refs in document order: ``(way_id, pos, ref)``.

    Null or empty ref lists produce no rows.
    """
    return ways.select(F.col(id_col).alias("way_id"),
                       F.posexplode(F.col(nd_col).getField("_ref")).alias("pos", "ref"))


def consecutive_pairs_array(refs: Column) -> Column:
    """``array<struct<src,dst>>``: each ref with the next one (null after last)."""
    return F.transform(refs, lambda x, i: F.struct(
        x.alias("src"), F.get(refs, i + 1).alias("dst")))


def build_edges(ways: DataFrame, tag_col: str = "tag", nd_col: str = "nd") -> DataFrame:
    """Directed, de-duplicated edge list ``(src, dst)`` from array ways."""
    hw = highway_ways(ways, tag_col)
    pairs = hw.select(is_oneway(tag_col).alias("_oneway"),
                      F.explode(consecutive_pairs_array(F.col(nd_col).getField("_ref"))).alias("_p"))
    return _edges_from_pairs(pairs.select("_oneway", F.col("_p.src").alias("src"),
                                          F.col("_p.dst").alias("dst")))


def _edges_from_pairs(pairs: DataFrame) -> DataFrame:
    """pairs ``(_oneway, src, dst)`` -> forward U reversed two-way, distinct.

    Both directions come out of one pass (a two-element array exploded per
    pair), so the upstream plan is evaluated once rather than once per union
    branch. ``distinct`` pre-aggregates in every map task.
    """
    fwd = F.struct(F.col("src").alias("src"), F.col("dst").alias("dst"))
    rev = F.when(~F.col("_oneway"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = pairs.select(F.explode(F.array(fwd, rev)).alias("_e"))
    return (e.where(F.col("_e").isNotNull() & F.col("_e.src").isNotNull())
            .select(F.col("_e.src").alias("src"), F.col("_e.dst").alias("dst")).distinct())


# ------------------------------------------------------------------ row ways

def way_nodes_rows(refs: DataFrame, order_cols: list[str], way_col: str = "way_id",
                   ref_col: str = "ref", num_partitions: int | None = None) -> DataFrame:
    """Row ways -> ``(way_id, pos, ref)`` with a skew-safe 0-based position."""
    seq = sequence_groups(refs.select(way_col, *order_cols, ref_col), [way_col], order_cols,
                          pos_col="pos", num_partitions=num_partitions)
    return seq.select(F.col(way_col).alias("way_id"), "pos", F.col(ref_col).alias("ref"))


def consecutive_edges_rows(refs: DataFrame, order_cols: list[str], way_col: str = "way_id",
                           ref_col: str = "ref", extra: tuple[str, ...] = (),
                           num_partitions: int | None = None) -> DataFrame:
    """Row ways -> ``(way_id, *extra, src, dst)``: each ref and its successor."""
    seq = sequence_groups(refs.select(way_col, *order_cols, ref_col, *extra), [way_col],
                          order_cols, value_col=ref_col, next_col="_next",
                          num_partitions=num_partitions)
    return seq.select(F.col(way_col).alias("way_id"), *extra,
                      F.col(ref_col).alias("src"), F.col("_next").alias("dst"))


def build_edges_rows(ways: DataFrame, refs: DataFrame, order_cols: list[str],
                     way_id: str = "way_id", tag_col: str = "tag", ref_col: str = "ref",
                     num_partitions: int | None = None) -> DataFrame:
    """Directed, de-duplicated edge list ``(src, dst)`` from row ways.

    ``ways`` holds ``(way_id, tag)`` (one row per way) and ``refs`` holds
    ``(way_id, *order_cols, ref)``. The way flags are joined onto the refs
    with an equi-join on the way id; AQE splits a skewed way partition.
    """
    flags = highway_ways(ways, tag_col).select(
        F.col(way_id).alias("_wid"), is_oneway(tag_col).alias("_oneway"))
    # Pair first (range sampling then scans only the ref columns), then keep
    # the pairs of highway ways and attach their one-way flag.
    pairs = consecutive_edges_rows(refs, order_cols, way_col=way_id, ref_col=ref_col,
                                   num_partitions=num_partitions)
    pairs = pairs.join(flags, pairs["way_id"] == flags["_wid"], "inner").drop("_wid")
    return _edges_from_pairs(pairs)
