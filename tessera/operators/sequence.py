"""Skew-safe ordering within groups: 0-based position and successor value.

``Window.partitionBy(group).orderBy(...)`` sends each whole group to one
task. If one group holds a third of all rows (one huge way, one hot key),
that task carries a third of the job. This operator cuts large groups:

1. One pass over the group keys finds the groups that would outweigh a
   partition (``approx_top_k`` sketches, merged in ``SKETCHES`` parts; a group
   with fewer than about one row in ``TRACKED`` may be missed and stays whole).
2. Their order keys are sampled once, and quantiles become bounds: as many
   pieces as the group needs. There are at most a few for each partition.
3. The window is over group and piece, so one exchange serves it. A piece is
   found by two comparisons with short lists (every ``sqrt``-th bound, then
   those between), in a table that is broadcast: its size is bounded by the
   number of partitions.
4. A table of one row a piece stitches the pieces: rows before it, and the first
   value of the next one.

Without a large group the plan is the plain window. Nothing is written.

Order columns must define the order that matters: rows that tie on
``group + order`` are interchangeable only if they are identical in the
value column, so include the value in ``order_cols`` when ties are possible.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import default_parallelism

HASH, PIECE = "_seq_h", "_seq_piece"
SKETCHES = 64       # parts of the rows that are sketched apart
TRACKED = 4096      # groups a sketch keeps
SAMPLES = 20        # sampled rows a piece


def _large_groups(df: DataFrame, n: int) -> tuple[dict[int, int], int]:
    """Group hash -> rows (about) of the groups over two partitions' share, and all rows."""
    rows = (df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("_p"))
            .agg(F.expr(f"approx_top_k({HASH}, {TRACKED // 16}, {TRACKED})").alias("top"),
                 F.count(F.lit(1)).alias("n")).collect())     # SKETCHES rows
    total, size = sum(r["n"] for r in rows), Counter()
    for r in rows:
        for item in r["top"]:
            size[item["item"]] += item["count"]
    return {h: c for h, c in size.items() if c * n > 2 * total}, total


def _bounds(df: DataFrame, large: dict[int, int], total: int, n: int, order_cols: list[str]) -> list[tuple]:
    """``(hash, coarse, fine)`` for each large group: bounds between its pieces."""
    rate = min(1.0, SAMPLES * n / total)
    sample = df.where(F.col(HASH).isin(list(large))).sample(rate, seed=7).select(HASH, *order_cols).collect()
    keys: dict[int, list] = {h: [] for h in large}
    for row in sample:      # about SAMPLES rows a partition
        keys[row[0]].append(tuple(row)[1:])
    out = []
    for h, found in keys.items():
        found.sort(key=lambda k: [(x is not None, x) for x in k])     # nulls first, as Spark orders them
        pieces = min(len(found), math.ceil(large[h] * n / total))
        cuts = sorted({len(found) * p // pieces for p in range(1, pieces)}) if pieces else []
        bounds = [found[c] for c in cuts]
        if bounds:
            step = math.isqrt(len(bounds) - 1) + 1
            fine = [bounds[i:i + step] for i in range(0, len(bounds), step)]
            out.append((h, [f[0] for f in fine], fine))
    return out


def sequence_groups(df: DataFrame, group_cols: list[str], order_cols: list[str],
                    value_col: str | None = None, pos_col: str | None = None,
                    next_col: str | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Add ``pos_col`` (0-based position in group) and/or ``next_col``.

    ``next_col`` is ``value_col`` of the following row of the same group in
    ``order_cols`` order, null for the last row of each group. Output has one
    row per input row. Null group keys form a group; nulls sort first.
    """
    if pos_col is None and next_col is None:
        return df
    if next_col is not None and value_col is None:
        raise ValueError("next_col needs value_col")
    n = num_partitions or default_parallelism(df.sparkSession)
    group_cols, order_cols = list(group_cols), list(order_cols)
    d = df.withColumn(HASH, F.xxhash64(*group_cols))
    large, total = _large_groups(d, n)
    bounds = _bounds(d, large, total, n, order_cols) if large else []
    if not bounds:
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        new = {} if pos_col is None else {pos_col: (F.row_number().over(w) - 1).cast("long")}
        if next_col is not None:
            new[next_col] = F.lead(value_col).over(w)
        return df.select("*", *[c.alias(name) for name, c in new.items()])
    return _stitched(df, d, bounds, group_cols, order_cols, value_col, pos_col, next_col)


def _stitched(df: DataFrame, d: DataFrame, bounds: list[tuple], group_cols: list[str], order_cols: list[str],
              value_col: str | None, pos_col: str | None, next_col: str | None) -> DataFrame:
    key = T.StructType([T.StructField(c, df.schema[c].dataType) for c in order_cols])
    schema = T.StructType([T.StructField("_h", T.LongType()), T.StructField("_coarse", T.ArrayType(key)),
                           T.StructField("_fine", T.ArrayType(T.ArrayType(key)))])
    b = df.sparkSession.createDataFrame(bounds, schema)
    d = d.join(F.broadcast(b), d[HASH] == b["_h"], "left")      # at most two bounds a partition
    at = F.struct(*order_cols)
    coarse = F.size(F.filter("_coarse", lambda x: x <= at))
    step = F.size(F.get("_fine", F.lit(0)))
    fine = F.size(F.filter(F.get("_fine", F.greatest(coarse - 1, F.lit(0))), lambda x: x <= at))
    piece = F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)
    d = d.withColumn(PIECE, F.coalesce(F.when(F.col("_h").isNotNull(), piece), F.lit(0)))
    cut = F.col("_h").isNotNull()

    # one row a piece of a large group
    first = [F.min_by(F.col(value_col), at).alias("_first")] if value_col is not None else []
    pieces = d.where(cut).groupBy(*group_cols, PIECE).agg(F.count(F.lit(1)).alias("_cnt"), *first)
    run = Window.partitionBy(*group_cols).orderBy(PIECE)
    stitch = pieces.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], F.col(PIECE).alias("_pc"),
        F.coalesce(F.sum("_cnt").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        *([F.lead("_first").over(run).alias("_next_first")] if first else []),
        F.lead(F.lit(True)).over(run).isNotNull().alias("_more"))

    w = Window.partitionBy(*group_cols, PIECE).orderBy(*order_cols)
    new = [F.row_number().over(w).alias("_row")]
    if next_col is not None:
        new += [F.lead(value_col).over(w).alias("_lead"), F.lead(F.lit(True)).over(w).isNull().alias("_end")]
    out = d.select(*df.columns, PIECE, *new)
    same = F.col(PIECE) == F.col("_pc")
    for i, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = out.join(F.broadcast(stitch), same, "left")       # as bounded as the bounds
    res = []
    if pos_col is not None:
        res.append((F.col("_row") - 1 + F.coalesce("_before", F.lit(0))).cast("long").alias(pos_col))
    if next_col is not None:
        res.append(F.when(F.col("_end") & F.coalesce("_more", F.lit(False)), F.col("_next_first"))
                   .otherwise(F.col("_lead")).alias(next_col))
    return out.select(*df.columns, *res)
