"""Connected components of an edge table by alternating large and small stars.

Every round is two joins with a partially aggregated minimum per node, so a
node with very many edges is reduced in the map tasks and its join rows can
be split. Rounds grow with the logarithm of the graph, not with its diameter.
Round results are tables in the shared checkpoint folder; nothing is
collected to the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.llm.common import materialise


def _land(edges: DataFrame) -> tuple[DataFrame, tuple]:
    seen = Observation()
    e = materialise(edges, "edges", seen, [F.count(F.lit(1)).alias("n"),
                                           F.bit_xor(F.xxhash64("hi", "lo")).alias("x")])
    return e, (seen.get["n"], seen.get["x"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``(hi long, lo long)`` links -> ``(node, root)`` for every node but the roots.

    ``root`` is the smallest node of the component. Self links, repeated and
    reversed links and links with a null end are allowed and change nothing;
    no links give no rows.
    """
    e = (edges.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo"),
                      (F.col("hi") != F.col("lo")).alias("real"))
         .where("real").select("hi", "lo").distinct())
    e, state = _land(e)
    while state[0]:
        ends = (e.select(F.col("lo").alias("n"), F.col("hi").alias("o"))
                .unionAll(e.select(F.col("hi").alias("n"), F.col("lo").alias("o"))))
        least = ends.groupBy("n").agg(F.min("o").alias("o")).select("n", F.least("n", "o").alias("m"))
        large = (e.join(least, F.col("lo") == F.col("n")).where("hi > m")
                 .select("hi", F.col("m").alias("lo")).distinct())
        mins = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(mins.withColumnRenamed("hi", "h"), F.col("hi") == F.col("h")).where("lo > m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionAll(mins.select("hi", F.col("m").alias("lo"))).distinct())
        e, now = _land(small)
        if now == state:
            break
        state = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
