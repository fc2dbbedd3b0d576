"""Text and XML sinks.

Ordered outputs use ``orderBy`` (a range-partitioned sort): each part file
holds one contiguous, sorted range and part files sort by name, so their
concatenation is the global order without funnelling rows through one task.
``single_file=True`` adds ``coalesce(1)`` for small published outputs only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.render import adjacency_line, route_line


def _write_text(df: DataFrame, path: str, single_file: bool, mode: str) -> None:
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).text(path)


def write_counts(counts: DataFrame, path: str, single_file: bool = False,
                 mode: str = "overwrite") -> None:
    """``word<TAB>count`` lines ordered by word."""
    lines = counts.orderBy("word").select(
        F.concat_ws("\t", F.col("word"), F.col("count").cast("string")).alias("value"))
    _write_text(lines, path, single_file, mode)


def write_topk(topk: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``count<TAB>word`` lines, count descending then word descending.

    The input is a top-k result (at most k rows), so one output file.
    """
    lines = topk.orderBy(F.col("count").desc(), F.col("word").desc()).select(
        F.concat_ws("\t", F.col("count").cast("string"), F.col("word")).alias("value"))
    _write_text(lines, path, True, mode)


def write_adjacency(adj: DataFrame, path: str, single_file: bool = False,
                    mode: str = "overwrite") -> None:
    """``node n1 n2 ...`` lines in ascending node order."""
    lines = adj.orderBy("node").select(adjacency_line("node", "neighbors").alias("value"))
    _write_text(lines, path, single_file, mode)


def write_routes(routes: DataFrame, path: str, single_file: bool = False,
                 mode: str = "overwrite") -> None:
    """One ``src -> ... -> dst`` line per reachable query, in query order."""
    lines = (routes.where(F.col("reachable")).orderBy("query_id")
             .select(route_line("src", "dst", "path").alias("value")))
    _write_text(lines, path, single_file, mode)


def append_routes(routes: DataFrame, path: str) -> None:
    """Add found routes to an append-only table: each call is one commit, which a later failure does not undo."""
    routes.select("query_id", "src", "dst", "distance", "path").write.mode("append").parquet(path)


# Fixed values of the GPX 1.1 format; the creator names this library.
GPX_ROOT = 'gpx xmlns="http://www.topografix.com/GPX/1/1" version="1.1" creator="tessera"'


def write_gpx(tracks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """GPX 1.1, one file a route: ``<gpx><trk><name/><trkseg><trkpt lat lon/>...``.

    ``tracks`` comes from ``graph.route_tracks``. Partitioned by the route
    key so each route lands in its own folder; coordinates have six decimals.
    """
    key = tracks.columns[0]
    degrees = lambda p, c: F.format_string("%.6f", p.getField(c)).alias(c)
    points = F.transform("trkseg.trkpt", lambda p: F.struct(degrees(p, "_lat"), degrees(p, "_lon")))
    (tracks.select(key, "name", F.struct(points.alias("trkpt")).alias("trkseg"))
     .write.mode(mode).partitionBy(key)
     .format("xml").option("rootTag", GPX_ROOT).option("rowTag", "trk")
     .option("attributePrefix", "_").save(path))
