"""Road-graph operators: adjacency, edge weights, geometry.

Shortest paths are in ``routes``; their entry points are named here as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.geo import haversine_m
from tessera.operators.routes import (prepare_edges, shortest_paths,  # noqa: F401  (callers find them here)
                                      valid_queries)


# ------------------------------------------------------------------ adjacency

def adjacency(edges: DataFrame) -> DataFrame:
    """``(node, neighbors array<long>)``, neighbours sorted numerically.

    Node order is the sink's work (``sinks.text.write_adjacency``).

    Every edge source is a node; a source whose only edges have a null target
    gets an empty list. Edges are expected de-duplicated (``build_edges``);
    ``collect_set`` guards against repeats anyway.
    """
    return (edges.groupBy(F.col("src").alias("node"))
            .agg(F.array_sort(F.collect_set("dst")).alias("neighbors")))


# ---------------------------------------------------------------- edge weight

def weight_edges(edges: DataFrame, nodes: DataFrame, id_col: str = "_id",
                 lat_col: str = "_lat", lon_col: str = "_lon",
                 weight: str = "distance") -> DataFrame:
    """``(src, dst, distance)``: great-circle metres between endpoint coordinates.

    Two inner equi-joins against the node table; edges missing either
    endpoint (or with a null target) drop out. The planner (AQE) broadcasts
    the node table only when its measured size is under the broadcast
    threshold; otherwise it is a partitioned join.
    """
    n = nodes.select(F.col(id_col).alias("_nid"), F.col(lat_col).alias("_nlat"),
                     F.col(lon_col).alias("_nlon"))
    a = n.select(F.col("_nid").alias("src"), F.col("_nlat").alias("_lat1"),
                 F.col("_nlon").alias("_lon1"))
    b = n.select(F.col("_nid").alias("dst"), F.col("_nlat").alias("_lat2"),
                 F.col("_nlon").alias("_lon2"))
    return (edges.select("src", "dst").join(a, "src").join(b, "dst")
            .select("src", "dst", haversine_m("_lat1", "_lon1", "_lat2", "_lon2").alias(weight)))


# ---------------------------------------------------------------- geometry

def locate(points: DataFrame, nodes: DataFrame, ref_col: str = "ref", id_col: str = "_id",
           lat_col: str = "_lat", lon_col: str = "_lon") -> DataFrame:
    """``points`` with ``lat, lon`` of the node ``ref_col``; unknown nodes drop out."""
    n = nodes.select(F.col(id_col).alias("_ref"), F.col(lat_col).alias("lat"), F.col(lon_col).alias("lon"))
    return points.join(n, points[ref_col] == n["_ref"]).drop("_ref")


def route_geometry(routes: DataFrame, nodes: DataFrame, key: str = "query_id",
                   path_col: str = "path", id_col: str = "_id", lat_col: str = "_lat",
                   lon_col: str = "_lon", extra: tuple[str, ...] = ()) -> DataFrame:
    """``(key, *extra, pos, lat, lon)``: the ordered coordinates of every route."""
    pts = routes.select(key, *extra, F.posexplode(path_col).alias("pos", "_point"))
    return locate(pts, nodes, "_point", id_col, lat_col, lon_col).select(
        key, *extra, F.col("pos").cast("long").alias("pos"), "lat", "lon")


def route_tracks(geometry: DataFrame, key: str = "query_id", name_col: str | None = None) -> DataFrame:
    """Group a route's points into a GPX-shaped track row.

    ``(key, name, trkseg: struct<trkpt: array<struct<_lat, _lon>>>)``. One
    row per route; a route's size is its hop count, bounded by the route.
    """
    name = F.col(name_col) if name_col else F.col(key).cast("string")
    pts = F.array_sort(F.collect_list(F.struct("pos", "lat", "lon")))
    g = geometry.groupBy(key, *( [name_col] if name_col else [])).agg(pts.alias("_pts"))
    trkpt = F.transform("_pts", lambda p: F.struct(p.getField("lat").alias("_lat"),
                                                    p.getField("lon").alias("_lon")))
    return g.select(key, name.alias("name"), F.struct(trkpt.alias("trkpt")).alias("trkseg"))
