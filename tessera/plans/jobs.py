"""User-level jobs composed from the operators (file in, file out)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import graph, osm, text
from tessera.sinks import text as sinks
from tessera.sources import osm as osm_src
from tessera.sources import text as text_src


def word_count_job(spark: SparkSession, input_path: str, output_path: str | None = None) -> DataFrame:
    """Count words of a file or directory; optionally write ``word<TAB>count``."""
    counts = text.word_count(text_src.read_lines(spark, input_path))
    if output_path:
        sinks.write_counts(counts, output_path)
    return counts


def topk_common_words_job(spark: SparkSession, input_a: str, input_b: str, stopwords: str,
                          output_path: str | None = None, k: int = 20) -> DataFrame:
    """Top-k words common to two corpora after stop-word removal."""
    stop = text_src.read_stopwords(spark, stopwords)
    top = text.topk_common_words(text_src.read_lines(spark, input_a),
                                 text_src.read_lines(spark, input_b), stop, k=k)
    if output_path:
        sinks.write_topk(top, output_path)
    return top


def road_edges(spark: SparkSession, osm_path: str) -> DataFrame:
    """Directed road edges of an OSM extract."""
    return osm.build_edges(osm_src.read_osm_ways(spark, osm_path))


def adjacency_job(spark: SparkSession, osm_path: str, output_path: str | None = None,
                  single_file: bool = False) -> DataFrame:
    """Adjacency list of the road graph; optionally write ``node n1 n2 ...``."""
    adj = graph.adjacency(road_edges(spark, osm_path))
    if output_path:
        sinks.write_adjacency(adj, output_path, single_file=single_file)
    return adj


def routes_job(spark: SparkSession, osm_path: str, queries_path: str,
               output_path: str | None = None, gpx_path: str | None = None,
               weight: str = "distance", track: str = "path", whole_metres: bool = False,
               settled_path: str | None = None, settle_every: int = 4) -> DataFrame:
    """Batch shortest routes for a query file.

    All OSM nodes are vertices (a query naming an unknown node is reported
    unreachable). Edge weight is the great-circle length in metres (rounded up
    with ``whole_metres``), so the node coordinates also drive exact
    goal-directed pruning. ``track`` settles routes of equal length (see
    ``routes.shortest_paths``). The file is parsed once for nodes, which are
    landed in buckets, and once for ways. With ``settled_path`` every route is
    committed to an append-only table there as soon as it is settled, which is
    looked for every ``settle_every`` rounds; the text in query order is written
    at the end.
    """
    nodes = osm_src.land_nodes(spark, osm_path)
    wedges = graph.weight_edges(road_edges(spark, osm_path), nodes, weight=weight)
    if whole_metres:
        wedges = wedges.withColumn(weight, F.ceil(weight).cast("double"))
    queries = text_src.read_route_queries(spark, queries_path)
    publish = (lambda found: sinks.append_routes(found, settled_path)) if settled_path else None
    if publish:     # the table is there even if no route is found
        publish(queries.select("query_id", "src", "dst", F.lit(None).cast("double").alias("distance"),
                               F.lit(None).cast("array<bigint>").alias("path")).limit(0))
    routes = graph.shortest_paths(wedges, queries, weight_col=weight,
                                  vertices=nodes.select(nodes["_id"].alias("id")),
                                  coords=nodes, track=track, on_settled=publish, settle_every=settle_every)
    if output_path:
        sinks.write_routes(routes, output_path)
    if gpx_path:
        sinks.write_gpx(named_tracks(routes, nodes), gpx_path)
    return routes


def named_tracks(routes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Track rows of the reachable routes, named ``<src>_<dst>``."""
    named = routes.where("reachable").withColumn("name", F.concat_ws("_", "src", "dst"))
    return graph.route_tracks(graph.route_geometry(named, nodes, extra=("name",)), name_col="name")
