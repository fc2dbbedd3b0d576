"""Registered queries that write the tables' data as files and read it back.

Each query writes its input (derived from the parquet tables) under the
checkpoint folder, runs a source, sink or file job over it and returns what
the files hold, so an oracle can compute the rows from the tables alone.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.functions.sql import register_sql_functions
from tessera.operators import graph, osm
from tessera.plans import catalog as C
from tessera.plans import jobs
from tessera.sinks import text as sinks
from tessera.sources import osm as osm_src
from tessera.sources import tables as T
from tessera.sources import text as src
from tessera.session import scratch_path


def _folder(spark):
    return scratch_path(spark, "files")


def q_file_word_count(spark, d):
    """The word-count job from text files to text files."""
    at = _folder(spark)
    T.corpus(spark, d).where(F.col("value").isNotNull()).write.text(f"{at}/in")
    jobs.word_count_job(spark, f"{at}/in", f"{at}/out")
    return src.read_ordered_lines(spark, f"{at}/out").select("pos", F.col("value").alias("line"))


def q_file_topk_common_words(spark, d):
    """The two-corpus job, with its stop list in upper case."""
    at = _folder(spark)
    docs = T.corpora(spark, d).where(F.col("value").isNotNull())
    for side in C.CORPORA:
        docs.where(F.col("side") == side).select("value").write.text(f"{at}/{side}")
    C._stop(spark).select(F.upper("word").alias("value")).write.text(f"{at}/stop")
    jobs.topk_common_words_job(spark, *[f"{at}/{side}" for side in C.CORPORA], f"{at}/stop", f"{at}/out", k=C.TOP_K)
    return src.read_lines(spark, f"{at}/out").select(
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))


def q_file_stopwords(spark, d):
    """A stop list of the documents' sources in upper case, repeats included."""
    at = _folder(spark)
    (T.table(spark, d, "documents").where(F.col("source").isNotNull())
     .select(F.upper("source").alias("value")).write.text(at))
    return src.read_stopwords(spark, at)


def q_file_key_values(spark, d):
    """Two key/value files, tagged and joined end to end."""
    at = _folder(spark)
    docs = T.table(spark, d, "documents").where("source IS NOT NULL AND lang IS NOT NULL")
    line = F.concat_ws("\t", "source", "lang", F.col("doc_id").cast("string"))
    for side, part in (("en", F.col("lang") == "en"), ("other", F.col("lang") != "en")):
        docs.where(part).select(line.alias("value")).write.text(f"{at}/{side}")
    return src.tagged_union_kv(*[src.read_kv(spark, f"{at}/{side}") for side in C.CORPORA], tags=C.CORPORA)


def q_file_route_queries(spark, d):
    """Route queries over several files, numbered as they come."""
    at = _folder(spark)
    (T.route_queries(spark, d).repartitionByRange(3, "query_id").sortWithinPartitions("query_id")
     .select(F.concat_ws(" ", "src", "dst").alias("value")).write.text(at))
    pos = F.row_number().over(Window.orderBy("query_id")) - 1     # a query a nation
    return src.read_route_queries(spark, at).select(pos.cast("long").alias("pos"), "src", "dst")


def _write_xml(df, path, row):
    df.write.format("xml").option("rootTag", "osm").option("rowTag", row).option("attributePrefix", "_").save(path)


def _write_ways(spark, d, path):
    """Ways with their refs in order, as XML."""
    refs = T.way_refs(spark, d)
    nd = F.array_sort(F.collect_list(F.struct(*T.WAY_ORDER_COLS, "ref")))
    nd = refs.groupBy(F.col("way_id").alias("_wid")).agg(nd.alias("_nd"))    # a way's line items
    ways = T.ways(spark, d)
    ways = ways.join(nd, ways["way_id"] == nd["_wid"]).select(
        F.col("way_id").alias("_id"),
        F.transform("_nd", lambda r: F.struct(r.getField("ref").alias("_ref"))).alias("nd"), "tag")
    _write_xml(ways, path, "way")


def q_file_osm_nodes(spark, d):
    """Nodes as XML."""
    at = _folder(spark)
    _write_xml(T.nodes(spark, d), at, "node")
    return osm_src.read_osm_nodes(spark, at).select(
        F.col("_id").alias("id"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))


def q_file_osm_ways(spark, d):
    """Ways as XML, their refs exploded in document order."""
    at = _folder(spark)
    _write_ways(spark, d, at)
    return osm.way_nodes(osm_src.read_osm_ways(spark, at)).select("way_id", F.col("pos").cast("long").alias("pos"), "ref")


def q_file_adjacency(spark, d):
    """The adjacency job from XML to text, with each line's place."""
    at = _folder(spark)
    _write_ways(spark, d, f"{at}/ways")
    jobs.adjacency_job(spark, f"{at}/ways", f"{at}/out")
    return src.read_ordered_lines(spark, f"{at}/out").select("pos", F.col("value").alias("line"))


def q_file_routes(spark, d):
    """K4, K5: routes as text in query order, one file."""
    at = _folder(spark)
    sinks.write_routes(C._routes(spark, d), at, single_file=True)
    return src.read_lines(spark, at).select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))


def _read_gpx(spark, at):
    track = "name string, trkseg struct<trkpt: array<struct<_lat: string, _lon: string>>>"
    tracks = (spark.read.format("xml").option("rowTag", "trk").option("attributePrefix", "_").schema(track)
              .option("recursiveFileLookup", True).load(at))
    return (tracks.select("name", F.posexplode("trkseg.trkpt").alias("pos", "p"))
            .select("name", F.col("pos").cast("long").alias("pos"), F.col("p._lat").alias("lat"),
                    F.col("p._lon").alias("lon")))


def q_file_gpx(spark, d):
    """K6: routes as GPX tracks; their points with the text of the coordinates."""
    at = _folder(spark)
    sinks.write_gpx(jobs.named_tracks(C._routes(spark, d), T.nodes(spark, d)), at)
    return _read_gpx(spark, at)


def q_file_routes_job(spark, d):
    """From an XML extract and a query file to route lines, tracks and settled routes.

    ``kind`` says where a row was read from: the text (``pos`` is the line's
    place), the tracks (the point's place) or the append-only table.
    """
    at = _folder(spark)
    _write_xml(T.nodes(spark, d), f"{at}/osm/nodes", "node")
    _write_ways(spark, d, f"{at}/osm/ways")
    queries = T.route_queries(spark, d).orderBy("query_id")
    queries.select(F.concat_ws(" ", "src", "dst").alias("value")).coalesce(1).write.text(f"{at}/queries")    # a query a nation
    jobs.routes_job(spark, f"{at}/osm/*", f"{at}/queries", f"{at}/text", f"{at}/gpx", whole_metres=True,
                    settled_path=f"{at}/settled")
    lines = src.read_ordered_lines(spark, f"{at}/text").select(F.lit("text").alias("kind"), "pos", F.col("value").alias("line"))
    points = _read_gpx(spark, f"{at}/gpx").select(F.lit("gpx").alias("kind"), "pos", F.concat_ws(" ", "name", "lat", "lon").alias("line"))
    settled = spark.read.parquet(f"{at}/settled").select(
        F.lit("settled").alias("kind"), F.lit(0).cast("long").alias("pos"),
        F.concat_ws(" ", "src", "dst", F.col("distance").cast("long")).alias("line"))
    return lines.unionByName(points).unionByName(settled)


def q_sql_functions(spark, d):
    """Temporary views and functions called from SQL."""
    T.register_views(spark, d, ("part",))
    register_sql_functions(spark)
    return spark.sql("""
SELECT p_partkey, round(coordinates_distance(0D, 0D, CAST(p_partkey % 80 AS DOUBLE), CAST(p_partkey % 170 AS DOUBLE)), 3)
         AS metres, array_join(CAST(add_path(array(p_partkey), p_partkey + 1) AS ARRAY<STRING>), ' ') AS path
FROM part""")


QUERIES = {f.__name__[2:]: f for f in (
    q_file_word_count, q_file_topk_common_words, q_file_stopwords, q_file_key_values, q_file_route_queries,
    q_file_osm_nodes, q_file_osm_ways, q_file_adjacency, q_file_routes, q_file_gpx, q_file_routes_job,
    q_sql_functions)}

_G = C.ORACLE_SQL
_SP = f"WITH RECURSIVE {C._G_SP}"
ORACLE_SQL = {
    "file_word_count": f"""
SELECT row_number() OVER (ORDER BY word) - 1 AS pos, word || chr(9) || CAST(count AS VARCHAR) AS line
FROM ({_G['word_count']}) c""",
    "file_topk_common_words": f"""
SELECT row_number() OVER (ORDER BY count DESC, word DESC) - 1 AS pos, CAST(count AS VARCHAR) || chr(9) || word AS line
FROM ({_G['topk_common_words']}) t""",
    "file_stopwords": "SELECT DISTINCT lower(source) AS word FROM documents WHERE source IS NOT NULL",
    "file_key_values": """
SELECT source AS key, lang || chr(9) || CAST(doc_id AS VARCHAR) AS value,
       CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END AS side
FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL""",
    "file_route_queries": f"""WITH {C._G_ALL}
SELECT row_number() OVER (ORDER BY query_id) - 1 AS pos, src, dst FROM q""",
    "file_osm_nodes": f"WITH {C._G_NODES} SELECT id, lat, lon FROM nodes",
    "file_osm_ways": _G["way_nodes"] + " WHERE l_orderkey IN (SELECT o_orderkey FROM orders)",
    "file_adjacency": f"SELECT row_number() OVER (ORDER BY node) - 1 AS pos, line FROM ({_G['adjacency_text']}) a",
    "file_routes": f"""{_SP}
SELECT row_number() OVER (ORDER BY query_id) - 1 AS pos, array_to_string(list_transform(
         list_concat([src], list_filter(path, lambda x: x <> src AND x <> dst), [dst]),
         lambda x: CAST(x AS VARCHAR)), ' -> ') AS line
FROM routes WHERE reachable""",
    "file_gpx": f"""{_SP},
pts AS (SELECT src, dst, unnest(path) AS ref, unnest(generate_series(0, len(path) - 1)) AS pos
        FROM routes WHERE reachable)
SELECT CAST(src AS VARCHAR) || '_' || CAST(dst AS VARCHAR) AS name, pos, printf('%.6f', n.lat) AS lat,
       printf('%.6f', n.lon) AS lon FROM pts JOIN nodes n ON pts.ref = n.id""",
    "file_routes_job": f"""{_SP},
pts AS (SELECT src, dst, unnest(path) AS ref, unnest(generate_series(0, len(path) - 1)) AS pos
        FROM routes WHERE reachable)
SELECT 'text' AS kind, row_number() OVER (ORDER BY query_id) - 1 AS pos, array_to_string(list_transform(
         list_concat([src], list_filter(path, lambda x: x <> src AND x <> dst), [dst]),
         lambda x: CAST(x AS VARCHAR)), ' -> ') AS line FROM routes WHERE reachable
UNION ALL
SELECT 'gpx', pos, src || '_' || dst || ' ' || printf('%.6f', n.lat) || ' ' || printf('%.6f', n.lon)
FROM pts JOIN nodes n ON pts.ref = n.id
UNION ALL
SELECT 'settled', 0, src || ' ' || dst || ' ' || CAST(distance AS BIGINT) FROM routes WHERE reachable AND src <> dst""",
    "sql_functions": """
SELECT p_partkey, round(6371.0 * 2 * atan2(sqrt(h), sqrt(1 - h)) * 1000.0, 3) AS metres,
       CAST(p_partkey AS VARCHAR) || ' ' || CAST(p_partkey + 1 AS VARCHAR) AS path
FROM (SELECT p_partkey, sin(radians(a) / 2) * sin(radians(a) / 2)
             + cos(radians(a)) * sin(radians(o) / 2) * sin(radians(o) / 2) AS h
      FROM (SELECT p_partkey, CAST(p_partkey % 80 AS DOUBLE) AS a, CAST(p_partkey % 170 AS DOUBLE) AS o FROM part) x) y""",
}
