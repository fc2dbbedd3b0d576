"""Registered queries over the parquet tables, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the Spark plan over the
whole tables; ``ORACLE_SQL[name]`` is the equivalent SQL over the same
tables (views ``documents``, ``orders``, ``lineitem``, ``part``,
``supplier`` ...). Column names match between the two. Floating results are
rounded to 3 decimals on both sides; shortest-path queries use whole-metre
weights (rounded up) so distances and tie-breaks are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.render import adjacency_line, route_line
from tessera.operators import checks, graph, osm, routes, text
from tessera.plans.stoplist import stopwords_df, stopwords_values_sql
from tessera.session import scratch_path, shuffles_removed, write_read
from tessera.sources import tables as T

CORPORA = ("en", "other")     # English documents against all others
TOP_K = 20
NATIONS = 25
LINE, EXPRESS = 1_000_000_000_000, 400      # node ids of a line, stations between express stops


# ====================================================================== text

def _stop(spark: SparkSession) -> DataFrame:
    return text.normalize_stopwords(stopwords_df(spark))


def q_word_count(spark, d):
    return text.word_count(T.corpus(spark, d))


def q_word_count_no_stopwords(spark, d):
    toks = text.tokenize(T.corpus(spark, d))
    return text.count_words(text.remove_stopwords(toks, _stop(spark)))


def _corpus_counts(spark, d, side):
    toks = text.tokenize(T.corpora(spark, d).where(F.col("side") == side).select("value"))
    return text.count_words(text.remove_stopwords(toks, _stop(spark)))


def q_common_words(spark, d):
    a, b = CORPORA
    return text.common_words(_corpus_counts(spark, d, a), _corpus_counts(spark, d, b))


def q_common_words_tagged(spark, d):
    a, b = CORPORA
    tagged = text.tagged_union(_corpus_counts(spark, d, a), _corpus_counts(spark, d, b))
    return text.common_words_tagged(tagged)


def q_topk_common_words(spark, d):
    return text.topk_common_words_by(T.corpora(spark, d), "side", CORPORA, stopwords_df(spark), k=TOP_K)


# ================================================================ road graph

def _ways(spark, d):
    return T.ways(spark, d)


def _edges(spark, d):
    return osm.build_edges_rows(T.ways(spark, d), T.way_refs(spark, d), T.WAY_ORDER_COLS)


def _wedges(spark, d, edges=None):
    return graph.weight_edges(_edges(spark, d) if edges is None else edges, T.nodes(spark, d))


def _wedges_m(spark, d, edges=None):
    """Weighted edges plus ``weight_m``: whole metres, rounded up.

    Rounding up keeps every weight at least the great-circle length of its
    edge, so the goal-directed pruning in ``shortest_paths`` stays exact.
    """
    return _wedges(spark, d, edges).withColumn("weight_m", F.ceil("distance").cast("long"))


def _routes(spark, d, edges=None):
    return graph.shortest_paths(_wedges_m(spark, d, edges), T.route_queries(spark, d),
                                weight_col="weight_m", vertices=T.vertices(spark, d),
                                coords=T.nodes(spark, d))


def q_highway_ways(spark, d):
    hw = osm.highway_ways(_ways(spark, d))
    tag = F.get(F.filter("tag", lambda t: t.getField("_k") == osm.HIGHWAY_KEY), 0)
    return hw.select("way_id", tag.getField("_v").alias("highway"))


def q_oneway_split(spark, d):
    # both sides at once: a flag, not two scans (osm.oneway_split gives them as two tables)
    return osm.highway_ways(_ways(spark, d)).select("way_id", osm.is_oneway().alias("oneway"))


def q_way_counts(spark, d):
    return osm.way_counts(_ways(spark, d))


def q_way_nodes(spark, d):
    return osm.way_nodes_rows(T.way_refs(spark, d), T.WAY_ORDER_COLS)


def q_consecutive_edges(spark, d):
    return osm.consecutive_edges_rows(T.way_refs(spark, d), T.WAY_ORDER_COLS)


def q_road_edges(spark, d):
    return _edges(spark, d)


def q_adjacency_list(spark, d):
    adj = graph.adjacency(_edges(spark, d))
    return adj.select("node", F.size("neighbors").cast("long").alias("degree"),
                      F.array_join(F.col("neighbors").cast("array<string>"), " ").alias("neighbors"))


def q_adjacency_text(spark, d):
    adj = graph.adjacency(_edges(spark, d))
    return adj.select("node", adjacency_line("node", "neighbors").alias("line"))


def q_edge_distance(spark, d):
    return _wedges(spark, d).select("src", "dst", F.round("distance", 3).alias("distance"))


def q_valid_route_queries(spark, d):
    return graph.valid_queries(T.route_queries(spark, d), T.vertices(spark, d))


def q_relax_once(spark, d):
    q = graph.valid_queries(T.route_queries(spark, d), T.vertices(spark, d))
    edges, hubs = graph.prepare_edges(_wedges(spark, d))
    q = q.join(hubs, q["src"] == hubs["node"], "left")
    # one label a query here: the query's id stands for its source
    init = q.select(F.col("query_id").alias("sid"), F.col("src").alias("node"), F.lit(0.0).alias("distance"),
                    F.lit(0).cast("long").alias("hops"), F.coalesce("_nb", F.lit(1)).alias("nb"), F.lit(True).alias("fresh"))
    best = routes.relax(init, edges, routes.partition_count(spark, 0))
    state = routes.merge_labels(init, best, F.lit(True)).join(q.select(F.col("query_id").alias("sid"), "src"), "sid")
    path = F.when(F.col("hops") > 0, F.concat_ws(" ", "src", "node")).otherwise(F.col("src").cast("string"))
    return state.select(F.col("sid").alias("query_id"), "node", F.round("distance", 3).alias("distance"), path.alias("path"))


def q_shortest_distance(spark, d):
    r = _routes(spark, d)
    return r.select("query_id", "src", "dst", "reachable", "distance")


def q_shortest_path_text(spark, d):
    r = _routes(spark, d)
    return r.select("query_id", F.when(F.col("reachable"), route_line("src", "dst", "path"))
                    .alias("route"))


def q_hop_routes(spark, d):
    """Fewest hops on the road edges: a weight without a great-circle bound, pruned by landmarks."""
    e = _edges(spark, d).withColumn("hop", F.lit(1.0))
    r = graph.shortest_paths(e, T.route_queries(spark, d), weight_col="hop", vertices=T.vertices(spark, d),
                             landmarks=2, track="pred")
    return r.select("query_id", "src", "dst", "reachable", F.col("distance").cast("long").alias("hops"))


def q_shared_source_routes(spark, d):
    """From each nation's source to every nation's destination: a search a source, in distance buckets."""
    q = T.route_queries(spark, d)
    to = q.select(F.col("query_id").alias("to_id"), F.col("dst").alias("to_dst"))
    pairs = q.select("query_id", "src", F.explode(F.sequence(F.lit(0), F.lit(NATIONS - 1))).alias("to_id"))
    pairs = pairs.join(to, "to_id").select((F.col("query_id") * NATIONS + F.col("to_id")).alias("query_id"), "src",
                                           F.col("to_dst").alias("dst"))
    r = graph.shortest_paths(_wedges_m(spark, d), pairs, weight_col="weight_m", vertices=T.vertices(spark, d),
                             coords=T.nodes(spark, d), delta=5e6, track="pred")
    return r.select("query_id", "src", "dst", "reachable", "distance")


def _lines(spark, d):
    """Each nation's line items as stations of one long two-way line, with an express stop every ``EXPRESS`` stations."""
    at = osm.way_nodes_rows(T.nation_refs(spark, d), T.NATION_ORDER_COLS)
    return at.select("way_id", "pos", (F.col("way_id") * LINE + F.col("pos")).alias("id"),
                     (1 + F.col("ref") % 97).cast("double").alias("w"))


def q_chain_routes(spark, d):
    """Routes along lines of thousands of nodes: chains are contracted, so rounds grow with the express stops."""
    # stations are needed many times: landed, the line items are sequenced once
    at = scratch_path(spark, "lines")
    with shuffles_removed(spark):
        stations = write_read(_lines(spark, d), f"{at}/stations")
    one = stations.where("pos > 0").select((F.col("id") - 1).alias("src"), F.col("id").alias("dst"), "w")
    far = stations.where((F.col("pos") > 0) & (F.col("pos") % EXPRESS == 0)).select(
        (F.col("id") - EXPRESS).alias("src"), F.col("id").alias("dst"), F.lit(10.0 * EXPRESS).alias("w"))
    e = one.unionByName(far)
    e = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))      # a scan of the stations, no exchange
    ends = stations.groupBy("way_id").agg(F.max("id").alias("last")).select(
        F.col("way_id").alias("query_id"), (F.col("way_id") * LINE + EXPRESS // 4).alias("src"),
        (F.col("last") - EXPRESS // 8).alias("dst"))
    r = write_read(graph.shortest_paths(e, ends, weight_col="w", vertices=stations.select("id")), f"{at}/routes")
    ok = checks.validate_routes(r.where("reachable"), e).select(F.col("query_id").alias("_q"), "ok")
    return r.join(ok, r["query_id"] == ok["_q"], "left").select("query_id", "src", "dst", "reachable", "distance", "ok")


def q_route_geometry(spark, d):
    wn = osm.way_nodes_rows(T.way_refs(spark, d), T.WAY_ORDER_COLS)
    return graph.locate(wn, T.nodes(spark, d)).select("way_id", "pos", "lat", "lon")


def q_shortest_route_geometry(spark, d):
    r = _routes(spark, d).where("reachable")
    return graph.route_geometry(r, T.nodes(spark, d))


def q_route_validation(spark, d):
    """Routes as found, without their second node, or without their last, by query id mod 3."""
    # the edges are needed twice and the routes three times: landed, a sequencing and the reading off happen once
    at = scratch_path(spark, "validation")
    e = write_read(_edges(spark, d), f"{at}/edges")
    r = write_read(_routes(spark, d, e).where("reachable"), f"{at}/routes")
    p, n = F.col("path"), F.size("path")
    defect = F.pmod("query_id", F.lit(3))
    r = r.withColumn("path", F.when(defect == 1, F.concat(F.slice(p, 1, 1), F.slice(p, 3, n)))
                     .when(defect == 2, F.slice(p, 1, F.greatest(n - 1, F.lit(0)))).otherwise(p))
    return checks.validate_routes(r, e)


def q_adjacency_validation(spark, d):
    """A list without the nodes divisible by 7, and with a neighbour -1 at each fifth node."""
    e = _edges(spark, d)
    adj = graph.adjacency(e).where("node % 7 <> 0").withColumn("neighbors", F.when(
        F.col("node") % 5 == 1, F.array_append("neighbors", F.lit(-1).cast("long"))).otherwise(F.col("neighbors")))
    return checks.validate_adjacency(adj, e)


QUERIES = {
    "word_count": q_word_count,
    "word_count_no_stopwords": q_word_count_no_stopwords,
    "common_words": q_common_words,
    "common_words_tagged": q_common_words_tagged,
    "topk_common_words": q_topk_common_words,
    "highway_ways": q_highway_ways,
    "oneway_split": q_oneway_split,
    "way_counts": q_way_counts,
    "way_nodes": q_way_nodes,
    "consecutive_edges": q_consecutive_edges,
    "road_edges": q_road_edges,
    "adjacency_list": q_adjacency_list,
    "adjacency_text": q_adjacency_text,
    "edge_distance": q_edge_distance,
    "valid_route_queries": q_valid_route_queries,
    "relax_once": q_relax_once,
    "shortest_distance": q_shortest_distance,
    "shortest_path_text": q_shortest_path_text,
    "hop_routes": q_hop_routes,
    "shared_source_routes": q_shared_source_routes,
    "chain_routes": q_chain_routes,
    "route_geometry": q_route_geometry,
    "shortest_route_geometry": q_shortest_route_geometry,
    "route_validation": q_route_validation,
    "adjacency_validation": q_adjacency_validation,
}


# ==================================================================== oracles

_TOKENS = r"unnest(string_split_regex(text, '[ \t\n\r\f]+'))"
_STOP = ("stop AS (SELECT DISTINCT lower(w) AS word FROM (VALUES "
         + stopwords_values_sql() + ") s(w))")

# counts of every word in the English documents and in all others
_SIDES = f"""
cnt AS (SELECT word, count(*) FILTER (lang = 'en') AS a, count(*) FILTER (lang IS DISTINCT FROM 'en') AS b
        FROM (SELECT lang, {_TOKENS} AS word FROM documents) t
        WHERE word <> '' AND word NOT IN (SELECT word FROM stop) GROUP BY word)"""

_TEXT = {
    "word_count": f"""
SELECT word, count(*) AS count
FROM (SELECT {_TOKENS} AS word FROM documents) t
WHERE word <> '' GROUP BY word""",
    "word_count_no_stopwords": f"""
WITH {_STOP}
SELECT word, count(*) AS count
FROM (SELECT {_TOKENS} AS word FROM documents) t
WHERE word <> '' AND word NOT IN (SELECT word FROM stop) GROUP BY word""",
    "common_words": f"""
WITH {_STOP}, {_SIDES}
SELECT word, greatest(a, b) AS count FROM cnt WHERE a > 0 AND b > 0""",
    "common_words_tagged": f"""
WITH {_STOP}, {_SIDES}
SELECT word, greatest(a, b) AS count FROM cnt WHERE a > 0 AND b > 0""",
    "topk_common_words": f"""
WITH {_STOP}, {_SIDES}
SELECT word, greatest(a, b) AS count FROM cnt WHERE a > 0 AND b > 0
ORDER BY count DESC, word DESC LIMIT 20""",
}

# Shared CTEs for the table-derived road graph.
_G_NODES = """nodes AS (
  SELECT p_partkey AS id,
         CAST(p_partkey * 37 % 180000 AS DOUBLE) / 1000.0 - 90.0 AS lat,
         CAST(p_partkey * 91 % 360000 AS DOUBLE) / 1000.0 - 180.0 AS lon
  FROM part)"""
_G_WAYS = """ways AS (
  SELECT o_orderkey AS way_id,
         coalesce(o_orderpriority <> '3-MEDIUM', false) AS highway,
         coalesce(o_orderstatus = 'F', false) AS oneway
  FROM orders)"""
_G_SEQ = """seq AS (
  SELECT w.oneway, l.l_partkey AS src,
         lead(l.l_partkey) OVER (PARTITION BY l.l_orderkey
                                 ORDER BY l.l_linenumber, l.l_shipdate, l.l_partkey) AS dst
  FROM lineitem l JOIN ways w ON l.l_orderkey = w.way_id WHERE w.highway)"""
_G_EDGES = """edges AS (
  SELECT DISTINCT src, dst FROM (
    SELECT src, dst FROM seq
    UNION ALL
    SELECT dst AS src, src AS dst FROM seq WHERE NOT oneway) u
  WHERE src IS NOT NULL)"""
_G_WEDGES = """wedges AS (
  SELECT src, dst, 6371.0 * (2 * atan2(sqrt(h), sqrt(1 - h))) * 1000.0 AS distance
  FROM (SELECT e.src, e.dst,
               sin(radians(b.lat - a.lat) / 2) * sin(radians(b.lat - a.lat) / 2)
               + cos(radians(a.lat)) * cos(radians(b.lat))
                 * sin(radians(b.lon - a.lon) / 2) * sin(radians(b.lon - a.lon) / 2) AS h
        FROM edges e JOIN nodes a ON e.src = a.id JOIN nodes b ON e.dst = b.id) x),
wedges_m AS (SELECT src, dst, distance, CAST(ceil(distance) AS BIGINT) AS weight_m FROM wedges)"""
_G_QUERIES = """q AS (
  SELECT CAST(s_nationkey AS BIGINT) AS query_id,
         arg_min(l_partkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS src,
         arg_max(l_partkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS dst
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey),
vq AS (SELECT * FROM q WHERE src IN (SELECT id FROM nodes) AND dst IN (SELECT id FROM nodes))"""
_G_ALL = ",\n".join([_G_NODES, _G_WAYS, _G_SEQ, _G_EDGES, _G_WEDGES, _G_QUERIES])
# Label-correcting recursion: each step relaxes the rows improved in the last
# one; USING KEY keeps one (smallest) label per (query, node).
_G_SP = _G_ALL + """,
sp(query_id, node, dist, path) USING KEY (query_id, node) AS (
  SELECT query_id, src, CAST(0 AS BIGINT), [src] FROM vq
  UNION
  (SELECT c.query_id, c.node, c.best.d, c.best.p FROM (
     SELECT s.query_id, e.dst AS node,
            min({'d': s.dist + e.weight_m, 'p': list_append(s.path, e.dst)}) AS best
     FROM sp s JOIN wedges_m e ON e.src = s.node
     WHERE NOT list_contains(s.path, e.dst)
     GROUP BY s.query_id, e.dst) c
   LEFT JOIN recurring.sp cur ON cur.query_id = c.query_id AND cur.node = c.node
   WHERE cur.dist IS NULL OR c.best < {'d': cur.dist, 'p': cur.path})),
routes AS (
  SELECT q.query_id, q.src, q.dst, sp.node IS NOT NULL AS reachable,
         CAST(sp.dist AS DOUBLE) AS distance, sp.path
  FROM q LEFT JOIN sp ON sp.query_id = q.query_id AND sp.node = q.dst)"""

_GRAPH = {
    "highway_ways": """
SELECT o_orderkey AS way_id, o_orderpriority AS highway FROM orders
WHERE o_orderpriority <> '3-MEDIUM'""",
    "oneway_split": """
SELECT o_orderkey AS way_id, coalesce(o_orderstatus = 'F', false) AS oneway FROM orders
WHERE o_orderpriority <> '3-MEDIUM'""",
    "way_counts": """
SELECT count(*) FILTER (WHERE o_orderpriority <> '3-MEDIUM') AS n_highway,
       count(*) FILTER (WHERE o_orderpriority <> '3-MEDIUM' AND o_orderstatus = 'F') AS n_oneway,
       count(*) FILTER (WHERE o_orderpriority <> '3-MEDIUM' AND o_orderstatus IS DISTINCT FROM 'F') AS n_twoway
FROM orders""",
    "way_nodes": """
SELECT l_orderkey AS way_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey) - 1 AS pos,
       l_partkey AS ref
FROM lineitem""",
    "consecutive_edges": """
SELECT l_orderkey AS way_id, l_partkey AS src,
       lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey) AS dst
FROM lineitem""",
    "road_edges": f"WITH {_G_WAYS},\n{_G_SEQ},\n{_G_EDGES}\nSELECT src, dst FROM edges",
    "adjacency_list": f"""WITH {_G_WAYS},\n{_G_SEQ},\n{_G_EDGES}
SELECT src AS node, count(dst) AS degree,
       array_to_string(list_transform(list_sort(list(dst) FILTER (WHERE dst IS NOT NULL)),
                                      lambda x: CAST(x AS VARCHAR)), ' ') AS neighbors
FROM edges GROUP BY src""",
    "adjacency_text": f"""WITH {_G_WAYS},\n{_G_SEQ},\n{_G_EDGES}
SELECT src AS node,
       CAST(src AS VARCHAR) || ' ' ||
       array_to_string(list_transform(list_sort(list(dst) FILTER (WHERE dst IS NOT NULL)),
                                      lambda x: CAST(x AS VARCHAR)), ' ') AS line
FROM edges GROUP BY src""",
    "edge_distance": f"WITH {_G_ALL}\nSELECT src, dst, round(distance, 3) AS distance FROM wedges",
    "valid_route_queries": f"WITH {_G_ALL}\nSELECT query_id, src, dst FROM vq",
    "relax_once": f"""WITH {_G_ALL},
init AS (SELECT query_id, src AS node, CAST(0.0 AS DOUBLE) AS distance, [src] AS path FROM vq),
cand AS (
  SELECT i.query_id, e.dst AS node,
         min({{'d': i.distance + e.distance, 'p': list_append(i.path, e.dst)}}) AS b
  FROM init i JOIN wedges e ON e.src = i.node
  WHERE NOT list_contains(i.path, e.dst)
  GROUP BY i.query_id, e.dst),
state AS (
  SELECT query_id, node, distance, path FROM init
  UNION ALL
  SELECT query_id, node, b.d, b.p FROM cand)
SELECT query_id, node, round(distance, 3) AS distance,
       array_to_string(list_transform(path, lambda x: CAST(x AS VARCHAR)), ' ') AS path
FROM state""",
    "shortest_distance": f"""WITH RECURSIVE {_G_SP}
SELECT query_id, src, dst, reachable, distance FROM routes""",
    "shortest_path_text": f"""WITH RECURSIVE {_G_SP}
SELECT query_id,
       CASE WHEN reachable THEN array_to_string(list_transform(
              list_concat([src], list_filter(path, lambda x: x <> src AND x <> dst), [dst]),
              lambda x: CAST(x AS VARCHAR)), ' -> ') END AS route
FROM routes""",
    "hop_routes": f"""WITH RECURSIVE {_G_ALL},
sp(query_id, node, hops) USING KEY (query_id, node) AS (
  SELECT query_id, src, CAST(0 AS BIGINT) FROM vq
  UNION
  (SELECT c.query_id, c.node, c.h FROM (SELECT s.query_id, e.dst AS node, min(s.hops + 1) AS h
     FROM sp s JOIN edges e ON e.src = s.node WHERE e.dst IS NOT NULL GROUP BY s.query_id, e.dst) c
   LEFT JOIN recurring.sp cur ON cur.query_id = c.query_id AND cur.node = c.node
   WHERE cur.hops IS NULL OR c.h < cur.hops))
SELECT q.query_id, q.src, q.dst, sp.node IS NOT NULL AS reachable, sp.hops
FROM q LEFT JOIN sp ON sp.query_id = q.query_id AND sp.node = q.dst""",
    "shared_source_routes": f"""WITH RECURSIVE {_G_SP}
SELECT a.query_id * {NATIONS} + b.query_id AS query_id, a.src, b.dst, sp.node IS NOT NULL AS reachable,
       CAST(sp.dist AS DOUBLE) AS distance
FROM q a CROSS JOIN q b LEFT JOIN sp ON sp.query_id = a.query_id AND sp.node = b.dst""",
    "chain_routes": f"""WITH RECURSIVE
st AS (SELECT n * {LINE} + pos AS id, n, pos, w FROM (
  SELECT CAST(s_nationkey AS BIGINT) AS n, CAST(1 + l_partkey % 97 AS DOUBLE) AS w, row_number() OVER (
    PARTITION BY s_nationkey ORDER BY l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS pos
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) x),
one AS (SELECT id - 1 AS src, id AS dst, w FROM st WHERE pos > 0
        UNION ALL SELECT id - {EXPRESS}, id, {10.0 * EXPRESS} FROM st WHERE pos > 0 AND pos % {EXPRESS} = 0),
e AS (SELECT src, dst, w FROM one UNION ALL SELECT dst, src, w FROM one),
q AS (SELECT n AS query_id, n * {LINE} + {EXPRESS // 4} AS src, max(id) - {EXPRESS // 8} AS dst FROM st GROUP BY n),
vq AS (SELECT * FROM q WHERE src IN (SELECT id FROM st) AND dst IN (SELECT id FROM st)),
sp(query_id, node, dist) USING KEY (query_id, node) AS (
  SELECT query_id, src, CAST(0 AS DOUBLE) FROM vq
  UNION
  (SELECT c.query_id, c.node, c.d FROM (SELECT s.query_id, e.dst AS node, min(s.dist + e.w) AS d
     FROM sp s JOIN e ON e.src = s.node GROUP BY s.query_id, e.dst) c
   LEFT JOIN recurring.sp cur ON cur.query_id = c.query_id AND cur.node = c.node
   WHERE cur.dist IS NULL OR c.d < cur.dist))
SELECT q.query_id, q.src, q.dst, sp.node IS NOT NULL AS reachable, sp.dist AS distance,
       CASE WHEN sp.node IS NOT NULL THEN true END AS ok
FROM q LEFT JOIN sp ON sp.query_id = q.query_id AND sp.node = q.dst""",
    "route_geometry": f"""WITH {_G_NODES},
wn AS (SELECT l_orderkey AS way_id,
              row_number() OVER (PARTITION BY l_orderkey
                                 ORDER BY l_linenumber, l_shipdate, l_partkey) - 1 AS pos,
              l_partkey AS ref FROM lineitem)
SELECT wn.way_id, wn.pos, n.lat, n.lon FROM wn JOIN nodes n ON wn.ref = n.id""",
    "shortest_route_geometry": f"""WITH RECURSIVE {_G_SP},
pts AS (SELECT query_id, unnest(path) AS ref, unnest(generate_series(0, len(path) - 1)) AS pos
        FROM routes WHERE reachable)
SELECT pts.query_id, pts.pos, n.lat, n.lon FROM pts JOIN nodes n ON pts.ref = n.id""",
    "route_validation": f"""WITH RECURSIVE {_G_SP},
given AS (SELECT query_id, src, dst,
                 CASE query_id % 3 WHEN 1 THEN list_concat(path[1:1], path[3:])
                                   WHEN 2 THEN path[1:len(path) - 1] ELSE path END AS path
          FROM routes WHERE reachable),
hops AS (SELECT query_id, path[i] AS a, path[i + 1] AS b
         FROM (SELECT query_id, path, unnest(generate_series(1, len(path) - 1)) AS i FROM given)),
bad AS (SELECT h.query_id, count(*) AS n FROM hops h
        WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.src = h.a AND e.dst = h.b)
        GROUP BY h.query_id),
ends AS (SELECT query_id, coalesce(path[1] = src AND path[len(path)] = dst, false) AS ends_ok, path FROM given)
SELECT r.query_id, len(r.path) - 1 AS n_hops, coalesce(bad.n, 0) AS n_bad_hops, r.ends_ok,
       (coalesce(bad.n, 0) = 0 AND r.ends_ok) AS ok
FROM ends r LEFT JOIN bad ON bad.query_id = r.query_id""",
    "adjacency_validation": f"""WITH {_G_WAYS},\n{_G_SEQ},\n{_G_EDGES},
nodes_listed AS (SELECT DISTINCT src AS node FROM edges WHERE src % 7 <> 0),
listed AS (SELECT src AS node, dst AS nbr FROM edges WHERE src % 7 <> 0 AND dst IS NOT NULL
           UNION ALL SELECT node, -1 FROM nodes_listed WHERE node % 5 = 1),
pairs AS (SELECT src, dst FROM edges WHERE dst IS NOT NULL),
n(missing_pairs, missing_nodes, extra_pairs, extra_nodes) AS (SELECT
  (SELECT count(*) FROM (SELECT * FROM pairs EXCEPT SELECT * FROM listed)),
  (SELECT count(*) FROM (SELECT src FROM edges EXCEPT SELECT node FROM nodes_listed)),
  (SELECT count(*) FROM (SELECT * FROM listed EXCEPT SELECT * FROM pairs)),
  (SELECT count(*) FROM (SELECT node FROM nodes_listed EXCEPT SELECT src FROM edges)))
SELECT (SELECT count(*) FROM nodes_listed) AS n_nodes, (SELECT count(*) FROM listed) AS n_pairs,
       missing_pairs + missing_nodes AS n_missing, extra_pairs + extra_nodes AS n_extra FROM n""",
}

ORACLE_SQL = {**_TEXT, **_GRAPH}
