import math
import os

import pytest
from pyspark.sql import functions as F

from conftest import fixture_path
from tessera.functions.geo import haversine_m
from tessera.operators import checks, graph, osm
from tessera.plans import jobs
from tessera.sources import osm as osm_src

EXPECTED_ADJ = {1: [2, 7], 2: [3], 3: [4], 4: [3, 5, 99], 5: [4, 5], 7: [], 99: [4]}


def adjacency_dict(adj):
    return {r.node: list(r.neighbors) for r in adj.collect()}


def test_read_osm_single_tag_is_array(spark):
    ways = osm_src.read_osm_ways(spark, fixture_path("small.osm"))
    w11 = ways.where("_id = 11").first()
    assert [t._k for t in w11.tag] == ["highway"]
    assert [n._ref for n in w11.nd] == [3, 4]
    assert ways.where("_id = 14").first().tag is None
    nodes = osm_src.read_osm_nodes(spark, fixture_path("small.osm"))
    assert nodes.count() == 7


def test_way_flags_and_counts(spark):
    ways = osm_src.read_osm_ways(spark, fixture_path("small.osm"))
    hw = osm.highway_ways(ways)
    assert sorted(r._id for r in hw.collect()) == [10, 11, 12, 15, 16, 17]
    one, two = osm.oneway_split(hw)
    assert sorted(r._id for r in one.collect()) == [10, 17]
    assert sorted(r._id for r in two.collect()) == [11, 12, 15, 16]
    c = osm.way_counts(ways).first()
    assert (c.n_highway, c.n_oneway, c.n_twoway) == (6, 2, 4)


def test_adjacency_from_xml(spark, scratch):
    adj = jobs.adjacency_job(spark, fixture_path("small.osm"), os.path.join(scratch, "adj"),
                             single_file=True)
    assert adjacency_dict(adj) == EXPECTED_ADJ
    lines = [r.value for r in spark.read.text(os.path.join(scratch, "adj")).collect()]
    assert lines == ["1 2 7", "2 3", "3 4", "4 3 5 99", "5 4 5", "7 ", "99 4"]


def test_row_ways_match_array_ways(spark):
    ways = osm_src.read_osm_ways(spark, fixture_path("small.osm"))
    rows = ways.select(F.col("_id").alias("way_id"),
                       F.posexplode(F.col("nd").getField("_ref")).alias("seq", "ref"))
    e_rows = osm.build_edges_rows(ways.select(F.col("_id").alias("way_id"), "tag"), rows, ["seq"],
                                  num_partitions=3)
    e_arr = osm.build_edges(ways)
    key = lambda r: (r.src, -1 if r.dst is None else r.dst)
    assert sorted(e_rows.collect(), key=key) == sorted(e_arr.collect(), key=key)
    wn = osm.way_nodes_rows(rows, ["seq"], num_partitions=3)
    assert sorted((r.way_id, r.pos, r.ref) for r in wn.collect()) == \
        sorted((r.way_id, r.pos, r.ref) for r in osm.way_nodes(ways).collect())


# Published route coordinates (degrees) and hop lengths (metres).
GPX_ROUTE = [(1.300329, 103.770917), (1.300200, 103.771280), (1.300175, 103.771351)]
GPX_HOPS = [42.83, 8.37]


def test_haversine_hop_lengths(spark):
    pairs = list(zip(GPX_ROUTE, GPX_ROUTE[1:]))
    df = spark.createDataFrame([(a[0], a[1], b[0], b[1]) for a, b in pairs],
                               "lat1 double, lon1 double, lat2 double, lon2 double")
    got = [r.d for r in df.select(haversine_m("lat1", "lon1", "lat2", "lon2").alias("d")).collect()]
    assert [round(x, 2) for x in got] == GPX_HOPS
    # python reference of the same formula
    def hav(a, b):
        dlat, dlon = math.radians(b[0] - a[0]), math.radians(b[1] - a[1])
        h = math.sin(dlat / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(dlon / 2) ** 2
        return 6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h)) * 1000
    assert all(abs(g - hav(a, b)) < 1e-6 for g, (a, b) in zip(got, pairs))


@pytest.mark.parametrize("track", ["path", "pred"])
def test_routes_job_cases(spark, scratch, track):
    out = os.path.join(scratch, "routes")
    gpx = os.path.join(scratch, "gpx")
    routes = jobs.routes_job(spark, fixture_path("small.osm"), fixture_path("queries.txt"), out,
                             gpx_path=gpx, track=track)
    got = {(r.src, r.dst): (r.reachable, None if r.path is None else list(r.path), r.distance)
           for r in routes.collect()}
    assert got[(1, 5)][0] and got[(1, 5)][1] == [1, 2, 3, 4, 5]
    assert got[(5, 1)][:2] == (False, None)
    assert got[(1, 6)][:2] == (False, None)
    assert got[(1, 1)] == (True, [1], 0.0)
    assert got[(1, 77)][:2] == (False, None)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines == ["1 -> 2 -> 3 -> 4 -> 5", "1 -> 1"]
    back = spark.read.format("xml").option("rowTag", "trk").load(gpx)
    assert back.count() == 2


def test_route_validation_detects_bad_hop(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")
    routes = spark.createDataFrame(
        [(0, 1, 3, [1, 2, 3]), (1, 1, 3, [1, 3]), (2, 1, 3, [1, 2])],
        "query_id long, src long, dst long, path array<long>")
    got = {r.query_id: (r.n_hops, r.n_bad_hops, r.ends_ok, r.ok)
           for r in checks.validate_routes(routes, edges).collect()}
    assert got == {0: (2, 0, True, True), 1: (1, 1, True, False), 2: (1, 0, False, False)}


def test_adjacency_validation(spark):
    ways = osm_src.read_osm_ways(spark, fixture_path("small.osm"))
    edges = osm.build_edges(ways)
    adj = graph.adjacency(edges)
    r = checks.validate_adjacency(adj, edges).first()
    assert (r.n_nodes, r.n_pairs, r.n_missing, r.n_extra) == (7, 10, 0, 0)
    broken = adj.where("node <> 2")
    r = checks.validate_adjacency(broken, edges).first()
    assert (r.n_missing, r.n_extra) == (2, 0)


def test_gpx_tracks_content(spark, scratch):
    from tessera.sinks.text import write_gpx
    nodes = osm_src.read_osm_nodes(spark, fixture_path("small.osm"))
    routes = spark.createDataFrame([(7, [1, 2, 3])], "query_id long, path array<long>")
    tracks = graph.route_tracks(graph.route_geometry(routes, nodes))
    row = tracks.first()
    assert row.name == "7"
    assert [(p._lat, p._lon) for p in row.trkseg.trkpt] == [
        (1.3, 103.77), (1.3009, 103.77), (1.3018, 103.77)]
    out = os.path.join(scratch, "gpx")
    write_gpx(tracks, out)
    text = "".join(r.value for r in spark.read.text(out).collect())
    assert 'xmlns="http://www.topografix.com/GPX/1/1" version="1.1"' in text
    assert "<trk>" in text and 'lat="1.300900" lon="103.770000"' in text


def test_sequence_edges_survive_partitioning_choice(spark):
    # same edges whatever the number of range partitions
    ways = osm_src.read_osm_ways(spark, fixture_path("small.osm"))
    rows = ways.select(F.col("_id").alias("way_id"),
                       F.posexplode(F.col("nd").getField("_ref")).alias("seq", "ref"))
    flags = ways.select(F.col("_id").alias("way_id"), "tag")
    key = lambda r: (r.src, -1 if r.dst is None else r.dst)
    base = sorted(osm.build_edges_rows(flags, rows, ["seq"]).collect(), key=key)
    for n in (1, 2, 5, 11):
        assert sorted(osm.build_edges_rows(flags, rows, ["seq"], num_partitions=n).collect(), key=key) == base


def test_route_validation_empty_path(spark):
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    routes = spark.createDataFrame([(0, 1, 2, [])], "query_id long, src long, dst long, path array<long>")
    r = checks.validate_routes(routes, edges).first()
    assert (r.n_bad_hops, r.ends_ok, r.ok) == (0, False, False)
