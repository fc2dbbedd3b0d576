import os
import shutil

from conftest import fixture_path
from tessera.operators import graph, osm
from tessera.sources import osm as osm_src
from tessera.streaming import jobs as stream


def test_word_count_stream(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    shutil.copy(fixture_path("file01.txt"), os.path.join(src, "a.txt"))
    shutil.copy(fixture_path("file02.txt"), os.path.join(src, "b.txt"))
    q = stream.start_word_count(spark, src, "wc_stream_test", os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    got = {(r.word, r["count"]) for r in spark.sql("SELECT * FROM wc_stream_test").collect()}
    assert got == {("Bye", 1), ("Goodbye", 1), ("Hadoop", 2), ("Hello", 2), ("World", 2)}


def test_route_stream_writes_each_batch(spark, scratch):
    qdir = os.path.join(scratch, "queries")
    os.makedirs(qdir)
    shutil.copy(fixture_path("queries.txt"), os.path.join(qdir, "q1.txt"))
    nodes = osm_src.read_osm_nodes(spark, fixture_path("small.osm"))
    edges = osm.build_edges(osm_src.read_osm_ways(spark, fixture_path("small.osm")))
    wedges = graph.weight_edges(edges, nodes)
    out = os.path.join(scratch, "routes")
    q = stream.start_route_stream(spark, wedges, qdir, out,
                                  vertices=nodes.select(nodes["_id"].alias("id")),
                                  checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(300)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ["1 -> 1", "1 -> 2 -> 3 -> 4 -> 5"]
