"""SQL users: temp views over the tables plus the registered SQL functions."""

import os

import pytest

from tessera.functions.sql import register_sql_functions
from tessera.plans import catalog as C
from tessera.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("""SELECT round(coordinates_distance(1.300329, 103.770917, 1.300200, 103.771280), 2) AS d,
                            add_path(array(1L, 2L), 3L) AS p,
                            route_line(1L, 5L, array(1L, 2L, 1L, 5L)) AS r,
                            adjacency_line(7L, array()) AS a""").first()
    assert r.d == 42.83 and list(r.p) == [1, 2, 3] and r.r == "1 -> 2 -> 5" and r.a == "7 "


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_views_and_sql_match_dataframe_operator(spark):
    assert "part" in T.register_views(spark, SF)
    register_sql_functions(spark)
    C.q_road_edges(spark, SF).createOrReplaceTempView("all_edges")
    sql = spark.sql("""
        SELECT e.src, e.dst,
               round(coordinates_distance(a.lat, a.lon, b.lat, b.lon), 3) AS distance
        FROM all_edges e
        JOIN (SELECT p_partkey AS id, CAST(p_partkey * 37 % 180000 AS DOUBLE) / 1000.0 - 90.0 AS lat,
                     CAST(p_partkey * 91 % 360000 AS DOUBLE) / 1000.0 - 180.0 AS lon FROM part) a
          ON e.src = a.id
        JOIN (SELECT p_partkey AS id, CAST(p_partkey * 37 % 180000 AS DOUBLE) / 1000.0 - 90.0 AS lat,
                     CAST(p_partkey * 91 % 360000 AS DOUBLE) / 1000.0 - 180.0 AS lon FROM part) b
          ON e.dst = b.id""")
    df = C.q_edge_distance(spark, SF)
    key = lambda r: (r.src, r.dst)
    assert sorted(sql.collect(), key=key) == sorted(df.collect(), key=key)
