"""SQL-callable forms of the library's scalar functions.

Registered as Spark SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN
<expression>``): the analyzer inlines the expression, so calling them from
SQL costs the same as writing the expression out -- no UDF, no Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.functions.geo import EARTH_RADIUS_KM

_HAV_A = """
CREATE OR REPLACE TEMPORARY FUNCTION tessera_hav_a(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
RETURNS DOUBLE
RETURN least(1.0D, sin(radians(lat2 - lat1) / 2) * sin(radians(lat2 - lat1) / 2)
       + cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) * sin(radians(lon2 - lon1) / 2))
"""

_DISTANCE = f"""
CREATE OR REPLACE TEMPORARY FUNCTION coordinates_distance(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
RETURNS DOUBLE
RETURN {EARTH_RADIUS_KM} * (atan2(sqrt(tessera_hav_a(lat1, lon1, lat2, lon2)),
                                 sqrt(1 - tessera_hav_a(lat1, lon1, lat2, lon2))) * 2) * 1000
"""

_ADD_PATH = """
CREATE OR REPLACE TEMPORARY FUNCTION add_path(path ARRAY<BIGINT>, id BIGINT)
RETURNS ARRAY<BIGINT>
RETURN array_append(path, id)
"""

_ROUTE_LINE = """
CREATE OR REPLACE TEMPORARY FUNCTION route_line(src BIGINT, dst BIGINT, path ARRAY<BIGINT>)
RETURNS STRING
RETURN array_join(cast(concat(array(src), filter(path, x -> x != src AND x != dst), array(dst))
                       AS ARRAY<STRING>), ' -> ')
"""

_ADJ_LINE = """
CREATE OR REPLACE TEMPORARY FUNCTION adjacency_line(node BIGINT, neighbors ARRAY<BIGINT>)
RETURNS STRING
RETURN concat(cast(node AS STRING), ' ', concat_ws(' ', cast(neighbors AS ARRAY<STRING>)))
"""


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register ``coordinates_distance``, ``add_path``, ``route_line`` and
    ``adjacency_line`` for SQL in this session; returns their names."""
    for stmt in (_HAV_A, _DISTANCE, _ADD_PATH, _ROUTE_LINE, _ADJ_LINE):
        spark.sql(stmt)
    return ["coordinates_distance", "add_path", "route_line", "adjacency_line"]
