"""OpenStreetMap XML sources (Spark's built-in XML data source).

Schemas are explicit: inference would cost an extra pass over the file and
would type a way holding a single ``<tag>`` as a struct rather than an
array. Only the attributes and children used downstream are declared, which
also bounds parsing work. For repeated use, ``land_nodes`` and ``land_ways``
parse the file once into bucketed tables under the checkpoint folder, so later
scans get column pruning and joins on the id need no exchange of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.session import bucketed, default_parallelism

NODE_SCHEMA = T.StructType([
    T.StructField("_id", T.LongType()),
    T.StructField("_lat", T.DoubleType()),
    T.StructField("_lon", T.DoubleType()),
])

WAY_SCHEMA = T.StructType([
    T.StructField("_id", T.LongType()),
    T.StructField("nd", T.ArrayType(T.StructType([T.StructField("_ref", T.LongType())]))),
    T.StructField("tag", T.ArrayType(T.StructType([
        T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())]))),
])


def _read(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    return (spark.read.format("xml")
            .option("rowTag", row_tag)
            .option("rootTag", "osm")
            .option("attributePrefix", "_")
            .schema(schema)
            .load(path))


def read_osm_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``(_id, _lat, _lon)`` for every ``<node>``."""
    return _read(spark, path, "node", NODE_SCHEMA)


def read_osm_ways(spark: SparkSession, path: str) -> DataFrame:
    """``(_id, nd array<struct<_ref>>, tag array<struct<_k,_v>>)`` per ``<way>``."""
    return _read(spark, path, "way", WAY_SCHEMA)


def land_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``read_osm_nodes``, parsed once into a table bucketed by ``_id``: joins on the id move no node."""
    return bucketed(read_osm_nodes(spark, path), default_parallelism(spark), ["_id"], "nodes")


def land_ways(spark: SparkSession, path: str) -> DataFrame:
    """``read_osm_ways``, parsed once into a table bucketed by ``_id``."""
    return bucketed(read_osm_ways(spark, path), default_parallelism(spark), ["_id"], "ways")
