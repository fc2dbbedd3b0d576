"""Adapters that derive the workloads' inputs from the parquet tables.

* corpora   -- ``documents.text`` split by language (one corpus per ``lang``)
* ways      -- an order is a way: ``(way_id, tag)``; tags from order columns
* way refs  -- a line item is a node ref of its order's way, ordered by
  ``(l_linenumber, l_shipdate, l_partkey)`` (the line number alone is not
  unique within an order)
* nodes     -- a part is a node; coordinates by exact arithmetic on its key
* route queries -- one per nation: from the part of the earliest line item
  supplied from that nation to the part of the latest one

Every adapter is a lazy projection/filter/join over the whole table, so
column pruning and filter pushdown reach the parquet scan.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.osm import HIGHWAY_KEY, ONEWAY_KEY

# Fixed values for the table-derived road graph.
MEDIUM_PRIORITY = "3-MEDIUM"     # orders with this priority are not highways
ONEWAY_STATUS = "F"              # status F -> oneway=yes
TWOWAY_STATUS = "O"              # status O -> oneway=no (explicitly two-way)
WAY_ORDER_COLS = ["l_linenumber", "l_shipdate", "l_partkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def corpus(spark: SparkSession, sf_dir: str, lang: str | None = None) -> DataFrame:
    """Document texts as a one-column corpus ``(value)``; all docs if ``lang`` is None."""
    docs = table(spark, sf_dir, "documents")
    if lang is not None:
        docs = docs.where(F.col("lang") == lang)
    return docs.select(F.col("text").alias("value"))


def corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value, side)`` of every document: side ``en`` for English, ``other`` for the rest."""
    return table(spark, sf_dir, "documents").select(
        F.col("text").alias("value"),
        F.when(F.col("lang") == "en", F.lit("en")).otherwise(F.lit("other")).alias("side"))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(way_id, tag array<struct<_k,_v>>)`` from ``orders``.

    ``highway=<priority>`` unless the priority is 3-MEDIUM; ``oneway=yes``
    for status F, ``oneway=no`` for status O, no oneway tag otherwise.
    """
    o = table(spark, sf_dir, "orders")
    hw = F.when(F.col("o_orderpriority") != MEDIUM_PRIORITY,
                F.struct(F.lit(HIGHWAY_KEY).alias("_k"), F.col("o_orderpriority").alias("_v")))
    ow = (F.when(F.col("o_orderstatus") == ONEWAY_STATUS,
                 F.struct(F.lit(ONEWAY_KEY).alias("_k"), F.lit("yes").alias("_v")))
          .when(F.col("o_orderstatus") == TWOWAY_STATUS,
                F.struct(F.lit(ONEWAY_KEY).alias("_k"), F.lit("no").alias("_v"))))
    return o.select(F.col("o_orderkey").alias("way_id"),
                    F.filter(F.array(hw, ow), lambda t: t.isNotNull()).alias("tag"))


def way_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(way_id, l_linenumber, l_shipdate, l_partkey, ref)`` from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("way_id"), *WAY_ORDER_COLS,
                     F.col("l_partkey").alias("ref"))


NATION_ORDER_COLS = ["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]


def nation_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(way_id, *NATION_ORDER_COLS, ref)``: the line items of each supplying nation as one long way."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, li["l_suppkey"] == s["s_suppkey"]).select(
        F.col("s_nationkey").cast("long").alias("way_id"), *NATION_ORDER_COLS, F.col("l_partkey").alias("ref"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(_id, _lat, _lon)`` from ``part``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(k.alias("_id"),
                    ((k * 37 % 180000).cast("double") / 1000.0 - 90.0).alias("_lat"),
                    ((k * 91 % 360000).cast("double") / 1000.0 - 180.0).alias("_lon"))


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id)``: every node is a vertex, connected or not."""
    return nodes(spark, sf_dir).select(F.col("_id").alias("id"))


def route_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, src, dst)``, one per nation with supplied line items.

    ``min_by``/``max_by`` aggregate with partial aggregation, so a nation
    holding most line items is pre-reduced in every map task.
    """
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate",
                                                 "l_orderkey", "l_linenumber")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    key = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    return (li.join(s, li["l_suppkey"] == s["s_suppkey"])
            .groupBy(F.col("s_nationkey").cast("long").alias("query_id"))
            .agg(F.min_by("l_partkey", key).alias("src"), F.max_by("l_partkey", key).alias("dst")))


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> list[str]:
    """Register the parquet tables found in ``sf_dir`` as temp views for SQL."""
    done = []
    for name in names:
        try:
            found = table(spark, sf_dir, name)
        except AnalysisException as e:      # any store that Spark reads: it says what is not there
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.createOrReplaceTempView(name)
        done.append(name)
    return done
