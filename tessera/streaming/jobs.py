"""Structured Streaming drivers for the batch jobs.

The reference has no stream operators; what it does have is incremental
output: each route is flushed to durable storage as soon as it is found.
These drivers give the same jobs a streaming form with Spark's own
machinery instead of hand-flushed files:

* ``word_count_stream`` -- word counts over a directory that keeps receiving
  text files (file source, stateful aggregation, changed counts as Parquet).
* ``start_route_stream`` -- route queries arriving as text files are
  answered per micro-batch with ``foreachBatch``; each batch's routes are
  committed before the next batch starts (the commit log replaces
  ``hflush``). Output folders are keyed by batch id and overwritten on
  replay, so a restarted query is idempotent.

Checkpoint locations default to a folder under ``spark.checkpoint.dir``
(shared storage on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import graph, text
from tessera.session import scratch_path
from tessera.sinks.text import write_routes
from tessera.sources.text import parse_route_queries


def word_count_stream(spark: SparkSession, input_dir: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(word, count)`` over every text file landing in ``input_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return text.word_count(reader.load(input_dir))


def start_word_count(spark: SparkSession, input_dir: str, query_name: str,
                     checkpoint: str | None = None, available_now: bool = True,
                     output_dir: str | None = None) -> StreamingQuery:
    """Run ``word_count_stream`` into a table of changed counts, and keep the view ``query_name`` of the latest ones.

    A batch appends the words it has seen with their new counts, under
    ``output_dir/batch=<id>`` (overwritten on replay); nothing of the
    vocabulary passes the driver.
    """
    out = (output_dir or scratch_path(spark, "wc-counts")).rstrip("/")

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        latest_counts(spark, out).createOrReplaceTempView(query_name)

    w = (word_count_stream(spark, input_dir).writeStream.outputMode("update").foreachBatch(publish)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "wc-stream")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def latest_counts(spark: SparkSession, output_dir: str) -> DataFrame:
    """``(word, count)``: the newest count of every word that ``start_word_count`` has written."""
    counts = spark.read.schema("word string, count long, batch long").parquet(output_dir)
    return counts.groupBy("word").agg(F.max_by("count", "batch").alias("count"))


def start_route_stream(spark: SparkSession, weighted_edges: DataFrame, queries_dir: str,
                       output_dir: str, weight_col: str = "distance",
                       vertices: DataFrame | None = None, checkpoint: str | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Answer route queries (``src dst`` lines) as their files arrive.

    Each micro-batch is a static DataFrame: parsed, solved with
    ``graph.shortest_paths`` and written as ``src -> ... -> dst`` lines to
    ``output_dir/batch=<id>``. ``query_id`` is the struct ``(batch, line)``,
    unique across batches and ordered like the input.
    """
    def solve(batch: DataFrame, batch_id: int) -> None:
        q = parse_route_queries(batch).withColumn(
            "query_id", F.struct(F.lit(batch_id).cast("long").alias("batch"),
                                 F.col("query_id").alias("line")))
        if q.isEmpty():
            return
        routes = graph.shortest_paths(weighted_edges, q, weight_col=weight_col, vertices=vertices)
        write_routes(routes, f"{output_dir.rstrip('/')}/batch={batch_id}")

    lines = spark.readStream.format("text").load(queries_dir)
    w = (lines.writeStream.foreachBatch(solve)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "route-stream")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
