"""Small helpers shared by the operators: scratch tables, column checks, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, write_read
from tessera.sources.tables import table  # noqa: F401  (queries import it from here)


def materialise(df: DataFrame, tag: str, observation: Observation | None = None,
                metrics: list | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and scan it again."""
    return write_read(df, scratch_path(df.sparkSession, tag), observation, metrics)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, doc_id="id", text="body")``: just these columns under these names.

    Names are looked up exactly as given, so other columns of the input, also
    ones named like an operator's own columns, never meet them.
    """
    for src in columns.values():
        if src not in df.columns:
            raise ValueError(f"no column {src!r} in {df.columns}")
    # by place: names that differ in case only are one name to Spark
    placed = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return placed.select(*[F.col(f"_{df.columns.index(src)}").alias(out) for out, src in columns.items()])


def packed(df: DataFrame, **columns: str) -> DataFrame:
    """``pick``, and the whole row beside it as the struct ``row``; ``unpacked`` gives it back."""
    placed = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    for src in columns.values():
        if src not in df.columns:
            raise ValueError(f"no column {src!r} in {df.columns}")
    return placed.select(F.struct(*placed.columns).alias("row"),
                         *[F.col(f"_{df.columns.index(src)}").alias(out) for out, src in columns.items()])


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The rows that ``packed`` put away, with the columns of ``like``."""
    return df.select("row.*").toDF(*like.columns)


def replaced(df: DataFrame, name: str, fn: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``fn`` applied to the column of exactly this name, at its place."""
    at = df.columns.index(name)
    placed = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return placed.withColumn(f"_{at}", fn(F.col(f"_{at}"))).toDF(*df.columns)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df`` (a map over partitions, no shuffle)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a batch holds up to 10,000 rows: long texts are worked on in smaller slices
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield fn(batch.slice(at, ROWS_AT_ONCE))

    return df.mapInArrow(run, schema)


ROWS_AT_ONCE = 512


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def partitions_for(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
