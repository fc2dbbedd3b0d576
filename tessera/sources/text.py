"""Text sources: line scans, stop lists, key/value text, route-query lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import whitespace_fields


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line of a file, a directory of files, or a list: ``(value)``."""
    return spark.read.text(path)


def read_ordered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(pos, value)``: every line with its place, counted from 0 over the files in the order of their names.

    A line's place is the lines of the blocks before its block, plus its place
    in the block; the window that adds up blocks has one row a block.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start",
                                         F.monotonically_increasing_id().alias("_at"))
    block = Window.partitionBy("file_path", "file_block_start").orderBy("_at")
    lines = lines.withColumn("_line", F.row_number().over(block) - 1)
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (lines.groupBy(F.col("file_path").alias("_file"), F.col("file_block_start").alias("_block"))
              .agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    here = (lines["file_path"] == blocks["_file"]) & (lines["file_block_start"] == blocks["_block"])
    return lines.join(blocks, here).select((F.col("_before") + F.col("_line")).cast("long").alias("pos"), "value")


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Stop list, one word a line, lower-cased and de-duplicated: ``(word)``."""
    return (spark.read.text(path)
            .select(F.lower(F.col("value")).alias("word"))
            .where(F.col("word").isNotNull())
            .distinct())


def parse_kv(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split each line at its FIRST tab: ``(key, value)``.

    A line without a tab gives ``value = ''``; later tabs stay in the value.
    """
    parts = F.split(F.col(col), "\t", 2)
    return lines.select(parts.getItem(0).alias("key"),
                        F.coalesce(F.get(parts, 1), F.lit("")).alias("value"))


def read_kv(spark: SparkSession, path: str) -> DataFrame:
    """Key/value text scan (first tab splits): ``(key, value)``."""
    return parse_kv(spark.read.text(path))


def tagged_union_kv(a: DataFrame, b: DataFrame, tags: tuple[str, str] = ("f1", "f2")) -> DataFrame:
    """Union of two key/value inputs with a source tag: ``(key, value, side)``."""
    return (a.select("key", "value", F.lit(tags[0]).alias("side"))
            .unionByName(b.select("key", "value", F.lit(tags[1]).alias("side"))))


def parse_route_queries(lines: DataFrame, col: str = "value", id_col: str | None = None) -> DataFrame:
    """Parse ``src dst`` lines (whitespace-separated, extra fields ignored).

    ``query_id`` is ``id_col``, or else increases in scan order (partition
    index, then position in the partition). Ids are unique, not dense. Blank
    lines are skipped.
    """
    f = whitespace_fields(col)
    return (lines.select((F.col(id_col) if id_col else F.monotonically_increasing_id()).alias("query_id"), f.alias("_f"))
            .where(F.size("_f") >= 2)
            .select("query_id",
                    F.col("_f").getItem(0).cast("long").alias("src"),
                    F.col("_f").getItem(1).cast("long").alias("dst")))


def read_route_queries(spark: SparkSession, path: str) -> DataFrame:
    """Route-query scan: ``(query_id, src, dst)``; ids increase with file name, then line.

    An id is the file's rank times 2^40, the offset of the line's block in the
    file and the line's number in the block. So the ids of one small file are
    its line numbers from 0. The window that numbers lines holds a block of a
    file, the one that ranks files holds a row a file.
    """
    block = ["_metadata.file_path", "_metadata.file_block_start"]
    lines = spark.read.text(path).select("value", *block, F.monotonically_increasing_id().alias("_at"))
    lines = lines.withColumn("_line", F.row_number().over(
        Window.partitionBy("file_path", "file_block_start").orderBy("_at")) - 1)
    ranks = (lines.select(F.col("file_path").alias("_file")).distinct()
             .withColumn("_rank", F.row_number().over(Window.orderBy("_file")) - 1))
    line_id = F.shiftleft(F.col("_rank").cast("long"), 40) + F.col("file_block_start") + F.col("_line")
    ordered = lines.join(ranks, lines["file_path"] == ranks["_file"])
    return parse_route_queries(ordered.withColumn("_id", line_id), id_col="_id")
