"""Operator 6: exact top-k by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of weighted terms (dimension, weight). Candidates are
dealt into blocks, queries into blocks; a task has one block of each. It
inverts its candidates to postings (term -> rows, weights), and for each term
scatters ``query weight * posting weight`` into dense score arrays of
queries x rows. A partition selection keeps each query's best of the block
(the k-th score by ``np.partition``, then all rows that reach it, so ties are
settled by id) and a window merges the blocks' lists.

Work is queries x rows by definition (each query against all rows). Candidates
are sent once for each block of queries and queries once for each block of
candidates; a task's memory is bounded by the block sizes. Blocks are dealt
by a hash of the id and the row's place in the scan, so repeated ids spread.

Defined results: a vector that is null or holds a null, NaN or infinite
component takes no part; a missing component counts as 0 (vectors may differ
in length, an empty one scores 0); a null id takes no part; rows with the
query's own id are its own row; repeated candidate ids are rows of their own;
a repeated query id asks once, with its smallest vector. Ties go to the
smaller id. No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick, table

BLOCK_ROWS = 16_384         # candidates in a block, about
BLOCK_QUERIES = 1_024       # queries in a block, about
AT_ONCE = 64                # queries with a dense score array at the same time


def quantised(embedding: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of each component, x as double."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _usable(embedding: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return embedding.isNotNull() & ~F.exists(embedding.cast("array<double>"), bad)


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    rows = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(rows.offsets.to_numpy())
    owner = np.repeat(np.arange(len(rows)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[owner, place] = rows.flatten().to_numpy()
    return out


def block_topk(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """``(query_id, vec_id, score)`` arrays of each query's best k rows of the block."""
    postings = [(np.flatnonzero(col), col[np.flatnonzero(col)]) for col in rows.T]
    found = []
    for first in range(0, len(query_ids), AT_ONCE):
        weights = queries[first:first + AT_ONCE]
        scores = np.zeros((len(weights), len(ids)), np.int64)
        for term, (at, value) in enumerate(postings):
            asked = np.flatnonzero(weights[:, term])
            if len(asked) and len(at):
                scores[np.ix_(asked, at)] += weights[asked, term][:, None] * value[None, :]
        for q, score in zip(query_ids[first:first + AT_ONCE], scores):
            other = np.flatnonzero(ids != q)
            s = score[other]
            if len(s) > k:
                reach = s >= np.partition(s, len(s) - k)[len(s) - k]
                other, s = other[reach], s[reach]
            best = np.lexsort((ids[other], -s))[:k]
            found.append((np.full(len(best), q), ids[other[best]], s[best]))
    return [np.concatenate(c) if found else np.empty(0, np.int64) for c in zip(*found)] if found else [
        np.empty(0, np.int64)] * 3


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of each query.

    ``is_query`` is a condition over the column ``vec_id``.
    """
    spark = vectors.sparkSession
    v = (pick(vectors, vec_id=id_col, embedding=vector_col)
         .where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
         .select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("terms")))
    queries = v.where(is_query).groupBy("vec_id").agg(F.min("terms").alias("terms"))
    n_rows, n_queries = v.agg(F.count(F.lit(1)), F.count_distinct(F.when(is_query, F.col("vec_id")))).first()
    c = max(1, -(-n_rows // BLOCK_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // 1024))
    r = max(1, -(-n_queries // BLOCK_QUERIES))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("r", F.pmod(F.xxhash64("vec_id"), F.lit(r)).cast("int")).withColumn("c", every(c))
    right = v.withColumn("c", deal(c)).withColumn("r", every(r))

    def search(asked: pa.Table, block: pa.Table) -> pa.Table:
        if not len(asked) or not len(block):
            got = [np.empty(0, np.int64)] * 3
        else:
            lists = [t["terms"].combine_chunks() for t in (asked, block)]
            width = max(int(np.diff(x.offsets.to_numpy()).max()) for x in lists)
            got = block_topk(asked["vec_id"].to_numpy(), _matrix(lists[0], width),
                             block["vec_id"].to_numpy(), _matrix(lists[1], width), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, got))))

    best = (left.groupBy("c", "r").cogroup(right.groupBy("c", "r"))
            .applyInArrow(search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op6_exact_topk(spark, sf_dir: str) -> DataFrame:
    """Every ``embeddings`` row whose id is divisible by 100 against all rows."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.t, c.t), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM (SELECT vec_id, min(t) AS t FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id) q, v c WHERE c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
