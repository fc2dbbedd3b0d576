"""Operator 11: hard negatives by rotated one-bit codes with exact intervals.

*Index.* A vector x of integers is rotated (signs and Hadamard transforms, the
same for all vectors) and kept as the signs of its components, one bit each,
as a unit vector c. Beside the code lie its alignment ``a = <x, c>`` and the
length r of the rest, ``x = a c + rest`` with ``rest`` at right angles to c.

*Interval.* For an anchor q, ``<q, x> = a <q, c> + <q, rest>``. The rotated q is
rounded to 8-bit levels, whose bit planes meet the codes by ``and`` and
popcount, so ``<q, c>`` is known up to the length e of the rounding error; by
Cauchy-Schwarz ``<q, rest>`` is at most r times the length of q's part at right
angles to c. The interval is certain, nothing is left to chance: rows whose
interval cannot matter are left out, the others are scored with integers.

*Positives.* Rows of the anchor's label with an upper end under the k-th
largest lower end are left out. *Negatives.* Rows of other labels whose
interval misses the window of scores that a positive allows are left out, and
so are those under the k-th largest lower end of rows that lie in it for sure.

Rows are dealt to blocks by a hash of id and place (so a label or an id that
holds a third of all rows spreads), anchors to blocks as well; a task has one
block of each, the anchors are the stated query set. Windows merge the
blocks' lists, at most k rows an anchor (and positive) and block.

Defined results: a row with a null label or vector, or a vector with a null,
NaN or infinite component, or a null id takes no part; a missing component
counts as 0 (vectors may differ in length); rows with the anchor's own id are
its own row; repeated ids of other rows are rows of their own; a repeated
anchor id asks once, with its smallest label and vector; ties go to the smaller
id; an anchor without positives, or a positive without a row in its window,
gives no rows; no rows give no rows. Extra columns are ignored. Scores are
64-bit integers, so components are expected to stay under about 2^28.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, materialise, partitions_for, pick, table
from tessera.llm.topk import _matrix, _usable, quantised

BLOCK_ROWS = 16_384         # rows in a block, about
BLOCK_ANCHORS = 4_096       # anchors in a block, about
PLANES = 8                  # bits of a rounded anchor component
ROTATION_SEED = 11
INDEX = "vec_id long, label long, terms array<long>, code binary, along double, rest double"


# ------------------------------------------------------------------ codes

def code_width(longest: int) -> int:
    """Components of a rotated vector: a power of two, whole 64-bit words."""
    return max(64, 1 << max(0, longest - 1).bit_length())


def rotated(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``x`` under a fixed rotation of ``width`` dimensions (two rounds of signs and Hadamard)."""
    rng = np.random.default_rng(ROTATION_SEED)
    y = np.zeros((len(x), width))
    y[:, :x.shape[1]] = x
    for _ in range(2):
        y *= rng.choice([-1.0, 1.0], width)
        half = 1
        while half < width:
            pairs = y.reshape(len(y), -1, 2, half)
            y = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(y), width)
            half *= 2
        y /= np.sqrt(width)
    return y


def encode(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes uint8, along, rest)`` of integer rows."""
    y = rotated(x, width)
    along = np.abs(y).sum(axis=1) / np.sqrt(width)
    rest = np.sqrt(np.maximum((y * y).sum(axis=1) - along * along, 0))
    return np.packbits(y >= 0, axis=1), along, rest


class Block:
    """Rows of the index, with their codes as 64-bit words."""

    def __init__(self, rows: pa.Table, width: int):
        self.ids, self.label = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.along, self.rest = rows["along"].to_numpy(), rows["rest"].to_numpy()
        raw = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8)
        self.words = raw.reshape(len(rows), width // 8).view(np.uint64)
        self.ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        self.terms = rows["terms"].combine_chunks()
        self.x = _matrix(self.terms, max(1, int(np.diff(self.terms.offsets.to_numpy()).max(initial=0))))
        self.most = int(np.abs(self.x).max(initial=0))

    def intervals(self, y: np.ndarray, at) -> tuple[np.ndarray, np.ndarray]:
        """Certain lower and upper ends of the scores of rows ``at`` for the rotated anchor ``y``."""
        width, low = len(y), y.min()
        step = (y.max() - low) / ((1 << PLANES) - 1) or 1.0
        level = np.rint((y - low) / step).astype(np.int64)
        near = low + step * level
        err = np.linalg.norm(y - near)
        words, summed = self.words[at], np.zeros(len(self.ids[at]), np.int64)
        for p in range(PLANES):
            plane = np.packbits((level >> p & 1).astype(bool)).view(np.uint64)
            summed += np.bitwise_count(words & plane).sum(axis=1, dtype=np.int64) << p
        dot = (2 * (low * self.ones[at] + step * summed) - near.sum()) / np.sqrt(width)
        along, rest, size = self.along[at], self.rest[at], np.linalg.norm(y)
        across = np.sqrt(np.maximum(size * size - np.maximum(np.abs(dot) - err, 0) ** 2, 0))
        # the last part covers the rounding of floating-point arithmetic
        half = along * err + rest * across + 1e-9 * size * (along + rest) + 1e-6
        return along * dot - half, along * dot + half

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Integer inner products of rows ``at``."""
        n = min(len(q), self.x.shape[1])
        x, q = self.x[at, :n], q[:n]
        if self.most * int(np.abs(q).max(initial=0)) * max(n, 1) < 1 << 53:     # exact in floating point
            return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return x @ q


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest, minus infinity if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _best(block: Block, at: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((block.ids[at], -score))[:k]
    return block.ids[at[order]], score[order]


def positives_in(block: Block, anchor: int, label: int, q: np.ndarray, y: np.ndarray, k: int):
    """The block's k best other rows of the label."""
    at = np.flatnonzero((block.label == label) & (block.ids != anchor))
    if len(at) > k:
        lower, upper = block.intervals(y, at)
        at = at[upper >= _kth(lower, k)]
    return _best(block, at, block.scores(q, at), k)


def negatives_in(block: Block, label: int, q: np.ndarray, y: np.ndarray, positive: list[int], low: int, high: int, k: int):
    """For each positive score P the block's k best rows of other labels with ``low P <= 100 score <= high P``."""
    other = np.flatnonzero(block.label != label)
    lower, upper = block.intervals(y, other)
    window = [(-(-low * p // 100), high * p // 100) for p in positive]
    needed = np.zeros(len(other), bool)
    for a, b in window:
        maybe = (upper >= a) & (lower <= b)
        needed |= maybe & (upper >= _kth(lower[maybe & (lower >= a) & (upper <= b)], k))
    at = other[needed]
    score = block.scores(q, at)
    out = []
    for a, b in window:
        inside = (score >= a) & (score <= b)
        out.append(_best(block, at[inside], score[inside], k))
    return out


# ------------------------------------------------------------------ mining

def build_index(vectors: DataFrame, width: int) -> DataFrame:
    """``vec_id, label, terms`` -> the stored index (``INDEX``), a table in the shared checkpoint folder."""

    def code(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = batch.column(2)
        codes, along, rest = encode(_matrix(terms, width), width)
        ends = np.arange(batch.num_rows + 1, dtype=np.int32) * (width // 8)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())]), pa.array(along), pa.array(rest)],
            names=["vec_id", "label", "terms", "code", "along", "rest"])

    return materialise(map_batches(vectors.select("vec_id", "label", "terms"), code, INDEX), "codes")


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95, scale: int = 256, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` and ``label`` are expressions over ``vec_id`` and ``label``;
    a negative's score lies between ``low`` and ``high`` hundredths of its
    positive's.
    """
    spark = vectors.sparkSession
    v = (pick(vectors, vec_id=id_col, label=label_col, embedding=vector_col)
         .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("embedding")))
         .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                 quantised(F.col("embedding"), scale).alias("terms")))
    v = v.select("vec_id", label.cast("long").alias("label"), "terms")
    n, n_anchors, longest = v.agg(F.count(F.lit(1)), F.count_distinct(F.when(is_anchor, F.col("vec_id"))),
                                  F.max(F.size("terms"))).first()
    width = code_width(longest or 0)
    index = build_index(v, width)
    c = max(1, -(-n // BLOCK_ROWS), min(partitions_for(spark), n // 1024))
    r = max(1, -(-n_anchors // BLOCK_ANCHORS))
    rows = (index.withColumn("c", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(c)).cast("int"))
            .withColumn("r", _each(r)))
    anchors = materialise(index.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "terms")).alias("a"))
                          .select("vec_id", "a.label", "a.terms",
                                  F.pmod(F.xxhash64("vec_id"), F.lit(r)).cast("int").alias("r")), "anchors")

    def asked(t: pa.Table):
        terms = t["terms"].combine_chunks()
        q = _matrix(terms, max(1, int(np.diff(terms.offsets.to_numpy()).max(initial=0))))
        return zip(t["vec_id"].to_pylist(), t["label"].to_pylist(), q, rotated(q, width))

    def positive(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            block = Block(right, width)
            for anchor, label, q, y in asked(left):
                ids, score = positives_in(block, anchor, label, q, y, positives)
                found.append((np.full(len(ids), anchor), ids, score))
        return _table(found, ("anchor_id", "positive_id", "positive_score"))

    near = (anchors.withColumn("c", _each(c)).groupBy("c", "r").cogroup(rows.groupBy("c", "r"))
            .applyInArrow(positive, "anchor_id long, positive_id long, positive_score long"))
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = materialise(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives), "positives")
    # one anchor's positives: as many as asked for
    each = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        "place", "positive_id", "positive_score"))).alias("near"))
    keyed = anchors.join(each, anchors["vec_id"] == each["anchor_id"]).drop("anchor_id")

    def negative(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            block = Block(right, width)
            for (anchor, label, q, y), near in zip(asked(left), left["near"].to_pylist()):
                lists = negatives_in(block, label, q, y, [p["positive_score"] for p in near], low, high, negatives)
                for p, (ids, score) in zip(near, lists):
                    found.append((np.full(len(ids), anchor), np.full(len(ids), p["place"]),
                                  np.full(len(ids), p["positive_id"]), np.full(len(ids), p["positive_score"]), ids, score))
        return _table(found, ("anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"))

    hard = (keyed.withColumn("c", _each(c)).groupBy("c", "r").cogroup(rows.groupBy("c", "r"))
            .applyInArrow(negative, "anchor_id long, place long, positive_id long, positive_score long, "
                                    "negative_id long, negative_score long"))
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _table(found: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*found)] if found else [np.empty(0, np.int64)] * len(names)
    return pa.table(dict(zip(names, map(pa.array, columns))))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: every ``embeddings`` row whose id is divisible by 50; labels of ids divisible by 7 are shifted first."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, shifted)


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT vec_id, min(struct_pack(label := label, t := t)) AS a FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (SELECT a.vec_id AS anchor_id, v.r, v.vec_id, v.label = a.a.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.a.t, v.t), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM a, v WHERE v.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (
    PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
