"""Operator 12: repeated byte strings by a logarithmic family of suffix arrays.

A byte goes if a ``WINDOW``-byte string that covers it starts anywhere else.

*Sparse suffixes.* Every window owns one anchor, the leftmost smallest of the
hashes of its ``PREFIX``-byte strings, so equal windows have their anchors at
equal places. Only the suffixes that start at anchors are indexed, about two
for each ``WINDOW - PREFIX + 1`` bytes; an anchor's windows are consecutive.

*Index family.* Texts come in batches. A batch gets a suffix array: its sparse
suffixes in the order of their first ``PREFIX`` bytes, equal ones counted, as a
table bucketed and sorted by them. It is merge-scanned (a sort-merge join of
sorted buckets) against each level of the family; a suffix that is met in a
level, or twice in the batch, may start a long match. Then the batch becomes a
level, and levels of equal size are merged, so there are at most log2(batches)
levels and a suffix is rewritten log2(batches) times.

*Long matches.* Candidates are carried on to ``WINDOW`` bytes in three steps,
each an aggregation with map-side combine that keeps one representative of
what is equal: all windows of an anchor together; the windows of ``RANGE``
neighbouring starts, among those that share the bytes common to them; single
windows. A passage that a third of all documents hold is thus one row for each
map task wherever it is equal. Comparisons are by two 64-bit hashes together
(of the strings and of a string they share). Copies of a whole text are one
text throughout.

Defined results, one row for each row of the input: a null or empty text has no
bytes and the hash of no bytes; a text shorter than ``WINDOW`` keeps all bytes;
null and repeated ids stay as they are, and equal texts of repeated rows are
copies of each other; strings are judged on the input whatever its order, so
there are no ties; no rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ROWS_AT_ONCE, materialise, partitions_for, pick, table
from tessera.llm.shingles import mix
from tessera.session import scratch_path

WINDOW = 400
PREFIX = 32             # bytes of a suffix that order the arrays
RANGE = 24              # starts whose windows are compared together
BATCHES = 4
STARTS_AT_ONCE = 1 << 20    # window starts of one text worked on together; places fit in PLACE bits
PLACE = np.uint64((1 << 24) - 1)


# ------------------------------------------------------------------ anchors

def _hashes(raw: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of the ``length`` bytes from each place on, by doubling."""
    with np.errstate(over="ignore"):
        h, have = raw.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1), 1
        while have < length:
            step = min(have, length - have)
            h = mix(h[:len(h) - step] * np.uint64(0xC2B2AE3D27D4EB4F) + h[step:])
            have += step
    return h


def anchors(raw: np.ndarray, window: int = WINDOW, prefix: int = PREFIX):
    """``(at, first, n)``: each anchor and the ``n`` window starts from ``first`` on that own it."""
    parts = []
    for begin in range(0, max(len(raw) - window + 1, 0), STARTS_AT_ONCE):
        some = raw[begin:begin + STARTS_AT_ONCE + window - 1]
        h = _hashes(some, prefix)
        n, w = len(h), window - prefix + 1
        key = np.full(-(-n // w) * w, np.uint64(2**64 - 1))
        key[:n] = (h & ~PLACE) | np.arange(n, dtype=np.uint64)
        blocks = key.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(behind[:n - w + 1], ahead[w - 1:n]) & PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        parts.append((at[first] + begin, first + begin, np.diff(np.append(first, len(at)))))
    return tuple(map(np.concatenate, zip(*parts))) if parts else (np.empty(0, np.int64),) * 3


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a uint8 matrix as binary values."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes()


def _flat_map(df: DataFrame, one, names: list[str], schema: str) -> DataFrame:
    """``one(row values...) -> arrays`` for each row; the arrays of some rows make a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                found = [one(*row) for row in zip(*batch.slice(begin, ROWS_AT_ONCE).columns)]
                found = [f for f in found if f is not None]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*found)], names=names)

    return df.mapInArrow(run, schema)


def sparse_suffixes(texts: DataFrame) -> DataFrame:
    """``digest, text`` -> ``digest, at, first, n, suffix binary, around``: the anchors of every text.

    ``around`` hashes all bytes of the windows that own the anchor.
    """

    def one(digest, text):
        body = _bytes(text)
        raw = np.frombuffer(body, np.uint8)
        at, first, n = anchors(raw)
        if not len(at):
            return None
        around = [xxhash.xxh3_64_intdigest(body[f:f + k + WINDOW - 1]) for f, k in zip(first.tolist(), n.tolist())]
        return (pa.array([_bytes(digest)] * len(at), pa.binary()), pa.array(at), pa.array(first), pa.array(n),
                _binary(np.lib.stride_tricks.sliding_window_view(raw, PREFIX)[at]), _signed(around))

    return _flat_map(texts.select("digest", "text"), one, ["digest", "at", "first", "n", "suffix", "around"],
                     "digest binary, at long, first long, n long, suffix binary, around long")


# ------------------------------------------------------------------ index family

def _bucketed(df: DataFrame, key: str, tag: str) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` in the shared checkpoint folder; joins on the key need no exchange."""
    spark = df.sparkSession
    name = f"tessera_{tag}_{uuid.uuid4().hex}"
    (df.write.bucketBy(partitions_for(spark), key).sortBy(key).option("path", scratch_path(spark, tag))
     .option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


class IndexFamily:
    """Suffix arrays of geometrically growing sizes."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []       # (batches it holds, table), largest first

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Index a batch; ``suffix`` values of the batch that start more than once in all that is indexed now."""
        array = _bucketed(suffixes.groupBy("suffix").agg(F.count(F.lit(1)).alias("n")), "suffix", "suffixes")
        found = array.where("n > 1").select("suffix")
        for _, level in self.levels:
            found = found.unionAll(array.join(level.select("suffix"), "suffix").select("suffix"))
        found = materialise(found, "matches")
        self.levels.append((1, array))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels.pop(), self.levels.pop()
            # a merge of sorted buckets (a union would lose the buckets)
            merged = a.withColumnRenamed("n", "one").join(b.withColumnRenamed("n", "two"), "suffix", "full_outer")
            merged = merged.select("suffix", (F.coalesce("one", F.lit(0)) + F.coalesce("two", F.lit(0))).alias("n"))
            self.levels.append((2 * size, _bucketed(merged, "suffix", "level")))
        return found


# ------------------------------------------------------------------ long matches

def _equal(rows: DataFrame, shared: str, whole: str, tag: str) -> tuple[DataFrame, DataFrame]:
    """``(equal, open)`` of rows ``digest, at, first, n, <shared>, <whole>``.

    ``equal``: ranges ``digest, first, n`` whose bytes another row has too.
    ``open``: one row of each distinct ``whole`` where a ``shared`` has several.
    """
    wholes = materialise(rows.groupBy(shared, whole).agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.struct("digest", "at", "first", "n")).alias("one")), tag)
    # landed before the joins, so that a key of very many rows can be split
    several = materialise(wholes.groupBy(shared).agg(F.min(whole).alias("lo"), F.max(whole).alias("hi"))
                          .where("lo < hi").select(shared), "several")
    again = wholes.where("rows > 1").select(shared, whole)
    return (rows.join(again, [shared, whole], "left_semi").select("digest", "first", "n"),
            wholes.join(several, shared, "left_semi").select("one.*"))


def _of_text(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows ``digest, at, first, n`` of a text as one list (no longer than the text) beside it."""
    lists = rows.groupBy("digest").agg(F.collect_list(F.struct("at", "first", "n")).alias("rows"))
    return texts.join(lists, "digest").select("digest", "text", "rows")


def _triples(rows: pa.Scalar) -> list[tuple[int, int, int]]:
    return sorted(zip(*(rows.values.field(c).to_pylist() for c in range(3))))


def _ranges(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The windows of each anchor in ranges of starts: ``shared`` is what all windows of a full range hold."""

    def one(digest, text, rows):
        body, out = _bytes(text), []
        for at, first, n in _triples(rows):
            for k in range((at - first - n + 1) // RANGE, (at - first) // RANGE + 1):
                near = at - RANGE * k       # the last start of the range
                lo, hi = max(first, near - RANGE + 1), min(first + n - 1, near)
                out.append((at, lo, hi - lo + 1,
                            xxhash.xxh3_64_intdigest(body[near:near - RANGE + 1 + WINDOW], seed=k),
                            xxhash.xxh3_64_intdigest(body[lo:hi + WINDOW])))
        at, first, n, shared, whole = zip(*out)
        return (pa.array([_bytes(digest)] * len(at), pa.binary()), pa.array(at, pa.int64()),
                pa.array(first, pa.int64()), pa.array(n, pa.int64()), _signed(shared), _signed(whole))

    return _flat_map(_of_text(texts, rows), one, ["digest", "at", "first", "n", "shared", "whole"],
                     "digest binary, at long, first long, n long, shared long, whole long")


def _windows(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Single windows of ranges: ``digest, at, first, n = 1, shared, whole``."""

    def one(digest, text, rows):
        body, out = _bytes(text), []
        for at, first, n in _triples(rows):
            k = (at - first) // RANGE
            near = at - RANGE * k
            shared = xxhash.xxh3_64_intdigest(body[near:near - RANGE + 1 + WINDOW], seed=k)
            out += [(s, shared, xxhash.xxh3_64_intdigest(body[s:s + WINDOW])) for s in range(first, first + n)]
        first, shared, whole = zip(*out)
        return (pa.array([_bytes(digest)] * len(first), pa.binary()), pa.array(first, pa.int64()),
                pa.array(np.ones(len(first), np.int64)), _signed(shared), _signed(whole))

    return _flat_map(_of_text(texts, rows), one, ["digest", "first", "n", "shared", "whole"],
                     "digest binary, first long, n long, shared long, whole long")


def repeated_windows(texts: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``digest, text`` (distinct) -> ``digest, first, n``: starts of windows that start elsewhere too."""
    batch = F.pmod(F.xxhash64("digest"), F.lit(batches)).cast("int")
    path = scratch_path(texts.sparkSession, "sparse")
    found = sparse_suffixes(texts).withColumn("batch", batch)
    found.write.partitionBy("batch").option("compression", "zstd").parquet(path)
    suffixes = texts.sparkSession.read.schema(found.schema).parquet(path)
    family, matches = IndexFamily(), None
    for b in range(batches):
        hit = family.add(suffixes.where(F.col("batch") == b))
        matches = hit if matches is None else matches.unionAll(hit)
    matches = materialise(matches.distinct(), "shared")     # landed, so that a common suffix can be split in the join
    rows = suffixes.join(matches, "suffix", "left_semi").select(
        "digest", "at", "first", "n", F.xxhash64("suffix").alias("suffix"), "around")
    whole_anchor, open_anchors = _equal(materialise(rows, "candidates"), "suffix", "around", "anchors")
    ranges = materialise(_ranges(texts, open_anchors), "ranges")
    whole_range, open_ranges = _equal(ranges, "shared", "whole", "wholes")
    windows = materialise(_windows(texts, open_ranges), "windows")
    twice = materialise(windows.groupBy("shared", "whole").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
                        .select("shared", "whole"), "twice")
    single = windows.join(twice, ["shared", "whole"], "left_semi").select("digest", "first", "n")
    return whole_anchor.unionAll(whole_range).unionAll(single)


# ------------------------------------------------------------------ operator

def _union(firsts: list[int], ns: list[int]) -> list[tuple[int, int]]:
    """Maximal byte runs that the windows cover."""
    out: list[tuple[int, int]] = []
    for first, n in sorted(zip(firsts, ns)):
        end = first + n - 1 + WINDOW
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES,
                   with_bytes: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans array<struct<start, end>>, kept_sha256`` (and ``kept binary``).

    ``spans`` are the removed byte runs, ``end`` exclusive.
    """
    d = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("sha", F.sha2("text", 256)).withColumn("n_bytes", F.octet_length("text").cast("long"))
    d = d.withColumn("digest", F.unhex(F.substring("sha", 1, 32)))
    # copies of a text become one row in every map task, and only long enough texts can lose a byte
    texts = (d.where(F.col("n_bytes") >= WINDOW).groupBy("digest")
             .agg(F.first(F.col("text").cast("binary")).alias("text"), F.count(F.lit(1)).alias("copies")))
    texts = _bucketed(texts, "digest", "texts")
    marks = (repeated_windows(texts.select("digest", "text"), batches).groupBy("digest")
             .agg(F.collect_list(F.struct("first", "n")).alias("marks")))

    def cut(digest, text, copies, marks):
        body = _bytes(text)
        if copies.as_py() > 1:
            spans = [(0, len(body))]
        elif marks.is_valid:
            spans = _union(*(marks.values.field(c).to_pylist() for c in range(2)))
        else:
            return None
        at, kept = 0, []
        for start, end in spans:
            kept.append(body[at:start])
            at = end
        kept = b"".join([*kept, body[at:]])
        return (pa.array([_bytes(digest)], pa.binary()),
                pa.array([[{"start": s, "end": e} for s, e in spans]], SPANS),
                pa.array([hashlib.sha256(kept).hexdigest()]), pa.array([kept if with_bytes else None], pa.binary()))

    found = _flat_map(texts.join(marks, "digest", "left"), cut, ["digest", "spans", "kept_sha256", "kept"],
                      "digest binary, spans array<struct<start: long, end: long>>, kept_sha256 string, kept binary")
    none = F.array().cast("array<struct<start: long, end: long>>")
    out = d.drop("text") if not with_bytes else d
    out = out.join(materialise(found, "cuts"), "digest", "left").withColumn("spans", F.coalesce("spans", none))
    columns = ["doc_id", "n_bytes",
               F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_removed"),
               "spans", F.coalesce("kept_sha256", "sha").alias("kept_sha256")]
    if with_bytes:
        columns.append(F.coalesce("kept", F.col("text").cast("binary")).alias("kept"))
    return out.select(*columns)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``; 400-byte strings."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
