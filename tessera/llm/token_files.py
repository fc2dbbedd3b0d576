"""Operator 4: token-id files with one shared zstandard dictionary.

File format (``.zids``), little-endian throughout::

    magic            8 bytes  b"ZIDS0001"
    dictionary hash 16 bytes  blake2b of the dictionary the frames need
    frames                    one zstandard frame a document: its ids as uint32
    index                     a row a document, in file order: doc_id int64,
                              is-null uint64, frame offset uint64, frame length
                              uint64, ids before it in the file uint64, ids uint64
    footer          24 bytes  index offset uint64, documents uint64, ids uint64

The dictionary lies beside the files (``dictionary.zdict``). A short document
is read with three small reads: footer, index row, frame. Files hold
documents in ascending id order and follow one another in that order; the
manifest table says how many ids come before each file.

The dictionary is trained on serialised id arrays of a bounded sample: at most
``SAMPLE_DOCS`` documents of small id hash (ids are chosen first, then their
texts are fetched), and of each one piece of at most ``SAMPLE_BYTES`` from
anywhere in it. It changes file sizes only. There is none if the sample has
fewer than ``LEAST_DOCS`` pieces or ``LEAST_BYTES``, which train no dictionary.

A file is closed at about ``FILE_BYTES`` and the next one begun, so memory and
file sizes do not grow with the documents of a task.

A task writes its file under a name of its own attempt; the manifest, which
is committed by Spark, names the files that count, so lost executors and
repeated tasks leave at most files that nobody reads.

Defined results: a null or empty text holds the end id alone; a null id comes
first and is kept as null; equal ids keep the order of the scan; no rows give
no files. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, materialise, partitions_for, pick, table
from tessera.llm.tokens import END_ID, id_bytes, tokenizer_path, word_table
from tessera.session import scratch_path

MAGIC = b"ZIDS0001"
INDEX = np.dtype([("doc_id", "<i8"), ("null", "<u8"), ("at", "<u8"), ("size", "<u8"),
                  ("start", "<u8"), ("n", "<u8")])
ROW = struct.Struct("<q5Q")        # a row of the index
FOOTER = np.dtype([("index", "<u8"), ("docs", "<u8"), ("ids", "<u8")])
HEAD = len(MAGIC) + 16
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 4096
LEAST_DOCS, LEAST_BYTES = 8, 8 * 1024
FILE_BYTES = 256 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that every executor shares (file:, hdfs:, s3: ...)."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _uri(path: str) -> str:
    # Hadoop prints file:/x, which has no authority part
    return "file://" + path[len("file:"):] if path.startswith("file:/") and not path.startswith("file://") else path


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> bytes:
    """Dictionary bytes; empty if the sample is too small to train one."""
    known = docs.select("doc_id").where("doc_id IS NOT NULL")
    n = known.count()
    if not n:
        return b""
    # about 1.5 x SAMPLE_DOCS ids under a hash threshold, so that no task sends more than its share
    rank = F.xxhash64("doc_id")
    under = -(1 << 63) + (min(1 << 64, (1 << 64) * 3 * SAMPLE_DOCS // (2 * n)) - 1)
    ids = known.where(rank <= F.lit(under)).distinct().orderBy(rank, "doc_id").limit(SAMPLE_DOCS)
    chosen = [r["doc_id"] for r in ids.collect()]       # at most SAMPLE_DOCS
    sample = docs.where("text IS NOT NULL").join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id long")), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"))      # of a repeated id one text

    def serialise(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, out = word_table(tokenizer), []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = id_bytes(text.as_py(), words, end_id)
            spare = max(0, len(ids) - SAMPLE_BYTES) // 4
            start = 4 * (zlib.crc32(str(doc_id).encode()) % (spare + 1))
            out.append(ids[start:start + SAMPLE_BYTES])
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])

    parts = [bytes(r["ids"]) for r in map_batches(sample.select("doc_id", "text"), serialise, "ids binary").collect()]
    parts.sort()
    if sum(map(len, parts)) < LEAST_BYTES or len(parts) < LEAST_DOCS:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, parts)) // 8), parts).as_bytes()
    except zstandard.ZstdError:     # a sample without repetition has no dictionary
        return b""


def _codec_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def dictionary_hash(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


class FileWriter:
    """Writes one file, document by document; memory is the index and one document."""

    def __init__(self, stream, dictionary: bytes):
        self.out, self.at, self.ids, self.docs, self.rows = stream, HEAD, 0, 0, bytearray()
        known = _codec_dictionary(dictionary)
        if known:
            known.precompute_compress(level=LEVEL)      # once a file, not once a document
        self.codec = zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
        self.out.write(MAGIC + dictionary_hash(dictionary))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.codec.compress(ids)
        self.out.write(frame)
        self.rows += ROW.pack(doc_id or 0, doc_id is None, self.at, len(frame), self.ids, len(ids) // 4)
        self.docs += 1
        self.at += len(frame)
        self.ids += len(ids) // 4

    def close(self) -> None:
        self.out.write(bytes(self.rows))
        self.out.write(np.array([(self.at, self.docs, self.ids)], FOOTER).tobytes())
        self.out.close()


class FileReader:
    """Reads a file's index, and documents one at a time."""

    def __init__(self, stream, dictionary: bytes):
        self.f = stream
        size = stream.size()
        if stream.read_at(HEAD, 0) != MAGIC + dictionary_hash(dictionary):
            raise ValueError("not a token file of this dictionary")
        foot = np.frombuffer(stream.read_at(FOOTER.itemsize, size - FOOTER.itemsize), FOOTER)[0]
        self.index_at, self.docs, self.ids = (int(foot[c]) for c in ("index", "docs", "ids"))
        self.codec = zstandard.ZstdDecompressor(dict_data=_codec_dictionary(dictionary))

    def index(self, first: int = 0, count: int | None = None) -> np.ndarray:
        count = self.docs - first if count is None else min(count, self.docs - first)
        raw = self.f.read_at(count * INDEX.itemsize, self.index_at + first * INDEX.itemsize)
        return np.frombuffer(raw, INDEX)

    def document(self, row) -> bytes:
        """Ids of the document of an index row, as little-endian uint32 bytes."""
        raw = self.codec.decompress(self.f.read_at(int(row["size"]), int(row["at"])))
        if len(raw) != 4 * int(row["n"]):
            raise ValueError("a frame does not hold the ids its index row counts")
        return raw


@dataclass
class TokenFiles:
    """A written data set: folder, dictionary and manifest ``(file, path, docs, ids, start)``."""

    folder: str
    dictionary: bytes
    manifest: DataFrame

    def read(self) -> DataFrame:
        """``doc_id, start, n_tokens, ids binary`` of all documents, read from the files."""
        dictionary = self.dictionary

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    fs, place = open_fs(path)
                    with fs.open_input_file(place) as f:
                        reader = FileReader(f, dictionary)
                        for first in range(0, reader.docs, 256):
                            rows = reader.index(first, 256)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(rows["doc_id"], pa.int64(), mask=rows["null"] > 0),
                                 pa.array(rows["start"].astype(np.int64) + before),
                                 pa.array(rows["n"].astype(np.int64)),
                                 pa.array([reader.document(r) for r in rows], pa.binary())],
                                names=["doc_id", "start", "n_tokens", "ids"])

        files = self.manifest.select("path", "start")
        return (files.repartition(max(partitions_for(files.sparkSession), 1), "path")
                .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary"))


def write_token_files(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                      tokenizer: str | None = None, end_id: int = END_ID) -> TokenFiles:
    """Encode all documents and write them as files in ascending id order.

    ``folder`` is a shared folder (default: a new one under the checkpoint folder).
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path()
    folder = _uri(folder or scratch_path(spark, "zids"))
    docs = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    dictionary = train_dictionary(docs, path, end_id)
    fs, place = open_fs(folder)
    fs.create_dir(place, recursive=True)
    with fs.open_output_stream(posixpath.join(place, "dictionary.zdict")) as f:
        f.write(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, writer, name, number = word_table(path), None, "", TaskContext.get().partitionId() << 32

        def closed() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([name]), pa.array([writer.docs], pa.int64()),
                 pa.array([writer.ids], pa.int64())], names=["file", "path", "docs", "ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if writer is None:
                    name = f"{folder}/part-{number >> 32:06d}-{number & 0xFFFFFFFF:04d}-{uuid.uuid4().hex}.zids"
                    fs, place = open_fs(name)
                    writer = FileWriter(fs.open_output_stream(place), dictionary)
                writer.add(doc_id.as_py(), id_bytes(text.as_py(), words, end_id))
                if writer.at + len(writer.rows) >= FILE_BYTES:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    # the place in the scan settles equal ids, so no text is hashed for the ranges, and a hot id can be cut
    ordered = (docs.withColumn("_at", F.monotonically_increasing_id())
               .repartitionByRange(partitions_for(spark), "doc_id", "_at").sortWithinPartitions("doc_id", "_at"))
    manifest = materialise(ordered.select("doc_id", "text").mapInArrow(write, "file long, path string, docs long, ids long"),
                           "manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)      # one row a file
    manifest = manifest.select("*", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    return TokenFiles(folder, dictionary, manifest)


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, written and read back."""
    files = write_token_files(table(spark, sf_dir, "documents"))
    # by Spark: a second Python function would be a second worker a core, beside those that hold tables of words
    return files.read().select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
