"""Operator 7: SentencePiece encoding and decoding over a table of distinct chunks.

The model marks white space with U+2581 and none of its pieces holds that
marker after another character (checked when the model is loaded). No merge
can therefore cross from one marked word into the next: a text's ids are the
ids of its marked words, joined. Each distinct marked word is segmented by the
library once for each table (a Python worker keeps one of bounded size), and every occurrence takes its ids from the table by position. The
table belongs to a worker, not to the corpus: joining a corpus-wide table
back would shuffle one row a word.

A model that allows longer pieces, or whose normaliser changes more than
spaces, is used on whole texts instead.

Defined results: a null or empty text has no ids and decodes to the empty
text; rows are independent, so null and repeated ids each return their row.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, pick, table
from tessera.llm.tokens import Generations, tokenizer_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CHUNK = re.compile(rb" +[^ ]*")
MAX_CHUNKS = 200_000


class ChunkTable(Generations):
    """Marked word (as UTF-8, with spaces for markers) -> its ids as int32 bytes."""

    def __init__(self, path: str):
        super().__init__(MAX_CHUNKS)
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (m.id_to_piece(i) for i in range(m.get_piece_size()))
        # the dummy prefix and plain spaces are all that the normaliser may add
        self.by_chunk = (not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
                         and m.encode(" a  b") == m.encode(" a") + m.encode(" b")
                         and m.encode("ａ é ﬁ", out_type=str) != m.encode("a é fi", out_type=str))

    def compute(self, chunk: bytes) -> bytes:
        if chunk.strip(b" "):
            # the library puts the first marker back
            ids = self.model.encode(chunk[1:].decode("utf-8", "surrogatepass"), num_threads=1)
        else:       # markers alone, at the end of a text
            ids = self.model.encode("a" + " " * len(chunk), num_threads=1)[len(self.model.encode("a")):]
        return np.array(ids, np.int32).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text, the same as ``model.encode(text)``."""
        if not text:
            return np.empty(0, np.int32)
        if not self.by_chunk:
            return np.array(self.model.encode(text, num_threads=1), np.int32)
        marked = b" " + text.encode("utf-8", "surrogatepass").replace(MARK.encode(), b" ")
        return np.frombuffer(b"".join(map(self.__getitem__, CHUNK.findall(marked))), np.int32)


_TABLES: dict[str, ChunkTable] = {}


def chunk_table(path: str) -> ChunkTable:
    """This process's table for a model file."""
    if path not in _TABLES:
        _TABLES[path] = ChunkTable(path)
    return _TABLES[path]


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  model: str | None = None) -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` for every row."""
    path = model or tokenizer_path(MODEL)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        chunks = chunk_table(path)
        ids = [chunks.encode(t.as_py()) for t in batch.column(1)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0),
             pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()),
                                      pa.array(np.concatenate([np.empty(0, np.int32), *ids]))),
             pa.array([chunks.model.decode(i.tolist()) if len(i) else "" for i in ids], pa.string())],
            names=["doc_id", "ids", "decoded"])

    return map_batches(pick(docs, doc_id=id_col, text=text_col)
                       .withColumn("doc_id", F.col("doc_id").cast("long")), run,
                       "doc_id long, ids array<int>, decoded string")


def decode_pieces(rows: DataFrame, ids_col: str = "ids", out_col: str = "decoded",
                  model: str | None = None) -> DataFrame:
    """All columns of ``rows`` and ``out_col``, the text of each row's ids (null ids: null)."""
    path = model or tokenizer_path(MODEL)

    @F.pandas_udf("string")
    def decoded(ids):
        m = chunk_table(path).model
        return ids.map(lambda i: m.decode([int(x) for x in i]) if len(i) else "", na_action="ignore")

    return rows.withColumn(out_col, decoded(F.col(f"`{ids_col}`")))


def op7_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``: counts and digests of ids and decoded texts."""
    coded = encode_pieces(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
