"""Operator 10: cost-balanced packing of documents into training sequences.

A piece of ``n`` tokens costs ``n + n^2 / quadratic`` (linear layers plus
attention inside the piece). Documents wait in a pool of up to ``pool``
tokens; the pool's tokens fix its sequences: as many full ones as fit, and
for what is left of a partition's last pool sequences of powers of two, which
need no padding. Documents longer than a sequence give full pieces first.
Then, in descending cost, each piece goes to the sequence of the lowest cost
that still holds it; where none does, it is cut over the lowest-cost
sequences with room. Every token gets a place, so no sequence is padded.

Nothing is shuffled: a pool is a run of a partition's rows, so memory is the
pool's ids plus one document's. Sequence ids hold the partition number in
their upper bits, are unique, and come out the same when a task runs again.

Defined results: a null or empty text is one token (the end id); rows with a
null or repeated id are documents of their own; no rows give no sequences.
Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pick, table
from tessera.llm.tokens import END_ID, id_bytes, tokenizer_path, word_table

POOL = 1 << 21          # tokens
QUADRATIC = 4096        # length at which attention costs as much as the rest
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def capacities(tokens: int, length: int, last: bool) -> list[int]:
    """Sequences for a pool: full ones, and powers of two for the rest of a last pool."""
    sizes = [length] * (tokens // length)
    rest, bit = tokens % length if last else 0, 1
    while rest >> bit.bit_length() - 1:
        if rest & bit:
            sizes.append(bit)
        bit <<= 1
    return sorted(sizes, reverse=True)


def assign(lengths: list[int], sizes: list[int],
           quadratic: int = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of the pieces placed.

    ``lengths`` are documents' tokens and ``sizes`` the sequences' capacities,
    largest first. What finds no room is always a document's tail. Ties go to
    the earlier document and the earlier sequence.
    """
    out: list[tuple[int, int, int, int, int]] = []
    room = np.array(sizes, np.int64)
    cost = np.zeros(len(sizes))
    longest = max(sizes, default=0)
    pieces, taken = [], 0
    for d, n in enumerate(lengths):
        start = 0
        while longest and n - start >= longest and taken < len(sizes) and sizes[taken] == longest:
            out.append((d, start, longest, taken, 0))
            room[taken] = 0
            taken, start = taken + 1, start + longest
        if n > start:
            pieces.append((start - n, d, start))
    pieces.sort()       # longest first, which is the highest cost first
    for negative, d, start in pieces:
        left = -negative
        if (room >= left).any():
            order = [int(np.argmin(np.where(room >= left, cost, np.inf)))]
        else:           # no sequence holds it whole: cut it, lowest costs first
            order = [int(s) for s in np.argsort(cost, kind="stable") if room[s]]
        for s in order:
            n = min(left, int(room[s]))
            out.append((d, start, n, s, sizes[s] - int(room[s])))
            room[s] -= n
            cost[s] += n + n * n / quadratic
            start, left = start + n, left - n
            if not left:
                break
    return out


class _Packer:
    """One partition's pool of documents and its sequence numbers."""

    def __init__(self, length: int, pool: int, first_id: int):
        self.length, self.pool, self.next_id = length, pool, first_id
        self.items: list[tuple[int | None, int, bytes, int]] = []   # id, tokens before, ids, document's tokens
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.items.append((doc_id, 0, ids, len(ids) // 4))
        self.tokens += len(ids) // 4

    def pack(self, last: bool) -> pa.RecordBatch:
        """Rows of the pool's pieces; what a pool that is not the last leaves over stays in it."""
        sizes = capacities(self.tokens, self.length, last)
        placed = assign([len(ids) // 4 for _, _, ids, _ in self.items], sizes)
        done = [0] * len(self.items)
        rows = []
        for d, start, n, s, offset in placed:
            doc_id, before, ids, total = self.items[d]
            rows.append((doc_id, before + start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), total,
                         self.next_id + s, offset))
            done[d] += n
        self.next_id += len(sizes)
        self.items = [(i, before + n, ids[4 * n:], total)
                      for (i, before, ids, total), n in zip(self.items, done) if 4 * n < len(ids)]
        self.tokens = sum(len(ids) // 4 for _, _, ids, _ in self.items)
        columns = list(zip(*rows)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          names=[f.split()[0] for f in SCHEMA.split(", ")])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 4096,
         pool: int = POOL, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(path)
        packer = _Packer(length, pool, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                packer.add(doc_id.as_py(), id_bytes(text.as_py(), words, end_id))
                if packer.tokens >= pool:
                    yield packer.pack(last=False)
        yield packer.pack(last=True)

    return (pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
            .mapInArrow(run, SCHEMA))


def op10_cost_balanced_packing(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` into sequences of at most 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"))
