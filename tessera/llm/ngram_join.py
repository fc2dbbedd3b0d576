"""Operator 1: n-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when the Jaccard similarity of their sets of ``width``-word
shingles reaches ``num/den``. The stages:

1. A map over the texts gives each document's set size, a digest of its set,
   and how many block keys (``SizeClasses``) a partner must share with it.
2. Equal sets are one class, led by its smallest document.
3. Keys that two documents share are found in buckets of packed arrays; a
   document that shares fewer keys than any partner would ask for has no
   partner and leaves. Those that stay get an edge to the smallest class of
   each shared key; the connected components of these edges are the blocks,
   one size class each. Every pair that can link has a block in common.
4. In each block a T-occurrence search finds the links: an inverted index of
   the block's shingles, and for each document its short lists merged on a
   heap, its longest lists binary-probed for the survivors only (DivideSkip),
   and those that reach the overlap which the threshold asks for are links.
   A block over ``BLOCK_ROWS`` classes or ``BLOCK_SHINGLES`` shingles is cut
   into parts, and every pair of parts is a task of its own.
5. Components of the links give the class ids.

Only block members' texts are read again and shuffled: a table of at most
``MEMBER_BUCKETS`` hash buckets, which is the bound of the broadcast, lets the
other documents go before the shuffle.

Defined results: a null or blank text has the empty set (``n_shingles`` 0),
links with nothing and is its own component; a null id takes no part and gets
a null component; repeated rows with one id are equal or different sets like
any other rows, linked as one node by their id, and each returns a row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, materialise, partitions_for, pick, table
from tessera.llm.components import connected_components
from tessera.llm.shingles import SizeClasses, shingle_sets

BLOCK_ROWS = 512
BLOCK_SHINGLES = 1_000_000
MEMBER_BUCKETS = 1 << 20
POOL_KEYS = 500_000       # keys that a map task holds before it deals them out
MU = 0.0085     # DivideSkip's weight of a list's logarithm


class Index:
    """Inverted lists over a few sets: ``lists[t]`` holds ascending set numbers."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.stride = max(1, len(sets))
        sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        terms, term_of = np.unique(flat, return_inverse=True)
        self.postings = np.sort(term_of.astype(np.int64) * self.stride + owner)
        self.start = np.searchsorted(self.postings, np.arange(len(terms) + 1, dtype=np.int64) * self.stride)
        self.terms_of = np.split(term_of.astype(np.int64), np.cumsum(sizes)[:-1]) if sets else []

    def search(self, q: int, lowest: int, num: int, den: int) -> list[int]:
        """Numbers >= ``lowest`` of the sets that link with set ``q``, by DivideSkip."""
        terms, n = self.terms_of[q], len(self.sets[q])
        t = -(-num * n // den)      # least overlap with a partner of any size
        length = self.start[terms + 1] - self.start[terms]
        order = np.argsort(length, kind="stable")
        longest = int(length[order[-1]])
        n_long = min(t - 1, int(t / (MU * math.log2(longest + 1) + 1)))
        short, long = terms[order[:n - n_long]], terms[order[n - n_long:]]
        lists = []
        for x in short[length[order[:n - n_long]] > 1]:
            run = self.postings[self.start[x]:self.start[x + 1]] - x * self.stride
            run = run[np.searchsorted(run, lowest):]
            if len(run):
                lists.append(run.tolist())
        counts = [(c, k) for c, g in groupby(heapq.merge(*lists))
                  if (k := sum(1 for _ in g)) >= t - n_long and c != q]
        if not counts:
            return []
        cand, count = (np.array(x, np.int64) for x in zip(*counts))
        if n_long:
            probe = long[:, None] * self.stride + cand[None, :]
            at = np.minimum(np.searchsorted(self.postings, probe), len(self.postings) - 1)
            count = count + (self.postings[at] == probe).sum(axis=0)
        size = np.array([len(self.sets[c]) for c in cand], np.int64)
        return cand[den * count >= num * (n + size - count)].tolist()


def _links_of_block(num: int, den: int, classes: SizeClasses, width: int):
    def run(block: pa.Table) -> pa.Table:
        """Links between the two parts of a block task, as a forest and link counts.

        Two sets may be together in two blocks: their link belongs to the one
        of the larger set's class.
        """
        rows = set()
        named = zip(*(block[x].to_pylist() for x in ("part", "rep", "copies", "digest")))
        for (part, rep, copies, digest), s in zip(named, shingle_sets((x.as_py() for x in block["text"]), width)):
            if _digest(s) == digest:        # an id may have several rows: only the class's own text counts
                rows.add((part, rep, copies, s.tobytes()))
        rows = sorted(rows)
        parts = [r[0] for r in rows]
        reps, copies = [r[1] for r in rows], [r[2] for r in rows]
        index = Index([np.frombuffer(r[3], np.uint64) for r in rows])
        cross = parts[0] != parts[-1] if rows else False
        second = parts.index(parts[-1]) if cross else 0
        own_pair = block["i"][0].as_py() == block["j"][0].as_py() if rows else True
        root, links = list(range(len(rows))), [0] * len(rows)
        own_class = classes.of([len(x) for x in index.sets]) == block["c"][0].as_py()

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        # a task for two parts whose second part drew no member has nothing to compare
        todo = range(len(rows)) if own_pair else range(second)
        for q in todo:
            for c in index.search(q, q + 1 if own_pair else second, num, den):
                if not own_class[q if len(index.sets[q]) >= len(index.sets[c]) else c]:
                    continue
                links[q] += copies[c]
                links[c] += copies[q]
                a, b = find(q), find(c)
                root[max(a, b)] = min(a, b)
        out = [(reps[x], reps[find(x)], links[x]) for x in range(len(rows)) if links[x]]
        node, top, n = zip(*out) if out else ((), (), ())
        return pa.table({"node": pa.array(node, pa.int64()), "root": pa.array(top, pa.int64()),
                         "links": pa.array(n, pa.int64())})

    return run


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _shared_keys(docs: DataFrame, classes: SizeClasses, width: int) -> DataFrame:
    """``(key, owner)`` of the block keys that two or more different sets have.

    A set is known by the first 8 bytes of its digest, so copies are one
    owner. A map task packs its keys into one array a bucket, so a key costs
    about ten bytes on the way and no row. Equal sets of one pool send their
    keys once, so what copies gather is bounded by the number of pools.
    """
    buckets = partitions_for(docs.sparkSession)

    def deal(keys: list[np.ndarray], ids: list[int]) -> pa.RecordBatch:
        flat = np.concatenate(keys)
        owner = np.repeat(np.array(ids, np.int64), [len(k) for k in keys])
        bucket = (flat >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        flat, owner, rows = flat[order], owner[order], []
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[b], cuts[b + 1])
            rows.append((int(b), flat[part].tobytes(), squeeze(np.diff(owner[part], prepend=0).tobytes())))
        b, k, o = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.binary()), pa.array(o, pa.binary())],
                                          names=["bucket", "keys", "owners"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, held, seen = [], [], 0, set()
        for batch in batches:
            for s in shingle_sets((text.as_py() for text in batch.column(0)), width):
                digest = _digest(s)
                if digest in seen:
                    continue
                seen.add(digest)
                for _, _, k in classes.keys(s):
                    keys.append(k)
                    ids.append(int.from_bytes(digest[:8], "big", signed=True))
                    held += len(k)
                if held >= POOL_KEYS:
                    yield deal(keys, ids)
                    keys, ids, held, seen = [], [], 0, set()
        if held:
            yield deal(keys, ids)

    def meet(bucket: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(k.as_buffer(), np.uint64) for k in bucket["keys"].combine_chunks()])
        expand = zstandard.ZstdDecompressor().decompress
        ids = np.concatenate([np.cumsum(np.frombuffer(expand(o.as_buffer()), np.int64))
                              for o in bucket["owners"].combine_chunks()])
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        once = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))
        keys, ids = keys[once], ids[once]
        first = np.append(True, keys[1:] != keys[:-1])
        group = np.cumsum(first) - 1
        least, most = np.minimum.reduceat(ids, np.flatnonzero(first)), np.maximum.reduceat(ids, np.flatnonzero(first))
        met = (least < most)[group]
        return pa.table({"key": keys[met].view(np.int64), "owner": ids[met]})

    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("text")
    return (usable.mapInArrow(emit, "bucket int, keys binary, owners binary")
            .groupBy("bucket").applyInArrow(meet, "key long, owner long"))


def _repeated(sets: DataFrame) -> DataFrame:
    """``again``: ids that stand for more than one set."""
    several = sets.groupBy(F.col("doc_id").alias("again")).agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
    return materialise(several.where("lo < hi").select("again"), "repeated")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, n_links``.

    ``component_id`` is the smallest id reachable over links (its own if there
    is none); ``n_links`` counts the other documents that link directly,
    copies included. See the module's notes for method and edge cases.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    classes = SizeClasses(num, den)

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, needs = [], [], []
        for s in shingle_sets((text.as_py() for text in batch.column(1)), width):
            sizes.append(len(s))
            digests.append(_digest(s))
            needs.append(classes.needs(s))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.array(needs, pa.map_(pa.int32(), pa.int32()))], names=["doc_id", "n", "digest", "needs"])

    sets = materialise(map_batches(docs, describe, "doc_id long, n long, digest binary, needs map<int,int>"), "sets")

    # equal sets: one class, led by its smallest document
    some = sets.where("n > 0 AND doc_id IS NOT NULL")
    heads = some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                       F.max("n").alias("n"), F.first("needs").alias("needs"))
    heads = materialise(heads, "classes")

    shared = materialise(_shared_keys(docs, classes, width), "shared")
    cls = F.shiftrightunsigned(F.shiftleft("key", 56), 56).cast("int")
    shared = shared.withColumn("cls", cls)
    # a set has a bounded number of keys in a class: one exchange serves the count and both joins
    counts = shared.withColumn("n_shared", F.count(F.lit(1)).over(Window.partitionBy("owner", "cls")))
    asked = heads.select(F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long").alias("o"), "rep",
                         F.explode("needs").alias("c", "need"))
    staying = materialise(counts.join(asked, (F.col("owner") == F.col("o")) & (F.col("cls") == F.col("c"))
                                      & (F.col("n_shared") >= F.col("need"))).select("key", "c", "rep"), "staying")
    # a block holds sets of one size class; a node is a set in a class
    node = F.xxhash64("rep", "c")
    keyed = staying.select("key", node.alias("node"))
    hubs = (keyed.groupBy(F.col("key").alias("k")).agg(F.min("node").alias("lo"), F.max("node").alias("most"))
            .where("lo < most").select("k", "lo"))
    edges = (keyed.join(hubs, F.col("key") == F.col("k")).where("node > lo")
             .select(F.col("node").alias("hi"), "lo"))
    blocks = connected_components(edges)

    # members of blocks, with the number of parts of their block
    blocks = (blocks.select(F.col("node").alias("m"), F.col("root").alias("block"))
              .unionAll(blocks.select(F.col("root").alias("m"), F.col("root").alias("block")).distinct()))
    by_rep = heads.select(F.col("rep").alias("r"), "copies", "digest", "n")
    members = (staying.select("rep", "c", node.alias("node")).distinct()
               .join(blocks, F.col("node") == F.col("m")).join(by_rep, F.col("rep") == F.col("r"))
               .select("rep", "c", "block", "copies", "digest", "n"))
    members = materialise(members, "members")
    weight = (members.groupBy(F.col("block").alias("b"))
              .agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS),
                              F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("parts")))
    members = members.join(weight, F.col("block") == F.col("b")).drop("b")

    # their texts again: the rest goes before the shuffle
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(MEMBER_BUCKETS))
    wanted = members.select(bucket("rep").alias("bucket")).distinct()   # MEMBER_BUCKETS rows at most
    texts = docs.join(F.broadcast(wanted), bucket("doc_id") == F.col("bucket"), "left_semi")
    texts = members.join(texts, F.col("rep") == F.col("doc_id"))

    part = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("parts")).cast("int")
    tasks = (texts.withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")))
    found = (tasks.select("block", "i", "j", "part", "c", "rep", "copies", "digest", "text")
             .groupBy("block", "i", "j")
             .applyInArrow(_links_of_block(num, den, classes, width), "node long, root long, links long"))
    found = materialise(found, "links")

    # rows of one id are one node: an id is tied to the heads of all its sets
    links = found.where("node <> root").select(F.col("node").alias("hi"), F.col("root").alias("lo"))
    tied = (some.select("doc_id", "digest").join(heads.select("digest", "rep"), "digest").where("doc_id <> rep")
            .select(F.col("doc_id").alias("hi"), F.col("rep").alias("lo"))
            .join(_repeated(some), F.col("hi") == F.col("again"), "left_semi"))
    top = connected_components(links.unionAll(tied))
    n_links = found.groupBy(F.col("node").alias("l")).agg(F.sum("links").alias("links"))
    by_class = (heads.join(top, F.col("rep") == F.col("node"), "left")
                .join(n_links, F.col("rep") == F.col("l"), "left")
                .select(F.col("digest").alias("d"), F.coalesce("root", "rep").alias("root"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    usable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return (sets.select("doc_id", "n", F.when(usable, F.col("digest")).alias("digest"))
            .join(by_class, F.col("digest") == F.col("d"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("root", "doc_id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``: 3-word shingles, Jaccard >= 0.9."""
    return jaccard_join(table(spark, sf_dir, "documents"))
