"""Operator 13: ranked lexical search by branch-and-bound over document FP-trees.

Documents are cut down to the terms that any query item asks for, each as a
vector of (term, tf) with the document's m. The terms of a vector stand in
descending document frequency, so vectors that begin alike share a path of an
FP-tree. Vectors are dealt to tasks by ranges of these paths, so each task
holds neighbouring subtrees; a task builds the tree of ``BLOCK_DOCS`` vectors
at a time. A node is a run of documents that share a path; it knows for each
term the largest tf and the smallest m below it. As a score grows with tf and
falls with m, they bound every score below. For each item the tree is searched
depth first, best bound first; a subtree whose bound cannot reach the item's
k-th score is left out, and the documents of a leaf are scored. The k best of
an item so far carry over to the task's next block; a window merges the tasks'
lists, at most k rows an item and task.

Items are taken in chunks of at most ``ITEM_TERMS`` different terms (an item
with more is a chunk of its own), so what is sent to the workers is bounded by
one chunk; documents are read once for each chunk. Statistics (N, L, df) are
over all documents.

Scores are 64-bit integers. ``w = floor(1000 ln((2N+2) / (2df+1)))`` is never
below 0, as df is at most N, so bounds add up; ``m = 100 - 90 + (90 n N) div L``,
by which long documents lose.

Defined results: a null or empty text has no terms, counts in no statistic and
is found by no item; a document with a null id counts in the statistics but is
not ranked; rows that repeat an id are ranked each; equal scores go by
ascending id; items with a null id or without terms find nothing; a repeated
item id asks once, with its smallest text; no documents or no items give no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, materialise, partitions_for, pick, table

ITEM_TERMS = 100_000        # different terms of the items asked at the same time
BLOCK_DOCS = 8_192          # documents of one tree
LEAF_DOCS = 64              # documents below which a subtree is scored whole
RANGE_TERMS = 8             # terms of a path by which vectors are dealt to tasks
SCALE = 1_000_000_000

# a term is a run of digits, ASCII letters (in lower case) and characters from U+0080 on
_TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_TERMS).split() if text else []


# ------------------------------------------------------------------ restricted vectors

def item_chunks(items: DataFrame) -> list[dict[int, list[bytes]]]:
    """Item id -> its distinct terms, in chunks of bounded vocabulary.

    ``items`` is the stated query set; its ids and terms pass the driver, one
    item at a time.
    """
    one = items.where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("text").alias("text"))

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([sorted(set(terms_of(t.as_py()))) for t in batch.column(1)],
                                       pa.list_(pa.binary()))], names=["item_id", "terms"])

    chunks: list[dict[int, list[bytes]]] = []
    known: set[bytes] = set()
    for row in map_batches(one, split, "item_id long, terms array<binary>").toLocalIterator():
        terms = [bytes(t) for t in row["terms"]]
        if not terms:
            continue
        if not chunks or len(known) + len(terms) > ITEM_TERMS:
            chunks.append({})
            known = set()
        chunks[-1][row["item_id"]] = terms
        known.update(terms)
    return chunks


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[DataFrame, int, int]:
    """``doc_id, n, terms array<int>, tfs array<long>`` of the documents with a term of the vocabulary; N and L."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)      # at most ITEM_TERMS terms, or one item's

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = known.value
        n, terms, tfs = [], [], []
        for text in batch.column(1):
            words = terms_of(text.as_py())
            n.append(len(words))
            found = Counter(map(ids.get, words))
            found.pop(None, None)
            terms.append(list(found))
            tfs.append(list(found.values()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
             pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    seen = Observation()
    all_rows = map_batches(docs, count, "doc_id long, n long, terms array<int>, tfs array<long>").observe(
        seen, F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"))
    vectors = materialise(all_rows.where(F.size("terms") > 0), "vectors")
    return vectors, seen.get["docs"] or 0, seen.get["terms"] or 0


# ------------------------------------------------------------------ tree

def contributions(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``(10^9 tf) div (1000 tf + 8 m)``, 0 where tf is 0."""
    return SCALE * tf // (1000 * tf + 8 * m)


class Tree:
    """FP-tree of some documents, given in the order of their paths.

    ``path`` / ``tf`` / ``start``: the vectors one after another, terms by rank
    (0: the most frequent). Nodes lie in lists: ``span`` (run of documents),
    ``below`` (children, none for a leaf), ``least_m``, and ``most_tf`` (rows
    of a node, columns of ``terms``). ``leaf`` has a dense terms x documents
    array of each leaf.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, start: np.ndarray, path: np.ndarray, tf: np.ndarray):
        self.ids, self.m, self.start, self.path, self.tf = ids, m, start, path, tf
        self.terms = np.unique(path)
        self.place = np.searchsorted(self.terms, path)
        self.span: list[tuple[int, int]] = []
        self.below: list[list[int]] = []
        self.least_m: list[int] = []
        self.leaf: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rows: list[np.ndarray | None] = []
        # children are made before their parents' maxima are taken, so nodes are finished in reverse
        waiting = [(0, len(ids), 0, -1)]
        while waiting:
            lo, hi, depth, parent = waiting.pop()
            node = len(self.span)
            self.span.append((lo, hi))
            self.below.append([])
            self.least_m.append(int(m[lo:hi].min()))
            rows.append(None)
            if parent >= 0:
                self.below[parent].append(node)
            if hi - lo > LEAF_DOCS:
                waiting += [(a, b, d, node) for a, b, d in self._children(lo, hi, depth)]
            else:
                a, b = start[lo], start[hi]
                terms, at = np.unique(self.place[a:b], return_inverse=True)
                dense = np.zeros((len(terms), hi - lo), np.int64)
                dense[at, np.repeat(np.arange(hi - lo), np.diff(start[lo:hi + 1]))] = tf[a:b]
                self.leaf[node] = (terms, dense)
        for node in reversed(range(len(self.span))):
            row = np.zeros(len(self.terms), np.int64)
            if node in self.leaf:
                terms, dense = self.leaf[node]
                row[terms] = dense.max(axis=1, initial=0)
            else:
                for child in self.below[node]:
                    np.maximum(row, rows[child], out=row)
            rows[node] = row
        self.most_tf = np.array(rows)
        self.least_m = np.array(self.least_m)

    def _children(self, lo: int, hi: int, depth: int) -> list[tuple[int, int, int]]:
        """``(lo, hi, depth)`` of the subtrees below a path; small neighbours share one."""
        while True:
            at = self.start[lo:hi] + depth
            there = at < self.start[lo + 1:hi + 1]
            if not there.any():         # equal paths: no term is left to branch on
                return [(a, min(a + LEAF_DOCS, hi), depth) for a in range(lo, hi, LEAF_DOCS)]
            term = np.where(there, self.path[np.minimum(at, len(self.path) - 1)], -1)
            cuts = lo + np.flatnonzero(np.diff(term)) + 1
            if len(cuts):
                break
            depth += 1
        out: list[tuple[int, int, int]] = []
        for a, b in zip([lo, *cuts.tolist()], [*cuts.tolist(), hi]):
            if out and b - out[-1][0] <= LEAF_DOCS:
                out[-1] = (out[-1][0], b, depth)
            else:
                out.append((a, b, depth + 1))
        return out

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best of ``best`` and this tree as ``(-score, doc_id)``, in order."""
        at = np.searchsorted(self.terms, terms)
        known = (at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)
        column, weight = at[known], weights[known]
        if not len(column):
            return best

        def bounds(nodes: list[int]) -> list[int]:
            tf = self.most_tf[np.ix_(nodes, column)]
            return (contributions(tf, self.least_m[nodes][:, None]) @ weight).tolist()

        waiting = list(zip(bounds([0]), [0]))
        while waiting:
            bound, node = waiting.pop()
            # a tie with the k-th may still win by its id
            if bound <= 0 or (len(best) == k and bound < -best[-1][0]):
                continue
            if node not in self.leaf:
                waiting += sorted(zip(bounds(self.below[node]), self.below[node]))
                continue
            lo, hi = self.span[node]
            have, dense = self.leaf[node]
            row = np.searchsorted(have, column)
            row_known = (row < len(have)) & (have[np.minimum(row, len(have) - 1)] == column)
            score = weight[row_known] @ contributions(dense[row[row_known]], self.m[lo:hi][None, :])
            reach = np.flatnonzero(score > 0 if len(best) < k else score >= max(1, -best[-1][0]))
            if len(reach):
                best = sorted(best + list(zip((-score[reach]).tolist(), self.ids[lo:hi][reach].tolist())))[:k]
        return best


# ------------------------------------------------------------------ search

def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy()


def _search_chunk(docs: DataFrame, items: dict[int, list[bytes]], k: int) -> DataFrame:
    """``item_id, doc_id, score``: at most k rows of each item and task."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in items.values() for t in terms}))}
    vectors, n_docs, n_terms = restricted_vectors(docs, vocabulary)
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[term] = count
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    weight = np.zeros(len(df), np.int64)        # by rank
    weight[rank] = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    asked = [(i, np.sort(rank[[vocabulary[t] for t in terms]])) for i, terms in sorted(items.items())]

    def ranked(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Vectors with their terms as ranks in ascending order, and m."""
        start, terms = _lists(batch.column(2))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(start))
        order = np.lexsort((rank[terms], owner))
        tfs = _lists(batch.column(3))[1]
        offsets = pa.array(start, pa.int32())
        m = [10 + 90 * n * n_docs // n_terms for n in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(m, pa.int64()),
             pa.ListArray.from_arrays(offsets, pa.array(rank[terms][order].astype(np.int32))),
             pa.ListArray.from_arrays(offsets, pa.array(tfs[order]))], names=["doc_id", "m", "path", "tfs"])

    paths = map_batches(vectors.where("doc_id IS NOT NULL"), ranked, "doc_id long, m long, path array<int>, tfs array<long>")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        held: list[pa.RecordBatch] = []

        def run():
            t = pa.Table.from_batches(held).combine_chunks()
            start, path = _lists(t["path"].chunk(0))
            tree = Tree(t["doc_id"].to_numpy(), t["m"].to_numpy(), start, path, _lists(t["tfs"].chunk(0))[1])
            for i, (_, terms) in enumerate(asked):
                best[i] = tree.search(terms, weight[terms], k, best[i])
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                if sum(b.num_rows for b in held) + part.num_rows > BLOCK_DOCS:
                    run()
                held.append(part)
        if held:
            run()
        rows = [(item, doc, -score) for (item, _), found in zip(asked, best) for score, doc in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)],
                                         names=["item_id", "doc_id", "score"])

    spark = docs.sparkSession
    # ranges by the beginnings of the paths: their bounds are sampled on the driver
    dealt = (paths.repartitionByRange(partitions_for(spark), F.slice("path", 1, RANGE_TERMS), "doc_id")
             .sortWithinPartitions("path"))
    return dealt.mapInArrow(search, "item_id long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for chunk in item_chunks(pick(items, item_id=item_col, text=item_text_col)
                             .withColumn("item_id", F.col("item_id").cast("long"))):
        found = found.unionAll(_search_chunk(d, chunk, k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` for every ``benchmark`` item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n, sum(len(t)) AS l FROM d WHERE len(t) > 0),
v AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, count(*) AS df FROM v GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id)),
m AS (SELECT d.r, d.doc_id, CAST(10 + (90 * len(d.t) * s.n) // s.l AS BIGINT) AS m FROM d, s WHERE len(d.t) > 0),
w AS (SELECT f.term, CAST(floor(1000 * ln(CAST(2 * s.n + 2 AS DOUBLE) / (2 * f.df + 1))) AS BIGINT) AS w FROM f, s),
p AS (SELECT q.item_id, m.doc_id, m.r,
    CAST(sum(w.w * ((1000000000 * v.tf) // (1000 * v.tf + 8 * m.m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN v USING (term) JOIN m USING (r) WHERE m.doc_id IS NOT NULL
  GROUP BY q.item_id, m.doc_id, m.r),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""
