"""Operator 8: main text of web pages by nearest-URL page differencing.

Every page is paired with the page of the same host whose URL path is nearest
(its neighbour in path order with the longer common prefix). The text lines of
both are aligned by a longest common subsequence; the shared lines are the
site's, not the page's, and are deleted. A neighbour with just the same
unmarked lines is a copy and not a sister page: then the other neighbour is
taken, and without one the page stays as it is. Two things are settled by
markup, as differencing cannot: what it names (menus, headers, footers,
sidebars, adverts, forms, comments ...) goes even when no neighbour shares
it, and lines of an ``article`` element stay even when a neighbour republishes
them. What is left outside the article, or outside ``main`` on a page without
one, belongs to the text only if it is longer than what is inside (then a short
article is a teaser); blocks keep their order on the page.

Pairing and alignment work on line hashes, a few bytes a line. Path order
comes from range partitions, so a host of any size spreads over tasks; a
table with two rows for each range partition joins the ends. Pages are joined
with the lines to delete, which few pages have; html itself is not sorted.

Defined results: a null or empty page has the empty text; a null URL is paired
with nothing; equal pages of one URL are one page for the pairing and each
return their row; a page alone on its host is left as markup has it. Extra
columns are ignored.
"""

from __future__ import annotations

import math
import os.path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, materialise, partitions_for, pick, table
from tessera.llm.html_blocks import ARTICLE, MAIN, MARKED, OTHER, blocks


def common_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Equal ends and lines of one side only are set aside first; the rest is
    aligned with one bit a line of ``b``. Every ``sqrt(len(a))``-th row is kept
    and those between are made again on the way back, so memory is about
    2 sqrt(len(a)) * len(b) bits.
    """
    shared = np.intersect1d(a, b)
    ia = np.flatnonzero(np.isin(a, shared)).tolist()
    x, y = a[ia].tolist(), b[np.isin(b, shared)].tolist()
    first = 0
    while first < min(len(x), len(y)) and x[first] == y[first]:
        first += 1
    last = 0
    while last < min(len(x), len(y)) - first and x[-1 - last] == y[-1 - last]:
        last += 1
    out = ia[:first] + (ia[len(ia) - last:] if last else [])
    x, y = x[first:len(x) - last], y[first:len(y) - last]
    if x and y:
        out += [ia[first + i] for i in _aligned(x, y)]
    return sorted(out)


def _aligned(x: list[int], y: list[int]) -> list[int]:
    """Positions in ``x`` of a longest common subsequence of ``x`` and ``y``."""
    where: dict[int, int] = {}
    for j, v in enumerate(y):
        where[v] = where.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1

    def rows_from(row: int, values: list[int]) -> list[int]:
        # bit j of row i is 0 where the subsequence of x[:i] and y[:j + 1] is one longer than that of y[:j]
        rows = [row]
        for v in values:
            u = row & where.get(v, 0)
            row = ((row + u) | (row - u)) & full
            rows.append(row)
        return rows

    step = math.isqrt(len(x)) + 1
    kept = [full]
    for at in range(0, len(x), step):
        kept.append(rows_from(kept[-1], x[at:at + step])[-1])
    out, j = [], len(y)
    length = lambda row, j: j - (row & (1 << j) - 1).bit_count()
    n = length(kept[-1], j)
    for block in reversed(range(len(kept) - 1)):
        rows = rows_from(kept[block], x[block * step:(block + 1) * step])
        for i in range(len(rows) - 1, 0, -1):
            if not n:
                return out
            if length(rows[i - 1], j) == n:
                continue
            # x[i - 1] of the block is used; go to the leftmost y that still gives n
            while rows[i] >> (j - 1) & 1:
                j -= 1
            j, n = j - 1, n - 1
            out.append(block * step + i - 1)
    return out


def _hash_lines(batch: pa.RecordBatch) -> pa.RecordBatch:
    hashes, places = [], []
    for page in batch.column(2):
        found = blocks(page.as_py())
        hashes.append([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t, _ in found])
        places.append(bytes(p for _, p in found))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.binary())],
        names=["url", "digest", "lines", "places"])


def _neighbours(light: DataFrame) -> DataFrame:
    """``light`` (host, path, url, digest, me) with the rows before and after it in that order."""
    order = ["host", "path", "url", "digest"]
    ranged = materialise(light.repartitionByRange(partitions_for(light.sparkSession), *order)
                         .withColumn("pid", F.spark_partition_id()), "ranges")
    w = Window.partitionBy("pid").orderBy(*order)
    ends = ranged.groupBy(F.col("pid").alias("p")).agg(F.min_by("me", F.struct(*order)).alias("head"),
                                                       F.max_by("me", F.struct(*order)).alias("tail"))
    along = Window.orderBy("p")         # one row a range partition
    ends = ends.select("p", F.lag("tail").over(along).alias("tail_before"),
                       F.lead("head").over(along).alias("head_after"))
    return (ranged.withColumn("before", F.lag("me").over(w)).withColumn("after", F.lead("me").over(w))
            .join(F.broadcast(ends), F.col("pid") == F.col("p"))
            .withColumn("before", F.coalesce("before", "tail_before"))
            .withColumn("after", F.coalesce("after", "head_after")))


def _deletions(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Unmarked lines outside an article that the nearest page shares, by position."""
    urls, digests, drops = [], [], []
    read = lambda page: (np.array(page["lines"], np.int64), np.frombuffer(page["places"], np.uint8))
    for url, digest, me, before, after in zip(*(c.to_pylist() for c in batch.columns)):
        near = [n for n in (before, after) if n is not None and n["host"] == me["host"]]
        near.sort(key=lambda n: -len(os.path.commonprefix([n["path"], me["path"]])))
        lines, places = read(me)
        for page in near:
            other, marks = read(page)
            if np.array_equal(lines[places != MARKED], other[marks != MARKED]):
                continue        # a copy says nothing about the site
            same = np.array(common_lines(lines, other), np.int64)
            gone = same[np.isin(places[same], (OTHER, MAIN))]
            if len(gone):
                urls.append(url), digests.append(digest), drops.append(gone.tolist())
            break
    return pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(digests, pa.binary()),
                                       pa.array(drops, pa.list_(pa.int32()))], names=["url", "digest", "gone"])


def main_text(page: str | None, gone=()) -> str:
    """Text of a page without marked blocks and without the blocks at the positions ``gone``.

    The article comes first, then ``main``, then the rest: each is taken only
    if it is longer than what is taken already.
    """
    gone = set(gone)
    found = [(t, place) for n, (t, place) in enumerate(blocks(page)) if n not in gone]
    taken, size = set(), 0
    for place in (ARTICLE, MAIN, OTHER):
        n = sum(len(t) for t, p in found if p == place)
        if n > size:
            taken.add(place)
            size += n
    return " ".join(t for t, place in found if place in taken)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    pages = pick(pages, page_id=id_col, url=url_col, html=html_col)
    pages = pages.withColumn("page_id", F.col("page_id").cast("long")).withColumn("digest", F.unhex(F.md5("html")))
    light = materialise(map_batches(pages.where("url IS NOT NULL AND html IS NOT NULL").select("url", "digest", "html"),
                                    _hash_lines, "url string, digest binary, lines array<long>, places binary"),
                        "lines")
    host = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?[^/?#]*([^?#]*)", 1)
    light = (light.dropDuplicates(["url", "digest"]).withColumn("host", host).withColumn("path", path)
             .withColumn("me", F.struct("host", "path", "lines", "places"))
             .select("host", "path", "url", "digest", "me"))
    gone = materialise(map_batches(_neighbours(light).select("url", "digest", "me", "before", "after"), _deletions,
                                   "url string, digest binary, gone array<int>"), "deletions")
    gone = gone.select(F.col("url").alias("u"), F.col("digest").alias("d"), "gone")

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page.as_py(), drop.as_py() or ()) for page, drop in zip(batch.column(2), batch.column(3))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    joined = pages.join(gone, (F.col("url") == F.col("u")) & (F.col("digest") == F.col("d")), "left")
    return map_batches(joined.select("page_id", "url", "html", "gone"), extract,
                       "page_id long, url string, text string, n_chars long")


def op8_page_text(spark, sf_dir: str) -> DataFrame:
    """All of ``pages``."""
    return extract_text(table(spark, sf_dir, "pages"))
