"""Text operators: tokenise, count, stop-word removal, common words, top-k.

All operators are lazy DataFrame transformations. Counting relies on Spark's
partial (map-side) aggregation, so a very frequent word (say a third of all
tokens) is pre-combined inside every map task before the shuffle and never
lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import tokens

WORD = "word"
COUNT = "count"


def tokenize(lines: DataFrame, text_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token: ``(*keep, word)``. Empty tokens are never emitted."""
    return lines.select(*keep, F.explode(tokens(text_col)).alias(WORD))


def count_words(words: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, word, count bigint)`` -- count per distinct word."""
    return words.groupBy(*by, WORD).agg(F.count(F.lit(1)).alias(COUNT))


def word_count(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Word count over a corpus of text lines: ``(word, count)``."""
    return count_words(tokenize(lines, text_col))


def normalize_stopwords(stop: DataFrame, col: str | None = None) -> DataFrame:
    """Lower-case a one-column stop list -> ``(word)``.

    Not de-duplicated: repeated keys cannot change the anti join it feeds,
    and skipping ``distinct`` saves a shuffle (``read_stopwords`` returns the
    de-duplicated list when the list itself is wanted).
    """
    c = col or stop.columns[0]
    return stop.select(F.lower(F.col(c)).alias(WORD)).where(F.col(WORD).isNotNull())


def remove_stopwords(words: DataFrame, stop: DataFrame) -> DataFrame:
    """Drop tokens found in the (lower-cased) stop list.

    The comparison is case-sensitive: the list is lower-cased, tokens are not,
    so ``The`` survives a list containing ``the``. A list of any size will do:
    the planner broadcasts a small one and shuffles both sides for a large one.
    """
    return words.join(stop.select(WORD), on=WORD, how="left_anti")


def common_words(counts_a: DataFrame, counts_b: DataFrame) -> DataFrame:
    """Words present in both corpora, scored by the larger of the two counts.

    Inner equi-join on ``word`` (vocabulary intersection) + ``greatest``.
    Each side has one row per word, so the join key is unique per side.
    """
    a = counts_a.select(WORD, F.col(COUNT).alias("_count_a"))
    b = counts_b.select(WORD, F.col(COUNT).alias("_count_b"))
    return a.join(b, on=WORD, how="inner").select(
        WORD, F.greatest("_count_a", "_count_b").alias(COUNT))


def tag_side(df: DataFrame, side: str) -> DataFrame:
    """Attach a literal source tag ``side`` to every row."""
    return df.withColumn("side", F.lit(side))


def tagged_union(counts_a: DataFrame, counts_b: DataFrame,
                 tags: tuple[str, str] = ("f1", "f2")) -> DataFrame:
    """Union of two ``(word, count)`` inputs with a ``side`` tag each."""
    return tag_side(counts_a.select(WORD, COUNT), tags[0]).unionByName(
        tag_side(counts_b.select(WORD, COUNT), tags[1]))


def common_words_tagged(tagged: DataFrame, min_sides: int = 2) -> DataFrame:
    """Grouped form of ``common_words`` over a tagged union.

    Per word: number of contributing sides and maximum count; keep words
    contributed by at least ``min_sides`` sides (a HAVING threshold).
    """
    g = tagged.groupBy(WORD).agg(
        F.countDistinct("side").alias("_sides"), F.max(COUNT).alias(COUNT))
    return g.where(F.col("_sides") >= min_sides).select(WORD, COUNT)


def side_counts(words: DataFrame, side_col: str, sides: tuple[str, str]) -> DataFrame:
    """``(word, count_a, count_b)``: per-word counts in two tagged corpora.

    One aggregation over a single tagged token stream (one shuffle on
    ``word``) instead of two per-corpus counts plus a join.
    """
    a, b = sides
    return words.where(F.col(side_col).isin(a, b)).groupBy(WORD).agg(
        F.count(F.when(F.col(side_col) == a, 1)).alias("count_a"),
        F.count(F.when(F.col(side_col) == b, 1)).alias("count_b"))


def common_from_side_counts(sc: DataFrame) -> DataFrame:
    """Words counted in both sides, scored by the larger count."""
    return sc.where((F.col("count_a") > 0) & (F.col("count_b") > 0)).select(
        WORD, F.greatest("count_a", "count_b").alias(COUNT))


def top_k(scored: DataFrame, k: int = 20, score: str = COUNT, key: str = WORD) -> DataFrame:
    """First ``k`` rows by ``score`` descending, ties by ``key`` descending.

    The cut is exact at ``k`` even inside a tie. Plans as
    ``TakeOrderedAndProject``: each partition keeps its own top ``k`` and only
    those rows are merged, so no global sort or single reducer is needed.
    """
    return scored.orderBy(F.col(score).desc(), F.col(key).desc()).limit(k)


def topk_common_words(lines_a: DataFrame, lines_b: DataFrame, stop: DataFrame,
                      k: int = 20, text_col: str = "value") -> DataFrame:
    """The two-corpus job: tokenise, drop stop words, count, intersect, top-k.

    Both corpora are tagged and unioned, so counting and intersecting take a
    single aggregation on ``word``.
    """
    stop = normalize_stopwords(stop)
    tagged = tokenize(lines_a.select(text_col, F.lit("a").alias("_side")), text_col, ("_side",)) \
        .unionByName(tokenize(lines_b.select(text_col, F.lit("b").alias("_side")), text_col, ("_side",)))
    kept = remove_stopwords(tagged, stop)
    return top_k(common_from_side_counts(side_counts(kept, "_side", ("a", "b"))), k)


def topk_common_words_by(lines: DataFrame, side_col: str, sides: tuple[str, str],
                         stop: DataFrame, k: int = 20, text_col: str = "value") -> DataFrame:
    """Same job when both corpora live in one table, told apart by ``side_col``.

    One scan (the side filter is pushed into it), one aggregation, one
    top-k.
    """
    stop = normalize_stopwords(stop)
    toks = tokenize(lines.where(F.col(side_col).isin(*sides)), text_col, (side_col,))
    kept = remove_stopwords(toks, stop)
    return top_k(common_from_side_counts(side_counts(kept, side_col, sides)), k)
