"""Stop lists as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default English stop list used by the registered text
# queries (function words only; callers pass their own list for other work).
DEFAULT_STOPWORDS = (
    "a", "about", "after", "all", "also", "an", "and", "any", "are", "as", "at",
    "be", "been", "but", "by", "can", "could", "did", "do", "does", "for", "from",
    "had", "has", "have", "he", "her", "him", "his", "how", "i", "if", "in",
    "into", "is", "it", "its", "me", "my", "no", "not", "of", "on", "one", "or",
    "our", "out", "she", "so", "some", "than", "that", "the", "their", "them",
    "then", "there", "these", "they", "this", "to", "up", "us", "was", "we",
    "were", "what", "when", "which", "who", "will", "with", "would", "you", "your",
)

def stopwords_df(spark: SparkSession, words=DEFAULT_STOPWORDS) -> DataFrame:
    """One-column ``(word)`` DataFrame of the given words.

    Built from literals on the JVM side (one-row range, exploded array), so
    no Python worker is started to ship the list.
    """
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(w) for w in words])).alias("word"))


def stopwords_values_sql(words=DEFAULT_STOPWORDS) -> str:
    """SQL ``VALUES`` list of the words, for oracles."""
    return ", ".join("('" + w.replace("'", "''") + "')" for w in words)
