"""Operator 5 (native): weak supervision over quality rules.

Each rule votes good (1), bad (-1) or abstains (0) on a text's counts. How
often a rule casts each vote on good and on bad documents is not known; an
expectation-maximisation over the votes of all documents estimates it
together with the share of good documents. The posterior probability of good
then decides, in place of "all rules must pass".

Documents with the same votes are alike to the model, so the expectation runs
over the table of vote patterns (at most ``3 ** len(RULES)`` rows) with its
counts; every iteration is one aggregation that returns one row of sums. The
texts are read once; votes and counts are a table in the checkpoint folder.
Only DataFrame functions are used.

Defined results: a null text counts as empty (all counts 0, the length rule
votes bad, the others abstain); rows are independent, so repeated and null
ids each return their row; an empty table gives no rows. Extra columns are
ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, packed, pick, table, unpacked

ITERATIONS = 12
PRIOR_WEIGHT = 0.01     # of all documents, spread over a rule's votes
BREAK = r"\x20\x09-\x0D"
MIN_WORDS, MAX_REPEAT_PCT = 50, 50

# name: (votes bad when, votes good when), over the counts, in SQL that Spark and DuckDB share
RULES = {
    "length": (f"n_words < {MIN_WORDS}", "n_words >= 100"),
    "repeats": ("100 * n_repeat_words > 30 * n_words", "n_words > 0 AND 100 * n_repeat_words <= 10 * n_words"),
    "symbols": ("100 * n_symbols > 10 * n_words", "n_words > 0 AND 100 * n_symbols <= 2 * n_words"),
    "lines": ("100 * n_dup_lines > 30 * n_lines", "n_lines > 0 AND n_dup_lines = 0"),
    "word_length": ("n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words)",
                    "n_words > 0 AND 2 * word_chars >= 7 * n_words AND word_chars <= 9 * n_words"),
    "capitals": ("100 * n_upper > 30 * word_chars", "n_words > 0 AND 100 * n_upper <= 10 * word_chars"),
    "exclaims": ("100 * n_exclaims > 10 * n_words", "n_words > 0 AND 100 * n_exclaims <= 2 * n_words"),
    "endings": ("100 * n_ended < 30 * n_lines", "n_lines > 0 AND 100 * n_ended >= 60 * n_lines"),
    "plain_words": ("100 * n_plain < 60 * n_words", "n_words > 0 AND 100 * n_plain >= 80 * n_words"),
    "marks": ("100 * n_marks > 10 * n_words", "n_words > 0 AND 100 * n_marks <= 2 * n_words"),
    "variety": ("100 * n_distinct < 15 * n_words", "n_words > 0 AND 100 * n_distinct >= 40 * n_words"),
}
VOTES = [f"v_{r}" for r in RULES]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_exclaims", "n_ended", "n_distinct", "n_plain", "n_marks")
MARKS = "[#*$%&|<>!?=~^_+-]{2,}"        # runs of signs
PLAIN = r"\p{L}+[.,;:!?]?"              # a word of letters, maybe with a mark after it


def _without(text: Column, pattern: str) -> Column:
    """Code points that the pattern matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the array ``words``."""
    n = F.size(words)
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(at, window)

    def covered(keyed: Column) -> Column:
        # neighbours in hash order are equal exactly where a window repeats
        same = lambda i, j: F.get(keyed, i)["h"] == F.get(keyed, j)["h"]
        again = F.filter(keyed, lambda k, i: F.coalesce(same(i, i - 1), F.lit(False))
                         | F.coalesce(same(i, i + 1), F.lit(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(
            again, lambda k: F.array(k["i"], k["i"] + 1, k["i"] + 2)))))

    def count(h: Column) -> Column:
        keyed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        # most texts repeat no window: one hash set tells
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            F.element_at(F.transform(F.array(keyed), covered), 1))

    return F.element_at(F.transform(F.array(hashes), count), 1)


def counted(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the columns ``COUNTS`` (long) of its column ``text``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda l: l.rlike(f"[^{BREAK}]"))
    return (df.withColumn("words", F.array_remove(F.split(t, f"[{BREAK}]+"), ""))
            .withColumn("lines", lines)
            .select(*df.columns, *[c.cast("long").alias(name) for name, c in {
                "n_words": F.size("words"),
                "word_chars": F.length(F.regexp_replace(t, f"[{BREAK}]+", "")),
                "n_symbols": _without(t, r"[#*$%&|<>]+"),
                "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
                "n_repeat_words": _repeat_words(F.col("words")),
                "n_lines": F.size("lines"),
                "n_upper": _without(t, r"\p{Lu}+"),
                "n_exclaims": _without(t, r"!+"),
                "n_ended": F.size(F.filter("lines", lambda l: l.rlike(rf'[.!?…"”»)][{BREAK}]*\z'))),
                "n_distinct": F.size(F.array_distinct("words")),
                "n_plain": F.regexp_count(t, F.lit(f"(?<![^{BREAK}]){PLAIN}(?![^{BREAK}])")),
                "n_marks": _without(t, MARKS),
            }.items()]))


def _vote(bad: str, good: str) -> str:
    return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"


def voted(df: DataFrame) -> DataFrame:
    return df.select("*", *[F.expr(f"CAST({_vote(*w)} AS tinyint)").alias(v) for v, w in zip(VOTES, RULES.values())])


BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)"
# what the first expectation starts from: a bad vote outweighs three good ones
START = " + ".join(f"(CASE {v} WHEN -1 THEN -3.0D WHEN 1 THEN 1.0D ELSE 0.0D END)" for v in VOTES)


def _weights(row, total: float) -> tuple[float, list[dict[int, float]]]:
    """Maximisation: prior log odds, and for each rule the log ratio of each vote."""
    eps = PRIOR_WEIGHT * total
    good, bad = row["good"], total - row["good"]
    out = []
    for v in VOTES:
        ratio, cells = {}, {x: (row[f"{v}_{k}_good"], row[f"{v}_{k}"]) for x, k in ((-1, "bad"), (1, "fine"))}
        cells[0] = (good - sum(c[0] for c in cells.values()), total - sum(c[1] for c in cells.values()))
        for x, (g, n) in cells.items():
            ratio[x] = (math.log((max(g, 0.0) + eps / 3) / (good + eps))
                        - math.log((max(n - g, 0.0) + eps / 3) / (bad + eps)))
        out.append(ratio)
    return math.log((good + eps / 2) / (bad + eps / 2)), out


def _log_odds(prior: float, ratios: list[dict[int, float]]) -> str:
    return " + ".join([f"{prior!r}D"] + [f"(CASE {v} WHEN -1 THEN {r[-1]!r}D WHEN 1 THEN {r[1]!r}D ELSE {r[0]!r}D END)"
                                         for v, r in zip(VOTES, ratios)])


def estimate(votes: DataFrame, iterations: int = ITERATIONS) -> str:
    """SQL expression of a document's log odds of being good, learnt from all votes."""
    patterns = materialise(votes.groupBy(*VOTES).agg(F.count(F.lit(1)).cast("double").alias("n")), "patterns")
    odds = START
    for _ in range(iterations):
        post = patterns.withColumn("g", F.expr(f"n / (1.0D + exp(-({odds})))"))
        row = post.agg(F.sum("n").alias("total"), F.sum("g").alias("good"),
                       *[F.coalesce(F.sum(F.when(F.col(v) == x, F.col(c))), F.lit(0.0)).alias(f"{v}_{k}{tail}")
                         for v in VOTES for x, k in ((-1, "bad"), (1, "fine"))
                         for c, tail in (("n", ""), ("g", "_good"))]).first()
        if not row["total"]:
            break
        odds = _log_odds(*_weights(row, row["total"]))
    return odds


def _verdict(df: DataFrame, odds: str) -> DataFrame:
    return (df.withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("quality", F.expr(f"1.0D / (1.0D + exp(-({odds})))"))
            .withColumn("kept", F.expr("NOT base_failed AND quality >= 0.5D")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, votes, ``base_failed``, posterior ``quality`` and ``kept`` for every row."""
    docs = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    votes = materialise(voted(counted(docs, "text")).drop("text"), "votes")
    return _verdict(votes, estimate(votes))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns."""
    votes = materialise(voted(counted(packed(docs, text=text_col), "text")).drop("text"), "votes")
    return unpacked(_verdict(votes, estimate(votes)).where("kept"), docs)


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    """DuckDB SQL: the same counts and votes, and one pair of CTEs for each iteration."""
    plain = lambda sql: sql.replace("0D", "0").replace("5D", "5")  # noqa: E731  no D after Spark's doubles
    votes = ", ".join(VOTES)
    eps = f"({PRIOR_WEIGHT} * total)"
    ctes = [f"""
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT r, unnest(x) AS word, generate_subscripts(x, 1) AS i
  FROM (SELECT r, regexp_extract_all(t, '[^{BREAK}]+') AS x FROM docs)),
win AS MATERIALIZED (SELECT r, i, word || chr(10) || lead(word, 1) OVER (PARTITION BY r ORDER BY i) || chr(10)
    || lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS x FROM w),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM win WHERE x IS NOT NULL) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) o(k) GROUP BY r),
wc AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, count(DISTINCT word) AS n_distinct,
    count(*) FILTER (regexp_full_match(word, '{PLAIN}')) AS n_plain FROM w GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs),
lc AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (regexp_matches(line, '[.!?…"”»)][{BREAK}]*\\z')) AS n_ended
  FROM l WHERE regexp_matches(line, '[^{BREAK}]') GROUP BY r),
c AS MATERIALIZED (SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')) AS n_upper,
    length(t) - length(regexp_replace(t, '!+', '', 'g')) AS n_exclaims,
    coalesce(n_ended, 0) AS n_ended, coalesce(n_distinct, 0) AS n_distinct, coalesce(n_plain, 0) AS n_plain,
    length(t) - length(regexp_replace(t, '{MARKS}', '', 'g')) AS n_marks
  FROM docs LEFT JOIN wc USING (r) LEFT JOIN rep USING (r) LEFT JOIN lc USING (r)),
v AS MATERIALIZED (SELECT *, {', '.join(f'{_vote(*w)} AS {v}' for v, w in zip(VOTES, RULES.values()))} FROM c),
p AS MATERIALIZED (SELECT {votes}, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY ALL)"""]
    odds, source = plain(START), "p"
    for k in range(ITERATIONS):
        sums = ", ".join(
            f"coalesce(sum({c}) FILTER ({v} = {x}), 0.0) AS {v}_{name}{tail}" for v in VOTES
            for x, name in ((-1, "bad"), (1, "fine")) for c, tail in (("n", ""), ("g", "_good")))
        ctes.append(f"s{k} AS MATERIALIZED (SELECT sum(n) AS total, sum(g) AS good, {sums} FROM "
                    f"(SELECT *, n / (1.0 + exp(-({odds}))) AS g FROM {source}))")
        cells = []
        for v in VOTES:
            for name, g, n in (("bad", f"{v}_bad_good", f"{v}_bad"), ("fine", f"{v}_fine_good", f"{v}_fine"),
                               ("none", f"good - {v}_bad_good - {v}_fine_good", f"total - {v}_bad - {v}_fine")):
                cells.append(f"ln((greatest({g}, 0.0) + {eps} / 3) / (good + {eps})) - "
                             f"ln((greatest(({n}) - ({g}), 0.0) + {eps} / 3) / (total - good + {eps})) AS w_{v}_{name}")
        ctes.append(f"q{k} AS MATERIALIZED (SELECT ln((good + {eps} / 2) / (total - good + {eps} / 2)) AS prior, "
                    f"{', '.join(cells)} FROM s{k})")
        odds = "prior + " + " + ".join(
            f"(CASE {v} WHEN -1 THEN w_{v}_bad WHEN 1 THEN w_{v}_fine ELSE w_{v}_none END)" for v in VOTES)
        source = f"p, q{k}"
    return (f"WITH {', '.join(ctes)} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, "
            f"{BASE_FAILED} AS base_failed, NOT {BASE_FAILED} AND 1.0 / (1.0 + exp(-({odds}))) >= 0.5 AS kept "
            f"FROM v, q{ITERATIONS - 1}")


ORACLE = _oracle()
