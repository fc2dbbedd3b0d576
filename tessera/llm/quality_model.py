"""Operator 3: quality classifier, a sparse rule ensemble compiled to columns.

1. Statistics of the whole text, as Spark column expressions (``STATS``).
2. Boosted shallow trees are grown on a bounded sample of labelled rows; each
   path from a root to a node is a conjunctive rule over the statistics.
3. A logistic model with a lasso penalty weighs the rules; most weights are 0.
4. The rules that are left become one column expression, so every row is
   scored inside Spark without Python.

``max_train`` (documented bound) labelled rows of smallest id hash are used
for fitting; the rows whose ``crc32(doc_id as text) mod folds`` is 0 are never
among them. Only the text is an input of a score.

Defined results: a null text scores as the empty text, whose statistics are
all 0; labels that are null or not 0/1 are ignored; an id with several labels
or rows gives a training row for each pair; without both labels to learn from
every score is the smoothed share of label 1 (0.5 without labels); a null id
counts as the empty text in the fold, so it is held out. An empty table gives
no rows. Extra columns are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import packed, pick, table, unpacked

MAX_TRAIN = 6000
FOLDS = 5
TREES, DEPTH, SHRINK, BINS, LEAF = 40, 3, 0.3, 24, 10
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)
CUT = 0.3

Rule = tuple[tuple[int, bool, float], ...]      # (statistic, is greater, threshold), all must hold


def _chars(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _stats(text: Column) -> Column:
    """Statistics (doubles) of a text column, as one struct.

    The words are counted once, and signs are looked for in what is left
    without letters, which are most of a text. Both are bound as the variable of a
    lambda, so that no statistic works them out again.
    """
    t = F.coalesce(text, F.lit(""))
    words = F.regexp_count(t, F.lit(r"\S+"))
    shared = F.array(F.struct(t.alias("t"), words.alias("words"),
                              F.regexp_replace(t, r"[\p{L}\p{M}]+", "").alias("rest")))

    def each(x: Column) -> Column:
        t, words, rest = x["t"], x["words"], x["rest"]
        n, w = F.greatest(F.length(t), F.lit(1)), F.greatest(words, F.lit(1))
        return F.struct(*[c.cast("double").alias(k) for k, c in {
            "log_chars": F.log1p(F.length(t).cast("double")),
            "log_words": F.log1p(words.cast("double")),
            "chars_a_word": F.length(t) / w,
            "signs": _chars(rest, r"[#*$%&<>~^=_+]+") / w,
            "pipes": _chars(rest, r"\|+") / w,
            "exclaims": _chars(rest, r"[!?]+") / w,
            "capitals": _chars(t, r"\p{Lu}+") / n,
            "digits": _chars(rest, r"[0-9]+") / n,
            "stops": _chars(rest, r"[.,;:]+") / w,
            "lines": _chars(rest, r"\n+") / w,
            "echoes": F.regexp_count(t, F.lit(r"(?<!\S)(\S++)(?=\s++\1(?!\S))")) / w,
            "letters": (F.length(t) - F.length(rest)) / n,
        }.items()])

    return F.element_at(F.transform(shared, each), 1)


STATS = ("log_chars", "log_words", "chars_a_word", "signs", "pipes", "exclaims", "capitals", "digits", "stops",
         "lines", "echoes", "letters")


# ------------------------------------------------------------------ fitting

def _grow(x: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, hessian: np.ndarray, rows: np.ndarray,
          depth: int, path: Rule, rules: list[Rule], step: np.ndarray) -> None:
    """Split ``rows`` for the largest gain; add every node's path to ``rules`` and leaf steps to ``step``."""
    if path:
        rules.append(path)
    best = None
    g, h = residual[rows], hessian[rows]
    whole = g.sum() ** 2 / (h.sum() + 1)
    if depth:
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            at = np.searchsorted(edges, x[rows, f], side="left")        # x <= edges[b] exactly for at <= b
            gs, hs, ns = (np.cumsum(np.bincount(at, v, len(edges) + 1))[:-1] for v in (g, h, np.ones(len(rows))))
            gain = gs ** 2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
            gain[(ns < LEAF) | (len(rows) - ns < LEAF)] = -1
            b = int(np.argmax(gain))
            if gain[b] > 1e-6 and (best is None or gain[b] > best[0]):
                best = (gain[b], f, float(edges[b]))
    if best is None:
        step[rows] += SHRINK * g.sum() / (h.sum() + 1)
        return
    _, f, cut = best
    right = x[rows, f] > cut
    for side, part in ((False, rows[~right]), (True, rows[right])):
        _grow(x, cuts, residual, hessian, part, depth - 1, (*path, (f, side, cut)), rules, step)


def simplify(path: Rule) -> Rule:
    """One bound for each statistic and direction, in a fixed order."""
    tight: dict[tuple[int, bool], float] = {}
    for f, greater, cut in path:
        key = (f, greater)
        tight[key] = cut if key not in tight else (max if greater else min)(cut, tight[key])
    return tuple((f, greater, cut) for (f, greater), cut in sorted(tight.items()))


def tree_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list[Rule]:
    """Distinct rules of boosted trees, each grown on a random half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        middle = (values[:-1] + values[1:]) / 2
        cuts.append(np.unique(np.quantile(middle, np.linspace(0, 1, BINS))) if len(middle) else middle)
    rules: list[Rule] = []
    z = np.zeros(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        half = np.sort(rng.choice(len(y), max(1, len(y) // 2), replace=False))
        step, found = np.zeros(len(y)), []
        _grow(x, cuts, y - p, p * (1 - p), half, DEPTH, (), found, step)
        rules += found
        z += step
    return list(dict.fromkeys(simplify(r) for r in rules))


def rule_matrix(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for f, greater, cut in rule:
            out[:, j] *= x[:, f] > cut if greater else x[:, f] <= cut
    return out


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights, by accelerated proximal gradient steps."""
    n = len(y)
    a = np.hstack([np.ones((n, 1)), r])
    rate = 4 * n / max(np.linalg.norm(a, 2) ** 2, 1e-9)
    w = v = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        grad = a.T @ (1 / (1 + np.exp(-np.clip(a @ v, -60, 60))) - y) / n
        new = v - rate * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[0]), w[1:]


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(y > 0, -z, z)))) if len(y) else 0.0


@dataclass
class RuleModel:
    """Intercept and weighted rules; ``score(text)`` is their column expression."""

    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self, text: Column) -> Column:
        """Probability of label 1, a double from 0 to 1.

        The statistics are bound once, as the variable of a lambda over a one
        element array, however many rules use them and wherever the optimizer
        moves the expression.
        """
        stats = F.array(_stats(text))

        def odds(s: Column) -> Column:
            z = F.lit(self.intercept)
            for rule, weight in self.rules:
                holds = F.lit(True)
                for f, greater, cut in rule:
                    v = s[STATS[f]]
                    holds = holds & (v > F.lit(cut) if greater else v <= F.lit(cut))
                z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

        return F.element_at(F.transform(stats, odds), 1)


def fit_rows(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Rules and weights from statistics and labels; the penalty is chosen on every fourth row."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    check = np.arange(len(y)) % 4 == 0
    if y[~check].min() == y[~check].max():
        check[:] = False
    rules = tree_rules(x[~check], y[~check])
    r = rule_matrix(x, rules)
    losses = []
    for penalty in PENALTIES:
        b, w = lasso_logistic(r[~check], y[~check], penalty)
        losses.append(log_loss(b + r[check] @ w, y[check]))
    # the strongest penalty that is about as good as the best
    chosen = next(p for p, l in zip(PENALTIES, losses) if l <= 1.1 * min(losses) + 0.001)
    b, w = lasso_logistic(r, y, chosen)
    return RuleModel(b, [(rule, float(c)) for rule, c in zip(rules, w) if abs(c) > 1e-6])


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, folds: int = FOLDS) -> RuleModel:
    """Fit on at most ``max_train`` labelled rows outside the held-out fold.

    ``docs`` has ``doc_id, text``; ``labels`` has ``doc_id, quality``. The
    sample is a bounded number of ids, which is what is broadcast, so only the
    texts asked for are touched; their statistics come to the driver.
    """
    chosen = (pick(labels, label_id="doc_id", quality="quality")
              .where(F.col("quality").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out(F.col("label_id"), folds))
              .orderBy(F.xxhash64("label_id"), "label_id", "quality").limit(max_train))
    docs = pick(docs, doc_id="doc_id", text="text")
    rows = (docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
            .select("doc_id", F.col("quality").cast("double").alias("quality"),
                    F.xxhash64("text").alias("h"), _stats(F.col("text")).alias("s")).select("doc_id", "quality", "h", "s.*")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "h", "quality").limit(max_train).toPandas())
    return fit_rows(rows[list(STATS)].to_numpy(float).reshape(-1, len(STATS)), rows["quality"].to_numpy(float))


def score(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text",
          cut: float = CUT, folds: int = FOLDS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    return (pick(docs, doc_id=id_col, text=text_col)
            .select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), folds).alias("held_out"),
                    model.score(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= cut).cast("int")))


def keep_good(docs: DataFrame, model: RuleModel, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows whose score reaches ``cut``, with all their columns."""
    rows = packed(docs, text=text_col)
    return unpacked(rows.where(model.score(F.col("text")) >= cut), docs)


def op3_quality_model(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, scored by a model of ``labels.quality``."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
