"""Operator 2: secret scans by base patterns and character Markov models.

Base spans come from three patterns (see ``BASE``). Beyond them every run of
token characters, cut at the base spans, is scored by two character Markov
models, one of random strings and one of ordinary words and identifiers. A run
becomes a ``markov`` span when its log-likelihood ratio reaches ``threshold``
a character, or ``threshold`` times ``PART`` if it is shorter than ``WHOLE``.
Of all other runs each part of greatest sum (maximal scoring segment) becomes
one when the sum reaches ``threshold`` times ``PART``, widened to the letters
and digits that it touches. The sum decides alone, so a short key is found, and so
is one glued to ordinary text; a number that the models take for random (a
telephone number, say) is a span as well.

The models are trained from labelled samples: the values that the base
patterns capture and random strings over the usual key alphabets (seeded)
are the random class; the other words of the corpus, and identifiers joined
from them, are the ordinary class. Transition counts of corpus words are
summed over all documents; the random strings are a fixed number.

Defined results: a null or empty text has no spans (empty list, counts 0);
spans are code points, end exclusive; a base span is never dropped or cut by
the models, and no ``markov`` span meets one. Rows are independent, so
repeated ids and null ids each return their row. No rows give no rows. Extra
columns are ignored by ``scan_secrets`` and kept by ``mask_secrets``.
"""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, pick, replaced, table

# fixed values: the base kinds in their listed order, with the least length of the value
BASE = (
    ("assign", re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""),
     2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    # a run under 16 characters fails whichever way it is cut, so only the long ones are looked for
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
)
# what a text must hold for a pattern to match, looked for at a tenth of the pattern's cost
ASSIGNED = ("passw", "secret", "token", "api_key", "apikey")
HEX = bytes(48 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
KINDS = {kind: n for n, (kind, *_) in enumerate(BASE)} | {"markov": len(BASE)}

RUN = re.compile(r"[A-Za-z0-9+/_=-]*")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CODE = np.full(128, len(ALPHABET), np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
START = len(ALPHABET)           # state before the first character
N = START + 1
KEY_ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
                 ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "_-")
RANDOM_STRINGS = 600            # of each alphabet
UNIFORM = 0.03
THRESHOLD = 0.4                 # log-likelihood ratio a character
WHOLE = 20                      # least length of a run that is judged as a whole
PART = 25                       # a part of a run needs the sum of as many characters at the threshold
SLICE = 1 << 20                 # characters scored at once


def may_hold(text: str) -> dict[str, bool]:
    """Which base patterns can match anywhere in ``text``; never false for one that does."""
    low = text.lower()
    return {"assign": any(w in low for w in ASSIGNED), "access": "AKIA" in text,
            "hex": b"0" * 16 in text.encode("utf-8", "surrogatepass").translate(HEX)}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base patterns, by start, then kind as listed."""
    out, may = [], may_hold(text)
    for kind, pattern, group, least in BASE:
        if not may[kind]:
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), m.end(), kind))
    out.sort(key=lambda s: (s[0], KINDS[s[2]]))
    return out


def transitions(strings: list[str]) -> np.ndarray:
    """Counts of character pairs, the first character's from ``START``."""
    joined = "\x00".join(strings)
    codes = CODE[np.frombuffer(joined.encode("ascii", "replace"), np.uint8) & 127]
    pairs = np.concatenate([[START], codes[:-1]]) * N + codes if len(codes) else codes
    counts = np.bincount(pairs, minlength=N * N).reshape(N, N)
    counts[:, START] = 0
    return counts


def _random_samples(seed: int = 17) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(a, k=rng.randint(20, 48))) for a in KEY_ALPHABETS for _ in range(RANDOM_STRINGS)]


WORD = re.compile(r"[A-Za-z][a-z]{2,}")
ORDINARY = re.compile(r"[A-Za-z0-9+/_=-]+")
JOINTS = re.compile(r"[+/_=-]+")
MIXED = 8       # letters and digits mixed over as many characters are what is looked for, so no sample of the ordinary


def is_plain(run: str) -> bool:
    """Whether a run is a sample of ordinary text: words, numbers or short codes, joined or alone."""
    if run.isalpha() or run.isdigit():
        return True
    return all(len(part) < MIXED or part.isalpha() or part.isdigit() for part in JOINTS.split(run))


class _Kinds(dict):
    """run -> 1 if it is plain, and 2 if it is a word; emptied when full, so memory is bounded."""

    def __missing__(self, run):
        if len(self) >= MAX_RUNS:
            self.clear()
        kind = (1 if is_plain(run) else 0) | (2 if WORD.fullmatch(run) else 0)
        if len(run) <= LONG_RUN:
            self[run] = kind
        return kind


MAX_RUNS, LONG_RUN = 100_000, 64
_RUN_KINDS = _Kinds()


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-likelihood ratio table ``[previous, next]`` (random over ordinary).

    Counts run over all documents in one map with a sum of ``N * N`` cells;
    each batch sends a row for each cell it has seen.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, words = [], []
        for text in batch.column(0):
            text = text.as_py() or ""
            spans = base_spans(text)
            for start, end, kind in spans:
                values.append(BASE[0][1].match(text, start, end).group(2) if kind == "assign" else text[start:end])
            found, at = [], 0
            for start, end, _ in spans:
                if start >= at:
                    found += ORDINARY.findall(text, at, start)
                at = max(at, end)
            found += ORDINARY.findall(text, at)
            kinds = list(map(_RUN_KINDS.__getitem__, found))
            words += [w for w, k in zip(found, kinds) if k & 1]
            found = [w for w, k in zip(found, kinds) if k & 2]
            # identifiers: neighbouring words joined the usual ways
            words += [f"{a}_{b}" for a, b in zip(found[::20], found[1::20])]
            words += [f"{a}{b.capitalize()}" for a, b in zip(found[7::20], found[8::20])]
            words += [f"{a}-{n % 31}" for n, a in enumerate(found[11::20])]
            words += [f"{a}_{b}".upper() for a, b in zip(found[3::20], found[4::20])]
            words += [a.upper() for a in found[9::20]]
            words += [c * 24 for c in "-=_/" for _ in range(len(found) // 400 + 1)]
            words += [f"20{n % 40:02d}-{n % 12 + 1:02d}-{n % 28 + 1:02d}/{a}" for n, a in enumerate(found[13::40])]
            words += [str(len(a) * 7919 * (n + 1) ** 3) for n, a in enumerate(found[5::40])]
        both = [transitions([re.sub(r"[^A-Za-z0-9+/_=-]", "", v) for v in values]), transitions(words)]
        label = np.concatenate([np.full(np.count_nonzero(c), n) for n, c in enumerate(both)])
        cell = np.concatenate([np.flatnonzero(c) for c in both])
        seen = np.concatenate([c.ravel()[np.flatnonzero(c)] for c in both])
        return pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(cell, pa.int32()),
                                           pa.array(seen, pa.int64())], names=["label", "cell", "seen"])

    cells = (map_batches(pick(docs, text=text_col), count, "label int, cell int, seen long")
             .groupBy("label", "cell").agg(F.sum("seen").alias("seen")).collect())   # 2 * N * N rows at most
    counts = np.zeros((2, N * N))
    for label, cell, seen in cells:
        counts[label, cell] = seen
    counts = counts.reshape(2, N, N)
    known = transitions(_random_samples()).astype(float)
    # captured values weigh as much as one alphabet of the random strings; a uniform share keeps
    # what a class has never shown from deciding alone
    classes = (known + counts[0] * (known.sum() / len(KEY_ALPHABETS) / max(1.0, counts[0].sum())), counts[1])
    logp = []
    for c in classes:
        p = (c[:, :START] + 0.5) / (c[:, :START] + 0.5).sum(axis=1, keepdims=True)
        logp.append(np.log((1 - UNIFORM) * p + UNIFORM / START))
    return logp[0] - logp[1]


def _segments(scores: list[float], least: float) -> list[tuple[int, int]]:
    """All maximal scoring segments (Ruzzo and Tompa) whose sum reaches ``least``, in linear time."""
    found: list[tuple[int, int, float, float, int]] = []    # start, end, sum before, sum at the end, place in chain
    total = 0.0
    for n, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        start, j = n, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                break
            start, _, before, _, up = found[j]
            del found[j:]
            j = up
        found.append((start, n + 1, before, total, j))
    return [(start, end) for start, end, before, at_end, _ in found if at_end - before >= least]


def _secret_parts(piece: str, scores: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Spans of one run: the run if its own sum is enough, else its segments, widened to whole alphanumerics."""
    if scores.sum() >= threshold * (len(piece) if len(piece) >= WHOLE else PART):
        return [(0, len(piece))]
    out: list[tuple[int, int]] = []
    for start, end in _segments(scores.tolist(), threshold * PART):
        while start and piece[start - 1].isalnum():
            start -= 1
        while end < len(piece) and piece[end].isalnum():
            end += 1
        if out and start <= out[-1][1]:
            start = out.pop()[0]
        out.append((start, end))
    return out


def markov_spans(text: str, ratio: np.ndarray, threshold: float,
                 taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of the runs of token characters, cut at ``taken``, by their log-likelihood ratio."""
    table = np.zeros((N, N))
    table[:, :START] = ratio
    table = table.ravel()
    least = max(threshold, 0) * min(WHOLE, PART)
    out, at, k = [], 0, 0
    while at < len(text):
        # long texts in slices that end where a run does
        stop = min(len(text), at + SLICE)
        stop = RUN.match(text, stop).end()
        codes = CODE[np.minimum(np.frombuffer(text[at:stop].encode("utf-32-le", "surrogatepass"), "<u4"), 127)]
        for start, end, _ in itertools.takewhile(lambda s: s[0] < stop, itertools.islice(taken, k, None)):
            codes[max(0, start - at):max(0, end - at)] = START
        while k < len(taken) and taken[k][1] <= stop:
            k += 1
        scores = table[np.concatenate([[START], codes[:-1]]) * N + codes]
        inside = np.concatenate([[False], codes < START, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])       # a run's start, its end, the next one's start ...
        if len(edges):
            # no part of a run has a greater sum than its positive scores
            sums = np.add.reduceat(np.append(np.maximum(scores, 0), 0), edges)[::2]
            for n in np.flatnonzero(sums >= least).tolist():
                start, end = edges[2 * n:2 * n + 2].tolist()
                out += [(at + start + x, at + start + y, "markov")
                        for x, y in _secret_parts(text[at + start:at + end], scores[start:end], threshold)]
        at = stop
    return out


def all_spans(text: str | None, ratio: np.ndarray, threshold: float = THRESHOLD):
    """``(base, all)`` spans of one text, both by start, then kind."""
    text = text or ""
    base = base_spans(text)
    both = sorted(base + markov_spans(text, ratio, threshold, base), key=lambda s: (s[0], KINDS[s[2]]))
    return base, both


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 ratio: np.ndarray | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row."""
    if ratio is None:
        ratio = train(docs, text_col)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digests, spans = {k: [] for k, *_ in BASE}, [], []
        for text in batch.column(1):
            base, both = all_spans(text.as_py(), ratio, threshold)
            for kind, col in n.items():
                col.append(sum(s[2] == kind for s in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(both))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in n.values()), pa.array(digests, pa.string()),
             pa.array(spans, pa.string())],
            names=["doc_id", *(f"n_{k}" for k in n), "base_sha256", "spans"])

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_batches(pick(docs, doc_id=id_col, text=text_col)
                       .withColumn("doc_id", F.col("doc_id").cast("long")), scan, schema)


def mask(text: str | None, ratio: np.ndarray, threshold: float = THRESHOLD) -> str | None:
    """The text with every span replaced by ``<kind>``; overlapping spans become one, named by the first."""
    if not text:
        return text
    out, at = [], 0
    for start, end, kind in all_spans(text, ratio, threshold)[1]:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, text_col: str = "text", ratio: np.ndarray | None = None) -> DataFrame:
    """All rows and columns with the secrets in ``text_col`` replaced (null stays null)."""
    if ratio is None:
        ratio = train(docs, text_col)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: mask(t, ratio), na_action="ignore")

    return replaced(docs, text_col, masked)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``; the models are trained on the same whole table."""
    return scan_secrets(table(spark, sf_dir, "documents"))
