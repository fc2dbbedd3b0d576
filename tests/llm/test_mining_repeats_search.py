"""Operators 11, 12 and 13 against brute force, and their edge cases."""

import collections
import hashlib
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import fp_search, hard_negatives, suffix_family

# ------------------------------------------------------------------ 11

VECTORS = "vec_id long, label int, embedding array<double>, terms string, r int, code binary, vec_ID2 long"


def vectors(spark, rows):
    """Rows with extra columns that clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", 1, b"c", 7) for r in rows], VECTORS)


def brute_negatives(rows, is_anchor, positives=5, negatives=3):
    usable = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows
              if i is not None and l is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for anchor in sorted({i for i, _, _ in usable if is_anchor(i)}):
        label, q = min((l, v) for i, l, v in usable if i == anchor)
        near = sorted((-dot(q, v), i) for i, l, v in usable if l == label and i != anchor)[:positives]
        for p, positive in near:
            inside = sorted((-dot(q, v), i) for i, l, v in usable
                            if l != label and i != anchor and 50 * -p <= 100 * dot(q, v) <= 95 * -p)[:negatives]
            out += [(anchor, positive, k + 1, i, -p, -s) for k, (s, i) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows):
    got = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 5 == 0, F.col("label"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def test_hard_negatives_match_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 20))
    rows = [(i, int(rng.integers(0, 4)), (centres[i % 4] + rng.normal(size=20)).tolist()) for i in range(300)]
    want = brute_negatives(rows, lambda i: i % 5 == 0)
    assert len(want) > 300 and mined(spark, rows) == want


def test_hard_negatives_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (0, 1, [0.5, 3.0]), (1, 1, [1.0]), (2, 1, []), (3, 2, [0.6, 1.2, 5.0]), (4, 2, [0.7, 1.0]),
            (4, 2, [0.7, 1.0]), (5, None, [1.0, 1.0]), (6, 1, None), (7, 1, [nan, 1.0]), (8, 2, [inf, 1.0]),
            (9, 1, [None, 1.0]), (None, 1, [1.0, 2.0]), (10, 3, [1.0, 2.0]), (11, 1, [1.0, 2.0]), (12, 1, [1.0, 2.0]),
            (15, 1, [-1.0, -2.0])]
    want = brute_negatives(rows, lambda i: i % 5 == 0)
    assert want and mined(spark, rows) == want
    assert mined(spark, []) == []


def test_intervals_hold_every_score(spark):
    """Also where rows are parallel, opposite, at right angles, equal, zero, or very large."""
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (400, 50))
    x[:5] = [x[9], -x[9], 0 * x[9], 1000 * x[9], np.eye(50, dtype=int)[0] * 10**6]
    width = hard_negatives.code_width(50)
    codes, along, rest = hard_negatives.encode(x, width)
    import pyarrow as pa
    block = hard_negatives.Block(pa.table({
        "vec_id": np.arange(400), "label": np.zeros(400, int), "terms": pa.array(x.tolist()),
        "code": [c.tobytes() for c in codes], "along": along, "rest": rest}), width)
    near = 0
    for q in x[:60]:
        lower, upper = block.intervals(hard_negatives.rotated(q[None], width)[0], np.arange(400))
        score = x @ q
        assert (lower <= score).all() and (score <= upper).all()
        assert (block.scores(q, np.arange(400)) == score).all()
        near += (upper - lower < 2 * np.linalg.norm(q) * np.linalg.norm(x, axis=1)).sum()
    assert near > 0.9 * 60 * 400       # narrower than the bound that needs no code


# ------------------------------------------------------------------ 12

def brute_removal(texts, w=400):
    bodies = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p:p + w] for b in bodies for p in range(len(b) - w + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for p in range(len(b) - w + 1):
            if seen[b[p:p + w]] > 1:
                gone[p:p + w] = b"\1" * w
        runs = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def removed(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame([(i, t, b"d", "s", 1, [], 0) for i, t in zip(ids, texts)],
                                 "doc_id long, text string, digest binary, sha string, n_bytes int, spans array<int>, copies int")
    rows = suffix_family.remove_repeats(docs, with_bytes=True).collect()
    return [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256, bytes(r.kept)) for r in rows]


def check_removal(spark, texts):
    want = [(i, *w) for i, w in enumerate(brute_removal(texts))]
    assert sorted(removed(spark, texts)) == want
    return want


def test_repeats_match_brute_force(spark):
    rng = random.Random(12)
    prose = lambda n: "".join(rng.choices("abcdefgh éß漢 ", k=n))
    passage, edge = prose(900), prose(400)
    texts = [prose(3000) for _ in range(12)]
    for t in range(6):                                       # the passage, cut at different places
        texts.append(prose(rng.randint(0, 700)) + passage[rng.randint(0, 300):rng.randint(500, 900)] + prose(300))
    near = list(texts[0])
    for at in (40, 700, 1100, 1101, 2500):                   # a near copy
        near[at] = "#"
    texts += ["".join(near), texts[1], texts[1], texts[2] + "x", "y" + texts[3][:-5]]
    ascii_edge = "".join(rng.choices("abcdefgh", k=400))
    texts += ["1" + ascii_edge + "2", "3" + ascii_edge + "4",           # 400 bytes in common: gone
              "5" + ascii_edge[:399] + "6", "7" + ascii_edge[1:] + "8", edge]
    want = check_removal(spark, texts)
    assert [w[2] for w in want[-5:-3]] == [400, 400]


def test_repeats_inside_one_text(spark):
    line = "the same line again and again\n"
    rng = random.Random(1)
    unit = "".join(rng.choices("abcdefgh", k=390))
    check_removal(spark, ["z" * 1500, line * 100, unit * 4 + "tail", unit + "".join(rng.choices("ij", k=500)) + unit,
                          "a" * 399, "b" * 400, "b" * 401 + "c", "12" * 450])


def test_repeats_of_null_empty_and_repeated_rows(spark):
    long = "".join(random.Random(4).choices("abcdef ", k=2000))
    ids, texts = [1, 1, None, None, 5, 6, 1], [long, long, None, "", "short", "  ", "short"]
    want = sorted(((i, *w) for i, w in zip(ids, brute_removal(texts))), key=repr)
    assert sorted(removed(spark, texts, ids), key=repr) == want
    assert removed(spark, []) == []


def test_very_long_text(spark, monkeypatch):
    """Texts of more starts than are worked on together."""
    rng = random.Random(2)
    body = "".join(rng.choices("abcdefghij", k=5000))
    at, first, n = suffix_family.anchors(np.frombuffer(body.encode(), np.uint8))
    monkeypatch.setattr(suffix_family, "STARTS_AT_ONCE", 700)
    cut = suffix_family.anchors(np.frombuffer(body.encode(), np.uint8))
    owner = np.repeat(cut[0], cut[2])
    assert (owner == np.repeat(at, n)).all() and (np.sort(np.concatenate([np.arange(f, f + k) for f, k in zip(cut[1], cut[2])]))
                                                  == np.arange(len(body) - 399)).all()


def test_family_has_levels_of_geometric_sizes(spark):
    family = suffix_family.IndexFamily()
    batch = lambda *words: spark.createDataFrame([(w.encode(),) for w in words], "suffix binary")
    found = [{bytes(r.suffix) for r in family.add(batch(*words)).collect()}
             for words in (("a", "b"), ("b", "c", "c"), ("a", "d"), ("e",), ("e", "d", "f"))]
    assert found == [set(), {b"b", b"c"}, {b"a"}, set(), {b"e", b"d"}]
    assert [size for size, _ in family.levels] == [4, 1]
    assert {bytes(r.suffix): r.n for r in family.levels[0][1].collect()} == {b"a": 2, b"b": 2, b"c": 2, b"d": 1, b"e": 1}


# ------------------------------------------------------------------ 13

def brute_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_ranking(docs, items, k=10):
    counted = [(i, collections.Counter(brute_terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t in items:
        if i is not None and t is not None:
            asked[i] = min(t, asked.get(i, t))
    out = []
    for item, text in asked.items():
        found = []
        for i, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(brute_terms(text)) if t in c)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def ranking(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, [1], "x") for i, t in docs], "doc_id long, text string, n int, terms array<int>, m string")
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, score int")
    got = fp_search.ranked_search(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()))


def search_corpus(n, seed=13):
    rng = random.Random(seed)
    common, rare = [f"c{k}" for k in range(30)], [f"R{k}é" for k in range(300)]
    docs = [(i, " ".join(rng.choices(common, k=rng.randint(0, 80)) + rng.choices(rare, k=rng.randint(0, 6)))) for i in range(n)]
    items = [(i, ", ".join(rng.sample(common, 6) + rng.sample(rare, 5) + ["nowhere"])) for i in range(25)]
    return docs, items


def test_ranked_search_matches_brute_force(spark):
    docs, items = search_corpus(700)
    docs += [(1000 + i, docs[5][1]) for i in range(150)]        # a large group of copies: ties by id
    assert ranking(spark, docs, items) == brute_ranking(docs, items)


def test_ranked_search_in_many_blocks_and_chunks(spark, monkeypatch):
    docs, items = search_corpus(300, 17)
    want = brute_ranking(docs, items)
    monkeypatch.setattr(fp_search, "ITEM_TERMS", 40)
    assert ranking(spark, docs, items[:6]) == [w for w in want if w[0] < 6]


def test_ranked_search_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "--- !!"), (None, "alpha beta"), (4, "Alpha alpha ALPHA"), (4, "beta"), (5, "beta"),
            (5, "beta"), (6, "\x00alpha\x7fgamma_delta"), (7, "x " * 50_000 + "alpha"), (8, "ÄLPHA 漢字")]
    items = [(1, "alpha, BETA; alpha"), (2, None), (3, ""), (None, "alpha"), (4, "zzz"), (5, "gamma"), (5, "delta beta"),
             (6, "älpha Älpha ÄLPHA 漢字")]
    assert ranking(spark, docs, items) == brute_ranking(docs, items)
    assert ranking(spark, [], items) == [] and ranking(spark, docs, []) == []


def test_tree_bounds_and_skips():
    """Every node's maxima and minima hold below it, and a search does not score every leaf."""
    rng = np.random.default_rng(0)
    n = 3000
    sizes = rng.integers(1, 12, n)
    vectors = sorted(tuple(np.sort(rng.choice(60, s, replace=False))) for s in sizes)
    start = np.append(0, np.cumsum([len(v) for v in vectors]))
    path = np.concatenate(vectors).astype(np.int64)
    tf, m = rng.integers(1, 9, len(path)), rng.integers(10, 400, n)
    tree = fp_search.Tree(np.arange(n), m, start, path, tf)
    assert sorted(x for node in tree.leaf for x in range(*tree.span[node])) == list(range(n))
    for node, (lo, hi) in enumerate(tree.span):
        assert tree.least_m[node] == m[lo:hi].min()
        part = slice(start[lo], start[hi])
        for term in range(60):
            where = path[part] == term
            most = tf[part][where].max(initial=0)
            assert tree.most_tf[node][np.searchsorted(tree.terms, term)] == most
    scored = []
    whole = dict(tree.leaf)

    class Seen(dict):
        def __getitem__(self, node):
            scored.append(node)
            return whole[node]

    tree.leaf = Seen(whole)
    terms, weights = np.array([3, 50, 58]), np.array([10, 4000, 5000])
    got = tree.search(terms, weights, 10, [])
    assert len(scored) < len(whole)
    score = collections.Counter()
    for d, v in enumerate(vectors):
        for k, t in enumerate(v):
            if t in terms:
                x = int(tf[start[d] + k])
                score[d] += int(weights[list(terms).index(t)]) * (10**9 * x // (1000 * x + 8 * int(m[d])))
    assert got == sorted((-s, d) for d, s in score.items())[:10]
