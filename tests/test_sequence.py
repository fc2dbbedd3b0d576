import random

import pandas as pd

from tessera.operators.sequence import sequence_groups


def expected(rows):
    df = pd.DataFrame(rows, columns=["g", "o", "v"]).sort_values(["g", "o", "v"])
    df["pos"] = df.groupby("g").cumcount()
    df["nxt"] = df.groupby("g")["v"].shift(-1)
    return {(r.g, r.o, r.v): (r.pos, None if pd.isna(r.nxt) else int(r.nxt)) for r in df.itertuples()}


def run(spark, rows, parts):
    df = spark.createDataFrame(rows, "g long, o long, v long")
    out = sequence_groups(df, ["g"], ["o", "v"], value_col="v", pos_col="pos", next_col="nxt",
                          num_partitions=parts)
    return {(r.g, r.o, r.v): (r.pos, r.nxt) for r in out.collect()}


def test_hot_group_spans_partitions(spark):
    rng = random.Random(7)
    rows = [(0, i, rng.randrange(10**6)) for i in range(3000)]          # one group: most rows
    rows += [(g, rng.randrange(50), rng.randrange(10**6)) for g in range(1, 400) for _ in range(3)]
    rows = list({(g, o, v) for g, o, v in rows})
    assert run(spark, rows, 9) == expected(rows)


def test_many_small_groups_and_singletons(spark):
    rng = random.Random(3)
    rows = list({(rng.randrange(200), rng.randrange(5), rng.randrange(1000)) for _ in range(1500)})
    assert run(spark, rows, 13) == expected(rows)


def test_more_partitions_than_rows(spark):
    rows = [(1, 0, 10), (1, 1, 11), (2, 0, 20)]
    assert run(spark, rows, 16) == expected(rows)


def test_null_group_and_order_keys(spark):
    rows = [(None, 1, 5), (None, None, 4), (None, 2, 6), (1, None, 7), (1, 0, 8), (2, 3, 9)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    want = {(None, None, 4): (0, 5), (None, 1, 5): (1, 6), (None, 2, 6): (2, None),
            (1, None, 7): (0, 8), (1, 0, 8): (1, None), (2, 3, 9): (0, None)}
    for parts in (1, 4):
        out = sequence_groups(df, ["g"], ["o", "v"], value_col="v", pos_col="pos", next_col="nxt",
                              num_partitions=parts)
        got = {(r.g, r.o, r.v): (r.pos, r.nxt) for r in out.collect()}
        # nulls sort first, and a null group key is one group of its own
        assert got == want


def test_random_partition_counts(spark):
    rng = random.Random(11)
    rows = list({(rng.randrange(30), rng.randrange(40), rng.randrange(10**5)) for _ in range(700)})
    want = expected(rows)
    for parts in (1, 2, 3, 8, 31):
        assert run(spark, rows, parts) == want


def test_one_exchange_and_no_write(spark, monkeypatch):
    """Planning writes nothing; without a large group the rows move once."""
    from tessera import session
    monkeypatch.setattr(session, "scratch_path", None)
    rows = [(g, o, g * o) for g in range(300) for o in range(4)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    out = sequence_groups(df, ["g"], ["o", "v"], value_col="v", pos_col="pos", next_col="nxt", num_partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_hot_group_is_dealt_to_balanced_tasks(spark):
    """A group with two thirds of the rows: no piece over three times a partition's share."""
    rows = [(0, i, i) for i in range(20_000)] + [(g, 0, 1) for g in range(1, 10_001)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    n = 12
    out = sequence_groups(df, ["g"], ["o", "v"], value_col="v", pos_col="pos", next_col="nxt", num_partitions=n)
    assert "_seq_piece" in out._jdf.queryExecution().executedPlan().toString()
    from tessera.operators import sequence
    from pyspark.sql import functions as F
    d = df.withColumn(sequence.HASH, F.xxhash64("g"))
    large, total = sequence._large_groups(d, n)
    (h, coarse, fine), = sequence._bounds(d, large, total, n, ["o", "v"])
    cuts = [0, *[b[0] for f in fine for b in f], 20_000]
    assert max(b - a for a, b in zip(cuts, cuts[1:])) <= 3 * total / n
    got = {(r.g, r.o): (r.pos, r.nxt) for r in out.where("g = 0").collect()}
    assert got == {(0, i): (i, i + 1 if i < 19_999 else None) for i in range(20_000)}
