import os

from pyspark.sql import functions as F

from conftest import fixture_path
from tessera.operators import text
from tessera.plans import jobs
from tessera.plans.stoplist import stopwords_df
from tessera.sinks import text as sinks
from tessera.sources import text as src


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_word_count_golden(spark, scratch):
    out = os.path.join(scratch, "wc")
    counts = jobs.word_count_job(spark, os.path.dirname(fixture_path("file01.txt")) + "/file0*.txt", out)
    got = [(r.word, r["count"]) for r in counts.orderBy("word").collect()]
    assert got == [("Bye", 1), ("Goodbye", 1), ("Hadoop", 2), ("Hello", 2), ("World", 2)]
    written = sorted(spark.read.text(out).collect(), key=lambda r: r.value)
    assert [r.value for r in written] == ["Bye\t1", "Goodbye\t1", "Hadoop\t2", "Hello\t2", "World\t2"]


def test_tokeniser_delimiters(spark):
    df = lines(spark, "a\tb\rc\fd e", "  fix  ", "", "x\x0by", "end\n")
    got = sorted(r.word for r in text.tokenize(df).collect())
    # tab, CR, FF and space split; vertical tab does not; 'fix' keeps its f
    assert got == sorted(["a", "b", "c", "d", "e", "fix", "x\x0by", "end"])


def test_punctuation_and_case_kept(spark):
    df = lines(spark, "It it. It, it")
    got = {(r.word, r["count"]) for r in text.word_count(df).collect()}
    assert got == {("It", 1), ("it.", 1), ("It,", 1), ("it", 1)}


def test_stopwords_case_sensitive(spark):
    stop = src.read_stopwords(spark, fixture_path("stopwords.txt"))
    assert sorted(r.word for r in stop.collect()) == ["a", "and", "of", "the"]
    toks = text.tokenize(lines(spark, "The the A a of Of"))
    kept = sorted(r.word for r in text.remove_stopwords(toks, stop).collect())
    assert kept == ["A", "Of", "The"]


def test_common_words_max_and_intersection(spark):
    a = lines(spark, "x x x y z", "only_a")
    b = lines(spark, "x y y y y z", "only_b")
    ca, cb = text.word_count(a), text.word_count(b)
    got = {(r.word, r["count"]) for r in text.common_words(ca, cb).collect()}
    assert got == {("x", 3), ("y", 4), ("z", 1)}
    tagged = text.common_words_tagged(text.tagged_union(ca, cb))
    assert {(r.word, r["count"]) for r in tagged.collect()} == got
    sc = text.common_from_side_counts(text.side_counts(
        text.tokenize(a.withColumn("s", F.lit("a")), keep=("s",)).unionByName(
            text.tokenize(b.withColumn("s", F.lit("b")), keep=("s",))), "s", ("a", "b")))
    assert {(r.word, r["count"]) for r in sc.collect()} == got


def test_top_k_ties_word_descending_and_exact_cut(spark):
    scored = spark.createDataFrame(
        [("And", 17), ("He", 17), ("There", 17), ("I", 287), ("Zed", 3), ("Abe", 3)],
        "word string, count long")
    got = [(r["count"], r.word) for r in text.top_k(scored, 4).collect()]
    assert got == [(287, "I"), (17, "There"), (17, "He"), (17, "And")]
    got3 = [(r["count"], r.word) for r in text.top_k(scored, 3).collect()]
    assert got3 == [(287, "I"), (17, "There"), (17, "He")]


def test_topk_job_writes_count_tab_word(spark, scratch):
    d = scratch
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("the cat sat\nThe cat ran\ncat dog\n")
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("a cat and a dog\nThe end\n")
    out = os.path.join(d, "out")
    top = jobs.topk_common_words_job(spark, os.path.join(d, "a.txt"), os.path.join(d, "b.txt"),
                                     fixture_path("stopwords.txt"), out, k=20)
    # "The" survives the lower-cased stop list (case-sensitive match)
    assert [(r["count"], r.word) for r in top.collect()] == [(3, "cat"), (1, "dog"), (1, "The")]
    written = [r.value for r in spark.read.text(out).collect()]
    assert written == ["3\tcat", "1\tdog", "1\tThe"]


def test_kv_parsing(spark):
    df = lines(spark, "k\tv", "k2\tv\tw", "lonely")
    got = [(r.key, r.value) for r in src.parse_kv(df).collect()]
    assert got == [("k", "v"), ("k2", "v\tw"), ("lonely", "")]


def test_tagged_union_kv(spark):
    a = src.parse_kv(lines(spark, "x\t1"))
    b = src.parse_kv(lines(spark, "x\t2"))
    got = sorted(tuple(r) for r in src.tagged_union_kv(a, b).collect())
    assert got == [("x", "1", "f1"), ("x", "2", "f2")]


def test_route_query_parsing(spark):
    q = src.read_route_queries(spark, fixture_path("queries.txt"))
    got = [(r.src, r.dst) for r in q.orderBy("query_id").collect()]
    assert got == [(1, 5), (5, 1), (1, 6), (1, 1), (1, 77)]


def test_write_topk_roundtrip(spark, scratch):
    scored = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "word string, count long")
    out = os.path.join(scratch, "topk")
    sinks.write_topk(text.top_k(scored, 2), out)
    assert [r.value for r in spark.read.text(out).collect()] == ["5\tc", "2\tb"]


def test_default_stoplist_is_lowercase_unique(spark):
    words = [r.word for r in stopwords_df(spark).collect()]
    assert len(words) == len(set(words)) and all(w == w.lower() for w in words)


def test_write_counts_ordered_by_word(spark, scratch):
    counts = spark.createDataFrame([("b", 1), ("a", 3), ("B", 2)], "word string, count long")
    out = os.path.join(scratch, "counts")
    sinks.write_counts(counts, out, single_file=True)
    assert [r.value for r in spark.read.text(out).collect()] == ["B\t2", "a\t3", "b\t1"]


def test_long_stop_list_drops_its_words_and_no_others(spark):
    from tessera.operators.text import normalize_stopwords, remove_stopwords
    stop = normalize_stopwords(spark.range(200_000).selectExpr("concat('W', id) AS word"))
    words = spark.createDataFrame([("w7",), ("W7",), ("w199999",), ("w200000",)], "word string")
    assert sorted(r[0] for r in remove_stopwords(words, stop).collect()) == ["W7", "w200000"]




def test_route_queries_follow_file_names_and_lines(spark, scratch):
    import os
    from tessera.sources.text import read_route_queries
    folder = os.path.join(scratch, "q")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.txt"), "w") as f:
        f.write("1 2\n")
    with open(os.path.join(folder, "b.txt"), "w") as f:
        f.writelines(f"{i} {i + 1}\n" for i in range(10, 40))
    got = [(r.src, r.dst) for r in read_route_queries(spark, folder).orderBy("query_id").collect()]
    assert got == [(1, 2)] + [(i, i + 1) for i in range(10, 40)]
    one = read_route_queries(spark, os.path.join(folder, "b.txt")).orderBy("query_id").collect()
    assert [r.query_id for r in one] == list(range(30))
