"""Operator 9 (native): URL filters by a temporal list join.

List entries are dated: from ``since`` on, a pattern (a host with its
subdomains, or a URL prefix of a host) is blocked or allowed. Each pattern's
entries become validity intervals; a capture is judged by the entries that
were active when it was fetched, the longest pattern first.

A capture asks for its host, all parent domains of the host and all prefixes
of its path, each a row of (key, time); the URL itself bounds their number, and
asks for patterns that are not listed go at once. Intervals and asks meet in an
as-of join by key and calendar bucket. Intervals exist only in buckets that are
asked for: an entry's own bucket, and where it is carried into a later one. So
a pattern with very many entries, or one that very many captures ask for,
spreads over its buckets (and ``PARTS`` parts of each), each ask meets only the
intervals of its own bucket, and one far-off date costs one row.
Only DataFrame functions are used.

Defined results: a null or unparsable URL, or a null fetch time, matches
nothing and is kept; hosts are compared without case, paths as written; a null
pattern, date or action drops the entry; entries of one pattern and moment
that disagree count as blocked; an entry holds from its moment on (inclusive);
repeated captures each return their row. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick, table

BUCKET_DAYS = 8
PARTS = 8           # of the captures that ask for one pattern in one bucket


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def keys_of(url: Column) -> Column:
    """Patterns that would match a URL: its domains from the host up, and the host's path prefixes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n),
                          lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    dirs = F.filter(F.split(path, "/"), lambda s: s != "")
    d = F.size(dirs)
    prefixes = F.when(d > 0, F.transform(F.sequence(F.lit(1), F.greatest(d, F.lit(1))),
                                         lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(dirs, 1, k), "/"))))
    return F.when(host != "", F.concat(domains, F.coalesce(prefixes, F.array().cast("array<string>"))))


def _pattern_key(pattern: Column) -> Column:
    """A pattern as captures ask for it: the host in lower case, the path as written."""
    host = F.substring_index(pattern, "/", 1)
    return F.concat(F.lower(host), pattern.substr(F.length(host) + 1, F.length(pattern)))


def _bucket(moment: str) -> Column:
    return F.floor(F.unix_date(F.to_date(moment)) / BUCKET_DAYS).cast("int")


def dated(entries: DataFrame) -> DataFrame:
    """``pattern, since, blocked`` entries -> ``key, since, state, bucket``: one row a pattern and moment (blocked wins)."""
    return (pick(entries, key="pattern", since="since", blocked="blocked")
            .where("key IS NOT NULL AND since IS NOT NULL AND blocked IS NOT NULL")
            .select(_pattern_key(F.col("key")).alias("key"), F.col("since").cast("timestamp").alias("since"), "blocked")
            .groupBy("key", "since").agg(F.max("blocked").alias("state"))
            .withColumn("bucket", _bucket("since")))


def intervals(dated_entries: DataFrame, asked: DataFrame) -> DataFrame:
    """Validity intervals of the list in the buckets that are asked for.

    ``asked`` is ``(key, bucket)``, distinct. Returns ``key, piece, start, stop,
    state``, ``start`` inclusive, ``stop`` exclusive (null: to the end of the
    bucket): the entries of the bucket, and the one still valid at its
    beginning. So there are no more rows than entries and asked buckets, however
    far apart these are. Windows hold one bucket's entries of a key, or one row
    a bucket of a key.
    """
    e = dated_entries
    ends = e.groupBy("key", "bucket").agg(F.max(F.struct("since", "state")).alias("final"), F.min("since").alias("first"))
    along = Window.partitionBy("key").orderBy("bucket")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    held = (ends.select("key", "bucket", "final", "first", F.lit(False).alias("ask")).unionByName(
        asked.select("key", "bucket", F.lit(None).cast(ends.schema["final"].dataType).alias("final"),
                     F.lit(None).cast("timestamp").alias("first"), F.lit(True).alias("ask")))
        .groupBy("key", "bucket").agg(F.max("final").alias("final"), F.max("first").alias("first"), F.max("ask").alias("ask"))
        .withColumn("carried", F.last("final", ignorenulls=True).over(before)).where("ask"))
    carried = held.where("carried IS NOT NULL").select(
        "key", F.col("bucket").alias("piece"), F.col("carried.since").alias("start"), F.col("first").alias("stop"),
        F.col("carried.state").alias("state"))
    within = Window.partitionBy("key", "bucket").orderBy("since")
    inside = (e.withColumn("stop", F.lead("since").over(within)).join(asked, ["key", "bucket"], "left_semi")
              .select("key", F.col("bucket").alias("piece"), F.col("since").alias("start"), "stop", "state"))
    return carried.unionByName(inside)


def judge(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
          time_col: str = "fetched") -> DataFrame:
    """``page_id, url, fetched, pattern, since, blocked`` for every capture.

    ``pattern`` and ``since`` name the deciding entry (null: none), ``blocked``
    is its verdict (false without one).
    """
    captures = pick(captures, page_id=id_col, url=url_col, fetched=time_col)
    captures = captures.withColumn("fetched", F.col("fetched").cast("timestamp"))
    listed = dated(entries)
    # only patterns that are listed are asked for: the rest goes before anything is shuffled by pattern
    known = listed.select(F.col("key").alias("listed")).distinct()
    asks = (captures.where("url IS NOT NULL AND fetched IS NOT NULL").select("url", "fetched").distinct()
            .select("url", "fetched", _bucket("fetched").alias("bucket"), F.explode(keys_of(F.col("url"))).alias("ask"))
            .join(known, F.col("ask") == F.col("listed"), "left_semi"))
    active = intervals(listed, asks.select(F.col("ask").alias("key"), "bucket").distinct())
    # a common domain in a busy week is cut in parts, its few intervals are copied to each
    asks = asks.withColumn("part", F.pmod(F.xxhash64("url"), F.lit(PARTS)).cast("int"))
    active = active.withColumn("of", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    hits = asks.join(active, (F.col("ask") == F.col("key")) & (F.col("bucket") == F.col("piece")) & (F.col("part") == F.col("of"))
                     & (F.col("start") <= F.col("fetched"))
                     & (F.col("stop").isNull() | (F.col("fetched") < F.col("stop"))))
    best = (hits.groupBy(F.col("url").alias("u"), F.col("fetched").alias("f"))
            .agg(F.max(F.struct(F.length("ask").alias("n"), F.col("ask").alias("pattern"),
                                F.col("start").alias("since"), "state")).alias("entry")))
    return (captures.join(best, (F.col("url") == F.col("u")) & (F.col("fetched") == F.col("f")), "left")
            .select("page_id", "url", "fetched", F.col("entry.pattern").alias("pattern"),
                    F.col("entry.since").alias("since"), F.coalesce("entry.state", F.lit(False)).alias("blocked")))


# ------------------------------------------------------------ registered query

FIRST_FETCH = "2024-01-01 00:00:00"


def _captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time from their id (the table has none): 0 to 3000 hours into 2024."""
    return pages.select("page_id", "url", F.expr(
        f"timestamp '{FIRST_FETCH}' + make_dt_interval(0, CAST(page_id * 7 % 3000 AS int))").alias("fetched"))


def _entries(events: DataFrame, pages: DataFrame) -> DataFrame:
    """A dated list: each event of a user lists the page of that number.

    Errors block and other events allow; by event number the entry is for the
    page's host, the domain above it, or the host's first directory.
    """
    host = host_of(F.col("url"))
    first = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/+([^/?#]+)", 1)
    pattern = (F.when(F.col("event_id") % 3 == 0, host)
               .when(F.col("event_id") % 3 == 1, F.regexp_replace(host, r"^[^.]*\.", ""))
               .when(first != "", F.concat(host, F.lit("/"), first)))
    return (events.join(pages.where(host != ""), F.col("user_id") == F.col("page_id"))
            .select(pattern.alias("pattern"), F.col("ts").alias("since"),
                    (F.col("event_type") == "error").alias("blocked")))


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    """All of ``pages``, judged by a list dated by ``events``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(_captures(pages), _entries(table(spark, sf_dir, "events"), pages)).select(
        "page_id", "url", F.date_format("fetched", "yyyy-MM-dd HH:mm:ss").alias("fetched"), "pattern",
        F.date_format("since", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("since"), "blocked")


_URL = "^[A-Za-z][A-Za-z0-9+.-]*://"
ORACLE = f"""
WITH p AS (SELECT page_id, url, TIMESTAMP '{FIRST_FETCH}' + to_hours(CAST(page_id * 7 % 3000 AS INTEGER)) AS fetched,
    lower(regexp_extract(url, '{_URL}(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
    list_filter(string_split(regexp_extract(url, '{_URL}[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS dirs FROM pages),
e AS (SELECT pattern, since, bool_or(blocked) AS blocked FROM (
    SELECT CASE event_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^[^.]*\\.', '')
        ELSE host || '/' || regexp_extract(url, '{_URL}[^/?#]*/+([^/?#]+)', 1) END AS pattern,
      ts AS since, event_type = 'error' AS blocked, event_id % 3 = 2 AS by_dir,
      regexp_extract(url, '{_URL}[^/?#]*/+([^/?#]+)', 1) AS first
    FROM events JOIN p ON user_id = page_id WHERE host <> '')
  WHERE pattern IS NOT NULL AND since IS NOT NULL AND blocked IS NOT NULL AND (NOT by_dir OR first <> '') GROUP BY ALL),
l AS (SELECT *, string_split(host, '.') AS labels FROM p WHERE host <> ''),
a AS (SELECT DISTINCT url, fetched, unnest(list_concat(
    list_transform(range(1, len(labels) + 1), lambda k: array_to_string(labels[len(labels) - k + 1:], '.')),
    list_transform(range(1, len(dirs) + 1), lambda k: host || '/' || array_to_string(dirs[:k], '/')))) AS ask
  FROM l WHERE fetched IS NOT NULL),
h AS (SELECT url, fetched, ask, max(since) AS since, arg_max(blocked, since) AS blocked
  FROM a JOIN e ON ask = pattern AND since <= fetched GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY url, fetched ORDER BY length(ask) DESC, ask DESC) AS n FROM h)
SELECT page_id, p.url, strftime(p.fetched, '%Y-%m-%d %H:%M:%S') AS fetched, ask AS pattern,
  strftime(since, '%Y-%m-%d %H:%M:%S.%f') AS since, coalesce(blocked, false) AS blocked
FROM p LEFT JOIN b ON p.url = b.url AND p.fetched = b.fetched AND b.n = 1
"""
