"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import catalog, files

QUERIES, ORACLE_SQL = catalog.QUERIES | files.QUERIES, catalog.ORACLE_SQL | files.ORACLE_SQL
SF = "/root/testdata/sf0.001"
TABLES = ["documents", "orders", "lineitem", "part", "supplier", "nation"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else None
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    # same column names and types ...
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    # ... and the same rows
    assert canon(df.columns, df.collect()) == canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["word", "count"] and 0 < len(rows) <= 20

