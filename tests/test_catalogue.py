"""Every query with SQL against DuckDB: names, types, rows."""

import glob
import math
import os

import duckdb
import pytest

from medloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def text(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    done = duck.execute(catalogue.ORACLE_SQL[name])
    kinds = {d[0]: str(d[1]) for d in done.description}
    names = [d[0] for d in done.description]
    assert sorted(names) == cols
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == kinds
    want = sorted(tuple(text(r[names.index(c)]) for c in cols) for r in done.fetchall())
    assert sorted(tuple(map(text, r)) for r in df.select(*cols).collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["year", "citationcount", "percentile"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
