"""Each query with SQL gives the rows that DuckDB gives, at the smallest scale."""

import math

import duckdb
import pytest

from corpusloom.plans import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(x) -> str:
    if hasattr(x, "tolist") and not isinstance(x, (str, bytes)):
        x = x.tolist()
    if x is None or x != x:
        return "-"
    if isinstance(x, float):
        return f"{x:.6g}" if math.isfinite(x) else str(x)
    if isinstance(x, (list, tuple)):
        return f"[{','.join(map(shown, x))}]"
    return str(x)


def rows(df) -> list[str]:
    df = df[sorted(df.columns)].astype(object)
    return sorted("|".join(map(shown, r)) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(own.SQL))
def test_query_equals_sql(spark, small, duck, name):
    got, want = own.QUERIES[name](spark, small).toPandas(), duck.execute(own.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", [n for n in own.QUERIES if n not in own.SQL])
def test_query_without_sql_runs(spark, small, name):
    df = own.QUERIES[name](spark, small)
    again = own.QUERIES[name](spark, small)
    assert df.columns == again.columns and rows(df.toPandas()) == rows(again.toPandas())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == own.license_histogram(spark, "/root/testdata/sf0.001").columns
    assert set(own.QUERIES) <= set(__spark_entry__.queries())
