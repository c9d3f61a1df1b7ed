"""Every query against the SQL that states its result, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__

SQL = __spark_entry__.oracle_sql()


def value(v):
    if isinstance(v, float):
        return round(v, 6)
    return round(float(v), 6) if type(v).__name__ == "Decimal" else tuple(map(value, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(small_dir):
    con = duckdb.connect()
    for path in Path(small_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small_dir, duck, name):
    df = __spark_entry__.queries()[name](spark, small_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(SQL[name])
    order = [c[0] for c in result.description]
    assert sorted(order) == columns
    assert got == sorted((tuple(value(r[order.index(c)]) for c in columns) for r in result.fetchall()), key=repr)


def test_entry(spark, small_dir):
    assert __spark_entry__.entry(spark).columns == ["pair_id", "sentence_id", "text", "page_title"]


def test_names():
    queries = __spark_entry__.queries()
    assert set(SQL) <= set(queries) and all(callable(q) for q in queries.values())
