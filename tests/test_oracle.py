"""Every query with an SQL equivalent gives the rows that DuckDB gives."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(round(value, 9) + 0.0) if isinstance(value, float) else repr(value)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(DATA))
    cursor = duck.execute(entry.oracle_sql()[name])
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    columns = sorted(df.columns)
    assert sorted(kinds) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    names = [c[0] for c in cursor.description]
    expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got and got == expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["request_code", "status", "target", "coverage_rate", "FavorableClient"]
