"""Every query that has SQL, against DuckDB on the same tables."""

import duckdb
import pytest
from tables_at import TESTDATA

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def scale(request):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{request.param}/{table}.parquet'")
    return f"{TESTDATA}/{request.param}", db


def test_every_oracle_has_a_query():
    assert set(entry_module.library_sql()) <= set(entry_module.library_queries())


@pytest.mark.parametrize("name", sorted(entry_module.library_sql()))
def test_matches_sql(spark, scale, name):
    sf_dir, db = scale
    expected = db.sql(entry_module.library_sql()[name])
    result = entry_module.library_queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    expected_types = dict(zip(expected.columns, map(str, expected.types)))
    assert {n: SPARK_TYPES[t] for n, t in result.dtypes} == expected_types
    names = ", ".join(f'"{c}"' for c in columns)
    want = sorted(db.sql(f"SELECT {names} FROM ({entry_module.library_sql()[name]})").fetchall(), key=repr)
    got = sorted(map(tuple, result.select(*columns).collect()), key=repr)
    assert len(got) == len(want)
    assert got == want
