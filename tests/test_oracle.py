"""Every registered query against its DuckDB oracle SQL (sf0.001), exactly:
same column names, same column types, same rows (order-insensitive)."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_of, spark_to_duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", [*sorted(E.QUERIES), *sorted(E.STATE_QUERIES)])
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert {f.name: spark_to_duck(f.dataType) for f in sdf.schema.fields} == dict(
        zip(rel.columns, (str(t) for t in rel.types)))
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(rel.columns, rel.fetchall())
