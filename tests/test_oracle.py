"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check_results import rows_of


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in sorted(Path(contract.SMALL).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


OWN = set(contract.queries()) - set(contract._optional()[0])


def test_every_query_has_its_sql():
    assert set(contract.oracle_sql()) >= OWN
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if n in OWN])
def test_query(spark, database, name):
    df = contract.queries()[name](spark, contract.SMALL)
    got = rows_of(df.columns, df.collect())
    result = database.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "month_start", "gmv", "total_orders", "prev_month_gmv", "mom_growth_pct"
    ]
    assert df.count() > 0
