"""Every registered query against DuckDB on the same tables."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from starfeed.operators import build_dimension, new_dimension_rows  # noqa: E402
from starfeed.registry import STORED_BEFORE  # noqa: E402
from starfeed.sources import testdata  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = canonical(result.fetchall(), columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == expected
    assert expected, "an oracle without rows proves nothing"


@pytest.mark.parametrize("probe", [10_000_000, 0])
def test_customers_found_by_probing(spark, duck, probe):
    """The way large tables go: keys first, then the rows by broadcast or by shuffle."""
    inputs = testdata.load(spark, SF_DIR, ["usuarios"])
    stored = build_dimension("dim_clientes", inputs).where(STORED_BEFORE["dim_clientes"])
    df = new_dimension_rows("dim_clientes", inputs, stored, ["cliente_id"], probe=probe, probe_rows=0)
    result = duck.execute(oracle_sql()["anti_new_customers"])
    columns = [d[0] for d in result.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


def test_entry(spark):
    assert not entry(spark).isEmpty()
