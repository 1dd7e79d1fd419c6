"""Every query against its SQL in DuckDB, on the smallest tables: rows, names and values."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from ridewell.plans import catalog, oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f).removesuffix('.parquet')} AS SELECT * FROM '{f}'")
    return con


def plain(rows):
    return sorted(repr(tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    told = duck.sql(oracle.SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(told.columns)
    at = [told.columns.index(c) for c in cols]
    want = [tuple(r[i] for i in at) for r in told.fetchall()]
    assert plain([tuple(r[c] for c in cols) for r in df.collect()]) == plain(want)


def test_net_flow_is_zero_for_each_system(spark):
    rows = catalog.QUERIES["net_flow_zero"](spark, SF).collect()
    assert rows and all(r["net"] == 0 for r in rows)


def test_scans_are_pruned(spark):
    """The monthly counts are one pass over the written fact, of which they read three columns."""
    plan = catalog.QUERIES["trips_monthly"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ReadSchema: struct<trip_month:date,date_key:date,quality_flags:array<string>>" in plan
