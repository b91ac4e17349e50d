"""A sample of registered queries against their DuckDB oracle on the smoke tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from conftest import SMOKE  # noqa: E402

SAMPLE = ["g10_run_daily", "g13_disruption_daily", "h4_punctuality_monthly", "c1_merge_upsert",
          "d10_operation_header", "e3_run_diff", "e5_disruption_diff", "a7_validate"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMOKE)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "on_time_pct" in df.columns


def test_every_query_has_oracle_or_is_listed():
    from oracle import all_sql
    from perron.queries import REGISTRY
    assert set(all_sql()) == set(REGISTRY)
    assert set(E.oracle_sql()) <= set(E.queries())
