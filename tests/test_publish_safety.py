"""Publishing keeps what a load does not touch, and the change log keeps one active version a key."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from perron.operators import tableops as C
from perron.plans import jobs
from perron.plans import live as LV
from tests.conftest import SMOKE


@pytest.fixture(scope="module")
def silver(spark):
    from perron.queries import _silver as load
    return load(spark, SMOKE)


def count(spark, root, name="f_train_run_daily"):
    return {r["month"]: r["count"] for r in C.read_current(spark, root, name).groupBy("month").count().collect()}


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_second_load_keeps_untouched_months(spark, silver, tmp_path, scheme):
    root = f"{scheme}{tmp_path}/gold"
    jobs.run_daily(spark, silver, root, dt.date(2001, 7, 31), 20)
    first = count(spark, root)
    # a run that dies after staging leaves a version that nothing points to
    C.stage_version(spark, root, {"f_train_run_daily": C.read_current(spark, root, "f_train_run_daily").limit(1)}, {"f_train_run_daily": ["month"]})
    jobs.run_daily(spark, silver, root, dt.date(2001, 8, 2), 1)
    second = count(spark, root)
    assert first and len(second) > 1
    assert {m: second.get(m) for m in first if m < 200108} == {m: n for m, n in first.items() if m < 200108}


def test_a_load_writes_touched_months_only(spark, silver, tmp_path):
    from perron.operators.layer import manifest
    root = f"{tmp_path}/gold"
    jobs.run_daily(spark, silver, root, dt.date(2001, 7, 31), 20)
    before = manifest(spark, root)
    jobs.run_daily(spark, silver, root, dt.date(2001, 8, 2), 1)
    after = manifest(spark, root)
    dims = {"d_date", "d_hour", "d_station", "d_route", "d_train_type", "d_train_status", "d_disruption_cause"}
    assert set(after) == dims | set(jobs.DAILY) | set(jobs.MONTHLY)
    for name in [*jobs.DAILY, *jobs.MONTHLY]:
        old, new = (dict(map(tuple, m[name]["parts"])) for m in (before, after))
        assert "200107" in old and old["200107"] == new["200107"], name  # the same directory
        assert set(new) - set(old) <= {"200108"}


def test_missing_table_of_the_published_version_is_an_error(spark, silver, tmp_path):
    root = f"{tmp_path}/gold"
    vdir = jobs.run_daily(spark, silver, root, dt.date(2001, 7, 31), 5)
    os.rename(f"{vdir}/f_train_run_daily", f"{vdir}/elsewhere")
    with pytest.raises(Exception):
        jobs.run_daily(spark, silver, root, dt.date(2001, 8, 1), 5)


@pytest.mark.parametrize("hashes, ended", [(["h2", "h1"], None), (["h1"], 0)])
def test_one_active_version_a_key(spark, hashes, ended):
    cols = [*LV.DIS_LOG_KEY, "order_id", *LV.DIS_TRACKED]
    base = spark.range(1).select(*[F.lit("1").cast("bigint" if c.endswith("_id") or c in LV.DIS_LOG_KEY else "string").alias(c) for c in cols])
    log = base.select("*", F.lit("h1").alias("change_hash"), F.lit(True).alias("is_active"), F.lit("2001-01-01 00:00:00").cast("timestamp").alias("snapshot_ts"))
    ev = None
    for i, h in enumerate(hashes):
        row = base.select("*", F.lit(h).alias("change_hash"), F.lit(f"2001-01-01 0{i + 2}:00:00").cast("timestamp").alias("snapshot_ts"))
        ev = row if ev is None else ev.unionByName(row)
    end = base.select(*LV.DIS_LOG_KEY, F.lit("2001-01-01 01:00:00").cast("timestamp").alias("snapshot_ts")).where(F.lit(ended is not None))
    out = LV.scd2_apply(log, ev, end)
    assert [r["change_hash"] for r in out.where("is_active").collect()] == ["h1"]
    assert out.count() == 1 + len(hashes)
