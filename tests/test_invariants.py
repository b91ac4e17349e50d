"""Fact invariants on the smoke tables: trace rows prove the fact cells, monthly
roll-ups equal daily sums, the version lookup never fans out."""

from pyspark.sql import functions as F

from conftest import SMOKE
from perron.plans import gold_facts as G
from perron.plans import traces as T
from perron.plans.silver_model import Silver
from perron.sources.fixtures import AS_OF


def _s(spark):
    return Silver.from_fixture(spark, SMOKE, materialize=False), G.Window_.days_back(AS_OF, 10)


def test_run_trace_sums_to_fact(spark):
    s, w = _s(spark)
    fact = G.run_daily(s, w)
    tr = T.run_daily_trace(s, fact).filter(F.col("in_fact") == "Y")
    keys = ["date_id", "from_station_id", "to_station_id", "type_valid_from", "status_code"]
    agg = tr.groupBy(*keys).agg(F.count(F.lit(1)).alias("runs_count"),
                                F.sum("terminal_delay").alias("sum_terminal_delay_min"))
    f = fact.groupBy(*keys).agg(F.sum("runs_count").alias("runs_count"),
                                F.sum("sum_terminal_delay_min").alias("sum_terminal_delay_min"))
    assert agg.exceptAll(f).count() == 0 and f.exceptAll(agg).count() == 0


def test_monthly_equals_daily(spark):
    s, w = _s(spark)
    daily = G.stop_daily(s, w)
    monthly = G.stop_monthly(daily)
    a = daily.agg(F.sum("arrivals_count"), F.sum("cancelled_count")).first()
    b = monthly.agg(F.sum("arrivals_count"), F.sum("cancelled_count")).first()
    assert tuple(a) == tuple(b)


def test_version_lookup_does_not_fan_out(spark):
    s, w = _s(spark)
    r = G.runs_in_window(s, w)
    assert G.with_type_version(r, s).count() == r.count()
    tt = G.train_types(s)
    assert tt.groupBy("category_code", "carrier_code").agg(
        F.sum((F.col("valid_to") == F.lit("2999-12-31").cast("date")).cast("int")).alias("n")
    ).filter("n > 1").count() == 0


def test_scd2_log_has_at_most_one_active_version_per_key(spark):
    from perron.queries import REGISTRY
    log = REGISTRY["d15_disruption_tracking_log"](spark, SMOKE)
    key = ["operating_date", "schedule_id", "train_order_id", "dsta_id", "sequence_number"]
    bad = log.groupBy(*key).agg(F.sum(F.col("is_active").cast("int")).alias("n")).filter("n > 1")
    assert bad.count() == 0


def test_recompute_is_idempotent(spark):
    from perron.queries import REGISTRY
    a = REGISTRY["c7_recompute_days"](spark, SMOKE)
    b = REGISTRY["g10_run_daily"](spark, SMOKE)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
