"""The silver load: one manifest, history untouched, nothing published on failure, gold on top."""

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from perron.operators.layer import Load, manifest, read_table
from perron.plans import silver_job as SJ
from tests.conftest import SMOKE

STAMP = "2026-01-02 06:00:00"


def _ops(date, order, status="C", name=None):
    doc = {"generatedAt": f"{date}T23:00:00Z", "pagination": {"page": 1}, "trains": [
        {"scheduleId": 1, "orderId": order, "trainOrderId": order, "operatingDate": date, "trainStatus": status,
         "stations": [{"stationId": 3, "plannedSequenceNumber": 1, "actualSequenceNumber": 1, "isConfirmed": True}]}]}
    return (name or f"operations_{date}_{order}.json", json.dumps(doc))


def _sched(dates, order):
    doc = {"generatedAt": "2026-01-01T00:00:00Z", "routes": [
        {"scheduleId": 1, "orderId": order, "trainOrderId": order, "name": "n", "carrierCode": "K", "nationalNumber": "1", "commercialCategorySymbol": "A",
         "operatingDates": dates, "stations": [{"orderNumber": 1, "stationId": 3}, {"orderNumber": 2, "stationId": 4}]}]}
    return (f"schedules_{order}_{dates[0]}.json", json.dumps(doc))


def _landing(spark, *docs):
    return spark.createDataFrame(list(docs), "object_name string, payload string")


def test_loads_add_and_keep(spark):
    root = tempfile.mkdtemp(prefix="perron-silver-")
    SJ.load_all(spark, {"operations": _landing(spark, _ops("2026-01-01", 1), _ops("2026-01-02", 2), ("bad.json", '{"trains": [')),
                        "schedules": _landing(spark, _sched(["2026-01-01", "2026-01-02"], 1), _sched(["2026-01-05"], 9))}, root, STAMP)
    before = manifest(spark, root)
    # the second load repeats a run, brings one of another day, and no longer has route 1 on the 2nd
    SJ.load_all(spark, {"operations": _landing(spark, _ops("2026-01-02", 2), _ops("2026-01-03", 3)),
                        "schedules": _landing(spark, _sched(["2026-01-01"], 1), _sched(["2026-01-02"], 2))}, root, STAMP)
    after, t = manifest(spark, root), SJ.published(spark, root)
    assert sorted((str(r.operating_date), r.order_id) for r in t["operation_header"].collect()) == [("2026-01-01", 1), ("2026-01-02", 2), ("2026-01-03", 3)]
    assert t["operation_details"].count() == 3 and t["schedule_details"].count() == 6
    assert sorted((str(r.operating_date), r.order_id, r.is_active) for r in t["schedule_header"].collect()) == [
        ("2026-01-01", 1, 1), ("2026-01-02", 1, 0), ("2026-01-02", 2, 1), ("2026-01-05", 9, 1)]
    assert [(r.feed, r.object_name, r.reason) for r in t["rejects"].collect()] == [("operations", "bad.json", "not a JSON object")]
    # directories of other days are the same, those of the rewritten days are new
    old, new = ({day: d for day, d in m["schedule_header"]["parts"]} for m in (before, after))
    assert old["2026-01-05"] == new["2026-01-05"] and old["2026-01-02"] != new["2026-01-02"]
    assert set(map(tuple, before["operation_header"]["parts"])) <= set(map(tuple, after["operation_header"]["parts"]))
    one = read_table(spark, root, after["operation_header"], (dt.date(2026, 1, 3), dt.date(2026, 1, 4)))
    assert len(one.inputFiles()) == 1 and one.count() == 1
    assert t["load_steps"].groupBy("load").count().count() == 2


def test_a_failed_load_publishes_nothing(spark):
    root = tempfile.mkdtemp(prefix="perron-silver-")
    SJ.load_all(spark, {"operations": _landing(spark, _ops("2026-01-01", 1))}, root, STAMP)
    before = manifest(spark, root)
    broken = _ops("2026-01-02", 2)[1].replace('"2026-01-02"', '"no date"')
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        SJ.load_all(spark, {"operations": _landing(spark, ("x.json", broken))}, root, STAMP)
    load = Load(spark, root)
    with pytest.raises(ValueError, match="1 of 2 rows have a null in code; nothing is published"):
        load.replace("def_carrier", spark.createDataFrame([("a",), (None,)], "code string"), ["code"])
    assert manifest(spark, root) == before


def test_gold_runs_on_the_load(spark):
    from perron import queries as Q
    from perron.operators import tableops as C
    from perron.plans import jobs
    root = tempfile.mkdtemp(prefix="perron-silver-")
    SJ.load_all(spark, Q._landings(Q._fx(spark, SMOKE)), f"{root}/silver", STAMP)
    s = SJ.as_silver(spark, f"{root}/silver")
    assert s.operation_details.count() == Q.REGISTRY["d11_operation_details"](spark, SMOKE).count()
    jobs.run_daily(spark, s, f"{root}/gold", Q.AS_OF, Q.FULL_DAYS)
    daily = C.read_current(spark, f"{root}/gold", "f_train_run_daily")
    runs = daily.agg(F.sum("runs_count")).first()[0]
    assert 0 < runs <= s.operation_header.count()
    assert C.read_current(spark, f"{root}/gold", "f_train_run_monthly").agg(F.sum("runs_count")).first()[0] == runs
    # the same facts as from the settled runs of the silver tables that the load stands for
    kept = s.operation_header.select("schedule_id", "order_id", "operating_date").collect()
    assert len(kept) == len(set(kept))


def test_facts_share_what_the_daily_job_stores(spark, tmp_path):
    from perron.plans import gold_facts as G
    from perron.plans.silver_model import Silver
    from perron.sources.fixtures import AS_OF
    s = Silver.from_fixture(spark, "/root/testdata/sf0.001")
    w, names = G.Window_.days_back(AS_OF, 2), []

    def store(name, df):
        names.append(name)
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    plain = [sorted(map(str, f(s, w).collect())) for f in (G.stop_daily, G.dep_daily, G.run_daily)]
    before = dict(s.extra)
    with G.stored(s, w, store):
        facts = [f(s, w) for f in (G.stop_daily, G.dep_daily, G.run_daily)]
        assert all("stop_lines" in f.inputFiles()[0] and len({p.rsplit("/", 2)[1] for p in f.inputFiles()}) == 1 for f in facts[:2])
    assert names == ["plan_ends", "typed_runs", "stop_lines"] and s.extra == before
    assert [sorted(map(str, f.collect())) for f in facts] == plain
