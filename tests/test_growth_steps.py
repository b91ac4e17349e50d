"""Shared steps whose cost grew faster than the input: shuffles, groupings, parts of tables, listings and repeated derivations."""

import datetime as dt

from pyspark.sql import functions as F

from perron import queries as Q
from perron import session
from perron.functions.ordered import top1
from perron.operators import shred
from perron.operators.layer import Load
from perron.plans import live as LV
from perron.plans import reports as H
from perron.plans import silver_job as SJ
from perron.plans.silver_model import Silver
from perron.sources import files as A
from perron.sources import payloads as P
from perron.sources.fixtures import Fixture


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark, tmp_path):
    """Three runs; one line comes twice, one run has a single line."""
    rows = [(1, 10, 3, 1), (1, 11, 4, 2), (1, 9, 5, 2), (2, 7, 13, 3), (7, 5, 2, 1), (7, 6, 3, 5)]
    lines = [(k, p, s, n, 21.0, 100.0, 0.05, 0.02, "R" if p % 2 else "N", "F") for k, p, s, n in rows]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                                 "l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 1, "F", "1-URGENT") for k in (1, 2, 7)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "BUILDING")], "c_custkey bigint, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    return Fixture(spark, str(tmp_path))


def test_shuffle_partitions_follow_the_input_and_never_fall(spark, tmp_path, monkeypatch):
    key, old = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    try:
        session.size_shuffles(spark, [f"{tmp_path}/t", f"{tmp_path}/missing"])
        assert spark.conf.get(key) == old
        monkeypatch.setattr(session, "PARTITION_BYTES", 100)
        session.size_shuffles(spark, [f"{tmp_path}/t"])
        assert int(spark.conf.get(key)) > int(old)
    finally:
        spark.conf.set(key, old)


def test_plan_stops_take_one_shuffle_until_they_are_stored(spark, tmp_path):
    plan = _lines(spark, tmp_path).schedule_details()
    stored = plan.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "order_id")
    assert _physical(stored).count("Exchange") == 1
    got = {(r.order_id, r.order_number): (r.dsta_id, r.arrival_time is None, r.departure_time is None) for r in plan.collect()}
    assert got == {(1, 1): (3, True, False), (1, 2): (5, False, True), (2, 3): (3, True, True), (7, 1): (2, True, False), (7, 5): (3, False, True)}


def test_a_filter_on_keys_comes_before_the_grouping(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 2, "a"), (1, 1, "c"), (2, 9, None), (None, 5, "x")], "k int, at int, v string")
    one = top1(df, ["k"], [("at", "desc"), "v"])
    assert sorted(one.collect(), key=str) == sorted([(1, 2, "a"), (2, 9, None), (None, 5, "x")], key=str) and one.columns == ["k", "at", "v"]
    plan = one.filter(F.col("k") == 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Filter") if "Filter" in plan else "LocalRelation" in plan
    assert top1(df.select("k"), ["k"], ["k"]).count() == 3


def test_rows_of_one_key_are_written_by_several_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        load = Load(spark, f"{tmp_path}/layer")
        load.append("t", spark.range(500).select(F.lit(200107).alias("month"), "id"), ["month"], "month")
        load.publish()
    finally:
        spark.conf.set(key, old)
    t = load.table("t", "")
    assert t.count() == 500 and len(t.inputFiles()) > 1


def test_only_the_listed_days_are_listed(spark, tmp_path):
    for day in ("20260101", "20260102", "20260103"):
        d = tmp_path / "daily" / "data" / "operations" / f"date={day}"
        d.mkdir(parents=True)
        (d / "a.json").write_text("{}")
    days = A.listing_dates(dt.date(2026, 1, 3))
    found = A.scan_documents(spark, str(tmp_path), "data", "operations", days)
    assert len(found.inputFiles()) == 2 and found.count() == 2
    assert A.scan_documents(spark, str(tmp_path), "data", "operations", ["20300101"]) is None


def test_a_feed_is_made_once_a_load(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def page(name):
        made.add(1)
        return '{"generatedAt": "2026-01-01T00:00:00Z", "trainStatuses": {"C": "done"}}' if name == "good" else "{"

    docs = spark.createDataFrame([("good",), ("bad",)], "object_name string").withColumn("payload", F.udf(page, "string")("object_name"))
    SJ.load_all(spark, {"train_statuses": docs}, f"{tmp_path}/layer", "2026-01-02 00:00:00")
    assert made.value == 2
    t = SJ.published(spark, f"{tmp_path}/layer")
    assert [r.object_name for r in t["rejects"].collect()] == ["bad"] and [r.code for r in t["def_train_status"].collect()] == ["C"]
    assert [r.reason for r in shred.checked(docs, "train_statuses").orderBy("object_name").collect()] == ["not a JSON object", None]


def test_pages_of_two_fetches_are_made_once(spark, tmp_path):
    fx = _lines(spark, tmp_path)
    both = P.operations_landing(fx, "050000", "060000")
    assert _plan(both).count("lineitem.parquet") + _plan(both).count("l_orderkey#") < 2 * (_plan(P.operations_landing(fx)).count("lineitem.parquet") + _plan(P.operations_landing(fx)).count("l_orderkey#"))
    alone = P.operations_landing(fx, "050000").unionByName(P.operations_landing(fx))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, alone.collect())) and both.count() == 6


def test_scan_tasks_are_bounded_unless_the_submitter_says_otherwise(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        session.size_shuffles(spark, [])
        assert spark.conf.get(key) == str(session.SCAN_BYTES)
        spark.conf.set(key, "64m")
        session.size_shuffles(spark, [])
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def test_names_of_files_are_read_after_the_pages_are_grouped(spark):
    # names made from groups of rows, as the pages of a feed are
    days = spark.createDataFrame([("20260102", h, k) for h in ("050000", "060000") for k in range(6)] + [("20260103", "050000", 1), (None, None, 1)], "d string, h string, k int")
    pages = days.groupBy("d", "h", (F.col("k") % 2).alias("page")).agg(F.collect_list("k").alias("ks"))
    stem = F.concat(F.lit("daily/data/operations/date="), "d", F.lit("/operations_20260101_"), "d", "h", F.format_string("_p%03d.json", F.col("page") + 1))
    found = A.latest_run(pages.select(stem.alias("object_name"), F.size("ks").alias("n")))
    got = sorted((r.object_name[-24:], r.n) for r in found.collect())
    assert got == [("_20260102060000_p001.json"[-24:], 3), ("_20260102060000_p002.json"[-24:], 3), ("_20260103050000_p002.json"[-24:], 1)] and found.columns == ["object_name", "n"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract" in line]


def _parts(spark, tmp_path):
    fx = _lines(spark, tmp_path)
    spark.createDataFrame([(k, f"TYPE {k % 2}") for k in range(20)], "p_partkey bigint, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k, f"S{k}", 1) for k in range(20)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    return fx


def test_disruption_rows_are_made_once_for_header_and_details(spark, tmp_path):
    fx = _parts(spark, tmp_path)
    s = Silver.from_fixture(spark, str(tmp_path))
    for name in ("disruption_header", "disruption_details"):
        assert sorted(map(str, getattr(s, name).collect())) == sorted(map(str, getattr(fx, name)().collect()))
    inputs = s.extra["fixture"].disruption_details().inputFiles()
    assert inputs and not [f for f in inputs if "lineitem" in f] and s.disruption_details.count() == 4


def test_the_run_is_looked_up_before_its_stops_in_the_route_report(spark, tmp_path):
    _parts(spark, tmp_path)
    s = Silver.from_fixture(spark, str(tmp_path))
    out = H.run_route(s)
    got = sorted((r.ophe_id, r.actual_sequence, r.relation, r.train_name) for r in out.collect())
    assert got == [(1, 1, "S3 -> S4", "Pociag 1"), (1, 2, "S3 -> S4", "Pociag 1"), (1, 3, "S3 -> S4", "Pociag 1"),
                   (2, 1, "S3 -> S3", "Pociag 2"), (7, 1, "S2 -> S3", "Pociag 7"), (7, 2, "S2 -> S3", "Pociag 7")]
    # from the top: plan stops, stations and stops are joined to runs that have their labels (a left join) already
    joins = [line.split("Join ")[1].split(",")[0].split()[0] for line in out._jdf.queryExecution().analyzed().toString().splitlines() if "Join " in line]
    assert joins[:4] == ["LeftOuter", "Inner", "Inner", "LeftOuter"]


def test_pages_of_runs_take_one_shuffle(spark, tmp_path):
    fx = _lines(spark, tmp_path)
    for landing in (P.schedules_landing, P.operations_landing):
        assert _physical(landing(fx)).count("Exchange hashpartitioning") == 1
    trains = shred.operations_rows(shred.parse(P.operations_landing(fx), "operations"))
    assert sorted((r.order_id, r.actual_sequence, r.planned_sequence, r.dsta_id) for r in trains.collect()) == [(1, 1, 1, 3), (1, 2, 2, 5), (1, 3, 2, 4), (2, 1, 3, 3), (7, 1, 1, 2), (7, 2, 5, 3)]
    stops = shred.schedule_stops(shred.parse(P.schedules_landing(fx), "schedules"))
    got = {(r.order_id, r.order_number): (r.dsta_id, r.arrival_time is None, r.departure_time is None) for r in stops.collect()}
    assert got == {(1, 1): (3, True, False), (1, 2): (5, False, True), (2, 3): (3, True, True), (7, 1): (2, True, False), (7, 5): (3, False, True)}


def test_top1_carries_the_columns_it_orders_by_once(spark):
    df = spark.createDataFrame([(1, 2, "b", "long"), (1, 2, "a", "long"), (None, 5, "x", None)], "k int, at int, v string, w string")
    out = top1(df, ["k"], [("at", "desc"), "v"])
    assert _plan(out).split("min(struct(")[1].split("))")[0].count("v#") == 1
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2, "a", "long"), (None, 5, "x", None)]


def test_a_filter_on_the_key_comes_before_the_log_is_made(spark):
    ev = spark.createDataFrame([(dt.date(2001, 7, 24), 1, None, s, 1, 9, "T", "m", h, dt.datetime(2001, 7, 24, hour), k) for s, h, hour, k in
                                [(3, "a", 6, "C"), (3, "b", 7, "C"), (4, "a", 6, "C"), (4, None, 7, "E")]],
                               "operating_date date, schedule_id bigint, train_order_id bigint, dsta_id bigint, sequence_number int, order_id bigint, "
                               "disruption_type_code string, message string, change_hash string, snapshot_ts timestamp, _kind string")
    log = LV.scd2_events(spark.createDataFrame([], Q.DLOG_DDL), ev)
    assert sorted((r.dsta_id, r.change_hash, r.is_active) for r in log.collect()) == [(3, "a", False), (3, "b", True), (4, "a", False)]
    plan = log.where("dsta_id = 3")._jdf.queryExecution().optimizedPlan().toString()
    assert "= 3" in plan[plan.rindex("Window ["):]


def test_disruption_events_take_no_join(spark, monkeypatch):
    def rows(fx):
        r = [(dt.date(2001, 7, d), 1, 5, 5, dt.date(2001, 7, 24), 3, 1, "T", m, 1) for d, m in [(24, "m"), (25, "m"), (26, "n"), (28, "n")]]
        r += [(dt.date(2001, 7, 24), 1, 6, None, dt.date(2001, 7, 26), 3, 1, None, "z", 2)]
        return spark.createDataFrame(r, "snapshot_day date, schedule_id bigint, order_id bigint, train_order_id bigint, operating_date date, dsta_id bigint, "
                                        "sequence_number int, disruption_type_code string, message string, disruption_id bigint")
    monkeypatch.setattr(Q, "_fx", lambda *a: None)
    monkeypatch.setattr(Q.LF, "disruption_snapshot_rows", rows)
    ev = Q._dis_events(spark, "")
    got = sorted((r.snapshot_day.day, r.order_id, r.kind, r.change_hash is None) for r in ev.collect())
    assert got == [(24, 5, "changed", False), (24, 6, "changed", False), (25, 6, "ended", True), (26, 5, "changed", False), (28, 5, "changed", False)]
    assert "Join" not in _plan(ev)
