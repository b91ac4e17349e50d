"""Write operators: idempotency, no-op skip, SCD2 invariants, flag window."""

from pyspark.sql import functions as F

from perron.operators import tableops as C
from perron.plans import live as LV

STAMP0, STAMP1 = "2026-01-01 00:00:00", "2026-01-02 00:00:00"


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_is_idempotent_and_skips_noops(spark):
    t = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, v string, w int").withColumn(
        "loaded_at", F.lit(STAMP0).cast("timestamp"))
    s = spark.createDataFrame([(1, "a", None), (2, "B", 5), (3, "c", 1)], "k int, v string, w int")
    once, ch = C.merge_upsert(t, s, ["k"], ["v", "w"], STAMP1)
    twice, ch2 = C.merge_upsert(once, s, ["k"], ["v", "w"], STAMP1)
    assert _sorted(once) == _sorted(twice)
    assert sorted((r.k, r.op) for r in ch.collect()) == [(2, "U"), (3, "I")]
    assert ch2.count() == 0
    # the null-equal row kept its old stamp
    assert once.filter("k = 1").first().loaded_at.strftime("%Y-%m-%d") == "2026-01-01"


def test_audit_only_changed_columns(spark):
    t = spark.createDataFrame([(1, "a", 1, STAMP0)], "k int, v string, w int, loaded_at string").withColumn(
        "loaded_at", F.col("loaded_at").cast("timestamp"))
    s = spark.createDataFrame([(1, "b", 1)], "k int, v string, w int")
    _, ch = C.merge_upsert(t, s, ["k"], ["v", "w"], STAMP1)
    a = C.audit_changes(ch, "t", ["k"], ["v", "w"], STAMP1).collect()
    assert [(r.column_name, r.old_value, r.new_value) for r in a] == [("v", "a", "b")]


def test_insert_new_twice_gives_nothing_new(spark):
    t = spark.createDataFrame([], "k int, v string, w int")
    b = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", None)], "k int, v string, w int")
    new = C.insert_new(t, b, ["k"], order_by=[("w", "desc")])
    assert _sorted(new) == [(1, "y", 2), (2, "z", None)]
    assert C.insert_new(t.unionByName(new), b, ["k"], order_by=["v"]).count() == 0


def test_sync_flag_window_and_empty_batch(spark):
    t = spark.createDataFrame([("2026-01-01", 1, 1), ("2026-01-02", 2, 1), ("2026-01-05", 3, 1)],
                              "d string, k int, is_active int").withColumn("d", F.col("d").cast("date"))
    b = spark.createDataFrame([("2026-01-01", 1), ("2026-01-03", 9)], "d string, k int").withColumn(
        "d", F.col("d").cast("date"))
    out = {r.k: r.is_active for r in C.sync_flag(t, b, ["d", "k"], "d").collect()}
    assert out == {1: 1, 2: 0, 3: 1}
    empty = b.limit(0)
    assert _sorted(C.sync_flag(t, empty, ["d", "k"], "d")) == _sorted(t)


def test_deactivate_missing(spark):
    t = spark.createDataFrame([(1, True), (2, True)], "id int, is_active boolean")
    out = {r.id: r.is_active for r in C.deactivate_missing(t, spark.createDataFrame([(1,)], "id int"),
                                                           ["id"]).collect()}
    assert out == {1: True, 2: False}


def test_assign_ids_stable(spark):
    ex = spark.createDataFrame([(1, "a")], "id bigint, n string")
    cand = spark.createDataFrame([("a",), ("c",), ("b",)], "n string")
    out = dict((r.n, r.id) for r in C.assign_ids(ex, cand, ["n"]).collect())
    assert out == {"a": 1, "b": 2, "c": 3}


DLOG = ("operating_date date, schedule_id bigint, train_order_id bigint, dsta_id bigint, sequence_number int, "
        "order_id bigint, disruption_type_code string, message string, change_hash string, is_active boolean, "
        "snapshot_ts timestamp")
EV = ("operating_date date, schedule_id bigint, train_order_id bigint, dsta_id bigint, sequence_number int, "
      "order_id bigint, disruption_type_code string, message string, change_hash string, snapshot_ts timestamp")


def _events(spark, rows):
    return spark.createDataFrame(rows, EV)


def test_scd2_one_active_version_per_key(spark):
    import datetime as dt
    d = dt.date(2026, 1, 1)
    t = [dt.datetime(2026, 1, 1, h) for h in range(4)]
    changed = _events(spark, [(d, 1, None, 3, 4, 9, "T", "a", "h1", t[0]), (d, 1, None, 3, 4, 9, "T", "b", "h2", t[1]),
                              (d, 1, None, 3, 4, 9, "T", "b", "h2", t[2])])
    ended = _events(spark, []).drop("order_id", "disruption_type_code", "message", "change_hash")
    log = LV.scd2_apply(spark.createDataFrame([], DLOG), changed, ended)
    rows = log.collect()
    assert len(rows) == 2 and sum(r.is_active for r in rows) == 1
    assert [r.change_hash for r in rows if r.is_active] == ["h2"]
    # ended later: nothing stays active; applying again changes nothing
    ended2 = spark.createDataFrame([(d, 1, None, 3, 4, t[3])], "operating_date date, schedule_id bigint, "
                                   "train_order_id bigint, dsta_id bigint, sequence_number int, snapshot_ts timestamp")
    log2 = LV.scd2_apply(log, changed.limit(0), ended2)
    assert sum(r.is_active for r in log2.collect()) == 0
    log3 = LV.scd2_apply(log2, changed.limit(0), ended2)
    assert _sorted(log3) == _sorted(log2)


def test_append_versions_is_replay_safe(spark):
    import datetime as dt
    ddl = ("operating_date date, schedule_id bigint, order_id bigint, train_order_id bigint, dsta_id bigint, "
           "change_hash string, snapshot_ts timestamp")
    d = dt.date(2026, 1, 1)
    b = spark.createDataFrame([(d, 1, 1, None, 5, "h", dt.datetime(2026, 1, 1, 1)),
                               (d, 1, 1, None, 5, "h", dt.datetime(2026, 1, 1, 2))], ddl)
    log = spark.createDataFrame([], ddl)
    new = LV.append_versions(log, b)
    assert new.count() == 1
    assert LV.append_versions(log.unionByName(new.select(*log.columns)), b).count() == 0
