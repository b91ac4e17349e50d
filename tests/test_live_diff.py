"""The reference's live-diff unit cases, re-expressed on DataFrames."""

import hashlib
import json

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.functions.canon import canonical_json
from perron.plans import live as LV
from perron.sources import files as A

ST = T.StructType([T.StructField("stationId", T.LongType()), T.StructField("plannedArrival", T.StringType()),
                   T.StructField("plannedDeparture", T.StringType()), T.StructField("actualArrival", T.StringType()),
                   T.StructField("actualDeparture", T.StringType()),
                   T.StructField("actualSequenceNumber", T.IntegerType()),
                   T.StructField("isConfirmed", T.BooleanType()), T.StructField("isCancelled", T.BooleanType())])
TRAIN = T.StructType([T.StructField("train_order_id", T.LongType()), T.StructField("operating_date", T.StringType()),
                      T.StructField("trainStatus", T.StringType()), T.StructField("stations", T.ArrayType(ST))])


def _py_canon(d):
    clean = {k: v for k, v in d.items() if v is not None and v is not False}
    return json.dumps(clean, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _train(spark, arr="10:00", confirmed=None, cancelled=None, status="N", tid=1):
    st = (60103, "10:00", None, arr, None, 3, confirmed, cancelled)
    return spark.createDataFrame([(tid, "2026-01-01", status, [st])], TRAIN)


def _hash(spark, df):
    return LV.with_run_hash(df, 60103)


def _diff(spark, prev, curr):
    return LV.diff_runs(_hash(spark, prev), _hash(spark, curr)).count()


def test_canonical_drops_null_and_false_keeps_zero(spark):
    df = spark.createDataFrame([(0, None, False)], "x int, y string, z boolean")
    txt = df.select(canonical_json({"x": F.col("x"), "y": F.col("y"), "z": F.col("z")},
                                   {"z": T.BooleanType()})).first()[0]
    assert txt == '{"x":0}'


def test_canonical_key_order_is_irrelevant(spark):
    df = spark.createDataFrame([(1, "a")], "b int, a string")
    t1 = df.select(canonical_json({"b": F.col("b"), "a": F.col("a")})).first()[0]
    t2 = df.select(canonical_json({"a": F.col("a"), "b": F.col("b")})).first()[0]
    assert t1 == t2 == '{"a":"a","b":1}'


def test_canonical_bytes_equal_python_json(spark):
    rows = [(0, None, False, "", "zażółć/\"q\"", True)]
    df = spark.createDataFrame(rows, "x int, y string, z boolean, e string, u string, t boolean")
    types = {"z": T.BooleanType(), "t": T.BooleanType()}
    r = df.select(canonical_json({c: F.col(c) for c in df.columns}, types).alias("j"),
                  LV.change_hash({c: F.col(c) for c in df.columns}, types).alias("h")).first()
    expect = _py_canon(dict(zip(df.columns, rows[0])))
    assert r.j == expect
    assert r.h == hashlib.sha256(expect.encode()).hexdigest()


def test_new_run_is_emitted(spark):
    prev = spark.createDataFrame([], TRAIN)
    assert _diff(spark, prev, _train(spark)) == 1


def test_unchanged_run_is_not_emitted(spark):
    assert _diff(spark, _train(spark), _train(spark)) == 0


def test_final_previous_is_frozen(spark):
    assert _diff(spark, _train(spark, confirmed=True), _train(spark, arr="10:05", confirmed=True)) == 0


def test_changed_non_final_is_emitted(spark):
    assert _diff(spark, _train(spark), _train(spark, arr="10:05")) == 1


def test_flag_absent_equals_false(spark):
    a = _hash(spark, _train(spark, confirmed=None)).first().change_hash
    b = _hash(spark, _train(spark, confirmed=False)).first().change_hash
    assert a == b


def test_station_falls_back_to_first(spark):
    st = (1, None, None, "09:00", None, 1, None, None)
    df = spark.createDataFrame([(1, "2026-01-01", "N", [st])], TRAIN)
    assert _hash(spark, df).first().change_hash is not None


DIS = "schedule_id bigint, order_id bigint, train_order_id bigint, operating_date string, dsta_id bigint, " \
      "sequence_number int, disruption_type_code string, message string, pos int"


def _dis(spark, rows):
    return LV.flatten_disruptions(spark.createDataFrame(rows, DIS), ["pos"])


def _row(tc="T1", msg="m", date="2026-01-02", pos=0):
    return (1, 2, 3, date, 4, 5, tc, msg, pos)


def test_disruption_new_same_message_type(spark):
    base = _dis(spark, [_row()])
    assert LV.diff_disruptions(base.limit(0), base)[0].count() == 1
    assert LV.diff_disruptions(base, _dis(spark, [_row()]))[0].count() == 0
    assert LV.diff_disruptions(base, _dis(spark, [_row(msg="m2")]))[0].count() == 1
    assert LV.diff_disruptions(base, _dis(spark, [_row(tc="T2")]))[0].count() == 1


def test_disruption_tombstone_respects_min_date(spark):
    prev = _dis(spark, [_row(date="2026-01-02")])
    curr = prev.limit(0)
    assert LV.diff_disruptions(prev, curr, "2026-01-01")[1].count() == 1
    assert LV.diff_disruptions(prev, curr, "2026-01-03")[1].count() == 0


def test_disruption_duplicate_key_last_wins(spark):
    flat = _dis(spark, [_row(msg="first", pos=0), _row(msg="last", pos=1)])
    assert flat.count() == 1 and flat.first().message == "last"


def test_lag_parsing(spark):
    df = spark.createDataFrame([(None,), ("not a date",), ("2020-01-01T00:00:00Z",)], "g string")
    out = df.select(LV.lag_seconds(F.col("g"), F.lit("2026-01-01 00:00:00").cast("timestamp")).alias("l")).collect()
    assert out[0].l is None and out[1].l is None and out[2].l > 0


def test_state_gating_by_outcome(spark):
    df = spark.createDataFrame([("OK", True), ("OK", False), ("EMPTY", False), ("STALE", True), ("ERR", True)],
                               "o string, sink boolean")
    got = [r.a for r in df.select(LV.state_may_advance(F.col("o"), F.col("sink")).alias("a")).collect()]
    assert got == [True, False, True, False, False]


def test_outcome(spark):
    df = spark.createDataFrame([(3, False, None), (0, False, None), (1, True, None), (1, False, "boom")],
                               "n int, stale boolean, err string")
    got = [r.o for r in df.select(LV.outcome(F.col("n"), F.col("stale"), F.col("err")).alias("o")).collect()]
    assert got == ["OK", "EMPTY", "STALE", "ERR"]


PAGES = "run_ts string, page int, valid boolean, has_next boolean, generated_at string, trains array<int>"


def test_two_pages_stitched_with_stamp_of_page_one(spark):
    pages = spark.createDataFrame([("r", 1, True, True, "t1", [1, 2]), ("r", 2, True, False, "t2", [3])], PAGES)
    rows = A.stitch_pages(pages).collect()
    assert sorted(r.train for r in rows) == [1, 2, 3]
    assert {r.snapshot_generated_at for r in rows} == {"t1"}


def test_bad_page_drops_snapshot(spark):
    pages = spark.createDataFrame([("r", 1, True, True, "t1", [1]), ("r", 2, False, False, "t2", [3])], PAGES)
    assert A.stitch_pages(pages).count() == 0


def test_missing_last_page_drops_snapshot(spark):
    pages = spark.createDataFrame([("r", 1, True, True, "t1", [1])], PAGES)
    assert A.stitch_pages(pages).count() == 0


def test_stale_snapshot_is_skipped(spark):
    df = spark.createDataFrame([Row(generated_at="2026-01-01 10:00:00")]).select(
        F.col("generated_at").cast("timestamp").alias("generated_at"))
    assert LV.not_stale(df, "2026-01-01 10:00:00").count() == 0
    assert LV.not_stale(df, "2026-01-01 09:59:00").count() == 1
