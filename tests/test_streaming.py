"""Live operations stream: snapshots in order, frozen finals, replay safety."""

import json
import os
import tempfile

from perron.streaming.live_stream import start_operations_stream


def _snap(path, ts, trains):
    with open(path, "w") as f:
        json.dump({"generatedAt": ts, "pagination": {"page": 1, "hasNextPage": False}, "trains": trains}, f)


def _train(tid, arr, confirmed=False):
    return {"scheduleId": 1, "orderId": tid, "trainOrderId": tid, "operatingDate": "2026-01-01",
            "trainStatus": "N", "stations": [{"stationId": 7, "plannedSequenceNumber": 1, "actualSequenceNumber": 1,
                                              "actualArrival": arr, "isConfirmed": confirmed}]}


def test_operations_stream_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="perron-live-")
    src, out, ck = os.path.join(root, "in"), os.path.join(root, "out"), os.path.join(root, "ck")
    os.makedirs(src)
    _snap(f"{src}/s1.json", "2026-01-01T10:00:00Z", [_train(1, "2026-01-01T10:00:00Z"), _train(2, "x", True)])
    _snap(f"{src}/s2.json", "2026-01-01T10:03:00Z", [_train(1, "2026-01-01T10:02:00Z"), _train(2, "y", True)])
    q = start_operations_stream(spark, src, out, ck, 7, {"availableNow": True})
    q.awaitTermination(300)
    log = spark.read.parquet(f"{out}/operation_tracking_log")
    # run 1: new, then changed; run 2: new, then frozen (final)
    assert sorted((r.train_order_id, r.snapshot_ts.minute) for r in log.collect()) == [(1, 0), (1, 3), (2, 0)]
    # a stale snapshot (not newer than the state) adds nothing
    _snap(f"{src}/s3.json", "2026-01-01T10:01:00Z", [_train(1, "2026-01-01T10:09:00Z")])
    q = start_operations_stream(spark, src, out, ck, 7, {"availableNow": True})
    q.awaitTermination(300)
    assert spark.read.parquet(f"{out}/operation_tracking_log").count() == 3
    hb = spark.read.parquet(f"{out}/heartbeat").collect()
    assert {r.outcome for r in hb} >= {"OK"}


def _dsnap(path, ts, rows):
    dis = [{"disruptionId": i, "disruptionTypeCode": tc, "message": m,
            "affectedRoutes": [{"scheduleId": 1, "orderId": 5, "trainOrderId": 5, "operatingDate": "2026-01-01",
                                "stationId": st, "sequenceNumber": 1}]} for i, (st, tc, m) in enumerate(rows)]
    with open(path, "w") as f:
        json.dump({"generatedAt": ts, "disruptions": dis}, f)


def test_disruptions_stream_scd2(spark):
    from perron.streaming.live_stream import start_disruptions_stream
    root = tempfile.mkdtemp(prefix="perron-dlive-")
    src, out, ck = os.path.join(root, "in"), os.path.join(root, "out"), os.path.join(root, "ck")
    os.makedirs(src)
    _dsnap(f"{src}/s1.json", "2026-01-01T10:00:00Z", [(7, "T1", "a"), (8, "T1", "b")])
    _dsnap(f"{src}/s2.json", "2026-01-01T10:03:00Z", [(7, "T1", "a2")])     # 7 changed, 8 ended
    q = start_disruptions_stream(spark, src, out, ck, {"availableNow": True})
    q.awaitTermination(300)
    from perron.streaming.live_stream import _latest_state
    log = _latest_state(spark, f"{out}/disruption_tracking_log").collect()
    active = sorted((r.dsta_id, r.message) for r in log if r.is_active)
    assert active == [(7, "a2")]
    assert len(log) == 3


def test_replayed_batch_changes_nothing(spark):
    """A batch that runs again reads what its first run read: log and state stay as they were."""
    from perron.streaming.live_stream import _latest_state, disruptions_batch
    root = tempfile.mkdtemp(prefix="perron-replay-")
    os.makedirs(f"{root}/in")
    _dsnap(f"{root}/in/s1.json", "2026-01-01T10:00:00Z", [(7, "T1", "a"), (8, "T1", "b")])
    _dsnap(f"{root}/in/s2.json", "2026-01-01T10:03:00Z", [(7, "T1", "a2")])
    paths = f"{root}/log", f"{root}/state", f"{root}/heartbeat"
    seen = []
    for batch, name in ((0, "s1"), (1, "s2"), (1, "s2"), (1, "s2")):
        disruptions_batch(spark, spark.read.option("wholetext", True).text(f"{root}/in/{name}.json"), batch, *paths)
        seen.append(sorted(map(str, _latest_state(spark, paths[0]).collect())))
    assert seen[1] == seen[2] == seen[3] and len(seen[1]) == 3


def test_runs_that_leave_the_window_are_not_ended(spark):
    """Yesterday's rows that are gone from today's snapshot merely age out and stay active."""
    from perron.streaming.live_stream import _latest_state, disruptions_batch
    root = tempfile.mkdtemp(prefix="perron-window-")
    os.makedirs(f"{root}/in")
    _dsnap(f"{root}/in/s1.json", "2026-01-01T23:58:00Z", [(7, "T1", "a")])
    _dsnap(f"{root}/in/s2.json", "2026-01-02T00:02:00Z", [])
    paths = f"{root}/log", f"{root}/state", f"{root}/heartbeat"
    for batch, name in ((0, "s1"), (1, "s2")):
        disruptions_batch(spark, spark.read.option("wholetext", True).text(f"{root}/in/{name}.json"), batch, *paths)
    assert [r.is_active for r in _latest_state(spark, paths[0]).collect()] == [True]


def _page(run_ts, page, gen, trains, more, cut=None):
    import json as j
    text = j.dumps({"generatedAt": gen, "pagination": {"page": page, "hasNextPage": more}, "trains": trains})
    return (f"live/operations/date={run_ts[:8]}/operations_{run_ts[:8]}_{run_ts}_p{page:03d}.json", text[:cut])


def _run(spark, root, batches, **kw):
    from perron.streaming.live_stream import operations_batch
    for bid, pages in batches:
        operations_batch(spark, spark.createDataFrame(pages, "object_name string, payload string"), bid, root, 7, now="2026-01-01 12:00:00", **kw)


def _beats(spark, root):
    return sorted((str(r.run_ts), r.outcome, r.delta_count) for r in spark.read.parquet(f"{root}/heartbeat").collect())


def _logged(spark, root):
    from perron.streaming.live_stream import read_log
    return sorted((r.train_order_id, r.snapshot_ts.strftime("%H:%M")) for r in read_log(spark, root).collect())


A, B, C, D = "20260101100000", "20260101100300", "20260101100600", "20260101130000"


def test_pages_of_a_fetch_arrive_in_two_batches(spark):
    root = tempfile.mkdtemp(prefix="perron-pages-")
    first = [_page(A, 1, "2026-01-01T10:00:00Z", [_train(1, None)], True)]
    second = [_page(A, 2, "2026-01-01T10:00:09Z", [_train(2, None)], False)]
    _run(spark, root, [(0, first)])
    assert _beats(spark, root) == [] and _logged(spark, root) == []
    _run(spark, root, [(1, second), (1, second), (2, [_page(B, 1, "2026-01-01T10:03:00Z", [_train(1, None), _train(2, None)], False)])])
    # one snapshot with the first page's stamp; the batch that ran again added no row
    assert _beats(spark, root) == [(A, "OK", 2), (B, "EMPTY", 0)]
    assert _logged(spark, root) == [(1, "10:00"), (2, "10:00")]


def test_bad_or_missing_page_drops_the_snapshot(spark):
    root = tempfile.mkdtemp(prefix="perron-bad-")
    _run(spark, root, [(0, [_page(A, 1, "2026-01-01T10:00:00Z", [_train(1, None)], True), _page(B, 1, "2026-01-01T10:03:00Z", [_train(1, None)], True)]),
                       (1, [_page(A, 2, "2026-01-01T10:00:09Z", [_train(2, None)], False, 40)]),
                       (2, [_page(A, 3, "2026-01-01T10:00:19Z", [_train(3, None)], False), _page(C, 1, "2026-01-01T09:59:00Z", [_train(4, None)], False)]),
                       (3, [_page(D, 1, "2026-01-01T09:00:00Z", [_train(5, None)], False)])])
    # A: a page is cut off, B: never whole and expired by D, C: sound, D: an older stamp than C's
    assert _beats(spark, root) == [(A, "ERR", 0), (B, "ERR", 0), (C, "OK", 1), (D, "STALE", 0)]
    assert _logged(spark, root) == [(4, "09:59")]
    errors = {str(r.run_ts): r.error for r in spark.read.parquet(f"{root}/heartbeat").collect()}
    assert errors == {A: "page 2: not a JSON object", B: "pages missing", C: None, D: None}


def test_failing_sink_keeps_the_state(spark):
    from perron.streaming.live_stream import append_log
    root = tempfile.mkdtemp(prefix="perron-sink-")

    def broken(*_):
        raise OSError("disk full")

    one, two = _train(1, None), _train(2, None)
    _run(spark, root, [(0, [_page(A, 1, "2026-01-01T10:00:00Z", [one], False)])])
    _run(spark, root, [(1, [_page(B, 1, "2026-01-01T10:03:00Z", [one], False), _page(C, 1, "2026-01-01T10:06:00Z", [one, two], False)])], sink=broken)
    assert _beats(spark, root) == [(A, "OK", 1), (B, "EMPTY", 0), (C, "ERR", 0 + 1)] and _logged(spark, root) == [(1, "10:00")]
    # the state stands at B: the next fetch brings train 2 again
    _run(spark, root, [(2, [_page(D, 1, "2026-01-01T13:00:00Z", [one, two], False)])], sink=append_log)
    assert _beats(spark, root)[-1] == (D, "OK", 1) and _logged(spark, root) == [(1, "10:00"), (2, "13:00")]


def test_disruption_file_that_is_no_json_is_an_error(spark):
    from perron.streaming.live_stream import disruptions_batch
    root = tempfile.mkdtemp(prefix="perron-derr-")
    batch = spark.createDataFrame([("live/disruptions/d1.json", '{"generatedAt": "2026-01-01T10:00:00Z", "disru')], "object_name string, payload string")
    disruptions_batch(spark, batch, 0, f"{root}/log", f"{root}/state", f"{root}/heartbeat")
    assert [(r.run_ts, r.outcome) for r in spark.read.parquet(f"{root}/heartbeat").collect()] == [("d1.json", "ERR")]


def test_board_from_the_streamed_log(spark):
    """H14 reads what the stream wrote: every column of the board comes from the log's own columns."""
    from perron import queries as Q
    from perron.plans import boards as BD
    from perron.streaming.live_stream import read_log
    from tests.conftest import SMOKE
    root = tempfile.mkdtemp(prefix="perron-board-")
    silver = Q._silver(spark, SMOKE)
    header = silver.schedule_header.where("operating_date = date'2001-07-27'").select("schedule_id", "order_id", "train_order_id").join(
        silver.schedule_details.where("dsta_id = 3 and departure_time is not null").select("schedule_id", "order_id").distinct(), ["schedule_id", "order_id"]).limit(5).collect()
    trains = [{"scheduleId": r.schedule_id, "orderId": r.order_id, "trainOrderId": r.train_order_id, "operatingDate": "2001-07-27", "trainStatus": "P",
               "stations": [{"stationId": 3, "plannedSequenceNumber": 1, "actualSequenceNumber": 1, "actualDeparture": "2001-07-27T11:30:00Z", "departureDelayMinutes": 9}]} for r in header]
    run = "20010727100000"
    _run(spark, root, [(0, [_page(run, 1, "2001-07-27T10:00:00Z", trains, False)])])
    rows = BD.board(silver, read_log(spark, root), Q._dis_log(spark, SMOKE), "2001-07-27 12:00:00", 3, "dep").collect()
    assert len({r.nr_pociagu for r in rows}) >= 1 and {r.faktyczny_odjazd for r in rows} == {"2001-07-27 13:30:00"} and {r.opoznienie_min for r in rows} == {9}


def test_pages_are_not_shuffled_unless_one_comes_twice(spark, tmp_path):
    from perron.operators.versions import write_version
    from pyspark.sql import functions as F
    from perron.streaming import assembly
    rows = [("20010724050000", 1, "b"), ("20010724050000", 2, "c"), ("20010724060000", 1, "d")]
    ddl = "run_key string, page int, object_name string"

    def stored(more, version):
        df = spark.createDataFrame(rows + more, ddl).select(*[(F.col(f.name) if f.name in ddl else F.lit(None)).cast(f.dataType).alias(f.name) for f in assembly.PAGES.fields])
        return write_version(assembly.gather(df, None, None), f"{tmp_path}/pages", version)

    once = assembly.first_files(stored([("20010724060000", 2, None)], 0))
    assert sorted(r.object_name for r in once.collect()) == ["b", "c", "d"]
    assert "Join" not in once._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.object_name for r in assembly.first_files(stored([("20010724050000", 1, "a")], 1)).collect()) == ["a", "c", "d"]
