"""Streams with file sources only (S6, S7, W1-W8, K5, K6, K8, A4, E1, E2):
stream = batch, restart from a checkpoint, replayed batch, routing, event time."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from sensorflow.functions import payload as PL
from sensorflow.operators.model import LinearModel, score
from sensorflow.operators.quality import keep_latest
from sensorflow.operators.wide import wide_readings
from sensorflow.sources import events as ev
from sensorflow.sources.streams import read_messages, read_messages_batch
from sensorflow.streaming import event_time as E
from sensorflow.streaming.index_stream import index_documents, start_index_stream
from sensorflow.streaming.scoring import prediction_rows, start_scoring_stream
from sensorflow.streaming.sinks import (BatchDirSink, progress_frame, read_batches,
                                        run_available, start)

from .conftest import SF_MID, SF_SMALL

NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
MODEL = LinearModel(0.3, (0.004, -0.003, 0.002, -0.005))


def _drop_messages(spark, folder, wide, fmt="text", payload_format="csv"):
    msgs = PL.to_messages(wide, payload_format)
    if fmt == "text":
        msgs.select("value").write.mode("append").text(folder)
    else:
        msgs.write.mode("append").format(fmt).save(folder)


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_index_stream_equals_batch_and_restarts(spark, tmp_path):
    wide = wide_readings(ev.readings(spark, SF_SMALL))
    inbox = str(tmp_path / "inbox")
    _drop_messages(spark, inbox, wide)
    target, ckpt = str(tmp_path / "docs"), str(tmp_path / "ckpt")

    def run():
        msgs = read_messages(spark, "text", inbox)
        q, sink = start_index_stream(msgs, target, ckpt, trigger={"availableNow": True}, now=NOW)
        run_available(q)
        return q, sink

    q, _ = run()
    out = read_batches(spark, target).drop("batch_id")
    batch = index_documents(read_messages_batch(spark, "text", inbox), now=NOW)
    assert _sorted(out) == _sorted(batch)
    assert progress_frame(spark, q).agg(F.sum("input_rows")).first()[0] == wide.count()

    # Restart with nothing new: no new batch.
    run()
    assert read_batches(spark, target).count() == wide.count()
    # A new file: only its rows are processed.
    _drop_messages(spark, inbox, wide.limit(3))
    run()
    per_batch = read_batches(spark, target).groupBy("batch_id").count().orderBy("batch_id")
    assert [r["count"] for r in per_batch.collect()] == [wide.count(), 3]


def test_batch_delivered_twice_is_idempotent(spark, tmp_path):
    wide = wide_readings(ev.readings(spark, SF_SMALL))
    docs = index_documents(PL.to_messages(wide, with_key=False), now=NOW)
    sink = BatchDirSink(str(tmp_path / "t"))
    sink(docs, 0)
    sink(docs, 0)
    assert read_batches(spark, str(tmp_path / "t")).count() == wide.count()


def test_scoring_stream_routes_and_counts(spark, tmp_path):
    wide = wide_readings(ev.readings(spark, SF_SMALL))
    inbox = str(tmp_path / "inbox")
    _drop_messages(spark, inbox, wide, fmt="json", payload_format="json")
    target = str(tmp_path / "routes")
    msgs = read_messages(spark, "json", inbox)
    q, sink = start_scoring_stream(msgs, MODEL, target, str(tmp_path / "ckpt"),
                                   payload_format="json", trigger={"availableNow": True})
    run_available(q)
    out = read_batches(spark, target)
    expect = prediction_rows(score(wide, MODEL))
    assert _sorted(out.select(*expect.columns)) == _sorted(expect)
    m = sink.last
    by_route = {r.route: r["count"] for r in out.groupBy("route").count().collect()}
    assert m["movement"] == by_route.get("activity", 0)
    assert m["no_movement"] == by_route.get("no_activity", 0)
    assert m["rows"] == wide.count()


def test_empty_route_leaves_other_target(spark, tmp_path):
    wide = wide_readings(ev.readings(spark, SF_SMALL))
    always_no = LinearModel(-100.0, (0.0, 0.0, 0.0, 0.0))
    sink = BatchDirSink(str(tmp_path / "r"), partition_by=("route",), transform=prediction_rows)
    sink(score(wide, always_no), 0)
    assert os.listdir(str(tmp_path / "r" / "batch_id=0")).count("route=activity") == 0
    assert read_batches(spark, str(tmp_path / "r")).select("route").distinct().count() == 1


def test_event_time_dedup_equals_batch_distinct(spark, tmp_path):
    long = keep_latest(ev.readings(spark, SF_MID), "event_id")
    wide = wide_readings(long, how="latest", order_col="event_id")
    inbox = str(tmp_path / "wide")
    wide.write.mode("append").parquet(inbox)
    wide.write.mode("append").parquet(inbox)  # delivered twice
    stream = spark.readStream.schema(wide.schema).parquet(inbox)
    dedup = E.drop_resent(stream, ["room", "ts_min_bignt"])
    q = start(dedup.drop("content_id", "event_date"), "memory", str(tmp_path / "ck"),
              trigger={"availableNow": True}, query_name="dedup_out")
    run_available(q)
    got = spark.table("dedup_out")
    assert got.count() == wide.count()
    assert _sorted(got) == _sorted(wide)


def test_windowed_metrics_stream_closed_windows_equal_batch(spark, tmp_path):
    wide = wide_readings(ev.readings(spark, SF_MID))
    inbox = str(tmp_path / "wide")
    wide.write.parquet(inbox)
    stream = spark.readStream.schema(wide.schema).parquet(inbox)
    agg = E.windowed_metrics(E.with_event_time(stream), "4 days", "2 days")
    q = start(agg, "memory", str(tmp_path / "ck"), trigger={"availableNow": True},
              query_name="win_out")
    run_available(q)
    got = spark.table("win_out")
    batch = E.windowed_metrics(E.with_event_time(wide), "4 days", "2 days")
    emitted = _sorted(got)
    assert 0 < len(emitted) <= batch.count()
    assert set(emitted) <= set(_sorted(batch))


def test_index_stream_quarantine_branch(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    good = "2013-08-26 22:12:11,1377555131,413,575.0,102.0,24.06,48.09,1.0"
    rows = [good, "2013-08-26 22:12:11,1377555131,413,bad,102.0,24.06,48.09,1.0",
            "2013-08-26 22:12:11,1377555131,413,575.0,102.0,24.06,48.09"]
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(inbox)
    q, _ = start_index_stream(read_messages(spark, "text", inbox), str(tmp_path / "docs"),
                              str(tmp_path / "ck"), trigger={"availableNow": True}, now=NOW,
                              quarantine=True)
    run_available(q)
    out = read_batches(spark, str(tmp_path / "docs"))
    by = {r.status: r["count"] for r in out.groupBy("status").count().collect()}
    assert by == {"ok": 1, "quarantine": 2}
    reasons = sorted(r.reason for r in out.filter("status = 'quarantine'").collect())
    assert reasons == ["co2", "pir"]


def test_compact_batches(spark, tmp_path):
    from sensorflow.streaming.sinks import compact_batches, read_compacted
    wide = wide_readings(ev.readings(spark, SF_SMALL))
    docs = index_documents(PL.to_messages(wide, with_key=False), now=NOW).repartition(6)
    sink = BatchDirSink(str(tmp_path / "t"))
    for b in range(3):
        sink(docs, b)
    t, c = str(tmp_path / "t"), str(tmp_path / "c")
    for _ in range(2):  # a repeated run replaces the first
        assert compact_batches(spark, t, c, first_batch=1) == 2 * wide.count()
    back = read_batches(spark, c)
    assert back.count() == 2 * wide.count()
    assert sorted(r.batch_id for r in back.select("batch_id").distinct().collect()) == [1, 2]
    files = [f for f in os.listdir(f"{c}/merged=1-2") if f.endswith(".parquet")]
    before = [f for f in os.listdir(str(tmp_path / "t" / "batch_id=1")) if f.endswith(".parquet")]
    assert len(files) < len(before)
    want = {b: wide.count() for b in range(3)}

    def per_batch():
        return {r.batch_id: r["count"] for r in read_compacted(spark, t, c).groupBy("batch_id").count().collect()}

    assert per_batch() == want
    compact_batches(spark, t, c, first_batch=1, drop_source=True)
    assert per_batch() == want and sorted(os.listdir(t)) == ["batch_id=0"]
    assert compact_batches(spark, t, c, first_batch=1) == 0
    sink(docs, 3)
    assert per_batch() == want | {3: wide.count()}


def test_index_stream_drops_resent_messages(spark, tmp_path):
    wide = wide_readings(ev.readings(spark, SF_SMALL))
    latest = wide_readings(keep_latest(ev.readings(spark, SF_SMALL), "event_id"),
                           how="latest", order_col="event_id")
    inbox = str(tmp_path / "inbox")
    _drop_messages(spark, inbox, latest)
    _drop_messages(spark, inbox, latest)  # re-ingested: the same rows again
    q, sink = start_index_stream(read_messages(spark, "text", inbox, max_per_trigger=1),
                                 str(tmp_path / "docs"), str(tmp_path / "ck"),
                                 trigger={"availableNow": True}, now=NOW, distinct=True)
    run_available(q)
    out = read_batches(spark, str(tmp_path / "docs"))
    assert out.count() == latest.count() < 2 * latest.count()
    assert sink.totals["batches"] > 1
    # each source row is read once
    read = sum(p["numInputRows"] for p in q.recentProgress)
    assert read == 2 * latest.count()
    # ids are kept as state: a batch needs none of the folders written before
    for b in range(sink.totals["batches"]):
        shutil.rmtree(tmp_path / "docs" / f"batch_id={b}")
    _drop_messages(spark, inbox, latest)
    q, sink = start_index_stream(read_messages(spark, "text", inbox), str(tmp_path / "docs"),
                                 str(tmp_path / "ck"), trigger={"availableNow": True}, now=NOW, distinct=True)
    run_available(q)
    assert sum(p["numInputRows"] for p in q.recentProgress) == latest.count()
    assert not [f for _, _, fs in os.walk(tmp_path / "docs") for f in fs if f.endswith(".parquet")]
    assert wide.count() >= latest.count()


def test_prediction_messages_json(spark):
    from sensorflow.schema import PREDICTION_SCHEMA
    from sensorflow.streaming.routing import prediction_messages
    wide = wide_readings(ev.readings(spark, SF_SMALL))
    scored = score(wide, MODEL)
    msgs = prediction_messages(prediction_rows(scored), {"activity": "moving"})
    back = msgs.select("topic", F.from_json("value", PREDICTION_SCHEMA).alias("m")) \
        .select("topic", "m.*")
    expect = prediction_rows(scored).withColumnRenamed("route", "topic").replace(
        {"activity": "moving"}, subset=["topic"])
    assert _sorted(back.select(*expect.columns)) == _sorted(expect)


def test_scoring_stream_counts_and_quarantines_invalid_rows(spark, tmp_path):
    good = "2013-08-26 22:12:11,1377555131,413,575.0,102.0,24.06,48.09,1.0"
    rows = [good, "2013-08-26 22:12:11,1377555131,413,bad,102.0,24.06,48.09,1.0",
            "2013-08-26 22:12:11,1377555131,413,NaN,102.0,24.06,48.09,1.0"]
    inbox = str(tmp_path / "inbox")
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(inbox)
    for mode, expect in (("skip", {"activity"}), ("quarantine", {"activity", "invalid"})):
        target = str(tmp_path / mode)
        q, sink = start_scoring_stream(read_messages(spark, "text", inbox),
                                       LinearModel(100.0, (0.0, 0.0, 0.0, 0.0)), target,
                                       str(tmp_path / f"ck_{mode}"),
                                       trigger={"availableNow": True}, invalid=mode)
        run_available(q)
        out = read_batches(spark, target)
        assert {r.route for r in out.select("route").distinct().collect()} == expect
        m = sink.last
        assert (m["rows"], m["movement"], m["invalid"]) == (3, 1, 2)


def test_scoring_stream_drops_resent_messages(spark, tmp_path):
    latest = wide_readings(keep_latest(ev.readings(spark, SF_SMALL), "event_id"),
                           how="latest", order_col="event_id")
    inbox = str(tmp_path / "inbox")
    _drop_messages(spark, inbox, latest, fmt="json", payload_format="json")
    _drop_messages(spark, inbox, latest, fmt="json", payload_format="json")
    q, sink = start_scoring_stream(read_messages(spark, "json", inbox), MODEL,
                                   str(tmp_path / "routes"), str(tmp_path / "ck"),
                                   payload_format="json", trigger={"availableNow": True},
                                   distinct=True)
    run_available(q)
    assert read_batches(spark, str(tmp_path / "routes")).count() == latest.count()


def test_dedupe_keeps_messages_without_instant(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    good = "2013-08-26 22:12:11,1377555131,413,575.0,102.0,24.06,48.09,1.0"
    no_ts = "2013-08-26 22:12:11,xx,413,575.0,102.0,24.06,48.09,1.0"
    spark.createDataFrame([(good,), (good,), (no_ts,)], "value string").write.text(inbox)
    q, _ = start_index_stream(read_messages(spark, "text", inbox), str(tmp_path / "docs"),
                              str(tmp_path / "ck"), trigger={"availableNow": True}, now=NOW,
                              quarantine=True, distinct=True)
    run_available(q)
    out = read_batches(spark, str(tmp_path / "docs"))
    by = {r.status: r["count"] for r in out.groupBy("status").count().collect()}
    assert by == {"ok": 1, "quarantine": 1}


def test_two_rooms_one_after_another_lose_nothing(spark, tmp_path):
    inbox, docs = str(tmp_path / "inbox"), str(tmp_path / "docs")
    for room, day in (("a", 20), ("b", 2), ("c", 11)):  # days apart, out of order
        rows = [f"2013-01-{day:02d} 00:00:{i:02d},{1356998400 + 86400 * (day - 1) + i},{room},"
                "575.0,102.0,24.06,48.09,1.0" for i in range(8)]
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1) \
            .write.mode("append").text(inbox)
    q, _ = start_index_stream(read_messages(spark, "text", inbox, max_per_trigger=1), docs,
                              str(tmp_path / "ck"), trigger={"availableNow": True}, now=NOW,
                              quarantine=True, distinct=True)
    run_available(q)
    by = {r.room: r["count"] for r in read_batches(spark, docs).groupBy("room").count().collect()}
    assert by == {"a": 8, "b": 8, "c": 8}


def test_restart_without_a_checkpoint_argument(spark, tmp_path):
    """A second session (its own SQL state) goes on where the first stopped."""
    import pytest
    from sensorflow.plans.jobs import run_index_stream
    inbox, a, b = (str(tmp_path / n) for n in ("inbox", "a", "b"))
    rows = [f"2013-08-26 22:12:1{i},137755513{i},413,575.0,102.0,24.06,48.09,0.0" for i in range(4)]

    def put(values):
        spark.createDataFrame([(v,) for v in values], "value string").repartition(len(values)) \
            .write.mode("append").text(inbox)

    def run(session, target):
        q, _ = run_index_stream(session, "text", inbox, target, max_per_trigger=1,
                                trigger={"availableNow": True})
        run_available(q)
        return sorted(r.event_ts_min for r in read_batches(session, target).collect())

    put(rows[:3])
    assert len(run(spark, a)) == 3
    put(rows[3:])
    other = spark.newSession()
    assert len(set(run(other, a))) == len(run(other, a)) == 4
    assert len(run(other, b)) == 4  # another target has offsets of its own
    with pytest.raises(ValueError, match="holds batches"):
        run_index_stream(spark, "text", inbox, a, checkpoint=str(tmp_path / "fresh"))


def test_totals_count_every_batch(spark, tmp_path):
    from sensorflow.streaming.sinks import Totals
    inbox = str(tmp_path / "inbox")
    spark.range(0, 105, 1, 105).selectExpr("cast(id as string) as value").write.text(inbox)
    totals = Totals()
    spark.streams.addListener(totals)
    try:
        sink = BatchDirSink(str(tmp_path / "out"), observe=lambda: [F.count(F.lit(1)).alias("rows")])
        q = start(read_messages(spark, "text", inbox, max_per_trigger=1), sink,
                  str(tmp_path / "ck"), trigger={"availableNow": True})
        run_available(q)
        got = totals.of(q)
    finally:
        spark.streams.removeListener(totals)
    assert got["batches"] == 105 and got["rows"] == 105
    assert sink.totals["batches"] == sink.totals["rows"] == 105
