"""The keyed table: newest row per key, one visible version, replays."""

import os

import pytest

from sensorflow.streaming.upsert import KeyedTable

SCHEMA = "k string, event_date date, v double, ver bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA.replace("date date", "date string")) \
        .selectExpr("k", "cast(event_date AS date) AS event_date", "v", "ver")


def content(spark, table):
    return sorted((r["k"], r["event_date"], r["v"]) for r in table.read(spark).collect())


def test_newest_row_per_key(spark, tmp_path):
    t = KeyedTable(str(tmp_path / "t"), ["k"])
    t(frame(spark, [("a", "2024-01-01", 1.0, 0), ("b", "2024-01-02", 2.0, 0), ("c", None, 3.0, 0),
                    ("a", "2024-01-01", 1.0, 0)]), 0)
    assert content(spark, t) == [("a", "2024-01-01", 1.0), ("b", "2024-01-02", 2.0), ("c", "none", 3.0)]
    untouched = {f for f in os.listdir(tmp_path / "t/batch_id=0/event_date=2024-01-02")}
    t(frame(spark, [("a", "2024-01-01", 9.0, 0), ("d", "2024-01-03", 4.0, 0), ("c", None, None, 0)]), 1)
    want = [("a", "2024-01-01", 9.0), ("b", "2024-01-02", 2.0), ("c", "none", None), ("d", "2024-01-03", 4.0)]
    assert content(spark, t) == want
    assert {f for f in os.listdir(tmp_path / "t/batch_id=0/event_date=2024-01-02")} == untouched
    assert "event_date=2024-01-02" not in os.listdir(tmp_path / "t/batch_id=1")
    # delivered again: nothing changes, not even with other rows
    before = sorted(os.walk(tmp_path / "t"))
    t(frame(spark, [("a", "2024-01-01", 5.0, 0)]), 1)
    t(frame(spark, [("a", "2024-01-01", 5.0, 0)]), 0)
    assert content(spark, t) == want and sorted(os.walk(tmp_path / "t")) == before


def test_version_column_decides(spark, tmp_path):
    t = KeyedTable(str(tmp_path / "t"), ["k"], version="ver")
    t(frame(spark, [("a", "2024-01-01", 1.0, 5), ("a", "2024-01-01", 2.0, 4), ("b", "2024-01-01", 1.0, None)]), 0)
    t(frame(spark, [("a", "2024-01-01", 3.0, 4), ("b", "2024-01-01", 2.0, None)]), 1)  # an older correction
    assert content(spark, t) == [("a", "2024-01-01", 1.0), ("b", "2024-01-01", 2.0)]
    t(frame(spark, [("a", "2024-01-01", 4.0, 5)]), 2)  # equal version, later batch
    assert content(spark, t)[0] == ("a", "2024-01-01", 4.0)


def test_a_reader_sees_one_version(spark, tmp_path, monkeypatch):
    t = KeyedTable(str(tmp_path / "t"), ["k"], keep=2)
    t(frame(spark, [("a", "2024-01-01", 1.0, 0), ("b", "2024-01-02", 1.0, 0)]), 0)
    begun = t.read(spark)  # reads batch 0's folders, whatever comes
    seen = []
    commit = KeyedTable._commit

    def look_first(self, spark, batch_id, days):
        seen.append(content(spark, t))  # all rows are written, none is visible
        commit(self, spark, batch_id, days)

    monkeypatch.setattr(KeyedTable, "_commit", look_first)
    t(frame(spark, [("a", "2024-01-01", 2.0, 0), ("b", "2024-01-02", 2.0, 0)]), 1)
    assert seen == [[("a", "2024-01-01", 1.0), ("b", "2024-01-02", 1.0)]]
    assert sorted(r["v"] for r in begun.collect()) == [1.0, 1.0]
    t(frame(spark, [("a", "2024-01-01", 3.0, 0)]), 2)
    assert t.snapshots(spark) == [1, 2]  # batch 0's folders are referred to no more
    assert not any(d.startswith("event_date") for d in os.listdir(tmp_path / "t/batch_id=0"))
    assert content(spark, t) == [("a", "2024-01-01", 3.0), ("b", "2024-01-02", 2.0)]


def test_a_failed_merge_is_done_anew(spark, tmp_path, monkeypatch):
    t = KeyedTable(str(tmp_path / "t"), ["k"])
    t(frame(spark, [("a", "2024-01-01", 1.0, 0)]), 0)

    def stop(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", stop)
        with pytest.raises(OSError):
            t(frame(spark, [("a", "2024-01-01", 2.0, 0), ("x", "2024-01-09", 2.0, 0)]), 1)
    assert content(spark, t) == [("a", "2024-01-01", 1.0)]
    t(frame(spark, [("a", "2024-01-01", 2.0, 0)]), 1)
    assert content(spark, t) == [("a", "2024-01-01", 2.0)]


def test_empty_batches_and_tables(spark, tmp_path):
    t = KeyedTable(str(tmp_path / "t"), ["k"])
    with pytest.raises(ValueError, match="no rows"):
        t.read(spark)
    nothing = frame(spark, [])
    assert t.read(spark, nothing.schema).count() == 0
    t(nothing, 0)
    t(frame(spark, [("a", "2024-01-01", 1.0, 0)]), 1)
    t(nothing, 2)
    assert content(spark, t) == [("a", "2024-01-01", 1.0)]
    with pytest.raises(ValueError, match="keep"):
        KeyedTable("t", ["k"], keep=0)
