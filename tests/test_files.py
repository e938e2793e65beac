"""Sensor file tree edge cases."""

import os

from pyspark.sql import functions as F

from sensorflow.operators import quality as Q
from sensorflow.operators.wide import wide_readings
from sensorflow.plans.ingest import build_wide, export_csv, read_wide_csv, write_wide_table
from sensorflow.sources.sensor_files import found_files, read_raw_tree, read_tree

SENSORS = ("co2", "humidity", "light", "pir", "temperature")


def _write(root, room, sensor, lines):
    d = os.path.join(root, room)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{sensor}.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")


def _tree(tmp_path):
    root = str(tmp_path / "rooms")
    # Room 413: complete, two common instants; values with spaces.
    for i, s in enumerate(SENSORS):
        _write(root, "413", s, [f" 1377299112 , {i + 1} ", f"1377299172,{i + 10}"])
    # Room 510: no pir file.
    for s in SENSORS:
        if s != "pir":
            _write(root, "510", s, ["1377299112,5", "1377299172,6"])
    with open(os.path.join(root, "README.txt"), "w") as f:
        f.write("not a room\n")
    return root


def test_complete_room_missing_sensor_and_stray_file(spark, tmp_path):
    root = _tree(tmp_path)
    wide = build_wide(spark, root)
    rows = wide.orderBy("room", "ts_min_bignt").collect()
    assert [(r.room, r.ts_min_bignt) for r in rows] == [("413", 1377299112), ("413", 1377299172)]
    first = rows[0]
    assert (first.co2, first.humidity, first.light, first.pir, first.temp) == (1.0, 2.0, 3.0, 4.0, 5.0)
    assert first.event_ts_min == "2013-08-23 23:05:12"
    # Nothing from the stray file, 510 reported missing pir.
    raw = read_raw_tree(spark, root)
    assert set(r.room for r in raw.select("room").distinct().collect()) == {"413", "510"}
    missing = Q.missing_sensor_files(found_files(raw)).collect()
    assert [(r.room, r.missing_sensor) for r in missing] == [("510", "pir")]
    grid_missing = Q.missing_sensors(read_tree(spark, root)).collect()
    assert {(r.room, r.missing_sensor) for r in grid_missing} == {("510", "pir")}


def test_duplicate_instant_fans_out_and_keep_latest(spark, tmp_path):
    root = str(tmp_path / "dups")
    for s in SENSORS:
        lines = ["100,1"]
        if s == "co2":
            lines = ["100,1", "100,2"]
        if s == "pir":
            lines = ["100,0", "100,1", "100,3"]
        _write(root, "7", s, lines)
    long = read_tree(spark, root)
    assert wide_readings(long).count() == 6
    dup = Q.duplicate_keys(long).orderBy("sensor").collect()
    assert [(r.sensor, r.n) for r in dup] == [("co2", 2), ("pir", 3)]
    raw = read_raw_tree(spark, root, with_line_order=True)
    from sensorflow.functions.cleaning import clean_readings
    latest = Q.keep_latest(clean_readings(raw), "line_order")
    w = wide_readings(latest, how="latest", order_col="line_order").collect()
    assert len(w) == 1 and w[0].co2 == 2.0 and w[0].pir == 3.0


def test_unparsable_values_are_null_and_dropped(spark, tmp_path):
    root = str(tmp_path / "bad")
    for s in SENSORS:
        lines = ["100,1", "200,2"]
        if s == "light":
            lines = ["100,bad", "200,2"]
        if s == "temperature":
            lines = ["100,1", "200"]  # one field only
        _write(root, "9", s, lines)
    long = read_tree(spark, root, keep_raw=True)
    q1 = {(r.sensor): r for r in Q.completeness(long).collect()}
    assert q1["light"].n_bad_value == 1 and q1["temperature"].n_missing_value == 1
    assert q1["co2"].n_bad_value == 0
    v2 = wide_readings(read_tree(spark, root), round_digits=None, drop_incomplete=False)
    assert v2.count() == 2
    v1 = wide_readings(read_tree(spark, root))
    assert v1.count() == 0


def test_write_table_and_csv_roundtrip(spark, tmp_path):
    root = _tree(tmp_path)
    wide = build_wide(spark, root)
    out = str(tmp_path / "wide_parquet")
    write_wide_table(wide, out, partition_by=("room",))
    back = spark.read.parquet(out)
    assert back.count() == 2
    # Append of a second batch (K2 incremental form).
    write_wide_table(wide, out, mode="append", partition_by=("room",))
    assert spark.read.parquet(out).count() == 4
    csv = str(tmp_path / "wide_csv")
    export_csv(wide, csv, single_file=True)
    assert len([f for f in os.listdir(csv) if f.startswith("part-")]) == 1
    back = read_wide_csv(spark, csv)
    assert dict(back.dtypes)["ts_min_bignt"] == "bigint"
    assert sorted(r.co2 for r in back.collect()) == sorted(r.co2 for r in wide.collect())


def test_room_filter_prunes_files(spark, tmp_path):
    root = _tree(tmp_path)
    raw = read_raw_tree(spark, root).filter(F.col("room") == "413")
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan
    assert raw.count() == 10


def test_tree_stream_equals_batch(spark, tmp_path):
    from sensorflow.sources.sensor_files import read_tree_stream
    from sensorflow.streaming.sinks import run_available, start
    root = _tree(tmp_path)
    stream = read_tree_stream(spark, root, max_files_per_trigger=3)
    q = start(stream, "memory", str(tmp_path / "ck"), trigger={"availableNow": True},
              query_name="tree_stream_out")
    run_available(q)
    got = sorted(tuple(r) for r in spark.table("tree_stream_out").collect())
    want = sorted(tuple(r) for r in read_tree(spark, root).collect())
    assert got == want and len(got) == 18


def test_broker_format_without_connector_fails_clearly(spark):
    import pytest
    from sensorflow.sources.streams import read_messages
    with pytest.raises(Exception) as info:
        read_messages(spark, "kafka", options={"kafka.bootstrap.servers": "localhost:1",
                                               "subscribe": "office-input"})
    assert "kafka" in str(info.value).lower()


def test_room_names_are_decoded(spark, tmp_path):
    from sensorflow.sources.sensor_files import read_tree_stream
    from sensorflow.streaming.sinks import run_available, start
    root, names = str(tmp_path / "odd"), {"room 5", "a%b", "c+d", "e%20f", "ü"}
    for name in names:
        for s in SENSORS:
            _write(root, name, s, ["100,1"])
    assert {r.room for r in build_wide(spark, root).collect()} == names
    assert read_raw_tree(spark, root).filter(F.col("room") == "c+d").count() == len(SENSORS)
    q = start(read_tree_stream(spark, root), "memory", str(tmp_path / "ck"),
              trigger={"availableNow": True}, query_name="odd_rooms")
    run_available(q)
    assert {r.room for r in spark.table("odd_rooms").collect()} == names


def test_folder_layout_equals_sql(spark, tmp_path):
    """The reference's layout (a folder per room, a file per sensor) against DuckDB."""
    import duckdb
    from sensorflow.plans import oracle as O
    from .conftest import SF_SMALL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_SMALL}/events.parquet'")
    root = str(tmp_path / "rooms")
    lines = con.execute(f"WITH {O.RAW_CTE} SELECT room, sensor, ts_raw, value_raw "
                        "FROM raw_readings ORDER BY ALL").fetchall()
    by_file = {}
    for room, sensor, ts, value in lines:
        by_file.setdefault((room, sensor), []).append(f"{ts},{'' if value is None else value}")
    for (room, sensor), content in by_file.items():
        _write(root, room, sensor, content)
    want = con.execute(f"WITH {O.RAW_CTE}, {O.wide_cte('clean')} SELECT * FROM wide").fetchall()
    for hot in (None, 4):
        got = [tuple(r) for r in build_wide(spark, root, hot_key_rows=hot).collect()]
        assert sorted(got) == sorted(want)


def test_keep_latest_keeps_readings_without_instant(spark):
    rows = [("a", "co2", None, 1.0, 1), ("a", "co2", None, 2.0, 2), ("b", "co2", None, 3.0, 3),
            ("a", "co2", 100, 4.0, 4), ("a", "co2", 100, 5.0, 5)]
    long = spark.createDataFrame(rows, "room string, sensor string, ts_min_bignt long, "
                                       "sensor_value double, n long")
    assert sorted(r.sensor_value for r in Q.keep_latest(long, "n").collect()) == [1, 2, 3, 5]


def test_sorted_series_is_in_order(spark):
    from sensorflow.operators.analytics import sorted_series
    from sensorflow.sources import events as ev
    from .conftest import SF_MID
    got = [(r.room, r.ts_min_bignt) for r in sorted_series(wide_readings(ev.readings(spark, SF_MID))).collect()]
    assert got == sorted(got) and len(got) > 1000


def test_published_text_is_what_the_file_says(spark, tmp_path):
    from sensorflow.plans.publish import read_table
    path = tmp_path / "codes.csv"
    path.write_text("code,n\n007,1.50\n")
    assert tuple(read_table(spark, str(path)).first()) == ("007", "1.50")
