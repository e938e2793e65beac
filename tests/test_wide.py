"""Wide join strategies: salted = plain on a skewed key; latest = join on
unique keys; plan shape (J1, Q4, U2)."""

import os

from pyspark.sql import functions as F

from sensorflow.operators import quality as Q
from sensorflow.operators.wide import hot_keys, repeat_rows, wide_readings

SENSORS = ("co2", "humidity", "light", "pir", "temperature")


def _skewed(spark):
    rows, rid = [], 0
    # One hot key: 40 co2, 3 pir, 2 light, 1 of the rest; plus 30 cold keys.
    counts = {"co2": 40, "humidity": 1, "light": 2, "pir": 3, "temperature": 1}
    for s, n in counts.items():
        for i in range(n):
            rows.append((rid, "hot", s, 100, float(i)))
            rid += 1
    for k in range(30):
        for s in SENSORS:
            rows.append((rid, f"r{k}", s, 200, float(k)))
            rid += 1
    return spark.createDataFrame(rows, "rid long, room string, sensor string, "
                                       "ts_min_bignt long, sensor_value double")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_salted_equals_plain_on_hot_key(spark):
    long = _skewed(spark)
    plain = wide_readings(long)
    salted = wide_readings(long, row_id="rid", hot_key_rows=5)
    assert plain.count() == 40 * 3 * 2 + 30
    assert _rows(salted) == _rows(plain)
    hk = hot_keys(long, 5).collect()
    # a part holds about a fifth of 5 rows: co2's 40 rows make 40 parts
    assert [(r.room, r._row_sensor, r._rows, r._columns) for r in hk] == [("hot", "co2", 40, 3)]


def test_every_key_hot_keeps_result_exact(spark):
    long = _skewed(spark)
    salted = wide_readings(long, row_id="rid", hot_key_rows=1)
    assert _rows(salted) == _rows(wide_readings(long))
    assert _rows(wide_readings(long, hot_key_rows=1)) == _rows(wide_readings(long))


def test_a_key_that_lacks_a_sensor_is_not_hot(spark):
    """It gives no row, so nothing is copied for it."""
    rows = [("two", s, 100, float(i)) for s in SENSORS[:2] for i in range(60)]
    rows += [("all", s, 100, float(i)) for s in SENSORS for i in range(2)]
    long = spark.createDataFrame(rows, "room string, sensor string, ts_min_bignt long, "
                                       "sensor_value double")
    assert [r.room for r in hot_keys(long, 5).collect()] == ["all"]
    assert _rows(wide_readings(long, hot_key_rows=5)) == _rows(wide_readings(long))


def test_balanced_hot_key_is_split_over_two_sensors(spark):
    rows = [("hot", s, 100, float(i)) for s in SENSORS for i in range(6)]
    long = spark.createDataFrame(rows, "room string, sensor string, ts_min_bignt long, "
                                       "sensor_value double")
    (key,) = hot_keys(long, 15).collect()
    assert key._rows == key._columns == 2 and key._row_sensor != key._column_sensor
    salted = wide_readings(long, hot_key_rows=15)
    assert salted.count() == 6 ** 5
    assert _rows(salted) == _rows(wide_readings(long))


def test_every_side_reads_its_own_sensor_only(spark, tmp_path):
    from sensorflow.plans.ingest import build_wide
    from sensorflow.sources import events as ev
    from sensorflow.sources.sensor_files import write_raw_hive_tree
    from .conftest import SF_SMALL
    hive, folders = str(tmp_path / "hive"), tmp_path / "folders"
    write_raw_hive_tree(ev.raw_readings(spark, SF_SMALL), hive)
    for s in SENSORS:
        (folders / "room 5").mkdir(parents=True, exist_ok=True)
        (folders / "room 5" / f"{s}.csv").write_text("100,1\n")
    for hot in (None, 10):
        plan = build_wide(spark, hive, layout="hive", hot_key_rows=hot) \
            ._jdf.queryExecution().optimizedPlan().toString()
        for s in SENSORS:
            assert f"= {s})" in plan
        wide = build_wide(spark, hive, layout="hive", hot_key_rows=hot)
        wide.collect()
        final = wide._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        scans = [line for line in final.splitlines() if "FileScan csv" in line]
        # the hot keys were counted before, and written: no side counts them again
        assert len(scans) == 5
        assert all("PartitionFilters: [" in x and "sensor#" in x.split("PartitionFilters")[1]
                   for x in scans)
        plan = build_wide(spark, str(folders), hot_key_rows=hot) \
            ._jdf.queryExecution().executedPlan().toString()
        for s in SENSORS:  # the file path filter of each side's scan
            assert f"= {s})" in plan
    (row,) = build_wide(spark, str(folders), hot_key_rows=1).collect()
    assert row.room == "room 5"


def test_latest_equals_join_on_unique_keys(spark):
    long = _skewed(spark)
    latest = Q.keep_latest(long, "rid")
    a = wide_readings(latest, how="latest", order_col="rid")
    b = wide_readings(latest.drop("rid"))
    assert _rows(a) == _rows(b)
    hot = a.filter(F.col("room") == "hot").first()
    assert hot.co2 == 39.0 and hot.pir == 2.0


def test_join_plan_reuses_partitioning(spark):
    long = _skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = wide_readings(long)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Five shuffles (one per sensor side), no re-shuffle between the joins.
    assert plan.count("Exchange hashpartitioning") <= 5 or "AdaptiveSparkPlan" in plan


def test_repeat_rows(spark):
    df = spark.range(3)
    out = repeat_rows(df, 4)
    assert out.count() == 12
    assert sorted(r.replay for r in out.filter("id = 0").collect()) == [1, 2, 3, 4]


def test_pir_null_nan_zero_one(spark):
    from sensorflow.functions.features import with_movement
    rows = []
    for key, pir in (("null", None), ("nan", float("nan")), ("zero", 0.0), ("one", 1.0)):
        for s in SENSORS:
            rows.append((key, s, 100, pir if s == "pir" else 1.0))
    long = spark.createDataFrame(rows, "room string, sensor string, ts_min_bignt long, "
                                       "sensor_value double")
    v2 = with_movement(wide_readings(long, round_digits=None, drop_incomplete=False))
    flags = {r.room: r.if_movement for r in v2.collect()}
    # NaN > 0 is true in Spark: this is why F1 runs before the flag.
    assert flags == {"null": "no_movement", "nan": "movement", "zero": "no_movement",
                     "one": "movement"}
    v1 = with_movement(wide_readings(long))
    assert {r.room: r.if_movement for r in v1.collect()} == {"zero": "no_movement",
                                                             "one": "movement"}


def test_bucketed_long_table_joins_without_shuffle(spark, tmp_path):
    from sensorflow.plans.ingest import read_long_table, write_long_table
    from sensorflow.sources import events as ev
    from .conftest import SF_SMALL
    long = ev.readings(spark, SF_SMALL).drop("ts")
    write_long_table(long, str(tmp_path / "long_b"), table="long_bucketed_test", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = wide_readings(read_long_table(spark, table="long_bucketed_test"))
        plan = wide._jdf.queryExecution().executedPlan().toString()
        rows = _rows(wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS long_bucketed_test")
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 4
    assert rows == _rows(wide_readings(long))
    files = [f for _, _, fs in os.walk(str(tmp_path / "long_b")) for f in fs
             if f.endswith(".parquet")]
    assert len(files) <= 5 * 4  # one file per bucket and sensor
