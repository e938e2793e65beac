"""The five-way join on a stream against the batch join."""

import random

from sensorflow.operators.wide import wide_readings
from sensorflow.schema import SENSORS
from sensorflow.streaming.align import start_align_stream
from sensorflow.streaming.sinks import Totals, read_batches, run_available

LONG = "room string, sensor string, ts_min_bignt bigint, sensor_value double"
DAY = 86400


def readings(rooms, days, seed):
    rng = random.Random(seed)
    return [(r, s, d * DAY, float(rng.randint(0, 9))) for r in rooms for d in days for s in SENSORS
            for _ in range(rng.choice([1, 1, 2]))]


def deliver(spark, tmp_path, rows):
    spark.createDataFrame(rows, LONG).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")


def drain(spark, tmp_path, **kw):
    source = spark.readStream.schema(LONG).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    totals = Totals()
    spark.streams.addListener(totals)
    try:
        q, _ = start_align_stream(source, f"{tmp_path}/wide", f"{tmp_path}/ckpt",
                                  trigger={"availableNow": True}, **kw)
        run_available(q)
        return totals.of(q)
    finally:
        spark.streams.removeListener(totals)


def test_sensor_by_sensor_loses_nothing_and_late_rows_are_counted(spark, tmp_path):
    rows = readings(["a", "b"], range(1, 9), 1)
    rows += [("a", "co2", None, 1.0), (None, "co2", 0, 1.0), ("a", "co2", 2**63 - 1, 1.0),
             ("b", "light", DAY, float("nan")), ("b", "other", 0, 1.0)]
    for s in (*SENSORS, "other"):  # the last sensor's first reading comes after all of the first's
        deliver(spark, tmp_path, [r for r in rows if r[1] == s])
    first = drain(spark, tmp_path, delay="2 days")
    assert first["late"] == 0
    want = wide_readings(spark.createDataFrame(rows, LONG))
    got = read_batches(spark, f"{tmp_path}/wide").drop("batch_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    # a restart goes on with the state: an open instant is completed, a closed one is late
    deliver(spark, tmp_path, [("a", "pir", 8 * DAY, 5.0), ("a", "pir", DAY, 5.0), ("c", "co2", DAY, 5.0)])
    second = drain(spark, tmp_path, delay="2 days")
    assert second["late"] == 2
    now = read_batches(spark, f"{tmp_path}/wide").drop("batch_id")
    again = wide_readings(spark.createDataFrame([*rows, ("a", "pir", 8 * DAY, 5.0)], LONG))
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, again.collect()))

