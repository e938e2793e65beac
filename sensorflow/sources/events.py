"""Adapter from the ``events`` table to long sensor readings.

The test data has no sensor files; ``events`` stands in for them: event type
-> sensor, user -> room, two-day bucket -> common instant. Two days keeps the
join neither empty nor exploding as the table grows (rooms grow with the
scale factor, readings per room stay constant).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.time import epoch_seconds_of_ntz

# Fixed values of the test mapping (FIXTURES.md §3.1).
EVENT_SENSOR = {
    "view": "co2",
    "click": "light",
    "signup": "temperature",
    "purchase": "humidity",
    "error": "pir",
}
INSTANT_SECONDS = 172800
PIR_EVENT = "error"
PIR_ZERO_AT_OR_BELOW = 25.0
# Fault injection for the raw-text fixture (FIXTURES.md §3.2): every row is
# kept, some values are spoiled.
BAD_VALUE_EVERY = 23
NULL_VALUE_EVERY = 17
ODD_VALUE_EVERY = {41: "NaN", 43: " Infinity", 47: "1e30", 53: "-inf"}
ODD_TIME_EVERY = {59: "9223372036854775807", 61: " -9223372036854775808 ", 67: "253402300800"}
# end of fixed values


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sensor_of(event_type) -> F.Column:
    expr = None
    for ev, sensor in EVENT_SENSOR.items():
        expr = (F.when(event_type == ev, F.lit(sensor)) if expr is None
                else expr.when(event_type == ev, F.lit(sensor)))
    return expr


def _reading_columns(sensor) -> list:
    et = F.col("event_type")
    seconds = epoch_seconds_of_ntz("ts")
    return [
        F.col("event_id"),
        F.col("ts"),
        F.col("user_id").cast("string").alias("room"),
        sensor.alias("sensor"),
        (F.floor(seconds / F.lit(INSTANT_SECONDS)) * F.lit(INSTANT_SECONDS)).cast("bigint")
        .alias("ts_min_bignt"),
        F.when((et == PIR_EVENT) & (F.col("value") <= PIR_ZERO_AT_OR_BELOW), F.lit(0.0))
        .otherwise(F.col("value")).alias("sensor_value"),
    ]


def readings_from_events(events: DataFrame, by_type: bool = False) -> DataFrame:
    """events -> ``event_id, ts, room, sensor, ts_min_bignt, sensor_value``.

    ``by_type=False``: one pass, the sensor computed per row (best when all
    readings are read). ``by_type=True``: one selection per event type with a
    literal sensor, unioned. A filter on the sensor (as each side of the wide
    join has) then drops the other branches at planning time and reaches the
    Parquet scan as ``event_type = ...``, so storage that is sorted or
    partitioned by type is read only where needed."""
    if not by_type:
        return events.select(*_reading_columns(_sensor_of(F.col("event_type"))))
    parts = [events.filter(F.col("event_type") == ev).select(*_reading_columns(F.lit(sensor)))
             for ev, sensor in EVENT_SENSOR.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raw_readings_from_readings(readings: DataFrame) -> DataFrame:
    """Readings as the text a sensor file would hold: spaces around both
    fields, some values unparsable (``bad``), missing, not finite or too large,
    some instants beyond any calendar."""
    eid = F.col("event_id")
    ts_raw = F.concat(F.lit(" "), F.col("ts_min_bignt").cast("string"), F.lit(" "))
    for every, text in ODD_TIME_EVERY.items():
        ts_raw = F.when(eid % every == 0, F.lit(text)).otherwise(ts_raw)
    value_raw = F.concat(F.lit(" "), F.col("sensor_value").cast("string"))
    for every, text in ODD_VALUE_EVERY.items():
        value_raw = F.when(eid % every == 0, F.lit(text)).otherwise(value_raw)
    return readings.select(
        "event_id", "room", "sensor",
        ts_raw.alias("ts_raw"),
        F.when(eid % BAD_VALUE_EVERY == 0, F.lit("bad"))
        .when(eid % NULL_VALUE_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(value_raw)
        .alias("value_raw"),
    )


def readings(spark: SparkSession, sf_dir: str, by_type: bool = False) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"), by_type)


def raw_readings(spark: SparkSession, sf_dir: str, by_type: bool = False) -> DataFrame:
    return raw_readings_from_readings(readings(spark, sf_dir, by_type))
