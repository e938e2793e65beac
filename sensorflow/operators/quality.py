"""Data quality: completeness (Q1), missing sensors (Q2), duplicates (Q4).

All are single grouped aggregates with partial aggregation; none gathers a
group's rows. Q2 counts each expected sensor per key and lists those with no
reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.schema import KEY, SENSORS


def completeness(parsed: DataFrame, ts_raw: str = "ts_raw", value_raw: str = "value_raw",
                 by=("room", "sensor")) -> DataFrame:
    """Q1: per room and sensor: rows, missing and unparsable time / value.

    Expects raw text and the parsed columns side by side (``clean_readings``
    with ``keep_raw=True``)."""
    def count_if(cond, name):
        return F.count(F.when(cond, F.lit(1))).alias(name)
    missing_ts = F.col(ts_raw).isNull() | (F.trim(F.col(ts_raw)) == "")
    missing_v = F.col(value_raw).isNull() | (F.trim(F.col(value_raw)) == "")
    return parsed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        count_if(missing_ts, "n_missing_ts"),
        count_if(~missing_ts & F.col("ts_min_bignt").isNull(), "n_bad_ts"),
        count_if(missing_v, "n_missing_value"),
        count_if(~missing_v & F.col("sensor_value").isNull(), "n_bad_value"))


def missing_sensors(long: DataFrame, sensors=SENSORS, key=KEY) -> DataFrame:
    """Q2: for every (room, instant) seen, the expected sensors with no
    reading there. One row per (key, missing sensor).

    Rows per sensor are conditional counts (a hash aggregate with primitive
    buffers); the missing names are then listed per key and exploded."""
    counts = (long.filter(F.col(key[0]).isNotNull() & F.col(key[1]).isNotNull())
                  .groupBy(*key)
                  .agg(*[F.count(F.when(F.col("sensor") == s, F.lit(1))).alias(f"_n{i}")
                         for i, s in enumerate(sensors)]))
    missing = F.filter(F.array(*[F.when(F.col(f"_n{i}") == 0, F.lit(s))
                                 for i, s in enumerate(sensors)]),
                       lambda x: x.isNotNull())
    return counts.select(*key, F.explode(missing).alias("missing_sensor"))


def missing_sensor_files(found_files: DataFrame, sensors=SENSORS) -> DataFrame:
    """Q2 for a sensor-file tree: rooms lacking a sensor file
    (``found_files``: one row per room and sensor file found)."""
    return missing_sensors(found_files.withColumn("_k", F.lit(0)), sensors, key=("room", "_k")) \
        .drop("_k")


def duplicate_keys(long: DataFrame, key=(*KEY, "sensor")) -> DataFrame:
    """Q4: (room, instant, sensor) keys with more than one reading; these
    are what makes the wide join fan out."""
    return (long.filter(F.col(key[0]).isNotNull() & F.col(key[1]).isNotNull())
                .groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > 1))


def keep_latest(long: DataFrame, order_col: str, key=(*KEY, "sensor")) -> DataFrame:
    """Q4 keep-latest: one reading per key, the one with the largest
    ``order_col`` (ties: any one of them). ``max_by`` aggregates partially on
    the map side, so a hot key costs one row per task, never its whole
    group. Readings with a null in the key belong to no instant: they all stay."""
    keyed = F.lit(True)
    for k in key:
        keyed = keyed & F.col(k).isNotNull()
    latest = long.filter(keyed).groupBy(*key).agg(
        F.max(F.col(order_col)).alias(order_col),
        F.max_by(F.col("sensor_value"), F.col(order_col)).alias("sensor_value"))
    return latest.unionByName(long.filter(~keyed).select(*latest.columns))
