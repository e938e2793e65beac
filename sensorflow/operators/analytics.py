"""Statistics over readings (A1, A3, A5-A9), filters (F2-F4), ordering (O1-O3).

All aggregates are grouped aggregates with map-side partial aggregation, so a
hot room or window adds no single-task bottleneck. Shares over a whole result
(A5) are computed on the already aggregated rows only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.functions.cleaning import valid_reading
from sensorflow.functions.features import movement_flag
from sensorflow.functions.time import epoch_to_text, epoch_to_timestamp
from sensorflow.schema import MOVEMENT


def _r(c, digits=6):
    return F.round(c, digits)


#: Readings are averaged as decimals of so many places: sums of doubles depend
#: on their order, sums of decimals don't.
PLACES = 6


def _avg(c):
    """The mean of the valid readings of ``c`` (not null, NaN, infinite or out of
    range) to ``PLACES`` places, half up, the same in any order of rows. Each
    reading is first rounded to ``PLACES`` places; sum and quotient are decimals."""
    reading = valid_reading(c)
    total = F.sum(reading.cast(f"decimal(28,{PLACES})"))
    return F.try_divide(total, F.count(reading)).cast(f"decimal(38,{PLACES})").cast("double")


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias(name))


def class_counts(scored: DataFrame) -> DataFrame:
    """A3: rows per predicted class, one grouped count (not one job per class)."""
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


def motion_distribution(flagged: DataFrame) -> DataFrame:
    """A5: movement / no-movement counts and their share of all rows."""
    counts = flagged.groupBy("if_movement").agg(F.count(F.lit(1)).alias("n"))
    # The window runs over the two aggregated rows only.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", _r(F.col("n") / total))


def env_windows(wide: DataFrame, window_seconds: int = 4 * 86400,
                ts_col: str = "ts_min_bignt", by_room: bool = False) -> DataFrame:
    """CO2, temperature, humidity per tumbling time window (epoch-aligned)."""
    ts = epoch_to_timestamp(ts_col)
    keys = [F.window(ts, f"{window_seconds} seconds").alias("w")]
    if by_room:
        keys.append(F.col("room"))
    agg = wide.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        _avg("co2").alias("avg_co2"), F.min("co2").alias("min_co2"),
        F.max("co2").alias("max_co2"),
        _avg("temp").alias("avg_temp"), F.min("temp").alias("min_temp"),
        F.max("temp").alias("max_temp"),
        _avg("humidity").alias("avg_humidity"), F.min("humidity").alias("min_humidity"),
        F.max("humidity").alias("max_humidity"))
    start = F.unix_seconds(F.col("w.start"))
    return agg.select(start.alias("window_start"), epoch_to_text(start).alias("window_start_text"),
                      *([F.col("room")] if by_room else []),
                      *[c for c in agg.columns if c not in ("w", "room")])


def sensor_windows(long: DataFrame, duration: str = "1 hour", ts_col: str = "ts") -> DataFrame:
    """A6 on long readings: per sensor and event-time window."""
    agg = long.groupBy(F.window(F.col(ts_col), duration).alias("w"), "sensor").agg(
        F.count(F.lit(1)).alias("n"),
        _avg("sensor_value").alias("avg_value"),
        F.min("sensor_value").alias("min_value"),
        F.max("sensor_value").alias("max_value"))
    return agg.select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "sensor", "n", "avg_value", "min_value", "max_value")


def room_stats(wide: DataFrame) -> DataFrame:
    """Per room: rows, mean readings, movement rate."""
    moving = (movement_flag("pir") == MOVEMENT).cast("double")
    return wide.groupBy("room").agg(
        F.count(F.lit(1)).alias("n"),
        _avg("co2").alias("avg_co2"), _avg("light").alias("avg_light"),
        _avg("temp").alias("avg_temp"), _avg("humidity").alias("avg_humidity"),
        _r(F.avg(moving)).alias("movement_rate"))


def movement_by_hour(pir_readings: DataFrame, ts_col: str = "ts",
                     value_col: str = "sensor_value") -> DataFrame:
    """Movement rate by room and hour of day, from motion readings."""
    moving = (F.col(value_col) > 0.0).cast("long")
    return pir_readings.groupBy("room", F.hour(F.col(ts_col)).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(moving).alias("n_movement"),
        _r(F.avg(moving.cast("double"))).alias("movement_rate"))


def windowed_accuracy(scored: DataFrame, window_seconds: int = 4 * 86400,
                      ts_col: str = "ts_min_bignt", label: str = "label") -> DataFrame:
    """Accuracy per tumbling window (batch form; the stream uses E2)."""
    hit = (F.col("prediction") == F.col(label)).cast("long")
    agg = scored.groupBy(F.window(epoch_to_timestamp(ts_col),
                                  f"{window_seconds} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("total"), F.sum(hit).alias("correct"))
    start = F.unix_seconds(F.col("w.start"))
    return agg.select(start.alias("window_start"), "total", "correct",
                      _r(F.col("correct") * 100.0 / F.col("total")).alias("accuracy_pct"))


def by_class(scored: DataFrame, cls: float) -> DataFrame:
    """F2."""
    return scored.filter(F.col("prediction") == float(cls))


def correct_predictions(scored: DataFrame, label: str = "label") -> DataFrame:
    """F3."""
    return scored.filter(F.col("prediction") == F.col(label))


def room_time_filter(wide: DataFrame, rooms=None, start: _dt.datetime | int | None = None,
                     end: _dt.datetime | int | None = None,
                     ts_col: str = "ts_min_bignt") -> DataFrame:
    """rooms in a set, time in the half-open range [start, end).

    Plain comparisons on stored columns, so Parquet receives them as pushed
    filters. Where the table has an ``event_date`` partition column, the
    same range is also stated on it, so whole day folders are skipped; where it
    has ``room_hash`` (``ingest.write_clustered_table``), the rooms are too, so
    row groups are."""
    out = wide
    if rooms is not None:
        out = out.filter(F.col("room").isin(list(rooms)))
        if "room_hash" in wide.columns and rooms:
            # the hash of a few names, folded to literals: it reaches the scan
            hashes = [F.pmod(F.xxhash64(F.lit(r)), F.lit(1 << 16)).cast("int") for r in rooms]
            out = out.filter(F.col("room_hash").isin(hashes))
    dated = "event_date" in wide.columns
    if start is not None:
        out = out.filter(F.col(ts_col) >= _epoch(start))
        if dated:
            out = out.filter(F.col("event_date") >= _day(_epoch(start)))
    if end is not None:
        out = out.filter(F.col(ts_col) < _epoch(end))
        if dated:
            out = out.filter(F.col("event_date") <= _day(_epoch(end)))
    return out


def _day(seconds: int) -> _dt.date:
    return _dt.datetime.fromtimestamp(seconds, _dt.timezone.utc).date()


def _epoch(t) -> int:
    if isinstance(t, _dt.datetime):
        return int(t.replace(tzinfo=t.tzinfo or _dt.timezone.utc).timestamp())
    return int(t)


def sorted_series(wide: DataFrame, key: str = "room", order: str = "ts_min_bignt") -> DataFrame:
    """O1: each room's rows together and in time order.

    A global sort on (room, time): Spark range-partitions on sampled bounds, so
    a room with a third of all rows is spread over several consecutive
    partitions instead of landing in one task; each partition is then sorted.
    The bounds are sampled by a first pass over the input, so give it a stored
    table, not a join."""
    return wide.orderBy(key, order)


def preview(wide: DataFrame, n: int = 5, order=("room", "ts_min_bignt")) -> DataFrame:
    """O2: first ``n`` rows in a fixed order (top-k; the limit is the feature).
    Ties are broken by every column, so the result is deterministic."""
    rest = [c for c in wide.columns if c not in order]
    return wide.orderBy(*order, *rest).limit(n)


def shuffled(df: DataFrame, seed: int = 0, key_cols=None) -> DataFrame:
    """O3: rows in a random but repeatable order: dealt to partitions by a hash
    of the row and the seed, and ordered by it inside each. One shuffle and no
    sampling pass; a topic keeps no order between partitions anyway."""
    order = F.xxhash64(F.lit(seed), *[F.col(c) for c in (key_cols or df.columns)])
    return (df.withColumn("_order", order).repartition("_order")
              .sortWithinPartitions("_order").drop("_order"))
