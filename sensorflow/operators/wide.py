"""The wide reading: five sensors aligned per (room, instant).

Long readings (``room, sensor, ts_min_bignt, sensor_value``) for all rooms are
aligned in one plan; the room is part of the key, so the plan size does not
grow with the number of rooms.

Strategies
----------
``join`` (default, reference semantics): four inner equi-joins on
  ``(room, ts_min_bignt)``. Duplicates fan out (2 co2 x 3 pir rows = 6 rows),
  an instant missing in one sensor disappears, null keys never match. Every
  side is shuffled once on the key and the joins reuse that partitioning
  (5 exchanges, no re-shuffle between joins). A broadcast is left to Spark's
  size-checked planner and AQE's runtime statistics.
``latest``: keep the latest reading per (room, instant, sensor) (Q4) and
  pivot in the same conditional aggregate (``max_by`` per sensor). One
  shuffle with map-side partial aggregation, so a hot key never gathers its
  rows in one task. Same result as ``join`` when the (room, instant, sensor)
  keys are unique.

Hot keys in ``join``: AQE splits skewed partitions of the first join only
(the later joins read its output, not a shuffle). Ask for salting with
``hot_key_rows``: every key with more readings than that is spread over a grid
of salt buckets. Its largest sensor is dealt over the grid's rows, its second
largest over the columns, the other sensors are copied to every bucket; so a
key that is balanced over the sensors is split as well. Which keys are hot is
found by a grouped count, of those that have all five sensors (others give no
row and are not copied); their table is written once and joined like any other
(Spark's own size check decides on a broadcast).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.cleaning import complete, round_columns
from sensorflow.functions.time import epoch_to_text
from sensorflow.schema import KEY, READING_COLUMNS, SENSORS, WIDE_COLUMNS, WIDE_NAME
from sensorflow.session import scratch_path

# Join order of the reference (co2, humidity, light, pir, temperature).
JOIN_ORDER = SENSORS


def _side(long: DataFrame, sensor: str) -> DataFrame:
    return (long.filter(F.col("sensor") == sensor)
                .select(*KEY, F.col("sensor_value").alias(WIDE_NAME[sensor])))


def finish_wide(joined: DataFrame, round_digits: int | None, drop_incomplete: bool,
                keep=()) -> DataFrame:
    """Aligned readings -> the wide columns (and ``keep``): F1, P5, P4."""
    if drop_incomplete:
        # F1. Room and instant cannot be null after the inner join (null keys
        # never match) and the text time is derived from the instant, so
        # "no null column" is "no null or NaN reading". Stated on the
        # readings, each test is pushed into its own join side, before the
        # shuffle.
        joined = joined.filter(complete(READING_COLUMNS))
    out = joined.select(
        epoch_to_text("ts_min_bignt").alias("event_ts_min"),
        "ts_min_bignt", "room", *READING_COLUMNS, *keep)
    out = round_columns(out, READING_COLUMNS, round_digits)
    return out.select(*WIDE_COLUMNS, *keep)


def join_sensors(long: DataFrame) -> DataFrame:
    """Inner equi-join chain of the five sensor sides on (room, instant)."""
    sides = [_side(long, s) for s in JOIN_ORDER]
    return reduce(lambda a, b: a.join(b, list(KEY), "inner"), sides)


def hot_keys(long: DataFrame, hot_key_rows: int) -> DataFrame:
    """Keys with all sensors and more than ``hot_key_rows`` readings: their two
    largest sensors and the parts each of these is dealt to, so that a part holds about a
    fifth of ``hot_key_rows`` (five sensors meet in a bucket)."""
    if hot_key_rows < 1:
        raise ValueError("hot_key_rows must be >= 1")
    # Each sensor's keys come from a filter of its own, so only its files are
    # read; the counts are conditional counts of one grouped pass.
    keys = reduce(lambda a, b: a.unionAll(b),
                  [long.filter(F.col("sensor") == s).select(*KEY, "sensor") for s in SENSORS])
    counts = [F.count(F.when(F.col("sensor") == s, F.lit(1))) for s in SENSORS]
    sized = keys.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("total"),
        F.array(*[F.struct(n.alias("n"), F.lit(s).alias("sensor"))
                  for n, s in zip(counts, SENSORS)]).alias("by_sensor"))
    part = hot_key_rows / len(SENSORS)
    ranked = F.sort_array("by_sensor", asc=False)
    all_there = F.forall("by_sensor", lambda x: x["n"] > 0)
    return (sized.filter((F.col("total") > hot_key_rows) & all_there)
                 .select(*KEY, ranked[0].alias("first"), ranked[1].alias("second"))
                 .select(*KEY,
                         F.col("first.sensor").alias("_row_sensor"),
                         F.ceil(F.col("first.n") / part).alias("_rows"),
                         F.col("second.sensor").alias("_column_sensor"),
                         F.greatest(F.ceil(F.col("second.n") / part), F.lit(1)).alias("_columns")))


def join_sensors_salted(long: DataFrame, hot_key_rows: int,
                        row_id: str | Column | None = None) -> DataFrame:
    """J1 with hot keys split over salt buckets; same rows as ``join_sensors``.

    Each side is filtered to its sensor first (so the filter reaches the scan);
    rows are dealt by a hash of ``row_id``, a column or an expression, or without
    one of all their columns (equal rows then stay together). A task that is run
    again must find the same ids: a row number is one only over a plain scan.
    The hot keys are found by a first pass and written under the session's
    checkpoint folder. Every output row is produced once: the
    two dealt sensors meet in one bucket, the others are copied to all. Other
    keys have one bucket and pass through unchanged."""
    path = scratch_path(long.sparkSession, "hot-keys")
    hot_keys(long, hot_key_rows).write.parquet(path)
    hot = long.sparkSession.read.parquet(path)
    rows, columns = (F.coalesce(F.col(c), F.lit(1)) for c in ("_rows", "_columns"))

    def salted(sensor: str) -> DataFrame:
        side = long.filter(F.col("sensor") == sensor)
        own = F.xxhash64(*long.columns) if row_id is None else \
            F.col(row_id) if isinstance(row_id, str) else row_id
        side = side.select(*KEY, F.col("sensor_value").alias(WIDE_NAME[sensor]), own.alias("_row"))
        place = F.xxhash64("_row")

        def dealt(to: str, parts):
            return F.when(F.col(to) == sensor, F.array(F.pmod(place, parts))).otherwise(
                F.sequence(F.lit(0).cast("bigint"), parts - 1))

        grid = F.flatten(F.transform(
            dealt("_row_sensor", rows),
            lambda r: F.transform(dealt("_column_sensor", columns), lambda c: r * columns + c)))
        return side.join(hot, list(KEY), "left").select(
            *KEY, WIDE_NAME[sensor], F.explode(grid).alias("_salt"))

    joined = reduce(lambda a, b: a.join(b, [*KEY, "_salt"], "inner"),
                    [salted(s) for s in JOIN_ORDER])
    return joined.drop("_salt")


def latest_per_sensor_wide(long: DataFrame, order_col: str) -> DataFrame:
    """Q4 keep-latest + conditional aggregate in one grouped pass.

    For each sensor, ``max_by(value, order)`` over that sensor's rows (other
    rows give a null order, which ``max_by`` ignores) picks the reading with
    the largest ``order_col``; a count of the sensor's rows tells presence.
    With a primitive order column the buffers are primitive, so Spark runs a
    hash aggregate with map-side partial aggregation. Inner semantics: the
    key is kept only when all five sensors are present.
    """
    aggs = []
    for s in SENSORS:
        is_s = F.col("sensor") == s
        aggs.append(F.max_by(F.col("sensor_value"), F.when(is_s, F.col(order_col)))
                    .alias(WIDE_NAME[s]))
        aggs.append(F.count(F.when(is_s, F.lit(1))).alias(f"_n_{WIDE_NAME[s]}"))
    grouped = long.filter(F.col("room").isNotNull() & F.col("ts_min_bignt").isNotNull()) \
        .groupBy(*KEY).agg(*aggs)
    present = reduce(lambda a, b: a & b, [F.col(f"_n_{WIDE_NAME[s]}") > 0 for s in SENSORS])
    return grouped.filter(present).select(*KEY, *READING_COLUMNS)


def wide_readings(long: DataFrame, how: str = "join", round_digits: int | None = 6,
                  drop_incomplete: bool = True, order_col: str | None = None,
                  hot_key_rows: int | None = None,
                  row_id: str | Column | None = None) -> DataFrame:
    """Long readings -> wide rows ``event_ts_min, ts_min_bignt, room, co2,
    light, temp, humidity, pir``.

    ``round_digits=6, drop_incomplete=True`` is version 1 of the reference;
    ``round_digits=None, drop_incomplete=False`` is version 2.

    ``hot_key_rows`` asks for the salted join: keys with more readings are
    split (``row_id`` tells the rows of a key apart).
    The rows are the same with and without.
    """
    if how == "join":
        joined = join_sensors_salted(long, hot_key_rows, row_id) if hot_key_rows \
            else join_sensors(long)
    elif how == "latest":
        if not order_col:
            raise ValueError("how='latest' needs order_col")
        joined = latest_per_sensor_wide(long, order_col)
    else:
        raise ValueError(f"unknown strategy {how!r}")
    return finish_wide(joined, round_digits, drop_incomplete)


def union_frames(frames) -> DataFrame:
    """Union by column name, keeping duplicates."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), frames)


def repeat_rows(df: DataFrame, times: int, replay_col: str = "replay") -> DataFrame:
    """Every row ``times`` times, numbered 1..times in ``replay_col``.

    A generator, not a join: each input row emits its copies in place, so no
    shuffle and no replicated side.
    """
    if times < 1:
        raise ValueError("times must be >= 1")
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias(replay_col))
