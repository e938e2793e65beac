"""Event-time operators added for replays and time windows.

E1 drops messages that were sent before. E2 computes windowed metrics on the
stream; in append mode each window is emitted once the watermark has passed it, in
update mode into a keyed table (``upsert.KeyedTable``) open windows are visible
and refined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.time import epoch_to_date, epoch_to_timestamp
from sensorflow.operators.analytics import _avg, _r


def with_event_time(df: DataFrame, seconds_col: str = "ts_min_bignt",
                    out: str = "event_time") -> DataFrame:
    return df.withColumn(out, epoch_to_timestamp(seconds_col))


def drop_resent(df: DataFrame, columns, keep: str = "30 days") -> DataFrame:
    """Messages of a day that are equal in ``columns`` pass once, with ``content_id``
    (their hash) and ``event_date`` (the day of their instant, or ``none``).

    Spark keeps the ids as keyed state, so a batch looks up its own ids only,
    however many batches came before. The state's time is the arrival, not the
    instant: nothing is ever late, and rooms that are delivered one after another
    or without an instant lose nothing. An id is forgotten ``keep`` after its
    arrival at the earliest; a message sent again later passes again."""
    day = epoch_to_date("ts_min_bignt") if "ts_min_bignt" in df.columns else F.col("event_date")
    marked = df.withColumns({
        "content_id": F.sha2(F.to_json(F.struct(*columns)), 256),
        "event_date": F.coalesce(day.cast("string"), F.lit("none")),
        "_arrival": F.current_timestamp()})
    return (marked.withWatermark("_arrival", keep).dropDuplicatesWithinWatermark(["event_date", "content_id"])
                  .drop("_arrival"))


def windowed_metrics(df: DataFrame, window: str = "4 days", delay: str = "2 days",
                     time_col: str = "event_time", by_room: bool = True) -> DataFrame:
    """Per window (and room) counts and means, emitted when closed."""
    keys = [F.window(F.col(time_col), window).alias("w")]
    if by_room:
        keys.append(F.col("room"))
    agg = (df.withWatermark(time_col, delay).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        _avg("co2").alias("avg_co2"),
        _avg("temp").alias("avg_temp"),
        _avg("humidity").alias("avg_humidity")))
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"),
                      *([F.col("room")] if by_room else []), "n", "avg_co2", "avg_temp",
                      "avg_humidity")


def windowed_accuracy(scored: DataFrame, window: str = "4 days", delay: str = "2 days",
                      time_col: str = "event_time", label: str = "label") -> DataFrame:
    """A9 on a stream: share of correct predictions per event-time window,
    emitted once the watermark has passed the window."""
    hit = (F.col("prediction") == F.col(label)).cast("long")
    agg = (scored.withWatermark(time_col, delay)
                 .groupBy(F.window(F.col(time_col), window).alias("w"))
                 .agg(F.count(F.lit(1)).alias("total"), F.sum(hit).alias("correct")))
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "total", "correct",
                      _r(F.col("correct") * 100.0 / F.col("total")).alias("accuracy_pct"))
