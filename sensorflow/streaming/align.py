"""The wide reading on a stream (J1, W5): five sensor streams joined as they come.

Each sensor's readings are a stream of their own with its own watermark, and the
four inner joins of the batch form become stream-stream joins on (room, instant).
A row is emitted as soon as its last reading arrives. Spark holds the readings of
an instant as join state until the watermark has passed it; the watermark is the
least of the five sensors' (the default policy), so a sensor that is delivered
late, or not at all yet, holds the others' readings instead of losing its own.
State is therefore bounded by the readings of ``delay`` and of the slowest
sensor's lag. (Spark's first watermark is the epoch, so instants up to
1970-01-01 00:00:00 always count as late.) Readings behind the watermark are dropped and counted by Spark
(``Totals`` sums them as ``late``).

The joins share one partitioning by (room, instant), so a reading is shuffled
once. Duplicates fan out as in the batch join. For long delays use the RocksDB
state store (``session.sizing_conf``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorflow.functions.time import epoch_to_timestamp
from sensorflow.operators.wide import JOIN_ORDER, finish_wide
from sensorflow.schema import KEY, WIDE_NAME
from sensorflow.streaming.sinks import BatchDirSink, start


def align_stream(long: DataFrame, delay: str = "2 days", round_digits: int | None = 6,
                 drop_incomplete: bool = True) -> DataFrame:
    """Long readings (``room, sensor, ts_min_bignt, sensor_value``; a stream) ->
    wide rows, and ``event_time``. Readings without a room or an instant match
    nothing and are left out before they become state; with ``drop_incomplete``
    so are readings that are missing or out of range."""
    keyed = long.filter(F.col(KEY[0]).isNotNull()).withColumn("event_time", epoch_to_timestamp(KEY[1]))
    keyed = keyed.filter(F.col("event_time").isNotNull())

    def side(sensor: str) -> DataFrame:
        return (keyed.filter(F.col("sensor") == sensor).withWatermark("event_time", delay)
                     .select(*KEY, "event_time", F.col("sensor_value").alias(WIDE_NAME[sensor])))

    joined = reduce(lambda a, b: a.join(b, [*KEY, "event_time"], "inner"), [side(s) for s in JOIN_ORDER])
    return finish_wide(joined, round_digits, drop_incomplete, keep=("event_time",))


def start_align_stream(long: DataFrame, target: str, checkpoint: str, delay: str = "2 days",
                       trigger: dict | None = None, query_name: str | None = None,
                       **options) -> tuple[StreamingQuery, BatchDirSink]:
    """Align a stream of long readings into ``target/batch_id=N``, each batch
    written once and replaced when it is replayed."""
    sink = BatchDirSink(target, transform=lambda b: b.drop("event_time"))
    q = start(align_stream(long, delay, **options), sink, checkpoint,
              trigger=trigger or {"processingTime": "30 seconds"}, query_name=query_name)
    return q, sink
