"""Statistics over any time range from stored partial aggregates.

A batch of readings is reduced once to partial aggregates per room, sensor and
hour, and these to days: counts, exact decimal sums, extremes, and a quantile
sketch, all of which merge. A range is then answered from whole days and, at its
ragged ends, hours; readings are never read again, and the rows read grow with
rooms, sensors and days, not with readings.

``Rollup`` is a ``foreachBatch`` sink (or called with batches): each batch has
folders of its own, so one that is delivered again replaces itself, and late
readings simply add partials to the hours they belong to.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.cleaning import valid_reading
from sensorflow.functions.time import epoch_to_date, valid_epoch
from sensorflow.operators.analytics import PLACES

HOUR, DAY = 3600, 86400
KEY = ("room", "sensor")
#: Size of the quantile sketches: rank error about 1.3 % (99 % confidence).
SKETCH = 200


def _bucket(seconds, width: int):
    return (F.floor(seconds / width) * width).cast("bigint")


def hourly_partials(long: DataFrame, ts: str = "ts_min_bignt", value: str = "sensor_value") -> DataFrame:
    """``room, sensor, bucket`` (the hour's first second) and its partials:
    ``n_rows``, and of the valid readings ``n``, ``total``, ``low``, ``high`` and
    ``sketch``. Rows without an instant belong to no hour and are left out; null
    rooms and sensors are groups."""
    reading = valid_reading(value)
    rows = long.withColumn("_s", valid_epoch(ts)).filter("_s IS NOT NULL") \
        .select(*KEY, _bucket(F.col("_s"), HOUR).alias("bucket"), reading.alias("_v"))
    return rows.groupBy(*KEY, "bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_v").alias("n"),
        F.sum(F.col("_v").cast(f"decimal(28,{PLACES})")).cast(f"decimal(38,{PLACES})").alias("total"),
        F.min("_v").alias("low"), F.max("_v").alias("high"),
        F.kll_sketch_agg_double("_v", SKETCH).alias("sketch"))


def _merged(partials: DataFrame, *by) -> DataFrame:
    return partials.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"),
        F.sum("total").cast(f"decimal(38,{PLACES})").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch", SKETCH).alias("sketch"))


class Rollup:
    """Hourly and daily partials under ``target``."""

    def __init__(self, target: str):
        self.target = target.rstrip("/")

    def _path(self, grain: str) -> str:
        return f"{self.target}/grain={grain}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        hours = f"{self._path('hour')}/batch_id={batch_id}"
        self._write(hourly_partials(batch), hours)
        days = batch.sparkSession.read.parquet(hours).withColumn("bucket", _bucket(F.col("bucket"), DAY))
        self._write(_merged(days, *KEY, "bucket"), f"{self._path('day')}/batch_id={batch_id}")

    @staticmethod
    def _write(partials: DataFrame, path: str) -> None:
        # by year: few folders; the buckets' statistics prune within
        partials.withColumn("year", F.year(epoch_to_date("bucket"))).sortWithinPartitions("bucket") \
            .write.mode("overwrite").partitionBy("year").parquet(path)

    def partials(self, spark: SparkSession, start: int, end: int) -> DataFrame:
        """The partials that make up [start, end): days where whole ones fit, else
        hours. Both ends must be full hours (epoch seconds)."""
        if start % HOUR or end % HOUR or start > end:
            raise ValueError("a range needs full hours, start before end")

        def read(grain: str, *spans: tuple[int, int]) -> DataFrame | None:
            spans = [(a, b) for a, b in spans if a < b]
            if not spans:
                return None
            inside = F.lit(False)
            for a, b in spans:
                inside = inside | ((F.col("bucket") >= a) & (F.col("bucket") < b)
                                   & F.col("year").between(_year(a), _year(b - 1)))
            return spark.read.parquet(self._path(grain)).filter(inside)

        first, last = -(-start // DAY) * DAY, end // DAY * DAY
        parts = [read("day", (first, last)), read("hour", (start, first), (last, end))] if first < last \
            else [read("hour", (start, end))]
        parts = [p for p in parts if p is not None]
        if not parts:
            return spark.read.parquet(self._path("hour")).limit(0)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def statistics(self, spark: SparkSession, start: int, end: int, by: Sequence[str] = KEY,
                   quantiles: Sequence[float] = (0.5,)) -> DataFrame:
        """Per ``by`` (of room and sensor): ``n_rows, n, avg_value, min_value,
        max_value`` of [start, end), exact, and approximate quantiles (``q50`` ...)."""
        merged = _merged(self.partials(spark, start, end), *by)
        mean = F.try_divide("total", "n").cast(f"decimal(38,{PLACES})").cast("double")
        return merged.select(
            *by, "n_rows", "n", mean.alias("avg_value"), F.col("low").alias("min_value"),
            F.col("high").alias("max_value"),
            *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))))
              .alias(f"q{round(100 * q)}") for q in quantiles])


def _year(seconds: int) -> int:
    return _dt.datetime.fromtimestamp(seconds, _dt.timezone.utc).year
