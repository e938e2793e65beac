"""Batch ingest (entry point A): sensor files -> wide table (K1, K2, D3).

The reference looped over rooms on the driver (the plan grew by five scans
and four joins per room), unioned them, wrote one CSV through
``coalesce(1)`` and concatenated part files in a shell. Here one scan covers
all rooms, the join keys include the room, and the result is written by all
tasks at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.operators.wide import wide_readings
from sensorflow.schema import WIDE_SCHEMA
from sensorflow.functions.cleaning import clean_readings
from sensorflow.functions.time import epoch_to_date
from sensorflow.sources.sensor_files import read_raw_hive_tree, read_raw_tree


def build_wide(spark: SparkSession, root: str, version: int = 1, layout: str = "folders",
               **wide_options) -> DataFrame:
    """Version 1: round to 6 digits, drop incomplete rows. Version 2: neither.

    Each join side reads its own sensor's files only. ``hot_key_rows`` splits
    keys with more readings over salt buckets. ``layout``: ``folders``
    (``<room>/<sensor>.csv``) or ``hive`` (``sensor=<sensor>/*.csv``)."""
    opts = {"round_digits": 6, "drop_incomplete": True} if version == 1 else \
        {"round_digits": None, "drop_incomplete": False}
    opts.update(wide_options)
    if opts.get("hot_key_rows"):
        # the sides are plain scans, so a row's number in its task is stable
        opts.setdefault("row_id", F.monotonically_increasing_id())
    reader = read_raw_hive_tree if layout == "hive" else read_raw_tree
    long = clean_readings(reader(spark, root))
    return wide_readings(long, **opts)


def write_wide_table(wide: DataFrame, path: str, mode: str = "overwrite",
                     partition_by: tuple[str, ...] = ()) -> None:
    """D3 as Parquet. ``mode='overwrite'`` replaces the table;
    ``mode='append'`` adds (K2's incremental form). With ``partition_by``
    and dynamic partition overwrite, only the partitions present in
    ``wide`` are replaced. ``partition_by=("event_date",)`` adds that column
    (UTC day of the instant): time-range filters then skip whole folders,
    and the folder count grows with days, not with rooms."""
    if "event_date" in partition_by and "event_date" not in wide.columns:
        wide = with_event_date(wide)
    if partition_by:
        # Few files per folder; AQE splits a hot partition value over tasks.
        wide = wide.hint("rebalance", *partition_by)
    w = wide.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def with_event_date(wide: DataFrame, ts_col: str = "ts_min_bignt") -> DataFrame:
    """``event_date``: the UTC calendar day of the instant (zone-independent)."""
    return wide.withColumn("event_date", epoch_to_date(ts_col))


def room_hash(room) -> Column:
    """16 bits of a hash of the room: a column whose statistics can skip rooms,
    however their names sort."""
    return F.pmod(F.xxhash64(room), F.lit(1 << 16)).cast("int")


def _spread(x: Column) -> Column:
    """The 16 bits of ``x``, each followed by a free place."""
    for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, step)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def with_cluster(wide: DataFrame, ts_col: str = "ts_min_bignt") -> DataFrame:
    """``room_hash``, and ``_cluster``: its bits interleaved with those of the
    instant's place between the earliest and the latest one."""
    low, high = wide.agg(F.min(ts_col), F.max(ts_col)).first()
    low, span = low or 0, max(1, (high or 0) - (low or 0))
    place = F.coalesce(F.floor((F.col(ts_col) - low).cast("double") / span * 65535), F.lit(0)).cast("bigint")
    hashed = wide.withColumn("room_hash", room_hash("room"))
    code = F.shiftleft(_spread(F.col("room_hash").cast("bigint")), 1).bitwiseOR(_spread(place))
    return hashed.withColumn("_cluster", code)


def write_clustered_table(wide: DataFrame, path: str, rows_per_file: int = 5_000_000,
                          mode: str = "overwrite") -> None:
    """D3 clustered by room and time at once (F4): the rows lie along a curve that
    interleaves both, so a file, and each row group in it, holds few rooms over a
    short time. ``room_time_filter`` states a room filter on ``room_hash`` too, and
    Parquet's statistics then skip row groups for a room filter alone, a time
    filter alone, and both. A hot room is cut by time. The curve's ends come from a
    first pass, so give it a stored table."""
    files = max(1, -(-wide.count() // rows_per_file))
    (with_cluster(wide).repartitionByRange(files, "_cluster").sortWithinPartitions("_cluster")
     .drop("_cluster").write.mode(mode).parquet(path))


def export_csv(wide: DataFrame, path: str, single_file: bool = False) -> None:
    """K1: CSV with header. ``single_file`` funnels all rows through one
    task (the reference's ``coalesce(1)``); only for small exports."""
    out = wide.coalesce(1) if single_file else wide
    out.write.mode("overwrite").option("header", True).csv(path)


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: the training CSV with its explicit schema (bigint seconds,
    double readings)."""
    return spark.read.schema(WIDE_SCHEMA).option("header", True).csv(path)


def write_long_table(long: DataFrame, path: str, mode: str = "overwrite",
                     table: str | None = None, buckets: int | None = None) -> None:
    """Long readings as Parquet partitioned by sensor (five folders). The wide
    join's per-sensor sides then read only their own folder: one pass over
    the data for all five sides. Within a folder, rows are clustered by
    (room, instant) so Parquet statistics can skip row groups for room or
    time filters.

    With ``table`` and ``buckets`` the data is also bucketed by (room,
    instant) and registered in the session's catalog: every later wide join
    over the table reads co-partitioned buckets and shuffles nothing. The
    bucket count should give files of a few hundred MB per sensor."""
    if buckets:
        if not table:
            raise ValueError("bucketing needs a table name (bucket metadata lives in the catalog)")
        # Shuffle partitions = buckets, so each task writes one file per bucket
        # (not one per bucket per input task); AQE may still split a hot
        # bucket over several tasks, which only adds files to that bucket.
        (long.hint("rebalance", buckets, "room", "ts_min_bignt")
             .write.mode(mode).partitionBy("sensor")
             .bucketBy(buckets, "room", "ts_min_bignt").sortBy("room", "ts_min_bignt")
             .option("path", path).saveAsTable(table))
        return
    (long.repartitionByRange("sensor", "room", "ts_min_bignt")
         .sortWithinPartitions("sensor", "room", "ts_min_bignt")
         .write.mode(mode).partitionBy("sensor").parquet(path))


def read_long_table(spark: SparkSession, path: str | None = None,
                    table: str | None = None) -> DataFrame:
    """The long table by path, or by catalog name (keeps the bucketing)."""
    return spark.table(table) if table else spark.read.parquet(path)
