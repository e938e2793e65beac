"""Sensor file tree ``<root>/<room>/<sensor>.csv``.

One scan for all rooms and sensors: the glob ``*/*.csv`` skips stray files in
the root, and room and sensor come from each row's file path. A filter on
room or sensor becomes a filter on ``_metadata.file_path``, which Spark uses
to skip whole files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.cleaning import clean_readings
from sensorflow.schema import RAW_FILE_SCHEMA, SENSORS

_PATH_RE = r"([^/]+)/([^/]+)\.csv$"


def _room(path):
    """The room folder's name. File paths are URL-encoded; a plus sign stands
    for itself there, which ``url_decode`` would read as a space."""
    return F.url_decode(F.replace(F.regexp_extract(path, _PATH_RE, 1), F.lit("+"), F.lit("%2B")))


def sensor_file_glob(root: str) -> str:
    return f"{root.rstrip('/')}/*/*.csv"


HIVE_SCHEMA = "room string, ts_min_bignt string, sensor_value string, sensor string"


def read_raw_hive_tree(spark: SparkSession, root: str, sensors=SENSORS,
                       with_line_order: bool = False, files: list[str] | None = None,
                       with_source: bool = False) -> DataFrame:
    """The same readings stored as ``<root>/sensor=<sensor>/*.csv`` with the room
    as first column: five folders, however many rooms there are. A filter on
    the sensor prunes folders. ``files`` reads only these files of the tree;
    ``with_source`` adds ``source_file``."""
    df = (spark.read.schema(HIVE_SCHEMA).option("sep", ",").option("header", False)
          .option("basePath", root).csv(files or root))
    df = df.filter(F.col("sensor").isin(list(sensors)))
    cols = ["room", "sensor", F.col("ts_min_bignt").alias("ts_raw"),
            F.col("sensor_value").alias("value_raw")]
    if with_source:
        cols.append(F.col("_metadata.file_path").alias("source_file"))
    if with_line_order:
        cols.append(_line_order())
    return df.select(*cols)


def _line_order():
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row")).alias("line_order")


def write_raw_hive_tree(raw: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Raw text readings (``room, sensor, ts_raw, value_raw``) as CSV files
    partitioned by sensor, one distributed write without a shuffle: every task
    writes at most five files."""
    (raw.select("room", "ts_raw", "value_raw", "sensor")
        .write.mode(mode).partitionBy("sensor").option("header", False)
        .csv(root))


def read_raw_tree(spark: SparkSession, root: str, sensors=SENSORS,
                  with_line_order: bool = False, files: list[str] | None = None) -> DataFrame:
    """S1 + S2: ``room, sensor, ts_raw, value_raw, source_file`` for every
    line of every known sensor file (unknown names are ignored), or of the
    ``files`` of the tree that are named.

    ``with_line_order`` adds ``line_order`` for keep-latest by file position:
    the block offset orders the splits of one file, the row id orders lines
    inside a split. The row id is not deterministic across re-planning, so
    filters written after it are not pushed into the scan; it is off by
    default."""
    df = (spark.read.schema(RAW_FILE_SCHEMA).option("sep", ",").option("header", False)
          .option("mode", "PERMISSIVE").csv(files or sensor_file_glob(root)))
    path = F.col("_metadata.file_path")
    df = df.filter(F.regexp_extract(path, _PATH_RE, 2).isin(list(sensors)))
    cols = [_room(path).alias("room"),
            F.regexp_extract(path, _PATH_RE, 2).alias("sensor"),
            F.col("ts_min_bignt").alias("ts_raw"),
            F.col("sensor_value").alias("value_raw"),
            path.alias("source_file")]
    if with_line_order:
        cols.append(_line_order())
    return df.select(*cols)


def read_tree(spark: SparkSession, root: str, sensors=SENSORS, keep_raw: bool = False) -> DataFrame:
    """Typed long readings from a file tree."""
    return clean_readings(read_raw_tree(spark, root, sensors), keep_raw=keep_raw)


def read_tree_stream(spark: SparkSession, root: str, sensors=SENSORS,
                     max_files_per_trigger: int | None = None,
                     layout: str = "folders") -> DataFrame:
    """The same tree as a file stream: each new file is read once.
    ``layout``: ``folders`` (``<room>/<sensor>.csv``) or ``hive``
    (``sensor=<sensor>/*.csv`` with the room as first column)."""
    r = spark.readStream.option("sep", ",")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    path = F.col("_metadata.file_path")
    if layout == "hive":
        df = r.schema(HIVE_SCHEMA).csv(root)
        out = df.select("room", "sensor", F.col("ts_min_bignt").alias("ts_raw"),
                        F.col("sensor_value").alias("value_raw"), path.alias("source_file"))
    else:
        df = r.schema(RAW_FILE_SCHEMA).csv(sensor_file_glob(root))
        out = df.select(
            _room(path).alias("room"),
            F.regexp_extract(path, _PATH_RE, 2).alias("sensor"),
            F.col("ts_min_bignt").alias("ts_raw"),
            F.col("sensor_value").alias("value_raw"),
            path.alias("source_file"))
    return clean_readings(out.filter(F.col("sensor").isin(list(sensors))))


def found_files(raw: DataFrame) -> DataFrame:
    """Distinct (room, sensor) pairs that have a file with at least one line."""
    return raw.select("room", "sensor").distinct()
