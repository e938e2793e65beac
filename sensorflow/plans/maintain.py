"""Incremental maintenance of the wide table.

The table is partitioned by day (``event_date``). A manifest beside it lists the
source files that the table was made from, with size, modification time and the
days each one holds readings of. A refresh compares it with the present files:

1. files that are new, changed or gone are found by an anti-join of the two lists;
2. the days they hold (now, or when they were last read) are the touched days;
3. only files that hold a touched day are read, only those days are joined again,
   and they replace their partitions by dynamic overwrite; a touched day without
   rows loses its partition. Other days keep their files.

The manifest is written last, under a new version number: a refresh that fails is
repeated as a whole and gives the same table. File lists and day lists reach the
driver (Spark's own file scan holds the former there too); readings do not.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.cleaning import clean_readings
from sensorflow.functions.time import epoch_to_date
from sensorflow.operators.wide import wide_readings
from sensorflow.plans.ingest import write_wide_table
from sensorflow.session import path_exists, remove_path
from sensorflow.sources.sensor_files import read_raw_hive_tree, read_raw_tree, sensor_file_glob

MANIFEST = "file string, path string, size bigint, modified timestamp, event_date date"


@dataclass(frozen=True)
class Refresh:
    """What a refresh found and did; ``version`` is that of the manifest."""

    version: int
    files_changed: int
    files_gone: int
    files_read: int
    days: tuple


def list_files(spark: SparkSession, root: str, layout: str = "folders") -> DataFrame:
    """``file`` (as in a scan's metadata), ``path``, ``size``, ``modified`` of every
    sensor file: a listing, no content is read."""
    where = root if layout == "hive" else sensor_file_glob(root)
    if not path_exists(spark, where):
        return spark.createDataFrame([], "file string, path string, size bigint, modified timestamp")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", layout == "hive")
             .option("pathGlobFilter", "*.csv").load(where))
    return files.select(F.col("_metadata.file_path").alias("file"), "path",
                        F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _long(spark: SparkSession, root: str, layout: str, paths: list[str]) -> DataFrame:
    # a path may hold characters that a glob would read as its own
    plain = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    if layout == "hive":
        return clean_readings(read_raw_hive_tree(spark, root, files=plain, with_source=True))
    return clean_readings(read_raw_tree(spark, root, files=plain))


def _versions(spark: SparkSession, state: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/version=*/_SUCCESS")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def _publish(spark: SparkSession, draft: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(draft).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(path(draft), path(target)):
        raise OSError(f"could not rename {draft} to {target}")


def _table_files(spark: SparkSession, table: str, dates: list) -> set[str]:
    """The table's files of these days: a listing of their folders."""
    if not dates or not path_exists(spark, f"{table}/event_date=*"):
        return set()
    folders = {f"event_date={d}" for d in dates}
    return {f for f in spark.read.parquet(table).inputFiles() if f.split("/")[-2] in folders}


def manifest(spark: SparkSession, state: str) -> DataFrame | None:
    """The files and days that the table was last made from."""
    versions = _versions(spark, state)
    return spark.read.schema(MANIFEST).parquet(f"{state}/version={versions[-1]}") if versions else None


def refresh(spark: SparkSession, root: str, table: str, state: str | None = None,
            layout: str = "folders", **wide_options) -> Refresh:
    """Bring the wide ``table`` up to date with the sensor files under ``root``.

    ``state`` holds the manifest (by default a hidden folder beside the table).
    ``wide_options`` go to ``wide_readings`` and must stay the same between
    refreshes. Readings without an instant belong to no day, and to no wide row."""
    state = state or f"{table.rstrip('/')}/_manifest"
    now = list_files(spark, root, layout)
    before = manifest(spark, state)
    known = before if before is not None else spark.createDataFrame([], MANIFEST)
    marks = ["file", "size", "modified"]
    listed = known.select(*marks).distinct()
    changed = now.join(listed, marks, "left_anti")
    stale = known.join(now.select(*marks), marks, "left_anti")  # changed since, or gone
    new_paths = sorted(r["path"] for r in changed.select("path").collect())
    gone = stale.join(now.select("file"), "file", "left_anti").select("file").distinct().count()
    version = (_versions(spark, state) or [-1])[-1] + 1
    if not new_paths and not gone:
        return Refresh(version - 1, 0, 0, 0, ())

    held = changed.withColumn("event_date", F.lit(None).cast("date"))
    if new_paths:
        days = (_long(spark, root, layout, new_paths)
                .select(F.col("source_file").alias("file"), epoch_to_date("ts_min_bignt").alias("event_date"))
                .filter("event_date IS NOT NULL").distinct())
        held = changed.join(days, "file", "left")
    # the next manifest, kept apart until the table is written
    draft = f"{state}/draft"
    kept = known.join(now.select(*marks), marks, "left_semi")
    kept.unionByName(held).select("file", "path", "size", "modified", "event_date") \
        .write.mode("overwrite").parquet(draft)
    drafted = spark.read.schema(MANIFEST).parquet(draft)
    touched = (stale.select("event_date").union(held.select("event_date"))
               .filter("event_date IS NOT NULL").distinct())
    dates = sorted(r[0] for r in touched.collect())
    paths = sorted(r[0] for r in drafted.filter(F.col("event_date").isin(dates))
                   .select("path").distinct().collect()) if dates else []
    replaced = _table_files(spark, table, dates)
    if paths:
        long = _long(spark, root, layout, paths).filter(epoch_to_date("ts_min_bignt").isin(dates))
        wide = wide_readings(long.drop("source_file"), **wide_options)
        write_wide_table(wide, table, "overwrite", ("event_date",))
    # a touched day whose files are the old ones got no rows: its partition goes
    fresh = {f.rpartition("/")[0] for f in _table_files(spark, table, dates) - replaced}
    for folder in {f.rpartition("/")[0] for f in replaced} - fresh:
        remove_path(spark, folder)
    _publish(spark, draft, f"{state}/version={version}")
    for old in _versions(spark, state)[:-1]:
        remove_path(spark, f"{state}/version={old}")
    return Refresh(version, len(new_paths), gone, len(paths), tuple(dates))
