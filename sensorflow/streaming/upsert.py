"""A table with one row per key, kept up to date by micro-batches.

``KeyedTable`` is a ``foreachBatch`` sink that merges each batch by key: of the
rows of a key the newest stays. The table is partitioned by day; a batch rewrites
the days it holds rows of, into a folder of its own, and a snapshot file then says
which folder holds which day. Readers follow the newest snapshot, which appears by
one rename, so they see the table before or after a merge and nothing between; the
folders of the last ``keep`` snapshots stay for readers that have begun. A batch
that is delivered again finds its snapshot and changes nothing; one that failed
before its snapshot is merged anew.

A merge is a grouped maximum with map-side partial aggregation over the touched
days' old rows and the batch, so a key with many corrections is no single task's
load. Only day names reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorflow.session import path_exists, remove_path


class KeyedTable:
    """The table under ``target``, one row per ``key``.

    Newest is the row of the greatest ``version`` column, if one is named; of
    equal versions that of the later batch; within a batch the choice falls by
    content, the same at every delivery. ``day`` names a date or text column that
    follows from the key (null days are kept as ``none``)."""

    def __init__(self, target: str, key: Sequence[str], version: str | None = None,
                 day: str = "event_date", keep: int = 2):
        if keep < 1:
            raise ValueError("keep must be >= 1")
        self.target = target.rstrip("/")
        self.key, self.version, self.day, self.keep = tuple(key), version, day, keep

    # -- snapshots ----------------------------------------------------------

    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())

    def snapshots(self, spark: SparkSession) -> list[int]:
        """The batches that the table has taken in, of those still kept."""
        path, fs = self._fs(spark)
        found = fs.globStatus(path(f"{self.target}/_snapshots/*.json")) or []
        return sorted(int(s.getPath().getName()[: -len(".json")]) for s in found)

    def _days(self, spark: SparkSession, batch_id: int) -> dict[str, int]:
        """Day -> the batch whose folder holds it."""
        text = spark.read.text(f"{self.target}/_snapshots/{batch_id}.json", wholetext=True).first()[0]
        return json.loads(text)

    def _commit(self, spark: SparkSession, batch_id: int, days: dict[str, int]) -> None:
        path, fs = self._fs(spark)
        draft = path(f"{self.target}/_snapshots/_{batch_id}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(days, sort_keys=True).encode()))
        out.close()
        if not fs.rename(draft, path(f"{self.target}/_snapshots/{batch_id}.json")):
            raise OSError(f"could not commit batch {batch_id} of {self.target}")

    def _folder(self, day: str, batch_id: int) -> str:
        return f"{self.target}/batch_id={batch_id}/{self.day}={day}"

    # -- reading and merging --------------------------------------------------

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """The table as of its newest snapshot (``schema``: of a table without
        rows, its columns)."""
        done = self.snapshots(spark)
        rows = self._read(spark, self._days(spark, done[-1]) if done else {})
        if rows is not None:
            return rows.drop("_batch")
        if schema is None:
            raise ValueError(f"{self.target} holds no rows yet")
        return spark.createDataFrame([], schema)

    def _read(self, spark: SparkSession, days: dict[str, int]) -> DataFrame | None:
        if not days:
            return None
        folders = [self._folder(d, b) for d, b in sorted(days.items())]
        return (spark.read.option("basePath", self.target).parquet(*folders)
                     .drop("batch_id").withColumn(self.day, F.col(self.day).cast("string")))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = self.snapshots(spark)
        if done and batch_id <= done[-1]:
            return  # delivered again
        known = self._days(spark, done[-1]) if done else {}
        new = batch.withColumn(self.day, F.coalesce(F.col(self.day).cast("string"), F.lit("none"))) \
            .withColumn("_batch", F.lit(batch_id).cast("bigint")).persist()
        # calendar days, so few
        touched = sorted(r[0] for r in new.select(self.day).distinct().collect())
        old = self._read(spark, {d: known[d] for d in touched if d in known})
        rows = new if old is None else old.select(*new.columns).unionByName(new)
        if touched:
            self._newest(rows).write.mode("overwrite").partitionBy(self.day) \
                .parquet(f"{self.target}/batch_id={batch_id}")
        new.unpersist()
        self._commit(spark, batch_id, known | {d: batch_id for d in touched})
        self._clean(spark)

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.key]
        order = F.struct(*([F.col(self.version)] if self.version else []), F.col("_batch"),
                         F.xxhash64(*rest))
        best = rows.groupBy(*self.key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
        return best.select(*self.key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*rows.columns)

    def _clean(self, spark: SparkSession) -> None:
        """Drop folders that none of the last ``keep`` snapshots refers to."""
        done = self.snapshots(spark)
        used = {self._folder(d, b) for s in done[-self.keep:] for d, b in self._days(spark, s).items()}
        for s in done[: -self.keep]:
            for d, b in self._days(spark, s).items():
                if self._folder(d, b) not in used and path_exists(spark, self._folder(d, b)):
                    remove_path(spark, self._folder(d, b))
            remove_path(spark, f"{self.target}/_snapshots/{s}.json")
