"""Message streams.

A message source delivers ``value`` (and optionally ``key``) as text. The
broker connector is chosen by format name (``kafka``) and needs its package
on the class path; the file formats (``text``, ``json``, ``parquet``) serve
tests and file-drop ingestion with the same downstream code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.schema import MESSAGE_SCHEMA


def read_messages(spark: SparkSession, fmt: str, path: str | None = None,
                  options: dict | None = None, starting: str = "latest",
                  max_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``key, value`` strings.

    ``starting`` / ``max_per_trigger`` map to ``startingOffsets`` /
    ``maxOffsetsPerTrigger`` for a broker and to ``maxFilesPerTrigger`` for
    files (a file source always starts with the files present)."""
    opts = dict(options or {})
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts.setdefault("startingOffsets", starting)
        if starting == "earliest":
            opts.setdefault("failOnDataLoss", "false")
        if max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
        df = r.options(**opts).load()
        return df.select(F.col("key").cast("string"), F.col("value").cast("string"))
    if max_per_trigger:
        opts.setdefault("maxFilesPerTrigger", str(max_per_trigger))
    if fmt == "text":
        df = r.options(**opts).load(path)
        return df.select(F.lit(None).cast("string").alias("key"), F.col("value"))
    df = r.schema(MESSAGE_SCHEMA).options(**opts).load(path)
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"))


def read_messages_batch(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """The same messages as a bounded frame (for stream = batch checks)."""
    if fmt == "text":
        return spark.read.text(path).select(F.lit(None).cast("string").alias("key"), "value")
    return spark.read.format(fmt).schema(MESSAGE_SCHEMA).load(path)
