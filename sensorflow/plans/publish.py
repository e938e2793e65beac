"""Publish job.

The reference sent rows one by one from a single process with a pause per
row. Here the whole table becomes ``key, value`` messages in one distributed
projection and is written by one distributed write. Rate control, where a
consumer needs it, belongs to the reading side (``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger``), not to the writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.payload import to_messages
from sensorflow.operators.analytics import shuffled
from sensorflow.operators.wide import repeat_rows


def read_table(spark: SparkSession, path: str, fmt: str | None = None, sep: str = ",",
               schema=None) -> DataFrame:
    """A delimited file with header, or Parquet for any other
    extension (as the reference decides by extension). Without a schema a
    delimited file's fields stay text: no pass to infer types, and what is
    published is what the file says (``007`` stays ``007``)."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        r = spark.read.option("header", True).option("sep", sep)
        r = r.schema(schema) if schema is not None else r
        return r.csv(path)
    return spark.read.parquet(path)


def publish_frame(df: DataFrame, sep: str = ",", payload_format: str = "csv",
                  exclude=(), key_col: str | int | None = None, repeat: int = 1,
                  shuffle_seed: int | None = None, drop_incomplete: bool = True) -> DataFrame:
    """Messages for a table: F1, drop excluded columns (absent names ignored),
    optional repeat and repeatable shuffle, then ``key, value``.

    ``key_col`` is a column name or a position among the published columns;
    a position outside them (the reference used 1000) or ``None`` means the
    stable business key (room and instant), since Spark rows have no index."""
    out = df.dropna(how="any") if drop_incomplete else df
    out = out.drop(*exclude)
    cols = list(out.columns)
    if isinstance(key_col, int):
        key_col = cols[key_col] if 0 <= key_col < len(cols) else None
    if repeat > 1:
        out = repeat_rows(out, repeat)
    if shuffle_seed is not None:
        out = shuffled(out, shuffle_seed)
    # The replay number is not part of the message, as in the reference.
    return to_messages(out, payload_format, cols=cols, sep=sep,
                       key_col=key_col if key_col in cols else None)


def write_messages(messages: DataFrame, fmt: str, target: str | None = None,
                   options: dict | None = None, mode: str = "append") -> None:
    """K3/K4: one distributed write. ``fmt='kafka'`` needs the connector on
    the class path and ``options`` with ``kafka.bootstrap.servers`` and
    ``topic``; file formats take ``target`` as the folder."""
    w = messages.write.format(fmt).options(**(options or {}))
    if fmt in ("kafka",):
        w.save()
    elif fmt == "text":
        messages.select(F.col("value")).write.mode(mode).options(**(options or {})).text(target)
    else:
        w.mode(mode).save(target)
