"""The reference's five programs as functions: ingest, train, publish, index
stream, scoring stream. Each takes a session and paths/options; none creates
a session, sets a master or deletes a target.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.payload import to_messages
from sensorflow.operators import model as M
from sensorflow.plans.ingest import build_wide, export_csv, write_wide_table
from sensorflow.plans.publish import publish_frame, read_table, write_messages
from sensorflow.sources.streams import read_messages
from sensorflow.streaming.index_stream import start_index_stream
from sensorflow.schema import WIDE_SCHEMA
from sensorflow.session import scratch_path
from sensorflow.streaming.scoring import start_prediction_messages, start_scoring_stream
from sensorflow.sources.sensor_files import read_tree_stream
from sensorflow.streaming.sinks import checkpoint_for, start


@dataclass
class IngestResult:
    wide: DataFrame
    rows: int
    seconds: float


def run_ingest(spark: SparkSession, root: str, table_path: str | None = None,
               csv_path: str | None = None, version: int = 1, layout: str = "folders",
               messages_path: str | None = None, payload_format: str = "json",
               messages_format: str = "json", messages_options: dict | None = None
               ) -> IngestResult:
    """Entry point A: sensor files -> wide table (Parquet, optional CSV
    export) and, as the second version did, the rows as messages.

    The join runs once: when the table is written, the other outputs read it
    back (no cache of the whole result, no second join). The row count is
    observed during the first write, not counted by another job."""
    t0 = time.time()
    wide = build_wide(spark, root, version=version, layout=layout)
    send = bool(messages_path) or messages_format == "kafka"
    if not table_path and csv_path and send:
        table_path = scratch_path(spark, "wide")  # two outputs: join once, read back twice
    obs = Observation("ingested")
    counted = wide.observe(obs, F.count(F.lit(1)).alias("rows"))
    written = False  # the first write goes through ``counted``
    if table_path:
        write_wide_table(counted, table_path)
        wide, written = spark.read.parquet(table_path), True
    if csv_path:
        export_csv(wide if written else counted, csv_path)
        written = True
    if send:
        write_messages(to_messages(wide if written else counted, payload_format, with_key=False),
                       messages_format, messages_path, messages_options, mode="append")
        written = True
    rows = int(obs.get["rows"]) if written else wide.count()
    return IngestResult(wide, rows, round(time.time() - t0, 3))


@dataclass
class TrainingResult:
    fit: M.FitReport
    accuracy_in_sample: float
    accuracy_holdout: float | None


def run_training(spark: SparkSession, table_path: str, model_path: str,
                 table_format: str | None = None, holdout_from: _dt.datetime | None = None
                 ) -> TrainingResult:
    """Entry point C, first half: read the wide table, fit, save, evaluate
    in-sample (as the reference) and on a time hold-out (when given: the fit
    then uses only the rows before it). A delimited table is read with the wide
    schema, not an inferred one."""
    wide = read_table(spark, table_path, fmt=table_format, schema=WIDE_SCHEMA)
    cutoff = int(holdout_from.replace(tzinfo=holdout_from.tzinfo or _dt.timezone.utc)
                 .timestamp()) if holdout_from else None
    train, test = (M.time_split(wide, cutoff) if cutoff is not None else (wide, None))
    rep = M.fit(train)
    M.save(rep.model, model_path)
    in_sample = M.accuracy(M.score(M.with_label(train), rep.linear)).first().accuracy_pct
    held = None
    if test is not None:
        held = M.accuracy(M.score(M.with_label(test), rep.linear)).first().accuracy_pct
    return TrainingResult(rep, in_sample, held)


def run_publish(spark: SparkSession, input_path: str, fmt: str, target: str | None = None,
                options: dict | None = None, sep: str = ",", message_sep: str = ",",
                exclude=(), key_col: str | None = None, repeat: int = 1,
                shuffle_seed: int | None = None, input_format: str | None = None) -> int:
    """The publisher: a table -> ``key, value`` messages in one write.
    Returns the number of messages written, counted during the write."""
    table = read_table(spark, input_path, fmt=input_format, sep=sep)
    msgs = publish_frame(table, sep=message_sep, exclude=exclude, key_col=key_col,
                         repeat=repeat, shuffle_seed=shuffle_seed)
    obs = Observation("published")
    write_messages(msgs.observe(obs, F.count(F.lit(1)).alias("n")), fmt, target, options)
    return int(obs.get["n"])


def run_index_stream(spark: SparkSession, source_format: str, source: str | None,
                     target: str, payload_format: str = "csv", source_options: dict | None = None,
                     starting: str = "latest", max_per_trigger: int | None = None,
                     trigger: dict | None = None, checkpoint: str | None = None,
                     quarantine: bool = False, distinct: bool = False,
                     time_as: str = "epoch_ms", fill_value: float | None = 0.0):
    """Entry point B: messages -> documents, one folder per micro-batch."""
    msgs = read_messages(spark, source_format, source, source_options, starting, max_per_trigger)
    return start_index_stream(msgs, target, checkpoint_for(spark, target, checkpoint),
                              payload_format=payload_format, trigger=trigger,
                              quarantine=quarantine, distinct=distinct, time_as=time_as,
                              fill_value=fill_value)


def run_scoring_stream(spark: SparkSession, model_path: str, source_format: str,
                       source: str | None, target: str, payload_format: str = "csv",
                       source_options: dict | None = None, starting: str = "latest",
                       max_per_trigger: int | None = None, trigger: dict | None = None,
                       checkpoint: str | None = None, invalid: str = "skip",
                       distinct: bool = False, message_format: str | None = None,
                       message_options: dict | None = None, topics: dict | None = None):
    """Entry point C, second half: score messages, route by class. With
    ``message_format`` the predictions go out as messages with a topic: to
    folders under ``target`` for a file format, to the broker that
    ``message_options`` name otherwise (``target`` then only keeps the
    checkpoint)."""
    model = M.linear_of(M.load(model_path))
    msgs = read_messages(spark, source_format, source, source_options, starting, max_per_trigger)
    checkpoint = checkpoint_for(spark, target, checkpoint)
    if message_format:
        files = message_format in ("parquet", "json", "orc", "csv")
        return start_prediction_messages(
            msgs, model, checkpoint, message_format, target if files else None, message_options,
            payload_format, trigger, topics=topics)
    return start_scoring_stream(msgs, model, target, checkpoint,
                                payload_format=payload_format, trigger=trigger,
                                invalid=invalid, distinct=distinct)


def run_long_ingest_stream(spark: SparkSession, root: str, table_path: str,
                           trigger: dict | None = None, checkpoint: str | None = None,
                           max_files_per_trigger: int | None = None,
                           layout: str = "folders"):
    """Continuous ingest (W5 re-aimed): new sensor files -> the long table,
    partitioned by sensor, appended by a file sink. Each file is read once
    (the reference re-read every room every 30 s); the file sink's commit log
    makes a replayed batch invisible to readers of the table folder."""
    long = read_tree_stream(spark, root, max_files_per_trigger=max_files_per_trigger,
                            layout=layout)
    return start(long.drop("source_file"), "parquet", checkpoint_for(spark, table_path, checkpoint),
                 trigger=trigger or {"processingTime": "30 seconds"},
                 options={"path": table_path}, partition_by=("sensor",))


def routed_counts(routes: DataFrame) -> DataFrame:
    """Rows per route and batch from a scoring target."""
    return routes.groupBy("batch_id", "route").agg(F.count(F.lit(1)).alias("n"))
