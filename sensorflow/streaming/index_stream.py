"""Entry point B: messages -> parse -> movement flag -> search documents.

``index_documents`` is a plain transformation, so the same code serves a
bounded frame and a stream. ``start_index_stream`` writes each micro-batch
into its own folder (replays overwrite, nothing is collected to the driver);
an external search index would be fed from that table, with ``content_id``
(``distinct=True``) as the document id for idempotent upserts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.features import search_document, with_movement
from sensorflow.functions.payload import invalid_reason, parse_payload, time_to_epoch_ms
from sensorflow.functions.time import epoch_to_date, epoch_to_timestamp, text_to_epoch_seconds
from sensorflow.schema import DOCUMENT_FIELDS, WIDE_COLUMNS
from sensorflow.streaming.event_time import drop_resent
from sensorflow.streaming.sinks import BatchDirSink, start
from sensorflow.streaming.upsert import KeyedTable


def index_documents(messages: DataFrame, payload_format: str = "csv",
                    now: _dt.datetime | None = None, fill_value: float | None = 0.0,
                    time_as: str = "epoch_ms", with_reason: bool = False,
                    with_day: bool = False) -> DataFrame:
    """P12 -> P13/P15 -> P7 -> P19 -> P14.

    ``time_as='epoch_ms'`` follows the first version (text time parsed to
    epoch ms, unparsable -> ``now``); ``'timestamp'`` follows the second
    (a timestamp, null when unparsable); ``'text'`` keeps the text.
    ``with_reason`` adds ``reason``: the fields that were missing or
    unparsable in the message (null when none), found before any fill.
    ``with_day`` adds ``event_date``, the UTC day of the message's instant."""
    parsed = parse_payload(messages, payload_format)
    keep = ()
    if with_day:
        parsed = parsed.withColumn("event_date", epoch_to_date("ts_min_bignt"))
        keep = ("event_date",)
    if with_reason:
        parsed = parsed.withColumn("reason", invalid_reason(parsed, WIDE_COLUMNS))
        keep += ("reason",)
    if time_as == "epoch_ms":
        parsed = time_to_epoch_ms(parsed, now)
    elif time_as == "timestamp":
        parsed = parsed.withColumn(
            "event_ts_min", epoch_to_timestamp(text_to_epoch_seconds("event_ts_min")))
    elif time_as != "text":
        raise ValueError(f"unknown time_as {time_as!r}")
    return search_document(with_movement(parsed), fill_value=fill_value, keep=keep)


def with_status(docs: DataFrame) -> DataFrame:
    """``status`` = ``ok`` or ``quarantine`` from ``reason``."""
    return docs.withColumn("status", F.when(F.col("reason").isNull(), F.lit("ok"))
                           .otherwise(F.lit("quarantine")))


def start_index_stream(messages: DataFrame, target: str, checkpoint: str,
                       payload_format: str = "csv", trigger: dict | None = None,
                       now: _dt.datetime | None = None, query_name: str | None = None,
                       quarantine: bool = False, distinct: bool = False,
                       time_as: str = "epoch_ms", fill_value: float | None = 0.0):
    """Run the index pipeline on a stream into ``target/batch_id=N``.

    With ``quarantine``, every batch is still written once, partitioned by
    ``status``: complete documents under ``status=ok``, rows with missing or
    unparsable fields (and their ``reason``) under ``status=quarantine``.
    ``distinct`` (E1) drops documents equal to one that arrived before
    (``event_time.drop_resent``). ``time_as`` and ``fill_value`` as in ``index_documents``."""
    docs = index_documents(messages, payload_format, now=now, with_reason=quarantine,
                           with_day=distinct, time_as=time_as, fill_value=fill_value)
    if distinct:
        docs = drop_resent(docs, DOCUMENT_FIELDS)
    sink = BatchDirSink(target, partition_by=(("event_date",) if distinct else ())
                        + (("status",) if quarantine else ()),
                        transform=with_status if quarantine else None)
    q = start(docs, sink, checkpoint, trigger=trigger or {"processingTime": "20 seconds"},
              query_name=query_name)
    return q, sink


def start_document_upserts(messages: DataFrame, target: str, checkpoint: str,
                           payload_format: str = "csv", trigger: dict | None = None,
                           now: _dt.datetime | None = None, key=("room", "event_ts_min"),
                           query_name: str | None = None, time_as: str = "epoch_ms",
                           fill_value: float | None = 0.0):
    """The index pipeline into a table with one document per ``key`` (K6): a
    corrected reading replaces the earlier document."""
    docs = index_documents(messages, payload_format, now=now, with_day=True, time_as=time_as,
                           fill_value=fill_value)
    table = KeyedTable(target, key)
    q = start(docs, table, checkpoint, trigger=trigger or {"processingTime": "20 seconds"},
              query_name=query_name)
    return q, table
