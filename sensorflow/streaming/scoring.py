"""Entry point C, second half: score a message stream and route by class.

Parse (either payload format) -> score (closed form of the fitted model, no
vector and no Python per row) -> one write per micro-batch, partitioned by
route, into the batch's own folder. Class counts are observed during that
write instead of separate count jobs.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.payload import parse_payload
from sensorflow.operators.model import LinearModel, linear_of, score
from sensorflow.schema import PREDICTION_FIELDS, WIDE_COLUMNS
from sensorflow.functions.time import epoch_to_date, epoch_to_text
from sensorflow.streaming.event_time import drop_resent, windowed_accuracy
from sensorflow.streaming.routing import prediction_messages, with_route
from sensorflow.streaming.sinks import BatchDirSink, class_count_metrics, start
from sensorflow.streaming.upsert import KeyedTable


def score_messages(messages: DataFrame, model: PipelineModel | LinearModel,
                   payload_format: str = "csv", method: str = "expression",
                   skip_invalid: bool = True) -> DataFrame:
    """Messages -> scored rows with ``prediction`` and ``confidence``.
    Rows with a null feature are skipped, or (``skip_invalid=False``, closed
    form only) kept with a null prediction."""
    parsed = parse_payload(messages, payload_format)
    return score(parsed, model, method=method, skip_invalid=skip_invalid)


def prediction_rows(scored: DataFrame, keep_invalid: bool = False) -> DataFrame:
    """The prediction message fields plus ``route``.
    Rows without a prediction are dropped, or routed to ``invalid``. The time is
    made from the epoch seconds (P6), whatever text the message carried."""
    if not keep_invalid:
        scored = scored.filter(F.col("prediction").isNotNull())
    scored = scored.withColumn("event_ts_min", epoch_to_text("ts_min_bignt"))
    kept = [c for c in ("event_date", "content_id") if c in scored.columns]
    return with_route(scored).select("route", *PREDICTION_FIELDS, *kept)


def start_scoring_stream(messages: DataFrame, model, target: str, checkpoint: str,
                         payload_format: str = "csv", trigger: dict | None = None,
                         query_name: str | None = None, invalid: str = "skip",
                         distinct: bool = False):
    """Score a stream; one write per batch partitioned by route.

    ``invalid='skip'`` drops rows with a null feature (counted as
    ``invalid`` in the batch metrics); ``'quarantine'`` writes them under
    ``route=invalid`` in the same write. ``distinct`` (E1) drops messages equal
    to one that arrived before (``event_time.drop_resent``)."""
    if invalid not in ("skip", "quarantine"):
        raise ValueError(f"unknown invalid handling {invalid!r}")
    lin = model if isinstance(model, LinearModel) else linear_of(model)
    scored = score_messages(messages, lin, payload_format, skip_invalid=False)
    keep = invalid == "quarantine"
    if distinct:
        scored = drop_resent(scored, WIDE_COLUMNS)
    sink = BatchDirSink(target, partition_by=("event_date", "route") if distinct else ("route",),
                        transform=lambda b: prediction_rows(b, keep_invalid=keep),
                        observe=class_count_metrics)
    q = start(scored, sink, checkpoint, trigger=trigger or {"processingTime": "10 seconds"},
              query_name=query_name)
    return q, sink


def start_prediction_messages(messages: DataFrame, model, checkpoint: str, fmt: str = "kafka",
                              target: str | None = None, options: dict | None = None,
                              payload_format: str = "csv", trigger: dict | None = None,
                              query_name: str | None = None, topics: dict | None = None):
    """Score a stream and send each prediction as a JSON message to its route's
    topic: one write per batch with a ``topic`` column. A broker format takes
    ``options`` (its ``topic`` column routes the rows); a file format takes
    ``target``, partitioned by topic, one folder per batch. ``topics`` renames
    the routes' topics."""
    lin = model if isinstance(model, LinearModel) else linear_of(model)
    scored = score_messages(messages, lin, payload_format, skip_invalid=False)

    def to_messages(batch: DataFrame) -> DataFrame:
        return prediction_messages(prediction_rows(batch), topics)

    if target:
        sink = BatchDirSink(target, fmt, ("topic",), to_messages, class_count_metrics)
    else:
        def sink(batch: DataFrame, batch_id: int) -> None:
            to_messages(batch).write.format(fmt).options(**(options or {})).save()
    q = start(scored, sink, checkpoint, trigger=trigger or {"processingTime": "10 seconds"},
              query_name=query_name)
    return q, sink


def start_running_accuracy(scored: DataFrame, target: str, checkpoint: str, window: str = "4 days",
                           delay: str = "2 days", trigger: dict | None = None,
                           query_name: str | None = None):
    """A9 as it runs: correct predictions per event-time window, in update mode
    into a keyed table by window, so that open windows are visible and refined by
    each batch. A window's state goes once the watermark has passed it."""
    accuracy = windowed_accuracy(scored, window, delay).withColumn(
        "event_date", epoch_to_date("window_start"))
    table = KeyedTable(target, ("window_start",))
    q = start(accuracy, table, checkpoint, trigger=trigger or {"processingTime": "10 seconds"},
              query_name=query_name, output_mode="update")
    return q, table
