"""Routing of scored rows by predicted class (K5, F2, A3).

The reference wrote two filtered copies of an uncached batch (scoring ran
again for every count and write) and the two writes were not atomic. Here a
``route`` column is derived once and one write partitions by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.schema import PREDICTION_FIELDS

# Route names (ours): the reference wrote predicted movement to an "activity"
# target and the rest to a "no activity" target; "invalid" holds rows that
# could not be scored.
ROUTE_POSITIVE = "activity"
ROUTE_NEGATIVE = "no_activity"
ROUTE_INVALID = "invalid"


def with_route(scored: DataFrame, positive: str = ROUTE_POSITIVE,
               negative: str = ROUTE_NEGATIVE, invalid: str = ROUTE_INVALID) -> DataFrame:
    return scored.withColumn(
        "route", F.when(F.col("prediction") == 1.0, F.lit(positive))
        .when(F.col("prediction") == 0.0, F.lit(negative))
        .otherwise(F.lit(invalid)))


def prediction_messages(rows: DataFrame, topics: dict | None = None) -> DataFrame:
    """``topic, value`` of routed prediction rows, the value as JSON (P16,
    P9). ``topics`` maps routes to topic names; others keep the route's name."""
    topic = F.col("route")
    for route, name in (topics or {}).items():
        topic = F.when(F.col("route") == route, F.lit(name)).otherwise(topic)
    return rows.select(topic.alias("topic"), F.to_json(F.struct(*PREDICTION_FIELDS)).alias("value"))
