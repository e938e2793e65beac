"""Derived columns: movement flag and label (P19, P20), search document (P14,
K7), confidence (P22). Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.schema import DOCUMENT_FIELDS, MOVEMENT, NO_MOVEMENT


def movement_flag(pir="pir") -> Column:
    """``pir > 0`` -> movement, otherwise (null included) no_movement.

    NaN > 0 is true in Spark, so NaN readings must be dropped first (F1)."""
    p = F.col(pir) if isinstance(pir, str) else pir
    return F.when(p > 0.0, F.lit(MOVEMENT)).otherwise(F.lit(NO_MOVEMENT))


def movement_label(pir="pir") -> Column:
    """P20: ``pir > 0`` -> 1.0, otherwise 0.0 (null -> 0.0)."""
    p = F.col(pir) if isinstance(pir, str) else pir
    return F.when(p > 0.0, F.lit(1.0)).otherwise(F.lit(0.0))


def with_movement(df: DataFrame, pir: str = "pir") -> DataFrame:
    return df.withColumn("if_movement", movement_flag(pir))


def search_document(df: DataFrame, fill_value: float | None = 0.0,
                    time_col: str = "event_ts_min", keep=()) -> DataFrame:
    """Typed document row. Null readings become ``fill_value``
    (0.0 as in the reference; ``None`` keeps them null); ``temp`` is renamed
    ``temperature``; readings are floats in the index mapping, kept as double
    here so no precision is lost before the sink. ``keep`` carries extra
    columns (e.g. a quarantine reason) through."""
    def reading(c):
        v = F.col(c).cast("double")
        return v if fill_value is None else F.coalesce(v, F.lit(float(fill_value)))
    cols = {
        "event_ts_min": F.col(time_col),
        "co2": reading("co2"),
        "humidity": reading("humidity"),
        "light": reading("light"),
        "temperature": reading("temp"),
        "room": F.col("room"),
        "pir": reading("pir"),
        "if_movement": F.col("if_movement"),
    }
    return df.select(*[cols[f].alias(f) for f in DOCUMENT_FIELDS], *keep)
