"""SQL surface (X2): long, wide and flagged readings as temporary views, so
users can keep writing the reference's SQL against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorflow.functions.features import with_movement
from sensorflow.operators.wide import wide_readings

VIEW_LONG = "sensor_readings"
VIEW_WIDE = "sensor_wide"
VIEW_FLAGGED = "sensor_flagged"


def register_views(spark: SparkSession, long: DataFrame, **wide_options) -> dict[str, DataFrame]:
    """Register the three views over ``long`` readings; returns the frames.

    Give ``long`` with the sensor as a stored or partition column, or as a
    union of one frame per sensor: each join side then reads its own only."""
    wide = wide_readings(long, **wide_options)
    flagged = with_movement(wide)
    frames = {VIEW_LONG: long, VIEW_WIDE: wide, VIEW_FLAGGED: flagged}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames
