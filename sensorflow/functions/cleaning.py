"""Cleaning of raw text readings (P1, P3, P4) and the null test (F1).

Spark 4 runs with ANSI on: a plain ``cast`` of bad text raises. The
``try_*`` forms give null instead, which the quality checks then count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.time import valid_epoch

#: A reading is a finite number below this size; NaN, infinite and larger ones
#: count as unparsable.
READING_LIMIT = 1e12


def parse_long(text) -> Column:
    """P1 + P3: trim, then text -> bigint; null when unparsable."""
    return F.trim(_c(text)).try_cast("bigint")


def parse_double(text) -> Column:
    """P1 + P3: trim, then text -> double; null when unparsable."""
    return F.trim(_c(text)).try_cast("double")


def valid_reading(value) -> Column:
    """The reading, or null where it is NaN, infinite or out of range."""
    c = _c(value)
    return F.when(F.abs(c) < READING_LIMIT, c)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_readings(raw: DataFrame, ts_col: str = "ts_raw", value_col: str = "value_raw",
                   keep_raw: bool = False) -> DataFrame:
    """Raw long readings -> typed ``ts_min_bignt bigint, sensor_value double``;
    both null where the text is unparsable or out of range."""
    out = (raw.withColumn("ts_min_bignt", valid_epoch(parse_long(ts_col)))
              .withColumn("sensor_value", valid_reading(parse_double(value_col))))
    return out if keep_raw else out.drop(ts_col, value_col)


def round_columns(df: DataFrame, cols, digits: int | None = 6) -> DataFrame:
    """``round(x, digits)`` (half up), keeping column order."""
    if digits is None:
        return df
    cols = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def complete(cols) -> Column:
    """True when each of the numeric ``cols`` holds a reading (not null, NaN,
    infinite or out of range): the test behind F1 as a conjunction, so the
    optimizer can push each part to the input that holds the column."""
    return reduce(lambda a, b: a & b,
                  [F.col(c).isNotNull() & (F.abs(F.col(c)) < READING_LIMIT) for c in cols])
