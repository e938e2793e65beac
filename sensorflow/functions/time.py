"""Time conversions (P5, P6, P7). All are built-in column expressions.

The reference renders and parses text in the session time zone. These
helpers pin UTC explicitly, so results do not depend on the session:
the sample ``2013-08-26 22:12:11,1377555131`` is the UTC rendering.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorflow.schema import TIME_FORMAT

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

#: Epoch seconds that count as an instant: the years 1 to 9999 (UTC). Spark's
#: time functions raise beyond what a timestamp holds, so one such message would
#: stop a job; every helper here gives null instead.
FIRST_SECOND = -62_135_596_800
LAST_SECOND = 253_402_300_799


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_epoch(seconds) -> Column:
    """Epoch seconds, or null where they are no instant of the years 1 to 9999."""
    c = _col(seconds)
    return F.when(c.between(FIRST_SECOND, LAST_SECOND), c)


def epoch_seconds_of_ntz(ts) -> Column:
    """Whole epoch seconds of a ``timestamp_ntz`` read as UTC wall clock."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), _col(ts))


def epoch_to_text(seconds) -> Column:
    """P5: epoch seconds -> ``yyyy-MM-dd HH:mm:ss`` (UTC)."""
    return F.date_format(F.timestamp_add("SECOND", valid_epoch(seconds), F.expr(_EPOCH_NTZ)), TIME_FORMAT)


def epoch_to_timestamp(seconds) -> Column:
    """Epoch seconds -> timestamp (an instant; no text round trip)."""
    return F.timestamp_seconds(valid_epoch(seconds))


def epoch_to_date(seconds) -> Column:
    """Epoch seconds -> calendar day (UTC), whatever the session zone."""
    return F.to_date(F.timestamp_add("SECOND", valid_epoch(seconds), F.expr(_EPOCH_NTZ)))


def text_to_epoch_seconds(text) -> Column:
    """Text in ``TIME_FORMAT`` (UTC) -> epoch seconds; null when unparsable."""
    parsed = F.try_to_timestamp(F.concat(_col(text), F.lit(" +0000")),
                                F.lit(TIME_FORMAT + " Z"))
    return F.unix_seconds(parsed)


def text_to_epoch_ms(text, now: _dt.datetime | None = None) -> Column:
    """Text -> epoch milliseconds; null or unparsable text falls back to
    ``now`` (processing time when not given, as in the reference)."""
    fallback = (F.unix_seconds(F.current_timestamp()) if now is None
                else F.lit(int(now.replace(tzinfo=now.tzinfo or _dt.timezone.utc).timestamp())))
    return F.coalesce(text_to_epoch_seconds(text), fallback).cast("bigint") * F.lit(1000)
