"""Time helpers give the same results whatever the session time zone."""

import datetime as dt

from pyspark.sql import functions as F

from sensorflow.functions.time import (epoch_seconds_of_ntz, epoch_to_text, epoch_to_timestamp,
                                       text_to_epoch_ms, text_to_epoch_seconds)

NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def _run(spark):
    df = spark.createDataFrame([(1377555131, "2013-08-26 22:12:11"), (0, "xx"), (None, None)],
                               "s bigint, t string")
    return [tuple(r) for r in df.select(
        epoch_to_text("s"), text_to_epoch_seconds("t"), text_to_epoch_ms("t", NOW),
        F.unix_seconds(epoch_to_timestamp("s")),
        epoch_seconds_of_ntz(F.lit("2013-08-26 22:12:11").cast("timestamp_ntz"))).collect()]


def test_zone_independent(spark):
    base = _run(spark)
    assert base[0] == ("2013-08-26 22:12:11", 1377555131, 1377555131000, 1377555131, 1377555131)
    assert base[1][1] is None and base[1][2] == int(NOW.timestamp()) * 1000
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert _run(spark) == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
