"""Golden rows and malformed messages."""

import datetime as dt

from sensorflow.functions import payload as PL
from sensorflow.streaming.index_stream import index_documents

# The three sample rows of the reference's documentation.
GOLDEN = [
    "2013-08-26 22:12:11,1377555131,413,575.0,102.0,24.06,48.09,0.0",
    "2013-08-27 15:25:07,1377617107,413,449.0,42.0,23.28,47.28,0.0",
    "2013-08-27 05:39:03,1377581943,413,474.0,3.0,24.59,43.98,0.0",
]
NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def _msgs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_golden_rows_to_documents(spark):
    docs = index_documents(_msgs(spark, GOLDEN), "csv", now=NOW).collect()
    assert [d.event_ts_min for d in docs] == [1377555131000, 1377617107000, 1377581943000]
    assert all(d.if_movement == "no_movement" for d in docs)
    assert docs[0].temperature == 24.06 and docs[0].room == "413" and docs[0].co2 == 575.0


def test_parsed_time_text_matches_seconds(spark):
    from sensorflow.functions.time import epoch_to_text
    rows = PL.parse_payload(_msgs(spark, GOLDEN), "csv") \
        .select("event_ts_min", epoch_to_text("ts_min_bignt").alias("t")).collect()
    assert all(r.event_ts_min == r.t for r in rows)


def test_short_payload_and_bad_time(spark):
    msgs = _msgs(spark, ["xx,1377555131,413,575.0,102.0,24.06,48.09",
                         "2013-08-26 22:12:11,1377555131,413,575.0,102.0,24.06,48.09,1.0"])
    parsed = PL.parse_payload(msgs, "csv")
    rows = parsed.collect()
    assert rows[0].pir is None and rows[1].pir == 1.0
    good, bad = PL.quarantine(parsed)
    assert good.count() == 1
    assert [r.reason for r in bad.collect()] == ["pir"]
    docs = index_documents(msgs, "csv", now=NOW).collect()
    assert docs[0].event_ts_min == int(NOW.timestamp()) * 1000  # P7 fallback
    assert docs[0].pir == 0.0 and docs[0].if_movement == "no_movement"
    assert docs[1].if_movement == "movement"
    kept = index_documents(msgs, "csv", now=NOW, fill_value=None).collect()
    assert kept[0].pir is None


def test_garbage_json_is_all_null_and_quarantined(spark):
    good_json = ('{"event_ts_min":"2013-08-26 22:12:11","ts_min_bignt":1377555131,"room":"413",'
                 '"co2":575.0,"light":102.0,"temp":24.06,"humidity":48.09,"pir":0.0}')
    parsed = PL.parse_payload(_msgs(spark, [good_json, "garbage"]), "json")
    rows = parsed.collect()
    assert rows[0].co2 == 575.0 and rows[0].ts_min_bignt == 1377555131
    assert all(v is None for v in rows[1])
    good, bad = PL.quarantine(parsed)
    assert good.count() == 1 and bad.count() == 1


def test_json_roundtrip_omits_nulls(spark):
    df = spark.createDataFrame([("t", 1, "r", 1.0, None, 3.0, 4.0, 0.0)],
                               "event_ts_min string, ts_min_bignt bigint, room string, co2 double, "
                               "light double, temp double, humidity double, pir double")
    msg = PL.to_messages(df, "json", with_key=False).first().value
    assert "light" not in msg
    back = PL.parse_payload(PL.to_messages(df, "json", with_key=False), "json").first()
    assert back.light is None and back.co2 == 1.0


def test_csv_payload_keeps_positions_with_nulls(spark):
    df = spark.createDataFrame([("t", 1, "r", None, 2.0, 3.0, 4.0, 5.0)],
                               "event_ts_min string, ts_min_bignt bigint, room string, co2 double, "
                               "light double, temp double, humidity double, pir double")
    v = PL.to_messages(df, with_key=False).first().value
    assert v == "t,1,r,,2.0,3.0,4.0,5.0"
    back = PL.parse_payload(PL.to_messages(df, with_key=False), "csv").first()
    assert back.co2 is None and back.light == 2.0


def test_custom_separator_and_key(spark):
    df = spark.createDataFrame([("a|b", 3)], "x string, y bigint")
    m = PL.to_messages(df, cols=("x", "y"), sep="|", key_col="y").first()
    assert m.key == "3" and m.value == "a|b|3"


def test_document_time_forms(spark):
    msgs = _msgs(spark, GOLDEN[:1] + ["xx,1,413,1.0,1.0,1.0,1.0,1.0"])
    ts = index_documents(msgs, "csv", time_as="timestamp").collect()
    assert ts[0].event_ts_min.timestamp() == 1377555131 and ts[1].event_ts_min is None
    text = index_documents(msgs, "csv", time_as="text").collect()
    assert text[0].event_ts_min == "2013-08-26 22:12:11"


def test_nan_reading_is_quarantined(spark):
    msgs = _msgs(spark, ["2013-08-26 22:12:11,1377555131,413,NaN,102.0,24.06,48.09,1.0"])
    _, bad = PL.quarantine(PL.parse_payload(msgs, "csv"))
    assert [r.reason for r in bad.collect()] == ["co2"]
