"""Property test: the wide join (plain and salted) and the keep-latest pivot
against a brute-force model of their semantics, on random readings with
duplicates, nulls, NaN, null keys and unknown sensors."""

import itertools
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorflow.operators.wide import wide_readings

SENSORS = ("co2", "humidity", "light", "pir", "temperature")
WIDE = {"co2": "co2", "humidity": "humidity", "light": "light", "pir": "pir",
        "temperature": "temp"}
ORDER = ("co2", "light", "temp", "humidity", "pir")

reading = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.sampled_from(SENSORS + ("x",)),
    st.sampled_from([100, 200, None]),
    st.one_of(st.none(), st.just(float("nan")),
              st.floats(min_value=-5, max_value=5, allow_nan=False).map(lambda v: round(v, 3))),
)


def _brute_join(rows, drop_incomplete):
    groups = {}
    for room, sensor, ts, v in rows:
        if room is None or ts is None or sensor not in WIDE:
            continue
        groups.setdefault((room, ts), {}).setdefault(WIDE[sensor], []).append(v)
    out = []
    for (room, ts), by in groups.items():
        if len(by) < 5:
            continue
        for combo in itertools.product(*[by[c] for c in ORDER]):
            if drop_incomplete and any(x is None or math.isnan(x) for x in combo):
                continue
            out.append((ts, room) + tuple(round(x, 6) if x is not None and not math.isnan(x)
                                          else x for x in combo))
    return out


def _brute_latest(rows):
    latest = {}
    for rid, (room, sensor, ts, v) in enumerate(rows):
        if room is None or ts is None or sensor not in WIDE:
            continue
        latest[(room, ts, sensor)] = v  # later row id wins
    return [(room, sensor, ts, v) for (room, ts, sensor), v in latest.items()]


def _key(r):
    return tuple((x is None, isinstance(x, float) and math.isnan(x), str(x)) for x in r)


def _spark_rows(df):
    cols = ("ts_min_bignt", "room") + ORDER
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, min_size=5, max_size=40))
def test_join_matches_brute_force(spark, rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    long = spark.createDataFrame(data, "rid long, room string, sensor string, "
                                       "ts_min_bignt long, sensor_value double")
    for drop in (True, False):
        want = sorted(_brute_join(rows, drop), key=_key)
        plain = wide_readings(long, drop_incomplete=drop)
        salted = wide_readings(long, drop_incomplete=drop, row_id="rid", hot_key_rows=1)
        assert _spark_rows(plain) == want
        assert _spark_rows(salted) == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, min_size=5, max_size=40))
def test_latest_matches_brute_force(spark, rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    long = spark.createDataFrame(data, "rid long, room string, sensor string, "
                                       "ts_min_bignt long, sensor_value double")
    want = sorted(_brute_join(_brute_latest(rows), False), key=_key)
    got = wide_readings(long, how="latest", order_col="rid", drop_incomplete=False)
    assert _spark_rows(got) == want


wide_row = st.tuples(
    st.sampled_from(["2013-08-26 22:12:11", "2024-01-01 00:00:00"]),
    st.one_of(st.none(), st.integers(min_value=0, max_value=2_000_000_000)),
    st.sampled_from(["413", "r 1", "x"]),
    *[st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False,
                                     allow_infinity=False)) for _ in range(5)],
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(wide_row, min_size=1, max_size=20))
def test_message_round_trip(spark, rows):
    from sensorflow.functions import payload as PL
    from sensorflow.schema import WIDE_SCHEMA
    df = spark.createDataFrame(rows, WIDE_SCHEMA)
    want = sorted((tuple(r) for r in df.collect()), key=_key)
    for fmt in ("csv", "json"):
        back = PL.parse_payload(PL.to_messages(df, fmt, with_key=False), fmt)
        assert sorted((tuple(r) for r in back.collect()), key=_key) == want
