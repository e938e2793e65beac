"""Ranges answered from stored partials against the readings themselves."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from sensorflow.operators.rollup import DAY, HOUR, Rollup

SCHEMA = "room string, sensor string, ts_min_bignt bigint, sensor_value double"


def readings(n=3000, seed=2):
    rng = random.Random(seed)
    return [("hot" if i % 3 else rng.choice("abc"), rng.choice(["co2", "pir"]),
             rng.randrange(-2 * DAY, 5 * DAY), round(rng.uniform(-50, 900), 4)) for i in range(n)]


def direct(rows, start, end, by):
    groups = {}
    for r in rows:
        if r[2] is not None and start <= r[2] < end:
            groups.setdefault(tuple(r[i] for i in by), []).append(r[3])
    out = {}
    for k, vs in groups.items():
        ok = [v for v in vs if v is not None and abs(v) < 1e12]
        mean = sum(map(Decimal, map(str, ok)), Decimal()) / len(ok) if ok else None
        out[k] = (len(vs), len(ok), ok and float(mean.quantize(Decimal("0.000001"), ROUND_HALF_UP)) or (None if not ok else 0.0),
                  min(ok, default=None), max(ok, default=None))
    return out


@pytest.fixture(scope="module")
def rollup(spark, tmp_path_factory):
    rows = readings() + [("odd", "co2", 0, None), ("odd", "co2", 10, math.nan), ("odd", "co2", 20, math.inf),
                         ("odd", "pir", 2**63 - 1, 1.0), ("odd", "pir", None, 1.0), ("odd", "pir", 60, 2.5)]
    r = Rollup(str(tmp_path_factory.mktemp("rollup") / "t"))
    for b in range(3):
        r(spark.createDataFrame(rows[b::3], SCHEMA), b)
    r(spark.createDataFrame(rows[1::3], SCHEMA), 1)  # delivered again
    return r, rows


@pytest.mark.parametrize("start, end", [
    (-2 * DAY, 5 * DAY), (0, DAY), (3 * HOUR, 4 * DAY + 5 * HOUR), (2 * HOUR, 9 * HOUR), (-5 * HOUR, 5 * HOUR),
    (DAY - HOUR, DAY + HOUR), (90 * DAY, 99 * DAY), (0, 0)])
def test_ranges_equal_the_direct_aggregate(spark, rollup, start, end):
    r, rows = rollup
    for by, places in ((("room", "sensor"), (0, 1)), (("sensor",), (1,))):
        got = {tuple(x)[: len(by)]: tuple(x)[len(by) :] for x in r.statistics(spark, start, end, by, ()).collect()}
        assert got == direct(rows, start, end, places)


def test_only_days_are_read_where_whole_days_fit(spark, rollup):
    r, _ = rollup
    plan = r.statistics(spark, 0, 2 * DAY)._jdf.queryExecution().executedPlan().toString()
    assert "grain=day" in plan and "grain=hour" not in plan
    ragged = r.partials(spark, HOUR, 2 * DAY)
    assert ragged.filter(f"bucket >= {DAY}").count() == r.partials(spark, DAY, 2 * DAY).count()


def test_quantiles_are_near(spark, rollup):
    r, rows = rollup
    start, end = -DAY, 4 * DAY + HOUR
    got = r.statistics(spark, start, end, ("room",), (0.1, 0.5, 0.9)).filter("room = 'hot'").first()
    values = sorted(v for room, _, t, v in rows if room == "hot" and start <= t < end)
    for q in (10, 50, 90):
        rank = sum(v <= got[f"q{q}"] for v in values) / len(values)
        assert abs(rank - q / 100) < 0.03
    assert r.statistics(spark, 0, HOUR).filter("room = 'odd' AND sensor = 'co2'").first()["q50"] is None


def test_ranges_need_full_hours(spark, rollup):
    for bad in ((1, HOUR), (0, 61), (DAY, 0)):
        with pytest.raises(ValueError, match="full hours"):
            rollup[0].statistics(spark, *bad)
