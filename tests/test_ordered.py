"""Previous rows, running totals, episodes, gaps and ranks over split ranges."""

import random

import pytest
from pyspark.sql import functions as F

from sensorflow.operators import ordered as O


def hot_rows(n=900, seed=1):
    """One room holds a third of all rows; times repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        room = "hot" if i % 3 == 0 else f"r{rng.randrange(40)}"
        rows.append((room, rng.randrange(n // 2), i, float(rng.choice([0, 0, 1, 2]))))
    return rows


@pytest.fixture(autouse=True)
def split(spark):
    """Small ranges stay apart, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def blocks(spark, split):
    df = spark.createDataFrame(hot_rows(), "room string, t bigint, i bigint, v double")
    held = O.in_blocks(df.union(df.limit(1).withColumn("room", F.lit(None).cast("string"))), ["room", "t", "i"])
    per_room = held.groupBy("room").agg(F.countDistinct(O.BLOCK).alias("n"))
    assert {r["room"]: r["n"] for r in per_room.collect()}["hot"] >= 2  # split over tasks
    return held


def expected(rows, fn):
    out = []
    for room in {r[0] for r in rows}:
        out += fn(sorted((r for r in rows if r[0] == room), key=lambda r: (r[1], r[2])))
    return sorted(out, key=str)


def test_previous_rows_cross_the_edges(spark, blocks, monkeypatch):
    got = O.with_previous(blocks, ["room"], ["t", "i"], ["v", "t"]).select("room", "t", "i", "prev_v", "prev_t")

    def fn(rs):
        return [(*r[:3], *((p[3], p[1]) if p else (None, None))) for p, r in zip([None, *rs], rs)]

    assert sorted(map(tuple, got.collect()), key=str) == expected(hot_rows(), fn)


def test_running_total_crosses_the_edges(spark, blocks):
    def fn(rs):
        return [(*r[:3], sum(x[3] for x in rs[: k + 1])) for k, r in enumerate(rs)]

    got = O.running_total(blocks, ["room"], ["t", "i"], "v", "total").select("room", "t", "i", "total")
    assert sorted(map(tuple, got.collect()), key=str) == expected(hot_rows(), fn)
    over_all = O.running_total(O.in_blocks(blocks.drop(O.BLOCK), ["i"]), [], ["i"], "v", "total")
    rows = sorted(hot_rows(), key=lambda r: r[2])
    want = {r[2]: sum(x[3] for x in rows[: k + 1]) for k, r in enumerate(rows)}
    first = {r["i"]: r["total"] for r in over_all.filter("room IS NOT NULL").collect()}
    odd = first.keys() and over_all.filter("room IS NULL").first()["v"]
    assert all(abs(first[i] - want[i]) in (0.0, odd) for i in want)


def test_no_window_holds_a_whole_room(spark, blocks):
    plan = O.with_previous(blocks, ["room"], ["t", "i"], ["v"])._jdf.queryExecution().analyzed().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line and "Window [" in line]
    assert windows and all("_block" in line for line in windows)


def motion(spark, rows):
    df = spark.createDataFrame(rows, "room string, s bigint, event_id bigint, sensor_value double")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


@pytest.mark.parametrize("gap", [None, 3])
def test_movement_episodes(spark, gap):
    rows = hot_rows(600, 5)

    def fn(rs):
        out, before = [], None
        for r in rs:
            if r[3] > 0:
                if before is None or before[3] <= 0 or (gap is not None and r[1] - before[1] > gap):
                    out.append([r[0], r[1], r[1], 0])
                out[-1][2] = r[1]
                out[-1][3] += 1
            before = r
        return [tuple(x) for x in out]

    odd = [("hot", 1, 10_000, None), ("hot", 2, 10_001, float("nan")), (None, 3, 10_002, 1.0), ("hot", None, 10_003, 1.0)]
    got = O.movement_episodes(motion(spark, rows + odd), max_gap_seconds=gap)
    got = got.select("room", F.unix_seconds("episode_start"), F.unix_seconds("episode_end"), "n_readings").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, fn)
    assert O.movement_episodes(motion(spark, odd)).count() == 0


def test_cadence_gaps(spark):
    rows = [("a", "co2", t) for t in (0, 10, 10, 20, 50, 60, 95)] + [("b", "co2", t) for t in (5, 15)]
    rows += [("a", "pir", t) for t in (0, 3, 10)] + [("a", "light", 7), (None, "co2", 1), ("a", "co2", None)]
    got = O.cadence_gaps(spark.createDataFrame(rows, "room string, sensor string, ts_min_bignt bigint"))
    assert sorted(map(tuple, got.collect())) == [("a", "co2", 20, 50, 10, 2), ("a", "co2", 60, 95, 10, 3),
                                                 ("a", "pir", 3, 10, 3, 2)]


def test_rank_accuracy_and_calibration(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 1), float(rng.random() < 0.4)) for _ in range(400)]
    df = spark.createDataFrame([*rows, (None, 1.0), (0.5, None)], "confidence double, label double")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    r = O.rank_accuracy(df).first()
    assert (r["positives"], r["negatives"]) == (len(pos), len(neg))
    assert r["auc"] == pytest.approx(won / len(pos) / len(neg), abs=1e-12)
    assert O.rank_accuracy(df.filter("label = 1")).first()["auc"] is None
    assert tuple(O.rank_accuracy(df.limit(0)).first()) == (0, 0, None)
    bins = {b["bin"]: (b["n"], b["n_positive"]) for b in O.calibration(df, 5).collect()}
    for b in range(5):
        inside = [y for s, y in rows if min(int(s * 5), 4) == b]
        assert bins[b] == (len(inside), sum(inside))
