"""Order-dependent analysis without a task per group.

A window function over a room puts all its readings into one task. Here the rows
are sorted into ranges by (key, order) and written once with their range number,
so a hot room lies in several ranges. Windows run per (range, key); what crosses a
range's edge comes from one row per (range, key), whose own window has at most as
many rows as there are ranges. ``order`` must tell the rows of a key apart, or rows
that it does not tell apart must be interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.session import scratch_path

BLOCK = "_block"


def in_blocks(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows, written in ranges of ``order`` with the range's number, ``_block``."""
    path = scratch_path(df.sparkSession, "blocks")
    df.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn(BLOCK, F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _edges(blocks: DataFrame, key: Sequence[str], last: dict[str, Column], carry) -> DataFrame:
    """For each (block, key) what the blocks before it hand over."""
    per_block = blocks.groupBy(BLOCK, *key).agg(*[c.alias(n) for n, c in last.items()])
    # a key has at most one row per block here
    before = Window.partitionBy(*(key or [F.lit(0)])).orderBy(BLOCK)
    return per_block.select(F.col(BLOCK), *key, *[carry(F.col(n), before).alias(n) for n in last])


def _joined(rows: DataFrame, edges: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.join(edges, [BLOCK, *key], "left")


def with_previous(blocks: DataFrame, key: Sequence[str], order: Sequence[str],
                  values: Sequence[str]) -> DataFrame:
    """``prev_<value>`` of the row before, per key, in order; null for a key's
    first row. Null keys are left out."""
    for k in key:
        blocks = blocks.filter(F.col(k).isNotNull())
    inside = Window.partitionBy(BLOCK, *key).orderBy(*order)
    rows = blocks.select("*", F.row_number().over(inside).alias("_nth"),
                         *[F.lag(v).over(inside).alias(f"_in_{v}") for v in values])
    last = F.max_by(F.struct(*values), F.struct(*order))
    edges = _edges(blocks, key, {"_last": last}, lambda c, w: F.lag(c).over(w))
    out = [F.when(F.col("_nth") == 1, F.col(f"_last.{v}")).otherwise(F.col(f"_in_{v}")).alias(f"prev_{v}")
           for v in values]
    return _joined(rows, edges, key).select(*blocks.columns, *out)


def running_total(blocks: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                  name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the key's rows up to and with this one,
    in order. Null keys are left out."""
    for k in key:
        blocks = blocks.filter(F.col(k).isNotNull())
    inside = Window.partitionBy(BLOCK, *key).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = blocks.withColumn("_sum", F.sum(value).over(inside))
    edges = _edges(blocks, key, {"_before": F.sum(value)},
                   lambda c, w: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    total = F.coalesce("_sum", F.lit(0)) + F.coalesce("_before", F.lit(0))
    return _joined(rows, edges, key).select(*blocks.columns, total.alias(name))


def movement_episodes(motion: DataFrame, room: str = "room", ts: str = "ts", value: str = "sensor_value",
                      tie: str = "event_id", max_gap_seconds: int | None = None) -> DataFrame:
    """``room, episode_start, episode_end, n_readings`` of each room's maximal
    runs of motion readings above zero; with ``max_gap_seconds`` a longer pause
    between two readings ends a run. Readings without a room or a time, and those
    that are null or NaN, are left out; ``tie`` orders readings of one instant."""
    seen = motion.filter(F.col(ts).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value))) \
        .select(room, ts, tie, (F.col(value) > 0).alias("moving"))
    order = [ts, tie]
    rows = with_previous(in_blocks(seen, [room, *order]), [room], order, ["moving", ts])
    begins = F.col("moving") & ~F.coalesce(F.col("prev_moving"), F.lit(False))
    if max_gap_seconds is not None:
        pause = F.timestamp_diff("MICROSECOND", F.col(f"prev_{ts}"), F.col(ts))
        begins = begins | (F.col("moving") & (pause > max_gap_seconds * 1_000_000))
    marked = rows.withColumn("begins", F.coalesce(begins, F.lit(False)).cast("bigint"))
    runs = running_total(marked, [room], order, "begins", "episode")
    return runs.filter("moving").groupBy(room, "episode").agg(
        F.min(ts).alias("episode_start"), F.max(ts).alias("episode_end"),
        F.count(F.lit(1)).alias("n_readings")).drop("episode")


def cadence_gaps(long: DataFrame, key: Sequence[str] = ("room", "sensor"), ts: str = "ts_min_bignt",
                 step_by: Sequence[str] = ("sensor",)) -> DataFrame:
    """Q1, Q2: spans in which a room's sensor is silent for longer than its step:
    ``gap_after, gap_before`` (the readings around it), ``step`` and ``n_missing``
    (readings that the step would have put between). The step is the most frequent
    distance of two neighbouring instants of a sensor (of equally frequent ones
    the shorter), over all rooms. Null keys and instants are left out."""
    instants = long.filter(F.col(ts).isNotNull()).select(*key, ts).distinct()
    rows = with_previous(in_blocks(instants, [*key, ts]), key, [ts], [ts])
    apart = rows.filter(F.col(f"prev_{ts}").isNotNull()).withColumn("_apart", F.col(ts) - F.col(f"prev_{ts}"))
    counted = apart.groupBy(*step_by, "_apart").agg(F.count(F.lit(1)).alias("_n"))
    steps = counted.groupBy(*step_by).agg(
        F.max_by("_apart", F.struct(F.col("_n"), -F.col("_apart"))).alias("step"))
    return apart.join(steps, list(step_by)).filter(F.col("_apart") > F.col("step")).select(
        *key, F.col(f"prev_{ts}").alias("gap_after"), F.col(ts).alias("gap_before"), "step",
        F.expr("CAST(ceil(_apart / step) - 1 AS bigint)").alias("n_missing"))


def rank_accuracy(scored: DataFrame, score: str = "confidence", label: str = "label") -> DataFrame:
    """M3 without a threshold: ``positives, negatives, auc``. The area under the
    ROC curve is the share of (positive, negative) pairs in which the positive
    scores higher, a tie counting half; from counts per distinct score, summed in
    order of the score. Rows without a score or a label are left out; ``auc`` is
    null where a class is missing."""
    positive = F.col(label) > 0
    counted = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(score).agg(
        F.count(F.when(positive, 1)).alias("_pos"), F.count(F.when(~positive, 1)).alias("_neg"))
    below = running_total(in_blocks(counted, [score]), [], [score], "_neg", "_upto")
    # twice the pairs won: whole numbers, so the order of the sum doesn't matter
    won = F.sum((F.col("_pos") * (2 * F.col("_upto") - F.col("_neg"))).cast("decimal(38,0)"))
    sums = below.agg(F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), won.alias("_won"))
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return sums.select(F.coalesce("positives", F.lit(0)).alias("positives"),
                       F.coalesce("negatives", F.lit(0)).alias("negatives"),
                       F.try_divide(F.col("_won").cast("double"), pairs).alias("auc"))


def calibration(scored: DataFrame, bins: int = 10, score: str = "confidence", label: str = "label") -> DataFrame:
    """M3: per bin of the score (``bin`` 0 to ``bins`` - 1, equally wide over 0 to
    1): rows, positives, and their observed rate."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    known = scored.filter(F.col(score).between(0.0, 1.0) & F.col(label).isNotNull())
    out = known.groupBy(at.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(label) > 0, 1)).alias("n_positive"))
    return out.withColumn("rate", F.round(F.col("n_positive") / F.col("n"), 6))
