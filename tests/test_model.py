"""Model: fit, closed form = transform, refusal of one-class data, save/load
(M1-M3, P20-P22, A2, K9, S8)."""

import pytest
from pyspark.sql import functions as F

from sensorflow.operators import model as M
from sensorflow.operators.wide import wide_readings
from sensorflow.sources import events as ev

from .conftest import SF_MID


@pytest.fixture(scope="module")
def wide(spark):
    return wide_readings(ev.readings(spark, SF_MID)).cache()


@pytest.fixture(scope="module")
def report(wide):
    return M.fit(wide)


def test_fit_counts(report, wide):
    assert report.rows == wide.count()
    assert report.skipped_rows == 0
    assert 0 < report.positives < report.rows
    assert len(report.linear.weights) == 4


def test_expression_equals_transform(report, wide):
    labelled = M.with_label(wide).withColumn("rid", F.monotonically_increasing_id()).cache()
    a = M.score(labelled, report.model, method="transform").select(
        "rid", F.col("prediction").alias("p1"), F.col("confidence").alias("c1"))
    b = M.score(labelled, report.linear).select(
        "rid", F.col("prediction").alias("p2"), F.col("confidence").alias("c2"))
    j = a.join(b, "rid")
    assert j.count() == labelled.count()
    worst = j.agg(F.max(F.abs(F.col("c1") - F.col("c2"))).alias("d"),
                  F.sum((F.col("p1") != F.col("p2")).cast("int")).alias("n")).first()
    assert worst.d < 1e-12 and worst.n == 0


def test_accuracy_is_in_sample_share(report, wide):
    scored = M.score(M.with_label(wide), report.model)
    acc = M.accuracy(scored).first()
    manual = scored.filter(F.col("prediction") == F.col("label")).count() / scored.count() * 100
    assert abs(acc.accuracy_pct - manual) < 1e-9


def test_one_class_refused(wide):
    with pytest.raises(M.OneClassError):
        M.fit(wide.withColumn("pir", F.lit(0.0)))


def test_null_feature_skipped_and_counted(spark, wide):
    one_null = wide.limit(1).withColumn("co2", F.lit(None).cast("double"))
    data = wide.unionByName(one_null)
    rep = M.fit(data)
    assert rep.skipped_rows == 1
    scored = M.score(M.with_label(data), rep.linear)
    assert scored.count() == wide.count()


def test_save_load(report, wide, tmp_path):
    path = str(tmp_path / "model")
    M.save(report.model, path)
    M.save(report.model, path)  # overwrite in place
    back = M.load(path)
    assert M.linear_of(back) == report.linear
