"""Movement model: fit, save, load, score, evaluate.

Scoring has two equal paths:
- ``transform``: the fitted ``PipelineModel`` (vector column, spark.ml).
- ``expression`` (default): the model's four coefficients and intercept as a
  plain column expression ``1 / (1 + exp(-(b + w.x)))``. It stays inside
  whole-stage code generation, builds no vector per row and needs no Python
  (the reference used a Python UDF to read the probability vector). The
  coefficients are five numbers taken from the fitted model, so nothing
  grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.cleaning import complete
from sensorflow.functions.features import movement_label
from sensorflow.schema import FEATURES

MAX_ITER = 10  # fixed value: the reference fits with 10 iterations, other settings default


class OneClassError(ValueError):
    """Training data holds a single class; the fit would be degenerate."""


@dataclass(frozen=True)
class LinearModel:
    intercept: float
    weights: tuple[float, ...]
    features: tuple[str, ...] = FEATURES
    threshold: float = 0.5

    def margin(self) -> Column:
        m = F.lit(float(self.intercept))
        for name, w in zip(self.features, self.weights):
            m = m + F.lit(float(w)) * F.col(name)
        return m

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


@dataclass
class FitReport:
    rows: int
    skipped_rows: int
    positives: int
    model: PipelineModel
    linear: LinearModel


def with_label(df: DataFrame, pir: str = "pir") -> DataFrame:
    return df.withColumn("label", movement_label(pir))


def assembler(handle_invalid: str = "skip") -> VectorAssembler:
    """Features in the fixed order; ``skip`` drops rows with a null
    reading (the reference's default raised and stopped the stream)."""
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features",
                           handleInvalid=handle_invalid)


def training_summary(df: DataFrame) -> tuple[int, int, int]:
    """(rows, rows with a null/NaN feature, positive labels) in one pass."""
    bad = ~complete(FEATURES)
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(bad.cast("long")).alias("bad"),
               F.sum(F.when(~bad, F.col("label")).cast("long")).alias("pos")).first()
    return int(r["n"]), int(r["bad"] or 0), int(r["pos"] or 0)


def fit(wide: DataFrame, max_iter: int = MAX_ITER) -> FitReport:
    """M1: label from pir, assemble, fit a binary logistic regression on all
    rooms pooled. Refuses training data with one class."""
    data = with_label(wide).select(*FEATURES, "label")
    n, bad, pos = training_summary(data)
    usable = n - bad
    if usable == 0 or pos == 0 or pos == usable:
        raise OneClassError(
            f"training data must hold both classes: {usable} usable rows, {pos} with movement")
    # The optimizer passes over the data about max_iter times. Its input (the
    # assembler's output) is not cached, so LogisticRegression caches its own
    # narrow instances (memory and disk) for the iterations and releases them.
    pipe = Pipeline(stages=[assembler("skip"),
                            LogisticRegression(featuresCol="features", labelCol="label",
                                               maxIter=max_iter)])
    model = _without_training_summary(pipe.fit(data), data.sparkSession)
    return FitReport(n, bad, pos, model, linear_of(model))


def _without_training_summary(model: PipelineModel, spark) -> PipelineModel:
    """The fitted model as saved and loaded again: the same coefficients,
    without the in-memory training summary. The summary references the
    training plan and the session; once the session has run an
    ``observe()``, tasks of ``transform`` that capture the model can no
    longer be serialized. The round trip writes a few numbers to the shared
    checkpoint folder."""
    from sensorflow.session import scratch_path
    path = scratch_path(spark, "fitted-model")
    save(model, path)
    loaded = load(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return loaded


def linear_of(model: PipelineModel) -> LinearModel:
    lr = model.stages[-1]
    return LinearModel(float(lr.intercept), tuple(float(x) for x in lr.coefficients.toArray()),
                       threshold=float(lr.getThreshold()))


def save(model: PipelineModel, path: str) -> None:
    """K9: overwrite in place (no separate delete step)."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """S8."""
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel | LinearModel, method: str = "expression",
          skip_invalid: bool = True) -> DataFrame:
    """M2: add ``probability`` (P(movement)), ``prediction`` and
    ``confidence`` (= P(movement), as the reference defines it, P22).

    Rows with a null or NaN feature are skipped (``skip_invalid``), as the
    assembler's ``skip`` does, or kept with null probability and prediction.
    """
    if method == "transform":
        if not isinstance(model, PipelineModel):
            raise TypeError("method='transform' needs the fitted PipelineModel")
        out = model.transform(df)
        p1 = vector_to_array("probability")[1]
        return (out.withColumn("confidence", p1)
                   .withColumn("probability", p1)
                   .drop("features", "rawPrediction"))
    lin = model if isinstance(model, LinearModel) else linear_of(model)
    ok = complete(lin.features)
    if skip_invalid:
        df = df.filter(ok)
        p = lin.probability()
    else:
        # Null (not 0.0, not NaN-as-1.0) for rows with a null or NaN feature.
        p = F.when(ok, lin.probability())
    return (df.withColumn("probability", p)
              .withColumn("prediction",
                          F.when(F.col("probability").isNull(), F.lit(None).cast("double"))
                          .when(F.col("probability") > lin.threshold, F.lit(1.0))
                          .otherwise(F.lit(0.0)))
              .withColumn("confidence", F.col("probability")))


def accuracy(scored: DataFrame, label: str = "label") -> DataFrame:
    """One pass: ``total, correct, accuracy_pct``."""
    hit = (F.col("prediction") == F.col(label)).cast("long")
    return scored.agg(F.count(F.lit(1)).alias("total"),
                      F.coalesce(F.sum(hit), F.lit(0)).alias("correct")) \
        .withColumn("accuracy_pct",
                    F.when(F.col("total") > 0, F.col("correct") * 100.0 / F.col("total")))


def time_split(df: DataFrame, cutoff_seconds: int, ts_col: str = "ts_min_bignt"):
    """Hold-out split by time (our addition to in-sample accuracy)."""
    return df.filter(F.col(ts_col) < cutoff_seconds), df.filter(F.col(ts_col) >= cutoff_seconds)
