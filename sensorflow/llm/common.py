"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers.

    A session started with the repository on PYTHONPATH (or with --py-files)
    needs nothing; otherwise the package is zipped once per application and
    distributed with ``addPyFile``.
    """
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    listed = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if app in _SHIPPED or str(root) in listed or root.suffix == ".zip":
        return
    target = os.path.join(tempfile.mkdtemp(), "sensorflow_llm.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in (root / "sensorflow").rglob("*.py"):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod`` (null ids count as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    mod: int,
    held_out: int,
    rows_per_class: dict[int, int],
) -> list[tuple[str, int]]:
    """A bounded training sample: (text, label) of documents that aren't held out.

    The ids are drawn from ``labels`` alone, by ascending hash, at most
    ``rows_per_class[c]`` for each class c; so at most the sum of these texts
    reaches the driver. Rows without a label or text are left out; a document
    labelled twice counts with the larger label. Sorted by text and label, so
    that the fit does not depend on the order of arrival.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("__label"))
        .where(id_remainder(F.col("doc_id"), mod) != held_out)
    )
    picked = None
    for value, rows in sorted(rows_per_class.items()):
        part = (
            known.where(F.col("__label") == value)
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(rows)
        )
        picked = part if picked is None else picked.unionByName(part)
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull())
    # the picked ids are bounded by rows_per_class
    got = texts.join(F.broadcast(picked), "doc_id").select("text", "__label").collect()
    return sorted((r[0], r[1]) for r in got)
