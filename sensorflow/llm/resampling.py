"""Importance resampling towards a target distribution by hashed n-grams.

A text's features are its runs of one to ``MOST`` consecutive words. Letters A-Z
are lower-cased, every run of separators becomes a single space, and for each
length n a regular expression scans the text with overlapping matches between
word boundaries (lookarounds), so that each match is the span of one n-gram; its
bytes go into a CRC, and the CRC's remainder is the feature's bucket. Separators
are ASCII only, so the scan runs over UTF-8 bytes.

One pass writes each document's buckets as a column of 16-bit numbers. Their
counts (pre-aggregated per task, ``buckets`` rows in all) and the target's give
every bucket a gain; the gains, bounded by ``buckets``, go back to the tasks, and
a document's weight is the mean gain of its features. Perturbing the weights with
Gumbel noise from a hash of the id and taking the highest draws without
replacement in proportion to exp(weight). Ranks come from a range-partitioned
sort and the row counts of its partitions: no task sees more than its range.

Null texts have no features, and weight 0. Texts below ``least_words`` are never
drawn. Ties go to the smaller doc_id (a null id last), repeated rows are separate
rows that follow each other. An empty target gives every bucket a gain from the
documents alone; extra columns are dropped.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import ship
from sensorflow.session import scratch_path

MOST = 2
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

#: Upper-case letters to lower case, separators to spaces, all else as it is.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_GRAMS = [
    regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % n) for n in range(MOST)
]
#: Bytes scanned at once; long texts are cut at spaces, with MOST - 1 words again.
STRETCH = 1 << 20


def stretches(folded: bytes) -> Iterator[tuple[bytes, int]]:
    """A collapsed text in stretches, each with the number of its first words that
    the stretch before has already given as n-grams' beginnings."""
    start, repeated, at = 0, 0, STRETCH
    while (cut := folded.find(b" ", at)) >= 0:
        back = cut
        for _ in range(MOST - 1):  # n-grams over the cut begin with these words
            back = folded.rfind(b" ", start, max(back, start))
        at = cut + 1
        if back >= 0:
            yield folded[start:cut], repeated
            start, repeated = back + 1, MOST - 1
            at = max(at, start + STRETCH)
    yield folded[start:], repeated


def feature_buckets(text: str | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words of ``text`` and the bucket of each of its features."""
    folded = b" ".join((text or "").encode().translate(_FOLD).split())
    if not folded:
        return 0, np.zeros(0, dtype=np.uint32)
    crc = zlib.crc32
    words, found = 0, []
    for part, repeated in stretches(folded):
        for n, gram in enumerate(_GRAMS, 1):
            spans = [m.span() for m in gram.finditer(part, overlapped=True)]
            # an n-gram that lies within the repeated words was given before
            spans = spans[max(0, repeated - n + 1) :]
            words += len(spans) if n == 1 else 0
            found += [crc(part[a:b]) for a, b in spans]
    return words, np.array(found, dtype=np.uint32) % np.uint32(buckets)


def bucket_rows(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features and the buckets, packed, of every row of
    ``texts`` (doc_id, text)."""
    ship(texts.sparkSession)

    @F.pandas_udf("n_words bigint, n_features bigint, buckets binary")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kind = np.uint16 if buckets <= 1 << 16 else np.uint32
        for batch in batches:
            rows = []
            for text in batch:
                words, found = feature_buckets(text, buckets)
                rows.append((words, len(found), found.astype(kind).tobytes()))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "buckets"])

    return texts.select("doc_id", scan("text").alias("f")).select("doc_id", "f.*")


def _unpacked(packed: bytes, buckets: int) -> np.ndarray:
    return np.frombuffer(packed, np.uint16 if buckets <= 1 << 16 else np.uint32)


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """How often each bucket occurs in ``rows``; each task sends at most one row
    a bucket, and ``buckets`` numbers reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for packed in batch["buckets"]:
                total += np.bincount(_unpacked(packed, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    sums = (
        rows.select("buckets").mapInPandas(count, "bucket bigint, n bigint")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    out = [0] * buckets
    for r in sums:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of each bucket's smoothed shares, floored."""
    n, all_s, all_t = len(source), sum(source), sum(target)
    return [
        math.floor(1000 * math.log(float(t + 1) * float(all_s + n) / (float(s + 1) * float(all_t + n))))
        for s, t in zip(source, target)
    ]


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, floored, from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def ranked(rows: DataFrame, order: list[Column], folder: str) -> DataFrame:
    """``rows`` with ``position``, 1, 2, 3, ... over all rows in ``order``.

    The rows are sorted within range partitions and written; the position within
    a partition is the low part of a row's running id, and the partitions' counts
    (a row each) give where each begins.
    """
    path = f"{folder}/ranked"
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(
        "__at", F.monotonically_increasing_id()
    ).write.parquet(path)
    written = rows.sparkSession.read.parquet(path).withColumn("__part", F.shiftright("__at", 33))
    sizes = {r["__part"]: r["n"] for r in written.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    begin, total = [], 0
    for part in range(max(sizes, default=0) + 1):
        begin.append(total)
        total += sizes.get(part, 0)
    first = F.element_at(F.lit(begin), F.col("__part").cast("int") + 1) if begin else F.lit(0)
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return written.withColumn("position", first.cast("bigint") + place + 1).drop("__at", "__part")


def resample(
    documents: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row
    of ``documents`` (doc_id, text); ``target`` needs a column text."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "resampling")
    bucket_rows(documents.select("doc_id", "text"), buckets).write.parquet(f"{folder}/buckets")
    rows = spark.read.parquet(f"{folder}/buckets")
    aimed = bucket_rows(target.select(F.lit(0).alias("doc_id"), "text"), buckets)
    gain = np.array(
        gains(bucket_counts(rows, buckets), bucket_counts(aimed, buckets)), dtype=np.int64
    )

    @F.pandas_udf("bigint")
    def total(packed: pd.Series) -> pd.Series:
        return pd.Series([int(gain[_unpacked(p, buckets)].sum()) for p in packed], dtype="int64")

    weighed = rows.withColumn("total", total("buckets")).select(
        "doc_id", "n_words", "n_features",
        F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features"))
        .otherwise(F.lit(0)).cast("bigint").alias("weight"),
    )
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn(
        "open", F.col("n_words") >= least_words
    )
    placed = ranked(
        scored, [F.col("open").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], folder
    )
    drawn = placed.where("open").count() * percent // 100
    return placed.select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("open") & (F.col("position") <= drawn), F.col("position")).alias("rank"),
    )
