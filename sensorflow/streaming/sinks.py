"""Micro-batch sinks and run helpers.

Idempotent batch writes: each micro-batch overwrites its own folder
``<target>/batch_id=<n>``. If Spark replays a batch after a failure (the
offsets are committed only after the callback returns), the replay replaces
the earlier attempt instead of adding a copy. Readers see the target as one
table partitioned by ``batch_id``.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from sensorflow.session import path_exists, remove_path


def checkpoint_for(spark: SparkSession, target: str, explicit: str | None = None) -> str:
    """The checkpoint of a target stands beside its data, in the hidden
    folder ``<target>/_checkpoint``, so the same target always continues its
    own offsets and no other's. Refuses to start from a checkpoint without
    offsets over a target that holds batches: batch numbers would begin at 0
    again and replace them."""
    path = explicit or f"{target.rstrip('/')}/_checkpoint"
    if not path_exists(spark, f"{path}/offsets/*") and \
            path_exists(spark, f"{target.rstrip('/')}/batch_id=*"):
        raise ValueError(f"{target} holds batches, but {path} no offsets: "
                         "name their checkpoint or another target")
    return path


class BatchDirSink:
    """``foreachBatch`` callback writing each batch to its own folder.

    ``transform`` runs on the batch frame first; ``partition_by`` splits the
    one write (e.g. by route). ``observe`` collects aggregate metrics over the
    incoming rows during that write, with no extra job: ``last`` holds the
    latest batch's, ``totals`` their sums over all batches of this run.
    """

    def __init__(self, target: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (),
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 observe: Callable[[], list] | None = None):
        self.target = target.rstrip("/")
        self.fmt = fmt
        self.partition_by = partition_by
        self.transform = transform
        self.observe = observe
        self.last: dict = {}
        self.totals: dict = {"batches": 0, "seconds": 0.0}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        t0 = time.time()
        obs = None
        if self.observe:
            # Observed on the incoming rows, before ``transform`` may drop some.
            obs = Observation(f"batch_{batch_id}")
            batch = batch.observe(obs, *self.observe())
        out = self.transform(batch) if self.transform else batch
        w = out.write.mode("overwrite").format(self.fmt)
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.save(f"{self.target}/batch_id={batch_id}")
        self.last = {"batch_id": batch_id, "seconds": round(time.time() - t0, 3)}
        if obs is not None:
            self.last.update(obs.get)
        for k, v in self.last.items():
            if k != "batch_id":
                self.totals[k] = self.totals.get(k, 0) + v
        self.totals["batches"] += 1


class Totals(StreamingQueryListener):
    """Batches, rows, seconds and late rows (dropped behind the
    watermark) of every query of a session, summed from each progress event
    (``recentProgress`` keeps about the last 100)."""

    def __init__(self) -> None:
        self._sums: dict[str, list] = {}
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        sums = self._sums.setdefault(str(p.runId), [0, 0, 0.0, 0])
        sums[0] += 1
        sums[1] += p.numInputRows
        sums[2] += p.durationMs.get("triggerExecution", 0) / 1000.0
        sums[3] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def _end(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def of(self, query: StreamingQuery, timeout_s: float = 30.0) -> dict:
        """The sums of an ended query; events arrive in order, its end last."""
        self._end(str(query.runId)).wait(timeout_s)
        n, rows, seconds, late = self._sums.get(str(query.runId), (0, 0, 0.0, 0))
        return {"batches": n, "rows": rows, "seconds": round(seconds, 3), "late": late}


def start(df: DataFrame, sink: Callable | str, checkpoint: str, trigger: dict | None = None,
          query_name: str | None = None, output_mode: str = "append",
          options: dict | None = None, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Start a stream with a checkpoint and a trigger.

    ``sink`` is a ``foreachBatch`` callable or a format name (``console``,
    ``memory``, ``parquet`` ...). ``trigger`` e.g. ``{"processingTime":
    "10 seconds"}`` or ``{"availableNow": True}``."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink).options(**(options or {}))
        if partition_by:
            w = w.partitionBy(*partition_by)
    return w.start()


def run_available(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Drain what is available and stop (tests, ``availableNow`` jobs)."""
    query.awaitTermination(timeout_s) if timeout_s else query.processAllAvailable()
    if query.isActive:
        query.stop()
    ex = query.exception()
    if ex is not None:
        raise RuntimeError(str(ex))
    return query


def run_for(query: StreamingQuery, seconds: float) -> StreamingQuery:
    """Run for a while, then stop."""
    query.awaitTermination(seconds)
    if query.isActive:
        query.stop()
    return query


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Per-batch id, input rows, seconds and rows per second from
    the query's progress reports (a few numbers per batch)."""
    rows = []
    for p in query.recentProgress:
        dur = (p["durationMs"] or {}).get("triggerExecution", 0)
        rows.append((int(p["batchId"]), int(p["numInputRows"] or 0), dur / 1000.0,
                     float(p["processedRowsPerSecond"] or 0.0)))
    return spark.createDataFrame(
        rows, "batch_id long, input_rows long, seconds double, rows_per_second double")


def read_batches(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """All batches written by ``BatchDirSink`` as one table."""
    return spark.read.format(fmt).load(target)


def compact_batches(spark: SparkSession, target: str, dest: str, first_batch: int | None = None,
                    last_batch: int | None = None, fmt: str = "parquet",
                    partition_by: tuple[str, ...] = ("event_date",), drop_source: bool = False) -> int:
    """Rewrite a range of per-batch folders as one table with few, larger files
    (frequent triggers leave many small ones), partitioned by day where the
    batches know it; ``batch_id`` becomes a column. The batch range is a
    partition filter, so only those folders are read; the rebalance hint lets
    AQE size the output files.

    The range has a folder of its own under ``dest``, ``merged=<first>-<last>``,
    that a repeated run replaces; nothing is doubled. ``drop_source`` removes the
    merged batch folders once it is written: read both with ``read_compacted``.
    Returns the rows written (observed)."""
    target = target.rstrip("/")
    held = [n for n in _batch_ids(spark, target)
            if (first_batch is None or n >= first_batch) and (last_batch is None or n <= last_batch)]
    if not held:
        return 0
    df = read_batches(spark, target, fmt).filter(F.col("batch_id").between(held[0], held[-1]))
    cols = [c for c in partition_by if c in df.columns]
    obs = Observation("compacted")
    out = df.hint("rebalance", *cols).observe(obs, F.count(F.lit(1)).alias("n"))
    w = out.write.mode("overwrite").format(fmt)
    (w.partitionBy(*cols) if cols else w).save(f"{dest.rstrip('/')}/merged={held[0]}-{held[-1]}")
    if drop_source:
        for n in held:
            remove_path(spark, f"{target}/batch_id={n}")
    return int(obs.get["n"])


def _batch_ids(spark: SparkSession, target: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/batch_id=*")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []
    return sorted(int(s.getPath().getName().split("=")[1]) for s in found)


def read_compacted(spark: SparkSession, target: str, dest: str, fmt: str = "parquet") -> DataFrame:
    """The merged ranges under ``dest`` and the batches that are in none of them;
    each batch once, whether its folder was dropped or not."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{dest.rstrip('/')}/merged=*/_SUCCESS")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []
    ranges = sorted(tuple(map(int, s.getPath().getParent().getName().split("=")[1].split("-"))) for s in found)
    parts, upto = [], -1
    for first, last in ranges:  # of ranges that overlap the later batches count
        part = spark.read.format(fmt).load(f"{dest.rstrip('/')}/merged={first}-{last}")
        parts.append(part.filter(F.col("batch_id") > upto))
        upto = max(upto, last)
    rest = [n for n in _batch_ids(spark, target.rstrip("/")) if not any(a <= n <= b for a, b in ranges)]
    if rest:
        parts.append(read_batches(spark, target, fmt).filter(F.col("batch_id").isin(rest)))
    if not parts:
        return read_batches(spark, target, fmt)
    return reduce(lambda a, b: a.unionByName(b), parts)


def class_count_metrics() -> list:
    """Observed per-batch counts of the two classes and of rows that could not
    be scored (a null feature; A3 without extra jobs)."""
    return [F.count(F.lit(1)).alias("rows"),
            F.count(F.when(F.col("prediction") == 1.0, 1)).alias("movement"),
            F.count(F.when(F.col("prediction") == 0.0, 1)).alias("no_movement"),
            F.count(F.when(F.col("prediction").isNull(), 1)).alias("invalid")]
