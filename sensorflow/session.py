"""Session settings and the shared checkpoint folder.

Library functions never create a session; they receive one. ``build_session``
is for scripts, tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on or that matter at scale. The session time
# zone only affects the text rendering helpers that follow the reference
# (``from_unixtime``); our own helpers are zone-independent.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.explainMode": "formatted",
}


MB = 1024 * 1024


def sizing_conf(input_bytes: int, partition_bytes: int = 256 * MB,
                shuffle_expansion: float = 1.0) -> dict:
    """Settings sized for an input of ``input_bytes`` (compressed files).

    Scan splits and shuffle partitions aim at ``partition_bytes`` each. The
    shuffled bytes are taken as ``shuffle_expansion`` times the input: the
    join sides carry three projected columns, about the compressed size of a
    reading. Map-output bookkeeping grows with maps x partitions; a caller who
    wants fewer partitions asks for larger ones. The RocksDB state store keeps streaming state (E1, E2)
    off the JVM heap."""
    shuffle = max(200, -(-int(input_bytes * shuffle_expansion) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(master: str | None = None, app: str = "sensorflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("SENSORFLOW_DRIVER_MEMORY", "8g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf and _is_local(master or ""):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="sensorflow-ckpt-")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(master: str) -> bool:
    """Whether driver and executors are one process of this machine."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``, if any (also the
    directory set on the SparkContext, where the session has one)."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        return jdir.get() if jdir.isDefined() else None
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Where the session names none, a
    local master gets a scratch one (its executors run on this machine); a
    cluster must name a shared folder itself."""
    root = checkpoint_root(spark)
    if not root:
        if not _is_local(spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sensorflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one job's output,
    removed when the session's JVM ends."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on whatever store it lies."""
    gone = spark._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path (a glob) matches anything, on whatever store it names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    return found is not None and len(found) > 0
