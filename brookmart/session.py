"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job here relies on. Results depend on the time zone;
# the others let Spark re-plan joins and split hot partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot join key is split even when the split costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# On a cluster stateful streams keep state in RocksDB, off the heap; its
# changelog is what is uploaded per batch, and a lost executor's state is
# restored from the checkpoint. Rows are not counted, for which every write would
# read first, and all stores of an executor share one memory. Local runs have
# little state and keep Spark's default, the heap.
CLUSTER_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "800",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built, and return it."""
    for key, value in (SETTINGS if _local(spark) else {**SETTINGS, **CLUSTER_SETTINGS}).items():
        spark.conf.set(key, value)
    # 200 is Spark's default, far too many for one machine; a cluster's own
    # setting, or any value chosen by the user, is left alone.
    if _local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def build(app: str = "brookmart", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def _local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


_local_root: str | None = None


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for tables and checkpoints, seen by all executors.

    It lies under ``spark.checkpoint.dir``. Only a local master may go without
    that setting; a cluster without it is refused, since a machine-local folder
    would not be seen by the other executors.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="run-")
        root = _local_root
    return f"{root.rstrip('/')}/brookmart/{name}-{uuid.uuid4().hex[:12]}"
