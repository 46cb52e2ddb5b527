"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every bizlens job relies on. Shuffle width is left to the cluster (AQE coalesces it);
# local runs pass their own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM does not compile methods beyond 8,000 bytes of bytecode. Stages of many cleaning expressions are beyond it
    # as one method; as projections of several methods they are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a given input volume and cluster size.

    The initial shuffle width gives ~``target_partition_bytes`` per partition for a shuffle as large as the input
    (at least 2 waves of the cluster's cores); AQE then coalesces small partitions to the advisory size and splits
    skewed ones. Scans split files at 256 MB so each task's input fits comfortably in executor memory.
    e.g. 100 TB on 1000 executors x 8 cores -> ~400k shuffle partitions before coalescing.
    """
    width = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def build_session(master: str | None = None, app: str = "bizlens", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a folder every executor can reach and is only read here; there it must be set.
    When it is unset in a local run or a test a fresh folder is made and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="bizlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext handle only use the conf value
        pass
    return current


#: Deletes a query's shuffle files when it ends; without it they stay until the driver happens to collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Each query run inside gives its shuffle files back when it ends, so the steps of a job do not add up on disk. For queries
    that run once (writes, scalars): what is executed a second time makes its shuffles again."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before) if before is not None else spark.conf.unset(FREED)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A unique path under the shared folder, for tables written by a job (never a machine-local temp dir)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, *parts, uuid.uuid4().hex)
