"""Session settings and the shared folder that holds intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Shuffles start with many small partitions, which adaptive execution joins up to the advised size.
# Two hundred, the default, would leave partitions of several gigabytes at the intended scale.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for; ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        given = dict(spark.sparkContext.getConf().getAll())
        for key, value in CLUSTER_CONF.items():
            if key not in given and key not in conf:
                spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may run without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below this application's part of the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tickloom-{application}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table read back.

    The result has no lineage to recompute when executors are lost, later scans prune columns and
    push filters down, and Catalyst knows its size: it broadcasts the table only below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides of a join. ``options``
    are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers that share this file system import the package from where it lies.

    On a cluster the package comes with ``--py-files``; the path then names nothing there.
    """
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Whole texts go to Python workers in batches of about ``size`` while an action runs inside.

    By default a batch has up to ten thousand rows whatever their size, and each task holds it several
    times over: in the executor's buffers and, in the worker, as read and as Python strings.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file systems know ``path``."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name)


def delete_path(spark: SparkSession, path: str) -> None:
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(name, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application."""
    delete_path(spark, f"{shared_folder(spark)}/tickloom-{spark.sparkContext.applicationId}")
