"""Session set-up and the scratch area for written intermediate tables."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lectern", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture costs several gateway calls per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("LECTERN_CHECKPOINT_DIR", "/tmp/lectern-scratch"))
        .config("spark.driver.memory", os.environ.get("LECTERN_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``. Without one, a folder below the warehouse, but only where driver
    and executors are one process; on a cluster that is an error, as no other folder is surely shared."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^,]*(,[^,]*)?\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return configured.rstrip("/")


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, fs = _folder(spark, path)
    return fs.exists(folder)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in ``path``; none if it is not there."""
    folder, fs = _folder(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []


def remove_file(spark: SparkSession, path: str) -> None:
    file, fs = _folder(spark, path)
    fs.delete(file, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not be there yet; false if it is."""
    folder, fs = _folder(spark, path)
    try:
        out = fs.create(folder, False)
    except Py4JJavaError as error:
        if fs.exists(folder):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def small_text(spark: SparkSession, path: str) -> str:
    folder, fs = _folder(spark, path)
    stream = fs.open(folder)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives the loss of executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most ``rows`` rows at a time to Python, so that a slow call does not hold back finished ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffle_width(spark: SparkSession) -> int:
    """Task count for steps that must not be coalesced by size (few input bytes, much work)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
