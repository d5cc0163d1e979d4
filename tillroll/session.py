"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path for intermediate tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which every executor can reach. Only a local
    session without that setting falls back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="tillroll-")
    return f"{root.rstrip('/')}/tillroll-{purpose}-{uuid.uuid4().hex}"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: de-duplication for ever outgrows a heap store."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files behind, and sort no rows by the folders they go to.

    Shuffle files would stay until the driver happens to collect its garbage, those of one write beside
    those of the next. For writes only: a DataFrame that is collected twice would make them again. A task
    sorts rows nevertheless where they go to more than a few folders.
    """
    options = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.maxConcurrentOutputFileWriters": "8",
    }
    before = {name: spark.conf.get(name) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def or_empty(spark: SparkSession, read, fields: str) -> DataFrame:
    """What ``read()`` returns, or no rows of ``fields`` where its path does not exist yet."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)
