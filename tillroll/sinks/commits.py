"""Small files that appear whole or not at all, on any store Spark can write.

What decides which data count (snapshots, curated versions, landed batches) is a small JSON file
each. It is written under another name first and renamed, which a file system does at once.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put(spark: SparkSession, path: str, records: list[dict]) -> bool:
    """Create a file of one JSON record a line; false if there is one of that name already."""
    jvm, fs = spark.sparkContext._jvm, _file_system(spark, path)
    final = _path(spark, path)
    if fs.exists(final):
        return False
    draft = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray("".join(json.dumps(r) + "\n" for r in records).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(final).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), rename)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def put_next(spark: SparkSession, folder: str, record: dict) -> int:
    """Add a record under the next free number; of two writers both are kept, one after the other."""
    taken = [int(n.removesuffix(".json")) for n in names_in(spark, folder)]
    number = max(taken, default=-1) + 1
    while not put(spark, f"{folder}/{number:09d}.json", [record]):
        number += 1
    return number


def read_records(spark: SparkSession, folder: str) -> dict[int, dict]:
    """The records of a folder by number; as many as are kept there."""
    if not names_in(spark, folder):
        return {}
    files = spark.read.text(folder, wholetext=True)
    found = files.select("value", F.col("_metadata.file_name").alias("name")).collect()
    return {int(r.name.removesuffix(".json")): json.loads(r.value) for r in found}


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of files and folders, drafts left out; none where the folder does not exist."""
    fs, path = _file_system(spark, folder), _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(n for s in fs.listStatus(path) if not (n := s.getPath().getName()).startswith("."))


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a folder."""
    return _file_system(spark, path).getContentSummary(_path(spark, path)).getLength()


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since the file or folder was last changed."""
    changed = _file_system(spark, path).getFileStatus(_path(spark, path)).getModificationTime()
    return (spark.sparkContext._jvm.System.currentTimeMillis() - changed) / 3_600_000


def remove(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def move(spark: SparkSession, old: str, new: str) -> None:
    fs, to = _file_system(spark, old), _path(spark, new)
    fs.mkdirs(to.getParent())
    if not fs.rename(_path(spark, old), to):
        raise OSError(f"could not move {old} to {new}")
