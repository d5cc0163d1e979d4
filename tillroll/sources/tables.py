"""Landed and curated tables, read with declared schemas and pruned to their slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import CURATED_FIELDS, CURATED_PARTITIONS, LANDED_FIELDS, LANDED_PARTITIONS
from tillroll.session import or_empty
from tillroll.sinks import commits


def read_json(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """JSON records of a declared schema; no rows where the path does not exist."""
    return or_empty(spark, lambda: spark.read.schema(fields).json(path), fields)


def read_landed(
    spark: SparkSession,
    root: str,
    feed_name: str,
    *,
    fmt: str = "parquet",
    date: str | None = None,
    hour: str | None = None,
    required: bool = False,
) -> DataFrame:
    """A landed feed, or one slice of it; only the folders of the slice are listed.

    What does not exist has no rows, or raises if ``required``.
    """
    base = f"{root}/{feed_name}"
    path = base
    if date is not None:
        path += f"/date={date}" if hour is None else f"/date={date}/hour={hour}"
    fields = f"{LANDED_FIELDS[feed_name]}, {LANDED_PARTITIONS}"
    reader = spark.read.schema(fields).format(fmt).option("basePath", base)
    rows = reader.load(path) if required else or_empty(spark, lambda: reader.load(path), fields)
    return rows.where(F.col("hour") == hour) if date is None and hour is not None else rows


def read_landed_until(
    spark: SparkSession,
    root: str,
    feed_name: str,
    *,
    date: str,
    hour: str,
    fmt: str = "parquet",
    after: tuple[str, str] | None = None,
) -> DataFrame:
    """A landed feed up to a slice, that slice included, and after slice ``after``, if given."""
    rows = read_landed(spark, root, feed_name, fmt=fmt).where(_upto(date, hour))
    if after is None:
        return rows
    # Stated on the date alone as well, which prunes whole folders.
    return rows.where(F.col("date") >= after[0]).where(~_upto(*after))


def _upto(date: str, hour: str):
    return (F.col("date") < date) | ((F.col("date") == date) & (F.col("hour") <= hour))


SLICES = "_slices"  # beside the folders of a curated table: which version of each slice counts
VERSION_FIELDS = (
    "path string, consumed map<string,map<string,bigint>>, date string, hour string"
)


def slice_versions(spark: SparkSession, root: str) -> DataFrame:
    """All records of a curated table's slices: ``date, hour, number, path, consumed``."""
    folder, columns = f"{root}/{SLICES}", ["date", "hour", "number", "path", "consumed"]
    if not commits.exists(spark, folder):
        return spark.createDataFrame([], f"{VERSION_FIELDS}, number bigint").select(*columns)
    records = spark.read.schema(VERSION_FIELDS).option("basePath", folder).json(folder)
    number = F.regexp_extract("_metadata.file_name", "^([0-9]+)", 1).cast("bigint")
    return records.withColumn("number", number).select(*columns)


def current_slices(spark: SparkSession, root: str) -> DataFrame:
    """The last record of each slice; ``path`` is null where the slice came out empty."""
    last = F.max_by(F.struct("number", "path", "consumed"), "number").alias("last")
    found = slice_versions(spark, root).groupBy("date", "hour").agg(last)
    return found.select("date", "hour", "last.*")


def read_curated(
    spark: SparkSession,
    root: str,
    *,
    fmt: str = "parquet",
    slices: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """The curated table as it is now, or some of its slices.

    The versions of the slices are looked up here, one small row each; what is committed later is not
    seen by this DataFrame.
    """
    fields = f"{CURATED_FIELDS}, {CURATED_PARTITIONS}"
    found = current_slices(spark, root).where("path is not null").select("date", "hour", "path")
    wanted = None if slices is None else set(slices)
    paths = [f"{root}/{r.path}" for r in found.collect() if wanted is None or (r.date, r.hour) in wanted]
    if not paths:
        return spark.createDataFrame([], fields)
    reader = spark.read.schema(f"{fields}, version string").format(fmt).option("basePath", root)
    return reader.load(sorted(paths)).drop("version")
