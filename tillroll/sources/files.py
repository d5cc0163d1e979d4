"""Hourly feed files: ``{root}/date=YYYY-MM-DD/hour=HH/<feed file>``, gzip, one record a line."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import Feed
from tillroll.session import or_empty

# Partition columns are declared, so that hour '00' stays text.
LINE_FIELDS = "value string, date string, hour string"


def feed_glob(root: str, feed: Feed, date: str | None = None, hour: str | None = None) -> str:
    """Where the feed's files lie; without date or hour, in all of them."""
    return f"{root}/date={date or '*'}/hour={hour or '*'}/{feed.file_name}"


def feed_lines(
    spark: SparkSession,
    root: str,
    feed: Feed,
    *,
    date: str | None = None,
    hour: str | None = None,
    partitions: int | None = None,
    numbered: bool = False,
) -> DataFrame:
    """The feed's non-blank lines with their date and hour; no rows if nothing has arrived.

    A gzip file is read by one task. ``partitions`` spreads the lines afterwards, which pays
    where few files are large. With ``numbered`` lines have the columns ``file`` and ``line``, their
    place, which is the same whenever the file is read.
    """
    path = feed_glob(root, feed, date, hour)
    reader = spark.read.schema(LINE_FIELDS).option("basePath", root)

    def read() -> DataFrame:
        text = reader.text(path)
        return numbered_lines(text) if numbered else text

    fields = LINE_FIELDS + (", file string, line bigint" if numbered else "")
    lines = _non_blank(or_empty(spark, read, fields))
    return lines.repartition(partitions) if partitions else lines


def stream_feed_lines(
    spark: SparkSession,
    root: str,
    feed: Feed,
    *,
    date: str | None = None,
    max_files_per_trigger: int | None = None,
    partitions: int | None = None,
    numbered: bool = False,
    archive: str | None = None,
) -> DataFrame:
    """The same as a stream. The checkpoint remembers the files read, so that none is read
    twice and one that arrives late is still picked up.

    Each trigger lists the feed's folders; a ``date`` pattern such as ``2020-01-*`` keeps that
    short where years of them lie about. With ``archive`` files move to that folder once the batch after
    theirs begins, so that what is listed are the files to come; one that arrives late is still found.
    """
    reader = spark.readStream.schema(LINE_FIELDS).option("basePath", root)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    text = reader.text(feed_glob(root, feed, date))
    lines = _non_blank(numbered_lines(text) if numbered else text)
    return lines.repartition(partitions) if partitions else lines


def numbered_lines(text: DataFrame) -> DataFrame:
    """Lines just read, with their file (from its date on, and where a split of it begins) and number.

    A split of a file is read by one task from its first line to its last; a gzip file is one split.
    """
    place = F.concat_ws(
        "@",
        F.regexp_extract("_metadata.file_path", "(date=.*)$", 1),
        F.col("_metadata.file_block_start").cast("string"),
    )
    placed = text.select("*", place.alias("file"))
    return placed.mapInArrow(_number, f"{LINE_FIELDS}, file string, line bigint")


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count the lines of each file, which come one after the other."""
    current, count = None, 0
    for batch in batches:
        files = batch.column(batch.schema.get_field_index("file")).dictionary_encode()
        codes = files.indices.to_numpy()
        begins = np.flatnonzero(np.diff(codes, prepend=-1))
        numbers = np.empty(batch.num_rows, np.int64)
        for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
            name = files.dictionary[int(codes[begin])].as_py()
            current, count = (name, count) if name == current else (name, 0)
            numbers[begin:end] = np.arange(count, count + end - begin)
            count += end - begin
        columns = [batch.column(c) for c in ("value", "date", "hour", "file")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(numbers)], names=["value", "date", "hour", "file", "line"]
        )


def _non_blank(lines: DataFrame) -> DataFrame:
    return lines.where(F.btrim("value") != "")
