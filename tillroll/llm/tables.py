"""Input tables and the bytes of their texts inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, as a regular expression class and in full.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text's UTF-8 bytes, for tasks that work on bytes."""
    return docs.select("doc_id", whole_text().cast("binary").alias("text"))


def text_rows(batches, rows: int = 200) -> Iterator[tuple]:
    """(doc_id, bytes) one by one; only a few rows of an Arrow batch are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: what bucket counts are derived from."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
