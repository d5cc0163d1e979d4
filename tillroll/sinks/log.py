"""Publishing records to the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators.records import no_headers
from tillroll.schemas import LOG_FIELDS, names
from tillroll.session import lean_writes, or_empty


KAFKA_COLUMNS = ["topic", "key", "value", "partition", "headers"]


def write_kafka(records: DataFrame, servers: str) -> None:
    """Routed records to Kafka; the sink honours their topic and partition columns."""
    writer = records.select(*KAFKA_COLUMNS).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).save()


def stream_to_kafka(
    records: DataFrame, servers: str, checkpoint: str, *, once: bool = False
) -> StreamingQuery:
    writer = (
        records.select(*KAFKA_COLUMNS)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def as_log(records: DataFrame, *, first_offset: int = 0) -> DataFrame:
    """Routed records completed to the shape the Kafka source delivers.

    Offsets rise from ``first_offset`` with gaps, as in a compacted topic.
    """
    if "timestamp" not in records.columns:
        records = records.withColumn("timestamp", F.current_timestamp())
    if "headers" not in records.columns:
        records = records.withColumn("headers", no_headers())
    return records.withColumns(
        {
            "offset": F.monotonically_increasing_id() + F.lit(first_offset),
            "timestampType": F.lit(0),
        }
    ).select(*names(LOG_FIELDS))


def write_log_files(log: DataFrame, path: str, batch: int) -> None:
    """Add one batch to a file-backed log; the same batch again replaces itself."""
    with lean_writes(log.sparkSession):
        (
            log.withColumn("batch", F.lit(batch))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("partition", "batch")
            .parquet(path)
        )


def _next_offset(spark: SparkSession, path: str, batch: int) -> int:
    fields = "offset bigint, batch bigint"
    log = or_empty(spark, lambda: spark.read.schema(fields).parquet(path), fields)
    last = log.where(F.col("batch") < batch).agg(F.max("offset")).first()[0]
    return 0 if last is None else last + 1


def stream_to_log_files(
    records: DataFrame, path: str, checkpoint: str, *, once: bool = True
) -> StreamingQuery:
    """Routed records to a file-backed log, for queries and tests without a broker.

    Offsets of a micro-batch follow those of the batches before it.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        first = _next_offset(batch.sparkSession, path, batch_id)
        write_log_files(as_log(batch, first_offset=first), path, batch_id)

    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)
    return (writer.trigger(availableNow=True) if once else writer).start()
