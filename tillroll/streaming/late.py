"""De-duplication within a watermark that keeps late rows, and says what became of each.

Spark drops rows later than the watermark before any stateful step sees them, also before a
``transformWithState`` processor. So lateness is told here, batch by batch: the watermark of a batch is the
latest time of all batches before it less ``delay``, kept in a numbered record beside the checkpoint, so
that a repeated batch finds the same. Rows before it go to ``late_<table>`` with the reason. The others land
once per key; the keys landed in slices from the watermark on, ``{root}/_keys/<table>``, are all that is
looked at, so what is remembered is bounded by the delay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.sinks import commits
from tillroll.sinks.landed import land, sliced
from tillroll.streaming.feeds import Landing

# Rows without a time are never late, and land in a slice of their own, which every batch looks at.
NO_TIME = ("unknown", "00")


def _slice_of(rows: DataFrame, time: str) -> DataFrame:
    placed = sliced(rows, time=F.col(time))
    return placed.withColumns(
        {c: F.coalesce(c, F.lit(v)) for c, v in zip(("date", "hour"), NO_TIME, strict=True)}
    )


def watermark_before(spark, marks: str, batch_id: int) -> str | None:
    """The latest time of the batches before this one, as text; none before the first."""
    known = commits.read_records(spark, marks)
    return known[max(n for n in known if n < batch_id)]["latest"] if any(n < batch_id for n in known) else None


def split_late(rows: DataFrame, time: str, latest: str | None, delay: str) -> tuple[DataFrame, DataFrame]:
    """Rows in time, and late ones with the reason."""
    if latest is None:
        return rows, rows.where("false").withColumn("reason", F.lit(""))
    mark = F.lit(latest).cast("timestamp") - F.expr(f"interval {delay}")
    is_late: Column = F.coalesce(F.col(time) < mark, F.lit(False))
    reason = F.format_string("before %s", F.date_format(mark, "yyyy-MM-dd HH:mm:ss"))
    return rows.where(~is_late), rows.where(is_late).withColumn("reason", reason)


def _known_keys(spark, base: str, latest: str | None, delay: str, batch: str) -> DataFrame | None:
    """Keys that other batches have landed in slices that rows in time can fall into."""
    days = commits.names_in(spark, base)
    if latest is not None:
        mark = F.lit(latest).cast("timestamp") - F.expr(f"interval {delay}")
        first = spark.range(1).select(F.date_format(mark, "yyyy-MM-dd"), F.date_format(mark, "HH")).first()
        days = [d for d in days if d >= f"date={first[0]}"]  # "unknown" sorts after all dates
    if not days:
        return None
    reader = spark.read.schema("key string, date string, hour string, batch string").option("basePath", base)
    keys = reader.parquet(*[f"{base}/{d}" for d in days]).where(F.col("batch") != batch)
    if latest is not None:
        keys = keys.where((F.col("date") > first[0]) | (F.col("hour") >= first[1]))
    return keys


def land_in_time(
    rows: DataFrame, to: Landing, table: str, key: str, time: str, delay: str = "10 minutes"
) -> StreamingQuery:
    """Land the first row per key that comes in time; late ones land in ``late_<table>``.

    Per batch, ``_fates/<table>`` holds the number of rows seen, landed, late and repeated: the first is the
    sum of the others.
    """
    marks, base = f"{to.checkpoints}/{table}-times", f"{to.tables}/_keys/{table}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"{query}-{batch_id}"
        latest = watermark_before(spark, marks, batch_id)
        batch.persist()
        try:
            own = _slice_of(batch, time)
            timely, late = split_late(own, time, latest, delay)
            new = timely.withColumn("_key", F.col(key).cast("string")).dropDuplicates(["_key"])
            known = _known_keys(spark, base, latest, delay, name)
            if known is not None:
                new = new.join(known.select(F.col("key").alias("_key")).distinct(), "_key", "left_anti")
            new.persist()
            land(new.drop("_key"), to.tables, table, name, fmt=to.fmt)
            land(late, to.tables, f"late_{table}", name, fmt=to.fmt)
            (
                new.select(F.col("_key").alias("key"), "date", "hour", F.lit(name).alias("batch"))
                .hint("rebalance", "date", "hour")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("date", "hour", "batch")
                .parquet(base)
            )
            seen, last = batch.agg(F.count(F.lit(1)), F.max(time).cast("string")).first()
            fates = {"seen": seen, "landed": new.count(), "late": late.count()}
            fates["repeated"] = seen - fates["landed"] - fates["late"]
            commits.put(spark, f"{to.tables}/_fates/{table}/{name}.json", [fates])
            # Last of all: a batch that dies before it is repeated whole, and finds the same watermark.
            latest = max(x for x in (latest, last) if x) if latest or last else None
            commits.put(spark, f"{marks}/{batch_id:09d}.json", [{"latest": latest}])
            new.unpersist()
        finally:
            batch.unpersist()

    writer = (
        rows.writeStream.queryName(f"{table}-{uuid.uuid4().hex[:8]}")
        .option("checkpointLocation", f"{to.checkpoints}/{table}")
        .foreachBatch(write)
    )
    if to.once:
        writer = writer.trigger(availableNow=True)
    elif to.every:
        writer = writer.trigger(processingTime=to.every)
    return writer.start()
