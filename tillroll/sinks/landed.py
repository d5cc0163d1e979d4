"""Landed tables: ``{root}/{feed}/date=/hour=/batch=``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.scalar import slice_date, slice_hour
from tillroll.operators.records import CARRIED
from tillroll.session import lean_writes
from tillroll.sinks import commits
from tillroll.sources.ledger import record_batch
from tillroll.sources.tables import read_landed


FILE_BYTES = 128 << 20  # of a compacted file, about


def sliced(rows: DataFrame, *, hour: str | None = None, time: Column | None = None) -> DataFrame:
    """Rows with the date and hour to land in: those of the feed's file, else of the log time.

    Never those of the clock, so a replayed batch lands where it did before. ``hour`` pins
    daily feeds.
    """
    ts = F.col("timestamp") if time is None else time
    date, at = slice_date(ts), slice_hour(ts, hour)
    if "feed_date" in rows.columns:
        date = F.coalesce("feed_date", date)
        at = at if hour is not None else F.coalesce("feed_hour", at)
    return rows.withColumns({"date": date, "hour": at})


def land(
    rows: DataFrame,
    root: str,
    table: str,
    batch: str,
    *,
    fmt: str = "parquet",
    target_files: int | None = None,
    spread: bool = True,
) -> None:
    """Write one batch of sliced rows.

    A batch owns its folder in each slice and replaces it, so that writing it twice leaves it
    once. Rows are rebalanced by slice first: a small batch makes one file per slice, a large
    slice still spreads over tasks. ``target_files`` deals the rows out to that many instead;
    without ``spread`` each partition is a file as it comes, and no row moves. The ledger takes the batch in once its rows are there.
    """
    seen = Observation("landed")
    slices = F.collect_set(F.concat_ws(" ", "date", "hour")).alias("slices")  # those of one batch
    out = rows.drop(*CARRIED, "_corrupt", "_unknown")
    if target_files:
        out = out.repartition(target_files)
    elif spread:
        out = out.hint("rebalance", "date", "hour")
    with lean_writes(rows.sparkSession):
        (
            out.withColumn("batch", F.lit(batch))
            .observe(seen, slices)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "hour", "batch")
            .format(fmt)
            .save(f"{root}/{table}")
        )
    landed = [tuple(s.split(" ")) for s in seen.get.get("slices", [])]
    record_batch(rows.sparkSession, root, table, batch, landed)


def unlanded(records: DataFrame, root: str, table: str, batch: str) -> DataFrame:
    """A batch's records without those that landed before, or come twice in the batch itself.

    A log that is written at least once holds some records twice. Copies carry the identity and the slice
    of one feed line, so it takes the identities landed in the batch's slices to tell, however long
    ago that was: ``{root}/_records/{table}/date=/hour=/batch=``, to which those of this batch are added.
    Repeating the batch finds the same records. Records without an identity all stay.

    Identities are looked at by themselves: whole records only move where a batch holds some that stay
    and some that do not.
    """
    spark, base = records.sparkSession, f"{root}/_records/{table}"
    named = F.col("record_id").isNotNull()
    own = sliced(records).where(named).select("record_id", "date", "hour")
    slices = own.groupBy("date", "hour").count().collect()  # hours of one batch
    if not slices:
        return records
    new = own.dropDuplicates(["record_id"])
    fields = "record_id string, date string, hour string, batch string"
    reader = spark.read.schema(fields).option("basePath", base)
    held = [f"{base}/date={r.date}/hour={r.hour}" for r in slices]
    held = [path for path in held if commits.exists(spark, path)]
    if held:
        before = reader.parquet(*held).where(F.col("batch") != batch)
        new = new.join(before.select("record_id"), "record_id", "left_anti")
    seen = Observation("new")
    with lean_writes(spark):
        (
            new.withColumn("batch", F.lit(batch))
            .hint("rebalance", "date", "hour")
            .observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "hour", "batch")
            .parquet(base)
        )
    n_new = seen.get.get("rows", 0)
    if n_new == sum(r["count"] for r in slices):
        return records
    unnamed = records.where(~named)
    if not n_new:
        return unnamed
    stay = records.where(named).join(new.select("record_id"), "record_id", "left_semi")
    once = stay.dropDuplicates(["record_id"])
    return unnamed.unionByName(once.select(*records.columns))


def compact_slice(
    spark: SparkSession,
    root: str,
    compacted: str,
    table: str,
    date: str,
    hour: str,
    *,
    fmt: str = "parquet",
) -> None:
    """Copy one closed slice of a landed table to the table under ``compacted``, in few files.

    The batches of the slice become one folder of files of a sensible size; running it again
    replaces them. The landed slice stays as it is, and can be removed once readers use the copy.
    """
    rows = read_landed(spark, root, table, fmt=fmt, date=date, hour=hour, required=True)
    size = commits.size_of(spark, f"{root}/{table}/date={date}/hour={hour}")
    # Whole splits of the old files make a new one, so that no row is shuffled.
    gathered = rows.drop("batch").coalesce(max(1, -(-size // FILE_BYTES)))
    land(gathered, compacted, table, "compacted", fmt=fmt, spread=False)
