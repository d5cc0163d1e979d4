"""Which curated slices do not hold all that has landed for them, and curating those again.

A curated slice notes the landed batches it was made from (``consumed``): of transactions those in its
hour, of products and customers those of one slice or all up to it, as the run was told, and all erasure
requests. A batch that lands in such a place afterwards makes the slice stale. Requests concern few
customers of all slices, which :func:`tillroll.plans.erasure.erase_stored` finds by itself, so they are only
looked at if asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.plans.curate import curate_slice
from tillroll.plans.snapshot import EVERYTHING
from tillroll.sources.ledger import landed_batches
from tillroll.sources.tables import current_slices

TABLES = ("transaction", "product", "customer")


def _stale_in_slice(slices: DataFrame, entries: DataFrame) -> DataFrame:
    """Slices that took a table from one (date, hour), where a batch came since."""
    place = F.split(F.split_part("key", F.lit(":"), F.lit(1)), " ")
    own = slices.where("key like '% %:%'").select(
        "date", "hour", "clock", place[0].alias("_date"), place[1].alias("_hour")
    )
    met = own.join(
        entries.select(F.col("date").alias("_date"), F.col("hour").alias("_hour"), "query", "number"),
        ["_date", "_hour"],
    )
    return met.where(F.col("number") > F.coalesce(F.col("clock")[F.col("query")], F.lit(-1)))


def _stale_until(slices: DataFrame, entries: DataFrame) -> DataFrame:
    """Slices that took a table up to their own, where a batch came since in any slice up to it.

    Per landing query, the highest number up to a slice runs along the slices in order.
    """
    names = [r.query for r in entries.select("query").distinct().collect()]  # one per checkpoint
    queries = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    own = slices.where("key like 'until:%' or key like 'all:%'").withColumn("query", F.explode(queries))
    whole = F.col("key").startswith("all:")
    at = {
        c: F.when(whole, last).otherwise(F.col(c))
        for c, last in zip(("date", "hour"), EVERYTHING, strict=True)
    }
    asked = own.select(
        "query", at["date"].alias("date"), at["hour"].alias("hour"),
        F.struct("date", "hour").alias("of"), F.lit(None).cast("bigint").alias("number"),
        F.coalesce(F.col("clock")[F.col("query")], F.lit(-1)).alias("taken"),
    )
    seen = entries.groupBy("query", "date", "hour").agg(F.max("number").alias("number"))
    both = asked.unionByName(seen, allowMissingColumns=True)
    upto = Window.partitionBy("query").orderBy("date", "hour")  # ties included
    found = both.withColumn("latest", F.max("number").over(upto))
    return found.where("taken is not null and latest > taken").select("of.*")


def stale_slices(
    spark: SparkSession,
    landing: str,
    curated: str,
    *,
    since: str | None = None,
    tables: Sequence[str] = TABLES,
) -> DataFrame:
    """``date, hour, table`` of slices for which more has landed than they hold.

    ``since`` is a day of landing: only batches from then on are looked at.
    """
    slices = current_slices(spark, curated).select(
        "date", "hour", F.explode("consumed").alias("key", "clock")
    )
    out = None
    for table in tables:
        own = slices.where(F.split_part("key", F.lit(":"), F.lit(2)) == table)
        entries = landed_batches(spark, landing, table, since)
        for found in (_stale_in_slice(own, entries), _stale_until(own, entries)):
            named = found.select("date", "hour", F.lit(table).alias("table"))
            out = named if out is None else out.unionByName(named)
    return out.distinct()


def recurate_late(
    spark: SparkSession,
    landing: str,
    curated: str,
    *,
    since: str | None = None,
    **options,
) -> list[tuple[str, str]]:
    """Curate the stale slices again, with the options they are curated with; returns them.

    In the order of the slices, each a job of its own: one that fails leaves the others done.
    """
    stale = stale_slices(spark, landing, curated, since=since).select("date", "hour").distinct()
    found = sorted((r.date, r.hour) for r in stale.collect())
    for date, hour in found:
        curate_slice(spark, landing, curated, date, hour, **options)
    return found
