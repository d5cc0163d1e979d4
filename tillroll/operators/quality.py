"""Validity rules, rejects and counts.

``line`` stands for the lines of transactions with their amounts as text. A line that breaks a rule
lands all the same, as its amount may count towards its basket; it is reported besides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalar import money, number


def rules(feed_name: str) -> dict[str, Column]:
    """The feed's rules by name, over the feed's text columns."""
    if feed_name == "erasure":
        return {"customer-id": F.col("`customer-id`").isNotNull()}
    if feed_name == "product":
        return {
            "sku": F.col("sku").isNotNull(),
            "popularity": number(F.col("popularity"), "float") > 0,
            "price": number(F.col("price")) >= 0,
        }
    if feed_name == "customer":
        return {"id": F.col("id").isNotNull()}
    if feed_name == "transaction":
        return {"products": F.size("purchases.products") > 0}
    if feed_name == "line":
        return {
            "sku": F.col("sku").isNotNull(),
            "total": money(F.col("total")).isNotNull(),
            "total_cost": money(F.col("total_cost")).isNotNull(),
        }
    raise ValueError(f"unknown feed {feed_name!r}")


def reject_reason(feed_name: str) -> Column:
    """Null for a record to land, else ``corrupt`` or the first rule it breaks."""
    broken = [
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules(feed_name).items()
    ]
    first = F.coalesce(*broken)
    if feed_name == "line":
        return first
    return F.when(first.isNotNull() & F.col("_corrupt").isNotNull(), "corrupt").otherwise(first)


def valid(records: DataFrame, feed_name: str) -> DataFrame:
    for ok in rules(feed_name).values():
        records = records.where(ok)
    return records


def rejected(records: DataFrame, feed_name: str) -> DataFrame:
    """The records that do not land, whole, with the reason."""
    return records.withColumn("reason", reject_reason(feed_name)).where(
        F.col("reason").isNotNull()
    )


def feed_counts(records: DataFrame, feed_name: str) -> DataFrame:
    """One row: records seen and records rejected."""
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(reject_reason(feed_name).isNotNull()).alias("rejected"),
    ).select(F.lit(feed_name).alias("feed"), "records", "rejected")


def observed(records: DataFrame, feed_name: str, label: str | None = None) -> DataFrame:
    """The same records, with the counts of ``feed_counts`` reported per batch by Spark."""
    return records.observe(
        label or feed_name,
        F.count(F.lit(1)).alias("records"),
        F.count_if(reject_reason(feed_name).isNotNull()).alias("rejected"),
    )
