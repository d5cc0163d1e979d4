"""Customer records: anonymised on request, newest version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalar import masked
from tillroll.operators import quality
from tillroll.operators.dedup import any_per_key, newest_per_key
from tillroll.operators.lookup import lookup_join


def known_customers(records: DataFrame) -> DataFrame:
    """Records that carry an id."""
    return quality.valid(records, "customer").drop("_unknown")


def erasure_requests(landed: DataFrame) -> DataFrame:
    """The landed erasure list with a plain column name for the customer."""
    return landed.withColumnRenamed("customer-id", "customer_id")


def erase_customers(
    customers: DataFrame,
    requests: DataFrame,
    *,
    columns: Sequence[str] = ("email", "phone_number"),
    method: str = "sha2",
    salt: str | None = None,
    mark: bool = False,
) -> DataFrame:
    """Mask the personal columns of every customer named in ``requests(customer_id, ...)``.

    ``mark`` adds the column ``masked``; rows that have it and are masked are not masked again.
    """
    named = (
        requests.where(F.col("customer_id").isNotNull())
        .select("customer_id")
        .distinct()
        .withColumn("_erased", F.lit(True))
    )
    flagged = lookup_join(customers, named, {"id": "customer_id"}, "left")
    marked = "masked" in customers.columns
    before = F.coalesce("masked", F.lit(False)) if marked else F.lit(False)
    new = F.coalesce("_erased", F.lit(False)) & ~before
    changes = {
        c: F.when(new, masked(F.col(c), method, salt)).otherwise(F.col(c)) for c in columns
    }
    if mark or marked:
        changes["masked"] = before | new
    return flagged.withColumns(changes).drop("_erased")


def latest_customers(customers: DataFrame, keep: str = "newest") -> DataFrame:
    """One row per id: the last change, and of equal ones the last landed.

    ``keep='any'`` takes an arbitrary version instead.
    """
    if keep == "any":
        return any_per_key(customers, ["id"])
    versions = [c for c in ("last_change", "date", "hour") if c in customers.columns]
    return newest_per_key(customers, ["id"], versions)
