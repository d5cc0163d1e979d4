"""Product records: typed, valid, one per sku."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalar import number
from tillroll.operators import quality
from tillroll.operators.dedup import any_per_key, newest_per_key


def typed_products(records: DataFrame) -> DataFrame:
    """Valid records only, with a numeric price and popularity."""
    return quality.valid(records, "product").withColumns(
        {
            "price": number(F.col("price")),
            "popularity": number(F.col("popularity"), "float"),
        }
    )


def clean_products(records: DataFrame, keep: str = "greatest") -> DataFrame:
    """Batch form: typed, valid and unique by sku.

    ``keep='greatest'`` settles copies that differ by comparing whole rows, so that runs
    agree; ``keep='any'`` takes whichever comes first.
    """
    typed = typed_products(records)
    if keep == "any":
        return any_per_key(typed, ["sku"])
    return newest_per_key(typed, ["sku"], [])
