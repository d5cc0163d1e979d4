"""One row per key, in batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def any_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever Spark meets first. Also keeps one row for the null key."""
    return rows.dropDuplicates(list(keys))


def newest_per_key(rows: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest`` columns per key; ties fall to the greatest row.

    A maximum of structs rather than a ranking window: it is combined before the shuffle, so
    a key with any number of versions sends one row per task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in newest]
    best = F.max(F.struct(*newest, *rest)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*rows.columns)
