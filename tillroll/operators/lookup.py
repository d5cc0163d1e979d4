"""Equi-join of a large side with a lookup side that has unique keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "inner",
    *,
    nulls_match: bool = False,
) -> DataFrame:
    """``facts`` joined to ``lookup`` on ``{fact column: lookup column}``; fact keys are kept.

    There is no broadcast hint: Spark broadcasts the lookup when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise.

    One fact key may hold a third of the rows, so the sort-merge must be one that adaptive
    execution can split. It only splits when both sides arrive straight from a shuffle, and a
    lookup that was just aggregated on its key normally does not, as its partitioning is
    reused. Null-safe keys hash differently from plain ones, so here both sides are exchanged
    (the lookup is the smaller side) and a hot key is split.
    """
    renamed = {c: f"_lk_{i}" for i, c in enumerate(on.values())}
    right = lookup.withColumnsRenamed(renamed)
    if not nulls_match:
        right = right.where(reduce(and_, (F.col(c).isNotNull() for c in renamed.values())))
        if how == "inner":
            facts = facts.where(reduce(and_, (F.col(c).isNotNull() for c in on)))
    same = reduce(and_, (F.col(f).eqNullSafe(F.col(renamed[k])) for f, k in on.items()))
    return facts.join(right, same, how).drop(*renamed.values())
