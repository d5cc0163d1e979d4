"""Which batches have landed in which slices: ``{root}/_ledger/{table}/landed=<day>/<batch>.json``.

A slice says what a row is about, not when it came: requests and products of a day land in its hour
00 whenever they arrive. So a job that builds on landed rows remembers the *batches* it has taken,
and the ledger tells it the ones that came since. Batches of one landing query are numbered in the
order they land, so what was taken is one number per query, a *clock*, however many there were.

An entry is written after the batch's rows; repeating a batch finds its entry there. Entries are kept by
the day they landed, so that looking for news lists the last days only.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import or_empty
from tillroll.sinks import commits

ENTRY = "query string, number bigint, batch string, date string, hour string, landed string"
Clock = dict[str, int]


@dataclass(frozen=True)
class Entry:
    """One batch in one slice."""

    query: str
    number: int
    batch: str
    date: str
    hour: str
    landed: str

    @property
    def slice(self) -> tuple[str, str]:
        return self.date, self.hour

    def after(self, clock: Clock) -> bool:
        """Not among the batches that a clock has taken."""
        return self.number > clock.get(self.query, -1)


def _named(batch: str) -> tuple[str, int]:
    """The landing query of a batch and its number there; a batch of another name is its own query."""
    numbered = re.fullmatch(r"(.+)-(\d+)", batch)
    return (numbered[1], int(numbered[2])) if numbered else (batch, 0)


def _today() -> str:
    return datetime.now(UTC).date().isoformat()


def _folder(root: str, table: str) -> str:
    return f"{root}/_ledger/{table}"


def record_batch(
    spark: SparkSession, root: str, table: str, batch: str, slices: Iterable[tuple[str, str]]
) -> None:
    """Note that a batch has landed in these slices."""
    query, number = _named(batch)
    entries = [
        {"query": query, "number": number, "batch": batch, "date": date, "hour": hour}
        for date, hour in sorted(slices)
    ]
    if entries:
        # The same batch once more makes the same name.
        own = hashlib.sha256(json.dumps(entries).encode()).hexdigest()[:16]
        commits.put(spark, f"{_folder(root, table)}/landed={_today()}/{batch}.{own}.json", entries)


def landed_batches(
    spark: SparkSession, root: str, table: str, since: str | None = None
) -> DataFrame:
    """The entries of a table, on and after a day of landing."""
    folder = _folder(root, table)
    days = commits.names_in(spark, folder)
    if since:
        days = [d for d in days if d >= f"landed={since}"]
    if not days:
        return spark.createDataFrame([], ENTRY)
    reader = spark.read.schema(ENTRY).option("basePath", folder)
    return reader.json([f"{folder}/{d}" for d in days]).distinct()


def entries(spark: SparkSession, root: str, table: str, since: str | None = None) -> list[Entry]:
    """The same on the driver: one small row per batch and slice of the days looked at."""
    rows = landed_batches(spark, root, table, since).collect()
    once = {(r.batch, r.date, r.hour): Entry(*r) for r in sorted(rows)}
    return list(once.values())


def clock_of(
    spark: SparkSession, root: str, table: str, date: str, hour: str, *, until: bool
) -> Clock:
    """The batches landed in a slice, or with ``until`` up to it, by now.

    Those of a slice are looked for from the day before its date on, as its rows cannot land earlier.
    """
    since = (datetime.fromisoformat(date) - timedelta(days=1)).date().isoformat()
    found = landed_batches(spark, root, table, None if until else since)
    own = F.struct("date", "hour"), F.struct(F.lit(date).alias("date"), F.lit(hour).alias("hour"))
    scoped = found.where(own[0] <= own[1] if until else own[0] == own[1])
    return dict(scoped.groupBy("query").agg(F.max("number")).collect())


def advanced(clock: Clock, taken: Iterable[Entry]) -> Clock:
    """The clock with these batches taken as well."""
    out = dict(clock)
    for e in taken:
        out[e.query] = max(e.number, out.get(e.query, -1))
    return out


def look_from(pending: Iterable[Entry]) -> str:
    """The day of landing from which a later run must look, with these entries left to take.

    A day back, as clocks of machines differ.
    """
    yesterday = (datetime.now(UTC) - timedelta(days=1)).date().isoformat()
    return min([yesterday, *(e.landed for e in pending)])


def read_batches(
    spark: SparkSession, root: str, table: str, fields: str, taken: Iterable[Entry], fmt: str
) -> DataFrame:
    """The landed rows of these batches; no other folder is listed."""
    base = f"{root}/{table}"
    paths = sorted({f"{base}/date={e.date}/hour={e.hour}/batch={e.batch}" for e in taken})
    if not paths:
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).format(fmt).option("basePath", base).load(paths)


def record_existing(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> int:
    """Note the batches of a table that landed before there was a ledger, from its folder names."""
    fields = "date string, hour string, batch string"
    rows = or_empty(
        spark, lambda: spark.read.schema(fields).format(fmt).load(f"{root}/{table}"), fields
    )
    known = landed_batches(spark, root, table).select("batch")
    new = rows.distinct().join(known, "batch", "left_anti")
    per_batch = new.groupBy("batch").agg(F.collect_set(F.struct("date", "hour")).alias("slices"))
    found = per_batch.collect()
    for r in found:
        record_batch(spark, root, table, r.batch, [tuple(s) for s in r.slices])
    return len(found)
