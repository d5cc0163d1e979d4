"""Erasure that reaches back: customers who ask to be forgotten are masked in what is stored already.

An index tells which landed batches and curated slices may hold a customer: ids are hashed to 2**24
positions, and each place has the bitmap of its ids, in pieces of 2**15 positions. It is built from what
is new, in proportion to it. New requests, hashed the same way, pick the places that may hold one of
them; there only the ids are read to see which do; and only those are written anew. All others keep
their files. Everything is built-in functions; requests and places are joined by piece of the bitmap.

Curated slices are replaced by a new version, at once. A landed batch is written beside the table and
then exchanged for the old folder; a run that dies in between is finished by the next one. Run it when no
job reads landed customers.

A request counts as done once a run is through; the next run takes it up once more, for customers that
were landing meanwhile. Later requests of the same customer find nothing left to do. Rows are masked
once: landed ones say that they are masked, and curated slices note the requests that went into them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.scalar import masked
from tillroll.operators.customer import erase_customers
from tillroll.operators.lookup import lookup_join
from tillroll.schemas import LANDED_FIELDS, LANDED_PARTITIONS
from tillroll.session import or_empty
from tillroll.sinks import commits
from tillroll.sinks.curated import write_curated
from tillroll.sources import ledger
from tillroll.sources.tables import current_slices, read_curated

POSITIONS = 1 << 24
PLACE = "place string, date string, hour string, piece bigint, bits binary"
MOST_SEGMENTS = 24
CUSTOMER = f"{LANDED_FIELDS['customer']}, {LANDED_PARTITIONS}"
REQUEST = f"{LANDED_FIELDS['erasure']}, {LANDED_PARTITIONS}"


def _position(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(POSITIONS))


def people_bitmaps(rows: DataFrame) -> DataFrame:
    """The bitmap of the ids in each ``place``, by piece, of rows ``place, date, hour, id``."""
    at = rows.where(F.col("id").isNotNull()).withColumn("at", _position(F.col("id")))
    return at.groupBy("place", "date", "hour", F.bitmap_bucket_number("at").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )


def has_bit(bits: Column, at: Column) -> Column:
    """Whether a bitmap has a bit, with eight of them in a byte from the lowest on."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.call_function("shiftright", byte.cast("int"), (at % 8).cast("int")) % 2 == 1


def places_of(index: DataFrame, ids: DataFrame) -> DataFrame:
    """``place, date, hour`` that may hold one of the ids: all that do, and a few others."""
    at = ids.select(_position(F.col("id")).alias("at"))
    wanted = at.groupBy(F.bitmap_bucket_number("at").alias("piece")).agg(
        F.collect_set(F.bitmap_bit_position("at")).alias("wanted")  # 2**15 at most
    )
    met = index.join(wanted, "piece")
    return met.where(F.exists("wanted", lambda b: has_bit(F.col("bits"), b))).select(
        "place", "date", "hour"
    ).distinct()


def _index(spark: SparkSession, root: str, record: dict | None) -> DataFrame:
    if not record or not record["segments"]:
        return spark.createDataFrame([], PLACE)
    return spark.read.schema(PLACE).parquet(*[f"{root}/{s}" for s in record["segments"]])


def _last(spark: SparkSession, folder: str) -> dict | None:
    known = commits.read_records(spark, f"{folder}/commits")
    return known[max(known)] if known else None


def _store(spark: SparkSession, root: str, record: dict, news: DataFrame, keep: DataFrame | None = None) -> dict:
    """The record with the bitmaps of new places added; many segments become one of places to ``keep``."""
    segments = [*record["segments"], f"segments/{uuid.uuid4().hex}"]
    people_bitmaps(news).hint("rebalance").write.parquet(f"{root}/{segments[-1]}")
    if len(segments) > MOST_SEGMENTS:
        rows = _index(spark, root, {"segments": segments})
        merged = f"segments/{uuid.uuid4().hex}"
        kept = rows if keep is None else rows.join(keep, "place", "left_semi")
        kept.hint("rebalance").write.parquet(f"{root}/{merged}")
        segments = [merged]
    record = record | {"segments": segments}
    commits.put_next(spark, f"{root}/commits", record)
    return record


def index_landed(spark: SparkSession, landing: str, index: str, *, fmt: str = "parquet") -> DataFrame:
    """The index of landed customer batches, with those that came since it was last looked at."""
    root = f"{index}/customer"
    record = _last(spark, root) or {"segments": [], "clock": {}, "since": None}
    found = ledger.entries(spark, landing, "customer", record["since"])
    news = [e for e in found if e.after(record["clock"])]
    if news:
        rows = ledger.read_batches(spark, landing, "customer", CUSTOMER, news, fmt)
        at = {"clock": ledger.advanced(record["clock"], news), "since": ledger.look_from([])}
        ids = rows.select(F.col("batch").alias("place"), "date", "hour", "id")
        record = _store(spark, root, record | at, ids)
    return _index(spark, root, record)


def index_curated(spark: SparkSession, curated: str, index: str, *, fmt: str = "parquet") -> DataFrame:
    """The same of the curated slices' versions that count now."""
    root = f"{index}/curated"
    record = _last(spark, root) or {"segments": []}
    current = current_slices(spark, curated).where("path is not null")
    places = current.select(F.col("path").alias("place"), "date", "hour")
    known = _index(spark, root, record).select("place").distinct()
    new = [(r.date, r.hour) for r in places.join(known, "place", "left_anti").collect()]
    if new:
        rows = read_curated(spark, curated, fmt=fmt, slices=new).select("date", "hour", "id")
        named = lookup_join(rows, places, {"date": "date", "hour": "hour"})
        record = _store(spark, root, record, named.select("place", "date", "hour", "id"), places)
    return _index(spark, root, record).join(places.select("place"), "place", "left_semi")


def _new_requests(
    spark: SparkSession, landing: str, index: str, done: list[dict], fmt: str
) -> tuple[DataFrame, dict]:
    """``id, query, number, date, hour`` of the requests since the run before the last; what is done then.

    Without those of customers whose requests were done by then.
    """
    before = done[-2] if len(done) > 1 else {"clock": {}, "since": None, "ids": []}
    found = ledger.entries(spark, landing, "erasure", before["since"])
    news = [e for e in found if e.after(before["clock"])]
    rows = ledger.read_batches(spark, landing, "erasure", REQUEST, news, fmt)
    batches = spark.createDataFrame(
        [(e.batch, e.query, e.number) for e in {e.batch: e for e in news}.values()],
        "_batch string, query string, number bigint",
    )
    asked = rows.where(F.col("customer-id").isNotNull()).select(
        F.col("customer-id").alias("id"), "date", "hour", "batch"
    )
    named = lookup_join(asked, batches, {"batch": "_batch"}).drop("batch").distinct()
    if before["ids"]:
        earlier = spark.read.schema("id string").parquet(*[f"{index}/{s}" for s in before["ids"]])
        named = named.join(earlier, "id", "left_anti")
    last = done[-1] if done else before
    pending = [e for e in news if e.after(last["clock"])]
    clock = ledger.advanced(last["clock"], pending)
    return named, {"clock": clock, "since": ledger.look_from(pending), "ids": last["ids"]}


def _note_ids(spark: SparkSession, index: str, ids: list[str], requests: DataFrame) -> list[str]:
    """The segments of customers that have asked, with those of new requests."""
    segments = [*ids, f"ids/{uuid.uuid4().hex}"]
    new = requests.select("id").distinct()
    if len(segments) > MOST_SEGMENTS:
        new = new.union(spark.read.schema("id string").parquet(*[f"{index}/{s}" for s in ids])).distinct()
        segments = segments[-1:]
    new.write.parquet(f"{index}/{segments[-1]}")
    return segments


def erase_stored(
    spark: SparkSession,
    landing: str,
    curated: str,
    index: str,
    *,
    columns: Sequence[str] = ("email", "phone_number"),
    method: str = "sha2",
    salt: str | None = None,
    fmt: str = "parquet",
) -> dict[str, list[tuple[str, str]]]:
    """Mask the customers of new requests in landed batches and curated slices; returns those touched.

    ``index`` is a folder of this job's own. The mask options must be those the tables are made with.
    """
    finish_exchanges(spark, landing)
    known = commits.read_records(spark, f"{index}/done")
    done = [known[n] for n in sorted(known)]
    requests, record = _new_requests(spark, landing, index, done, fmt)
    path = f"{index}/requests-{uuid.uuid4().hex}"
    requests.write.parquet(path)  # read several times, and the same each time
    requests = spark.read.schema(requests.schema).parquet(path)
    mask = {"columns": columns, "method": method, "salt": salt}
    touched = {"customer": [], "curated": []}
    if not requests.isEmpty():
        touched = {
            "customer": _erase_landed(spark, landing, index, requests, mask, fmt),
            "curated": _erase_curated(spark, curated, index, requests, record["clock"], mask, fmt),
        }
        record["ids"] = _note_ids(spark, index, record["ids"], requests)
    commits.put_next(spark, f"{index}/done", record)
    commits.remove(spark, path)
    return touched


def _erase_landed(
    spark: SparkSession, landing: str, index: str, requests: DataFrame, mask: dict, fmt: str
) -> list[tuple[str, str]]:
    base = f"{landing}/customer"
    ids = requests.select("id").distinct()
    maybe = places_of(index_landed(spark, landing, index, fmt=fmt), ids).collect()
    reader = spark.read.schema(CUSTOMER).format(fmt).option("basePath", base)

    def batches(places) -> DataFrame:
        return reader.load([f"{base}/date={p.date}/hour={p.hour}/batch={p.place}" for p in places])

    if not maybe:
        return []
    clear = batches(maybe).where(~F.coalesce("masked", F.lit(False)))
    hit = lookup_join(clear.select("id", "date", "hour", "batch"), ids, {"id": "id"})
    places = hit.select(F.col("batch").alias("place"), "date", "hour").distinct().collect()
    if not places:
        return []
    staged = f"{landing}/_exchange/{uuid.uuid4().hex}"
    named = ids.withColumnRenamed("id", "customer_id")
    erased = erase_customers(batches(places), named, mark=True, **mask)
    (
        erased.hint("rebalance", "date", "hour", "batch")
        .write.partitionBy("date", "hour", "batch")
        .format(fmt)
        .save(f"{staged}/new")
    )
    record = {"folders": [f"date={p.date}/hour={p.hour}/batch={p.place}" for p in places]}
    commits.put(spark, f"{staged}/exchange.json", [record])
    finish_exchanges(spark, landing)
    return sorted({(p.date, p.hour) for p in places})


def finish_exchanges(spark: SparkSession, landing: str) -> None:
    """Put written batches in the place of the old ones, also where an earlier run died at it."""
    root = f"{landing}/_exchange"
    for run in commits.names_in(spark, root):
        staged = f"{root}/{run}"
        if commits.exists(spark, f"{staged}/exchange.json"):
            [record] = spark.read.schema("folders array<string>").json(f"{staged}/exchange.json").collect()
            for folder in record.folders:
                live, old, new = (f"{x}/{folder}" for x in (f"{landing}/customer", f"{staged}/old", f"{staged}/new"))
                if not commits.exists(spark, new):
                    continue  # exchanged already
                if commits.exists(spark, live):
                    commits.move(spark, live, old)
                commits.move(spark, new, live)
        commits.remove(spark, staged)


def _erase_curated(
    spark: SparkSession,
    curated: str,
    index: str,
    requests: DataFrame,
    clock: ledger.Clock,
    mask: dict,
    fmt: str,
) -> list[tuple[str, str]]:
    ids = requests.select("id").distinct()
    maybe = places_of(index_curated(spark, curated, index, fmt=fmt), ids)
    slices = [(r.date, r.hour) for r in maybe.select("date", "hour").distinct().collect()]
    if not slices:
        return []
    current = {(r.date, r.hour): r.consumed or {} for r in current_slices(spark, curated).collect()}
    held = spark.createDataFrame(
        [(*s, current[s].get("all:erasure", {}), current[s].get("erased", {})) for s in slices],
        "date string, hour string, taken map<string,bigint>, erased map<string,bigint>",
    )
    rows = read_curated(spark, curated, fmt=fmt, slices=slices)
    # Who is to be forgotten in which slice, where none of their requests has gone into it.
    present = lookup_join(rows.select("id", "date", "hour").distinct(), held, {"date": "date", "hour": "hour"})
    gone_in = F.col("number") <= F.greatest(
        *[F.coalesce(F.col(c)[F.col("query")], F.lit(-1)) for c in ("taken", "erased")]
    )
    met = present.join(requests.select("id", "query", "number"), "id").groupBy("id", "date", "hour").agg(F.bool_or(gone_in).alias("hidden"))
    to_mask = met.where("not hidden").select("id", "date", "hour")
    path = f"{index}/masks-{uuid.uuid4().hex}"
    to_mask.write.parquet(path)
    to_mask = spark.read.schema("id string, date string, hour string").parquet(path)
    touched = sorted((r.date, r.hour) for r in to_mask.select("date", "hour").distinct().collect())
    if touched:
        flagged = lookup_join(
            read_curated(spark, curated, fmt=fmt, slices=touched).drop("year", "month"),
            to_mask.withColumn("_mask", F.lit(True)),
            {"id": "id", "date": "date", "hour": "hour"},
            "left",
        )
        hidden = {
            c: F.when(F.col("_mask"), masked(F.col(c), mask["method"], mask["salt"])).otherwise(F.col(c))
            for c in mask["columns"]
        }

        def consumed(date: str, hour: str) -> dict:
            before = {k: dict(v) for k, v in current[date, hour].items()}
            erased = before.get("erased", {})
            return before | {"erased": {q: max(n, erased.get(q, -1)) for q, n in clock.items()}}

        write_curated(
            flagged.withColumns(hidden).drop("_mask"), curated, slices=touched, fmt=fmt, consumed=consumed
        )
    commits.remove(spark, path)
    return touched
