"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import envelope as env
from tillroll.operators import basket, customer, product, quality
from tillroll.operators.records import (
    decode_feed,
    decode_transaction_lines,
    line_texts,
    log_text,
    routed,
)
from tillroll.plans import sample_feeds as feeds
from tillroll.plans.curate import curate, curate_slice, enrich_lines
from tillroll.plans.erasure import erase_stored
from tillroll.plans.lineage import recurate_late
from tillroll.plans.snapshot import EVERYTHING, newest_until, write_snapshot
from tillroll.schemas import (
    CUSTOMER,
    ERASURE,
    FEEDS,
    LANDED_FIELDS,
    PRODUCT,
    TRANSACTION,
    Feed,
    names,
)
from tillroll.session import lean_writes, scratch_dir, use_rocksdb_state
from tillroll.sinks import commits
from tillroll.sinks.curated import write_curated
from tillroll.sinks.landed import compact_slice, land
from tillroll.sinks.log import as_log, stream_to_log_files, write_log_files
from tillroll.sources.files import feed_lines
from tillroll.sources.log import peek, read_log_files
from tillroll.sources.tables import read_curated, read_json, read_landed, read_landed_until
from tillroll.streaming.dedup import dedup_stream
from tillroll.streaming.feeds import (
    Landing,
    land_customers,
    land_erasures,
    land_products,
    land_rejects,
    land_transactions,
    start_landing,
    start_publishing,
    wait,
)
from tillroll.streaming.late import land_in_time
from tillroll.streaming.metrics import BatchLog
from tillroll.streaming.metrics import read_batches as read_metrics

LOG_TIME = "2020-01-01 10:15:00"
LINE = ["transaction_id", "customer_id", "sku", "quanitity", "total", "total_cost"]
CURATED_LINE = ["transaction_id", "transaction_time", *LINE[1:]]
LANDED_LINE = names(LANDED_FIELDS["transaction"])
CUSTOMER_COLUMNS = names(CUSTOMER.fields)
PRODUCT_COLUMNS = names(PRODUCT.fields)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The same rows, made once and read from a scratch table wherever they are used."""
    path = scratch_dir(spark, "stored")
    with lean_writes(spark):
        rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def _kept(spark: SparkSession, rows: DataFrame) -> Iterator[DataFrame]:
    """The same for as long as they are needed."""
    path = scratch_dir(spark, "kept")
    try:
        with lean_writes(spark):
            rows.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        commits.remove(spark, path)


def _raw(spark: SparkSession, sf: str, feed: Feed, **options) -> DataFrame:
    """The feed's raw lines."""
    if feed is TRANSACTION:
        return feeds.transaction_text(spark, sf, **options)
    records = {
        "erasure": feeds.erasures,
        "product": feeds.products,
        "customer": feeds.customers,
    }[feed.name]
    return feeds.as_text(records(spark, sf))


def _as_log(raw: DataFrame, feed: Feed) -> DataFrame:
    return as_log(routed(raw, feed, time=F.lit(LOG_TIME).cast("timestamp")))


def _log(spark: SparkSession, sf: str, feed: Feed, **options) -> DataFrame:
    """The feed's records in the shape of the log."""
    return _as_log(_raw(spark, sf, feed, **options), feed)


def _clean_customers(spark: SparkSession, sf: str) -> DataFrame:
    known = customer.known_customers(feeds.customers(spark, sf))
    requests = customer.erasure_requests(feeds.erasures(spark, sf))
    return customer.erase_customers(known, requests)


def _clean_products(spark: SparkSession, sf: str) -> DataFrame:
    return product.clean_products(feeds.products(spark, sf))


def _with_day(lines: DataFrame) -> DataFrame:
    # The time is text already; its date part is cheaper to cut off than to write again.
    return lines.withColumn("day", F.substring_index("transaction_time", "T", 1))


# --- envelope, log and files ---------------------------------------------------------------


def envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, with all their quotes, line breaks and scripts, in and out again."""
    documents = feeds.table(spark, sf, "documents").select("doc_id", "text")
    back = env.decode(env.encode(F.to_json(F.struct("doc_id", "text"))))
    record = documents.select(F.from_json(back, "doc_id bigint, text string").alias("r"))
    return record.select(
        "r.doc_id",
        F.length("r.text").cast("bigint").alias("n_chars"),
        F.md5("r.text").alias("text_md5"),
    )


def envelope_roundtrip_regex(spark: SparkSession, sf: str) -> DataFrame:
    """Plain customer records through the lenient decoder."""
    log = _log(spark, sf, CUSTOMER)
    return decode_feed(log, CUSTOMER, envelope="regex").select("key", *CUSTOMER_COLUMNS)


def feed_route(spark: SparkSession, sf: str) -> DataFrame:
    """All four feeds published, counted by key and partition."""
    logs = [_log(spark, sf, f, lines_per_record=1) for f in FEEDS.values()]
    return log_text(_union(logs)).groupBy("key", "partition").agg(F.count(F.lit(1)).alias("n"))


def _write_feed_hour(lines: DataFrame, root: str, feed: Feed, hour: str) -> None:
    path = f"{root}/date=2020-01-01/hour={hour}/{feed.file_name}"
    with lean_writes(lines.sparkSession):
        lines.select("value").write.option("compression", "gzip").text(path)


def feed_gz_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All lines written as gzip files of two hours, and found again by feed, date and hour."""
    root = scratch_dir(spark, "feeds")
    field = {
        "erasure": "customer-id",
        "product": "sku",
        "customer": "email",
        "transaction": "transaction_id",
    }
    for feed in FEEDS.values():
        raw = _raw(spark, sf, feed, lines_per_record=1)
        width = F.length(F.get_json_object("value", f"$['{field[feed.name]}']"))
        late = F.coalesce(width % 2 == 0, F.lit(False))
        raw = _stored(spark, raw.select("value"))
        _write_feed_hour(raw.where(late), root, feed, "10")
        _write_feed_hour(raw.where(~late), root, feed, "00")
    scans = [
        feed_lines(spark, root, f).select(F.lit(f.name).alias("feed"), "date", "hour")
        for f in FEEDS.values()
    ]
    return _union(scans).groupBy("feed", "date", "hour").agg(F.count(F.lit(1)).alias("n"))


def topic_peek(spark: SparkSession, sf: str) -> DataFrame:
    """The first 20 records of a log made of the events table."""
    events = feeds.table(spark, sf, "events").select(
        F.col("event_type").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return peek(events, 20)


# --- batch transforms ------------------------------------------------------------------------


def transaction_lines(spark: SparkSession, sf: str) -> DataFrame:
    """From enveloped nested records to typed lines."""
    return decode_transaction_lines(_log(spark, sf, TRANSACTION)).select(*LANDED_LINE)


def transaction_lines_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """The same where the nested parts are JSON text inside JSON."""
    log = _log(spark, sf, TRANSACTION, quoted=True)
    return decode_transaction_lines(log).select(*LANDED_LINE)


def transaction_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Records of one line each, some with fields that no feed declares, which are kept whole."""
    raw = _raw(spark, sf, TRANSACTION, lines_per_record=1)
    raw = raw.withColumn("_id", F.get_json_object("value", "$.transaction_id"))
    key = F.col("_id")
    number = key.cast("bigint")
    coupon = F.when(number % 5 == 0, F.format_string('"coupon":{"code":"C%s","cents":[1,%s]},', key, key))
    note = F.when(number % 3 == 0, F.lit('"note":"thanks, \\"bye\\"",'))
    added = F.concat(F.lit("{"), F.coalesce(note, F.lit("")), F.coalesce(coupon, F.lit("")))
    value = F.concat(added, F.substring("value", 2, 1 << 30))
    made = raw.select(F.explode(F.array(value)).alias("value"))  # made once, not wherever it is used
    records = decode_feed(_as_log(made, TRANSACTION), TRANSACTION, unknown=True)
    return records.where("_unknown is not null and _corrupt is null").select(
        "transaction_id", "customer_id", F.col("_unknown").alias("unknown")
    )


def product_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _clean_products(spark, sf)


def product_rejected(spark: SparkSession, sf: str) -> DataFrame:
    records = decode_feed(_log(spark, sf, PRODUCT), PRODUCT)
    return quality.rejected(records, "product").select(*PRODUCT_COLUMNS, "reason")


def customer_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return customer.known_customers(feeds.customers(spark, sf))


def customer_erased(spark: SparkSession, sf: str) -> DataFrame:
    return _clean_customers(spark, sf)


def customer_erased_salted(spark: SparkSession, sf: str) -> DataFrame:
    """Salted hashes, and the name hidden too."""
    known = customer.known_customers(feeds.customers(spark, sf))
    requests = customer.erasure_requests(feeds.erasures(spark, sf))
    columns = ("email", "phone_number", "last_name")
    return customer.erase_customers(known, requests, columns=columns, salt="pepper")


def customer_erased_murmur3(spark: SparkSession, sf: str) -> DataFrame:
    """Which fields the 32-bit hash has masked; the hash itself is checked in tests."""
    known = customer.known_customers(feeds.customers(spark, sf))
    requests = customer.erasure_requests(feeds.erasures(spark, sf))
    clear = known.withColumns({"_email": F.col("email"), "_phone": F.col("phone_number")})
    hidden = customer.erase_customers(clear, requests, method="murmur3", mark=True)
    number = F.coalesce(F.col("email").rlike("^-?[0-9]+$"), F.lit(False))
    return hidden.select(
        *[c for c in CUSTOMER_COLUMNS if c not in ("email", "phone_number")],
        F.col("_email").alias("email"),
        F.col("_phone").alias("phone_number"),
        (F.col("masked") & number).alias("masked"),
        F.coalesce(F.col("phone_number") == "42", F.lit(False)).alias("null_is_42"),
    )


def customer_latest(spark: SparkSession, sf: str) -> DataFrame:
    return customer.latest_customers(_clean_customers(spark, sf))


def customer_latest_until(spark: SparkSession, sf: str) -> DataFrame:
    """First versions landed at 09 and 11, second ones at 10: the newest as of 10."""
    root = scratch_dir(spark, "landed")
    second = F.col("last_change") > "2020-01-01T06"
    hour = F.when(second, "10").when(F.col("phone_number").isNull(), "11").otherwise("09")
    rows = _clean_customers(spark, sf).withColumns(
        {"key": F.lit("customer"), "date": F.lit("2020-01-01"), "hour": hour}
    )
    land(rows, root, "customer", "b0")
    upto = read_landed_until(spark, root, "customer", date="2020-01-01", hour="10")
    return customer.latest_customers(upto).select(*CUSTOMER_COLUMNS)


def erasure_land(spark: SparkSession, sf: str) -> DataFrame:
    """The erasure list written as JSON and read with its declared schema."""
    path = scratch_dir(spark, "erasure")
    feeds.erasures(spark, sf).write.json(path)
    return customer.erasure_requests(read_json(spark, path, ERASURE.fields))


def feed_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Records and rejects per feed, with bad requests and transactions among them."""
    bad = {
        "erasure": feeds.bad_erasures(spark, sf),
        "transaction": feeds.bad_transactions(spark, sf),
    }
    counts = []
    for f in FEEDS.values():
        log = _log(spark, sf, f)
        if f.name in bad:
            log = log.unionByName(_as_log(bad[f.name], f))
        counts.append(quality.feed_counts(decode_feed(log, f), f.name))
    return _union(counts).groupBy("feed").agg(
        F.sum("records").alias("records"), F.sum("rejected").alias("rejected")
    )


def erasure_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Requests that name nobody are kept with the reason, not lost."""
    raw = _raw(spark, sf, ERASURE).unionByName(feeds.bad_erasures(spark, sf))
    bad = quality.rejected(decode_feed(_as_log(raw, ERASURE), ERASURE), "erasure")
    return bad.select(F.col("customer-id").alias("customer_id"), "email", "reason")


def line_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Lines without sku or with amounts that are none."""
    records = decode_feed(_as_log(feeds.bad_transactions(spark, sf), TRANSACTION), TRANSACTION)
    bad = quality.rejected(line_texts(records), "line")
    return bad.select("transaction_id", "sku", "total", "total_cost", "reason")


def basket_running_total(spark: SparkSession, sf: str) -> DataFrame:
    lines = feeds.lines(spark, sf).select(*LINE)
    return basket.with_running_total(lines).select(*LINE, "total_price")


def basket_running_total_by_day(spark: SparkSession, sf: str) -> DataFrame:
    lines = _with_day(feeds.lines(spark, sf)).select("day", *LINE)
    totals = basket.with_running_total(lines, ["day", "customer_id"])
    return totals.select("day", *LINE, "total_price")


def basket_total(spark: SparkSession, sf: str) -> DataFrame:
    lines = feeds.lines(spark, sf).select(*LINE)
    return basket.with_basket_total(lines).select(*LINE, "total_price")


def line_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_lines(feeds.lines(spark, sf).select(*LINE), _clean_products(spark, sf))


# --- curated ---------------------------------------------------------------------------------


def curated_running(spark: SparkSession, sf: str) -> DataFrame:
    """The curated table of one slice that holds everything."""
    return curate(
        feeds.lines(spark, sf), _clean_products(spark, sf), _clean_customers(spark, sf)
    )


def curated_running_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return curate(
        _with_day(feeds.lines(spark, sf)),
        _clean_products(spark, sf),
        _clean_customers(spark, sf),
        slices=["day"],
    )


def curated_per_transaction(spark: SparkSession, sf: str) -> DataFrame:
    return curate(
        _stored(spark, feeds.lines(spark, sf).select(*CURATED_LINE)),
        _clean_products(spark, sf),
        _clean_customers(spark, sf),
        mode="per_transaction",
    )


def _quarter_slices(lines: DataFrame) -> DataFrame:
    quarter = F.date_trunc("quarter", "o_orderdate")
    return lines.withColumns(
        {
            "date": F.date_format(quarter, "yyyy-MM-dd"),
            "hour": F.lpad((F.col("transaction_id").cast("bigint") % 2).cast("string"), 2, "0"),
        }
    )


def curated_slice_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Two slices per quarter, curated and stored twice: the table holds them once."""
    root = scratch_dir(spark, "curated")
    lines = _quarter_slices(feeds.lines(spark, sf)).select("date", "hour", *CURATED_LINE)
    rows = curate(
        _stored(spark, lines),
        _clean_products(spark, sf),
        _clean_customers(spark, sf),
        slices=["date", "hour"],
    )
    for _ in range(2):
        # Kept in files first: what curating shuffles is gone before rows move by slice.
        with _kept(spark, rows) as curated:
            write_curated(curated, root)
    return read_curated(spark, root)


def _landed_day(spark: SparkSession, sf: str, root: str, lines: DataFrame, date: str) -> None:
    """One hour of one day landed: transaction lines, and all customers."""
    slice_of = {"date": F.lit(date), "hour": F.lit("10")}
    # Of one slice, and in parts of a sensible size already: no need to move them.
    land(lines.select(*LANDED_LINE).withColumns(slice_of), root, "transaction", "b0", spread=False)
    people = _clean_customers(spark, sf).withColumns(slice_of | {"key": F.lit("customer")})
    land(people, root, "customer", "b0")


def _landed_products(spark: SparkSession, sf: str, root: str, date: str) -> None:
    slice_of = {"date": F.lit(date), "hour": F.lit("00"), "key": F.lit("product")}
    land(_clean_products(spark, sf).withColumns(slice_of), root, "product", "b0")


def curated_missing_input(spark: SparkSession, sf: str) -> DataFrame:
    """A run against folders that do not exist fails, and the curated slice stays as it was."""
    root = scratch_dir(spark, "missing")
    _landed_products(spark, sf, root, "2020-01-01")
    _landed_day(spark, sf, root, feeds.lines(spark, sf), "2020-01-01")
    curate_slice(spark, root, f"{root}/curated", "2020-01-01", "10")
    for tables, hour in ((f"{root}/nowhere", "10"), (root, "11")):
        try:
            curate_slice(spark, tables, f"{root}/curated", "2020-01-01", hour)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            raise AssertionError("a run without input went through")
    return read_curated(spark, f"{root}/curated")


def _land_in_halves(spark: SparkSession, rows: DataFrame, root: str, table: str, late: Column) -> None:
    """All rows in one slice; those that are late in a batch that lands after a snapshot of it."""
    slice_of = {"date": F.lit("2020-01-01"), "hour": F.lit("00"), "key": F.lit(table)}
    late = F.coalesce(late, F.lit(False))
    for batch, part in ((0, rows.where(~late)), (1, rows.where(late))):
        land(part.withColumns(slice_of), root, table, f"query-{batch}")
        if not batch:
            write_snapshot(spark, root, f"{root}/snapshots", table, "2020-01-01", "10")


def snapshot_late_product(spark: SparkSession, sf: str) -> DataFrame:
    """Every third product lands after the snapshot, in a slice before it: the next day has all."""
    root = scratch_dir(spark, "late")
    late = F.col("sku").cast("bigint") % 3 == 0
    _land_in_halves(spark, _clean_products(spark, sf), root, "product", late)
    write_snapshot(spark, root, f"{root}/snapshots", "product", "2020-01-02", "10")
    return newest_until(spark, root, f"{root}/snapshots", "product", "2020-01-03", "00").select(
        *PRODUCT_COLUMNS
    )


def snapshot_late_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Second versions of customers, and some of the first, land after the snapshot of their slice."""
    root = scratch_dir(spark, "late")
    late = (F.col("last_change") > "2020-01-01T06") | F.col("phone_number").isNull()
    _land_in_halves(spark, _clean_customers(spark, sf), root, "customer", late)
    return newest_until(spark, root, f"{root}/snapshots", "customer", "2020-01-02", "10").select(
        *CUSTOMER_COLUMNS
    )


def snapshot_late_erasure(spark: SparkSession, sf: str) -> DataFrame:
    """Requests that land after the snapshot of their slice are honoured like those before it."""
    root = scratch_dir(spark, "late")
    late = F.col("customer-id").cast("bigint") % 4 == 3
    _land_in_halves(spark, feeds.erasures(spark, sf), root, "erasure", late)
    asked = newest_until(spark, root, f"{root}/snapshots", "erasure", *EVERYTHING)
    known = customer.known_customers(feeds.customers(spark, sf))
    return customer.erase_customers(known, customer.erasure_requests(asked))


def curated_second_day(spark: SparkSession, sf: str) -> DataFrame:
    """Products land on the first day only, some of them after its first snapshot; lines of the second
    day find all of them in snapshots."""
    root = scratch_dir(spark, "days")
    lines = _stored(spark, feeds.lines(spark, sf).select(*LANDED_LINE))
    odd = F.col("transaction_id").cast("bigint") % 2 == 1
    late = F.col("sku").cast("bigint") % 3 == 0
    _land_in_halves(spark, _clean_products(spark, sf), root, "product", late)
    for date, part in (("2020-01-01", lines.where(odd)), ("2020-01-02", lines.where(~odd))):
        _landed_day(spark, sf, root, part, date)
        curate_slice(
            spark, root, f"{root}/curated", date, "10", snapshots=f"{root}/snapshots"
        )
        write_snapshot(spark, root, f"{root}/snapshots", "product", date, "10")
    return read_curated(spark, f"{root}/curated")


def curated_late_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Half of an hour's lines, and every third product, land after the hour was curated."""
    root = scratch_dir(spark, "late")
    lines = _stored(spark, feeds.lines(spark, sf).select(*LANDED_LINE))
    slice_of = {"date": F.lit("2020-01-01"), "hour": F.lit("10")}
    goods = _clean_products(spark, sf).withColumns(slice_of | {"hour": F.lit("00"), "key": F.lit("product")})
    _landed_day(spark, sf, root, lines.where("false"), "2020-01-01")
    odd = F.col("transaction_id").cast("bigint") % 2 == 1
    third = F.col("sku").cast("bigint") % 3 == 0
    for batch, (some, sold) in enumerate(((~third, odd), (third, ~odd))):
        land(goods.where(some), root, "product", f"products-{batch}")
        land(lines.where(sold).withColumns(slice_of), root, "transaction", f"lines-{batch}")
        if batch:
            found = recurate_late(spark, root, f"{root}/curated")
            assert found == [("2020-01-01", "10")] and not recurate_late(spark, root, f"{root}/curated")
        else:
            curate_slice(spark, root, f"{root}/curated", "2020-01-01", "10")
    return read_curated(spark, f"{root}/curated")


def curated_erased_late(spark: SparkSession, sf: str) -> DataFrame:
    """Customers land unmasked, their requests after them; curating masks them, once."""
    root = scratch_dir(spark, "late")
    _landed_products(spark, sf, root, "2020-01-01")
    slice_of = {"date": F.lit("2020-01-01"), "hour": F.lit("10")}
    lines = feeds.lines(spark, sf).select(*LANDED_LINE).withColumns(slice_of)
    land(lines, root, "transaction", "b0", spread=False)  # as in _landed_day
    requests = customer.erasure_requests(feeds.erasures(spark, sf))
    early = F.col("customer_id").cast("bigint") % 4 == 3  # these are masked when they land
    people = customer.erase_customers(
        customer.known_customers(feeds.customers(spark, sf)), requests.where(early), mark=True
    )
    land(people.withColumns(slice_of | {"key": F.lit("customer")}), root, "customer", "b0")
    asked = feeds.erasures(spark, sf).withColumns(
        {"date": F.lit("2020-01-01"), "hour": F.lit("00"), "key": F.lit("erasure")}
    )
    land(asked, root, "erasure", "b0")
    curate_slice(spark, root, f"{root}/curated", "2020-01-01", "10")
    return read_curated(spark, f"{root}/curated")


def erasure_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Customers are landed and curated in the clear; then their requests land, and reach back."""
    root = scratch_dir(spark, "backfill")
    _landed_products(spark, sf, root, "2020-01-01")
    slice_of = {"date": F.lit("2020-01-01"), "hour": F.lit("10")}
    lines = feeds.lines(spark, sf).select(*LANDED_LINE).withColumns(slice_of)
    land(lines, root, "transaction", "lines-0", spread=False)  # as in _landed_day
    people = customer.known_customers(feeds.customers(spark, sf)).withColumns(
        slice_of | {"key": F.lit("customer"), "masked": F.lit(False)}
    )
    land(people, root, "customer", "people-0")
    asked = feeds.erasures(spark, sf).withColumns(slice_of | {"key": F.lit("erasure")})
    early = F.col("customer-id").cast("bigint") % 4 == 3  # these go in when the hour is curated
    land(asked.where(early), root, "erasure", "asked-0")
    curate_slice(spark, root, f"{root}/curated", "2020-01-01", "10")
    land(asked.where(~early), root, "erasure", "asked-1")
    for _ in range(2):  # a second run changes nothing
        erase_stored(spark, root, f"{root}/curated", f"{root}/index")
    landed = customer.latest_customers(read_landed(spark, root, "customer"))
    kept = landed.select("id", F.col("email").alias("_email"), F.col("phone_number").alias("_phone"))
    rows = read_curated(spark, f"{root}/curated").join(kept, "id")
    return rows.where("email = _email and phone_number <=> _phone").drop("_email", "_phone")


def landed_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Lines landed by many small batches, copied into few files."""
    root = scratch_dir(spark, "compacted")
    lines = _stored(spark, feeds.lines(spark, sf).select(*LANDED_LINE))
    rows = lines.withColumns({"date": F.lit("2020-01-01"), "hour": F.lit("10")})
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(4))
    for batch in range(4):
        land(rows.where(part == batch), root, "transaction", f"b{batch}", target_files=3)
    compact_slice(spark, root, f"{root}/compacted", "transaction", "2020-01-01", "10")
    return read_landed(spark, f"{root}/compacted", "transaction").select(*LANDED_LINE)


# --- streams ---------------------------------------------------------------------------------


def _landing(spark: SparkSession, purpose: str) -> Landing:
    root = scratch_dir(spark, purpose)
    return Landing(tables=f"{root}/tables", checkpoints=f"{root}/checkpoints", once=True)


def _log_files(spark: SparkSession, sf: str, feed: Feed, batch: int = 0, path: str = "") -> str:
    path = path or scratch_dir(spark, "log")
    write_log_files(_log(spark, sf, feed), path, batch)
    return path


def _files_per_trigger(spark: SparkSession, log: str, batches: int = 8) -> int:
    """How many of a log's files make a micro-batch, so that it takes that many batches at most.

    One for a small log. A batch of one file would be one task, and a large log has hundreds of files.
    """
    n = len(read_log_files(spark, log, streaming=False).inputFiles())
    return max(1, -(-n // batches))


def stream_product_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The product feed published twice; each sku lands once, also over a restart."""
    to = _landing(spark, "products")
    log = ""
    for batch in range(2):
        log = _log_files(spark, sf, PRODUCT, batch, log)
        land_products(read_log_files(spark, log, [PRODUCT.partition]), to).awaitTermination()
    return read_landed(spark, to.tables, "product").select(*PRODUCT_COLUMNS)


def stream_product_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The product feed published twice, the second time with new names of every third sku; these land
    again, as do none of the others, also over a restart."""
    to = replace(_landing(spark, "changes"), product_dedup="changes")
    raw = feeds.products(spark, sf)
    third = F.col("sku").cast("bigint") % 3 == 0
    new = raw.withColumn("name", F.when(third, F.concat("name", F.lit(" (new)"))).otherwise(F.col("name")))
    log, provider = scratch_dir(spark, "log"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    use_rocksdb_state(spark)
    try:
        for batch, records in enumerate((raw, new)):
            write_log_files(_as_log(feeds.as_text(records), PRODUCT), log, batch)
            land_products(read_log_files(spark, log, [PRODUCT.partition]), to).awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return read_landed(spark, to.tables, "product").select(*PRODUCT_COLUMNS)


def stream_event_dedup_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Events arriving in three spans of time, every one twice, unique within the watermark.

    Events without a time come first, when there is no watermark yet that they could miss.
    """
    root = scratch_dir(spark, "events")
    source = feeds.table(spark, sf, "events")
    first, last = source.agg(F.min("ts"), F.max("ts")).first()
    third = (last - first) / 3
    cuts = [F.lit(str(first + i * third)).cast("timestamp_ntz") for i in (1, 2)]
    ts = F.col("ts")
    spans = [F.coalesce(ts < cuts[0], F.lit(True)), (ts >= cuts[0]) & (ts < cuts[1]), ts >= cuts[1]]
    for span in spans:
        events = source.where(span).withColumn("ts", ts.cast("timestamp"))
        events.unionByName(events).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        unique = dedup_stream(stream, "event_id", "within_watermark", time="ts")
        (
            unique.writeStream.option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{root}/out")
            .awaitTermination()
        )
    unique = spark.read.schema(events.schema).parquet(f"{root}/out")
    return unique.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream_transaction_land(spark: SparkSession, sf: str) -> DataFrame:
    to = _landing(spark, "transactions")
    log = read_log_files(spark, _log_files(spark, sf, TRANSACTION), [TRANSACTION.partition])
    land_transactions(log, to).awaitTermination()
    landed = read_landed(spark, to.tables, "transaction")
    return landed.select(*LANDED_LINE, "date", "hour")


def stream_transaction_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """The feed files published twice, as a sink that retries does; each record lands once."""
    root = scratch_dir(spark, "replayed")
    to = Landing(tables=f"{root}/tables", checkpoints=f"{root}/checkpoints", once=True)
    _write_feed_hour(_raw(spark, sf, TRANSACTION), f"{root}/feeds", TRANSACTION, "10")
    for time in range(2):
        lines = feed_lines(spark, f"{root}/feeds", TRANSACTION, numbered=True)
        write_log_files(as_log(routed(lines, TRANSACTION)), f"{root}/log", time)
        log = read_log_files(spark, f"{root}/log", [TRANSACTION.partition])
        land_transactions(log, to).awaitTermination()
    return read_landed(spark, to.tables, "transaction").select(*LANDED_LINE)


def stream_customer_erased(spark: SparkSession, sf: str) -> DataFrame:
    """Customers anonymised by the erasure requests landed before them."""
    to = _landing(spark, "customers")
    for feed, start in ((ERASURE, land_erasures), (CUSTOMER, land_customers)):
        log = read_log_files(spark, _log_files(spark, sf, feed), [feed.partition])
        start(log, to).awaitTermination()
    return read_landed(spark, to.tables, "customer").select(*CUSTOMER_COLUMNS)


def stream_product_rejects(spark: SparkSession, sf: str) -> DataFrame:
    to = _landing(spark, "rejects")
    log = read_log_files(spark, _log_files(spark, sf, PRODUCT), [PRODUCT.partition])
    land_rejects(log, PRODUCT, to).awaitTermination()
    return spark.read.parquet(f"{to.tables}/rejected_product").select(*PRODUCT_COLUMNS, "reason")


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events, each twice, the last third of their time first: what has become of every row."""
    to = _landing(spark, "events")
    source = feeds.table(spark, sf, "events")
    first, last = source.agg(F.min("ts"), F.max("ts")).first()
    cut = F.lit(str(first + 2 * (last - first) / 3)).cast("timestamp_ntz")
    early = F.coalesce(F.col("ts") < cut, F.lit(False))
    for part in (source.where(~early), source.where(early)):
        events = part.withColumn("ts", F.col("ts").cast("timestamp"))
        events.unionByName(events).write.mode("append").parquet(f"{to.tables}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{to.tables}/in")
        land_in_time(stream, to, "event", "event_id", "ts").awaitTermination()
    fates = []
    for fate in ("event", "late_event"):
        rows = spark.read.parquet(f"{to.tables}/{fate}")
        fates.append(rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("fate", F.lit(fate)))
    sums = spark.read.json(f"{to.tables}/_fates/event").agg(
        F.sum("repeated").alias("n"), F.sum("seen").alias("seen"), F.sum(F.expr("landed + late + repeated")).alias("all")
    )
    repeated = sums.where("seen = all").select(F.lit(None).cast("string").alias("event_type"), "n", F.lit("repeated").alias("fate"))
    return _union([*fates, repeated]).select("event_type", "fate", "n")


def batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """All feeds landed, bad requests and transactions among them, and what the batches saw read back."""
    to = _landing(spark, "metrics")
    bad = {"erasure": feeds.bad_erasures, "transaction": feeds.bad_transactions}
    starts = {
        "erasure": land_erasures, "product": land_products, "transaction": land_transactions,
        "customer": land_customers,
    }
    with BatchLog(spark, f"{to.tables}/_batches") as batches:
        for name, start in starts.items():
            feed, log = FEEDS[name], _log_files(spark, sf, FEEDS[name])
            if name in bad:
                write_log_files(_as_log(bad[name](spark, sf), feed), log, 1)
            some = _files_per_trigger(spark, log)
            query = start(read_log_files(spark, log, [feed.partition], max_files_per_trigger=some), to)
            query.awaitTermination()
            batches.settle([query])
    seen = read_metrics(spark, f"{to.tables}/_batches")
    return seen.groupBy("feed").agg(F.sum("records").alias("records"), F.sum("rejected").alias("rejected"))


def feeds_to_curated(spark: SparkSession, sf: str) -> DataFrame:
    """Everything: gzip files, the log, landed tables, the curated table of one hour."""
    root = scratch_dir(spark, "all")
    to = Landing(tables=f"{root}/landed", checkpoints=f"{root}/checkpoints", once=True)
    for feed in FEEDS.values():
        _write_feed_hour(_raw(spark, sf, feed), f"{root}/feeds", feed, feed.hour or "10")
    publishing = start_publishing(
        spark,
        f"{root}/feeds",
        lambda records, feed: stream_to_log_files(
            records, f"{root}/log/{feed.name}", f"{root}/checkpoints/publish-{feed.name}"
        ),
    )
    wait(spark, publishing.values(), once=True)
    landing = start_landing(
        lambda f: read_log_files(spark, f"{root}/log/{f.name}", [f.partition]), to
    )
    wait(spark, landing.values(), once=True)
    curate_slice(spark, to.tables, f"{root}/curated", "2020-01-01", "10")
    return read_curated(spark, f"{root}/curated")


QUERIES = {
    f.__name__: f
    for f in (
        envelope_roundtrip,
        envelope_roundtrip_regex,
        feed_route,
        feed_gz_scan,
        topic_peek,
        transaction_lines,
        transaction_lines_quoted,
        transaction_unknown_fields,
        product_clean,
        product_rejected,
        customer_not_null,
        customer_erased,
        customer_erased_salted,
        customer_erased_murmur3,
        customer_latest,
        customer_latest_until,
        erasure_land,
        erasure_rejected,
        line_rejected,
        feed_quality,
        basket_running_total,
        basket_running_total_by_day,
        basket_total,
        line_enriched,
        curated_running,
        curated_running_by_day,
        curated_per_transaction,
        curated_slice_rewrite,
        curated_missing_input,
        curated_second_day,
        snapshot_late_product,
        snapshot_late_customer,
        snapshot_late_erasure,
        curated_late_lines,
        curated_erased_late,
        erasure_backfill,
        landed_compacted,
        stream_product_dedup,
        stream_product_changes,
        stream_event_dedup_watermark,
        stream_transaction_land,
        stream_transaction_replayed,
        stream_customer_erased,
        stream_product_rejects,
        stream_late_rows,
        batch_metrics,
        feeds_to_curated,
    )
}
