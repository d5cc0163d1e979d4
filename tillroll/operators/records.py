"""From log records to typed feed records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.functions import envelope as env
from tillroll.functions.scalar import money
from tillroll.schemas import (
    ADDRESS_FIELDS,
    LINE_FIELDS,
    PURCHASE_TEXT_FIELDS,
    TOPIC,
    TRANSACTION,
    TRANSACTION_TEXT_FIELDS,
    Feed,
)

# Log columns that later steps need: event time, position, the date and hour of the feed's file, and
# which record of which file it is.
CARRIED = ["timestamp", "offset", "feed_date", "feed_hour", "record_id"]
HEADERS = "array<struct<key:string,value:binary>>"


def no_headers() -> Column:
    return F.lit(None).cast(HEADERS)


def feed_headers(date: Column, hour: Column, record: Column | None = None) -> Column:
    """The date and hour of a feed's file as record headers, and the record's identity if known."""
    pairs = [("date", date), ("hour", hour), *([] if record is None else [("record", record)])]
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in pairs])


def record_identity(feed: Feed) -> Column:
    """The same for each publishing of one line of one feed file, and of no other line.

    Made of the file, the line's place in it and its text, so that equal lines remain two records.
    """
    return F.md5(F.concat_ws("\n", F.lit(feed.name), "file", "line", "value"))


def _header(name: str) -> Column:
    found = F.filter("headers", lambda h: h["key"] == name)
    return F.get(F.transform(found, lambda h: h["value"].cast("string")), F.lit(0))


def log_text(log: DataFrame) -> DataFrame:
    """Key and value as text; every other log column, the timestamp included, as it is."""
    return log.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


def with_feed_slice(log: DataFrame) -> DataFrame:
    """The date and hour of the feed's file and the record's identity, where headers hold them."""
    known = "headers" in log.columns
    none = F.lit(None).cast("string")
    carried = {"feed_date": "date", "feed_hour": "hour", "record_id": "record"}
    return log.withColumns({c: _header(n) if known else none for c, n in carried.items()})


def unknown_fields(record: Column, feed: Feed) -> Column:
    """The fields of a record's text that the feed does not declare, as JSON by name; null without any.

    Values stay as they are, nested ones whole. A text that is no JSON object, or names a field twice, has
    none: it is for the rejects to tell.
    """
    fields = F.try_variant_get(F.try_parse_json(record), "$", "map<string,variant>")
    declared = StructType.fromDDL(feed.fields).names
    others = F.map_filter(fields, lambda name, _: ~name.isin(*declared))
    # One use of each part, as an expression used twice is computed twice.
    return F.get(F.filter(F.array(F.to_json(others)), lambda text: text != "{}"), F.lit(0))


def decode_feed(
    log: DataFrame, feed: Feed, *, envelope: str = "json", unknown: bool = False
) -> DataFrame:
    """The feed's records, parsed and spread into columns.

    ``_corrupt`` holds the text of a record that is not quite what the feed declares. With ``unknown``,
    ``_unknown`` holds the fields that it does not declare.
    """
    value = F.col("value")
    record = F.coalesce(env.decode(value, envelope), value)
    texts, more = with_feed_slice(log_text(log)).where(F.col("key") == feed.key), []
    if unknown:  # made once each, whatever is selected or filtered later
        texts = texts.select("key", *CARRIED, F.explode(F.array(record)).alias("_record"))
        record, more = F.col("_record"), ["_unknown"]
        texts = texts.select("*", F.explode(F.array(unknown_fields(record, feed))).alias("_unknown"))
    parsed = F.from_json(
        record,
        f"{feed.fields}, _corrupt string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    one = F.array(parsed)
    # Spread by a generator, not by a projection: later filters cannot move below it, where
    # each would parse the record once more.
    one = F.transform(one, _reread) if feed is TRANSACTION else one
    return texts.select("key", *CARRIED, *more, F.inline(one))


def _reread(record: Column) -> Column:
    """A transaction with the nested parts of an irregular record read piece by piece.

    One parse takes a regular record whole. It gives up on an address, a basket or all its
    lines where one of them is JSON text inside JSON, or one line is no object. Those records
    are read again level by level, so that quoted parts count and a bad line costs only itself.
    """

    def basket(of: Column) -> Column:
        lines = F.transform(of["products"], lambda line: F.from_json(line, LINE_FIELDS))
        return F.struct(lines.alias("products"), of["total_cost"].alias("total_cost"))

    def parts(of: Column) -> Column:
        address = F.from_json(of["delivery_address"], ADDRESS_FIELDS)
        purchases = _once(F.from_json(of["purchases"], PURCHASE_TEXT_FIELDS), basket)
        return F.struct(address.alias("delivery_address"), purchases.alias("purchases"))

    def whole(nested: Column) -> Column:
        names = StructType.fromDDL(TRANSACTION.fields).names
        source = {c: nested if c in ("delivery_address", "purchases") else record for c in names}
        return F.struct(*[source[c][c].alias(c) for c in names], record["_corrupt"].alias("_corrupt"))

    text = F.from_json(record["_corrupt"], TRANSACTION_TEXT_FIELDS)
    as_parsed = F.struct(*[record[c].alias(c) for c in ("delivery_address", "purchases")])
    return _once(F.when(record["_corrupt"].isNull(), as_parsed).otherwise(_once(text, parts)), whole)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def transaction_lines(records: DataFrame, *, keep_empty: bool = False) -> DataFrame:
    """One row per basket line, nested parts spread, amounts exact.

    A basket without lines yields no row unless ``keep_empty``.
    """
    lines = line_texts(records, keep_empty=keep_empty)
    return lines.withColumns({c: money(F.col(c)) for c in ("total_cost", "total")})


def line_texts(records: DataFrame, *, keep_empty: bool = False) -> DataFrame:
    """The same with amounts as the text they came as."""
    one_line = F.explode_outer if keep_empty else F.explode
    baskets = records.select(
        "key",
        *CARRIED,
        "transaction_id",
        "transaction_time",
        "customer_id",
        "purchases.total_cost",
        "delivery_address.*",
        # By itself, as each line would carry all lines of its basket along otherwise.
        F.col("purchases.products").alias("_lines"),
    )
    kept = [c for c in baskets.columns if c != "_lines"]
    return baskets.select(*kept, one_line("_lines").alias("_line")).select(
        *kept,
        "_line.sku",
        F.coalesce("_line.quanitity", "_line.quantity").alias("quanitity"),
        "_line.price",
        "_line.total",
    )


def decode_transaction_lines(
    log: DataFrame, *, envelope: str = "json", keep_empty: bool = False
) -> DataFrame:
    """Transaction lines straight from the log."""
    records = decode_feed(log, TRANSACTION, envelope=envelope)
    return transaction_lines(records, keep_empty=keep_empty)


def routed(
    lines: DataFrame, feed: Feed, topic: str = TOPIC, *, time: Column | None = None
) -> DataFrame:
    """Raw lines (column ``value``) as log records, keyed and sent to the feed's partition.

    The ``date`` and ``hour`` of the lines' file travel as headers, so that records land there
    whenever they were published; so does the identity of numbered lines, by which a record that was
    published twice lands once. ``time`` sets the records' timestamp in a file-backed log; a broker
    sets its own.
    """
    placed = {"date", "hour"} <= set(lines.columns)
    record = record_identity(feed) if {"file", "line"} <= set(lines.columns) else None
    columns = [
        F.lit(topic).alias("topic"),
        F.lit(feed.key).cast("binary").alias("key"),
        env.encode(env.strip_quotes(F.col("value"))).cast("binary").alias("value"),
        F.lit(feed.partition).alias("partition"),
        (
            feed_headers(F.col("date"), F.col("hour"), record) if placed else no_headers()
        ).alias("headers"),
    ]
    if time is not None:
        columns.append(time.alias("timestamp"))
    return lines.select(*columns)
