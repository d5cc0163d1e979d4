"""Feeds and table schemas."""

from __future__ import annotations

from dataclasses import dataclass

TOPIC = "retail-feeds"  # unless the caller names another

# Feed file names, log keys and partitions, field names and their spelling
# ("quanitity" included). They must equal what the feeds carry, or nothing parses.
ERASURE_FIELDS = "`customer-id` string, email string"
PRODUCT_FIELDS = "sku string, name string, price string, category string, popularity string"
CUSTOMER_FIELDS = (
    "id string, first_name string, last_name string, email string, phone_number string, "
    "address string, city string, country string, postcode string, last_change string, "
    "segment string"
)
ADDRESS_FIELDS = "address string, postcode string, city string, country string"
LINE_FIELDS = "sku string, quanitity string, quantity string, price string, total string"
TRANSACTION_FIELDS = (
    "transaction_id string, transaction_time string, customer_id string, "
    f"delivery_address struct<{ADDRESS_FIELDS}>, "
    f"purchases struct<products: array<struct<{LINE_FIELDS}>>, total_cost: string>"
)
# The same record with its nested parts kept as text, to read irregular ones piece by piece.
TRANSACTION_TEXT_FIELDS = (
    "transaction_id string, transaction_time string, customer_id string, "
    "delivery_address string, purchases string"
)
PURCHASE_TEXT_FIELDS = "products array<string>, total_cost string"


def names(fields: str) -> list[str]:
    """Column names of a flat schema written as above."""
    return [field.split()[0].strip("`") for field in fields.split(", ")]


@dataclass(frozen=True)
class Feed:
    """One hourly feed: where it lies, how it is keyed in the log, what a record holds."""

    name: str
    file_name: str
    key: str
    partition: int
    fields: str
    hour: str | None = None  # daily feeds always land in this hour


ERASURE = Feed("erasure", "erasure.json.gz", "erasure", 0, ERASURE_FIELDS, "00")
PRODUCT = Feed("product", "products.json.gz", "product", 1, PRODUCT_FIELDS, "00")
CUSTOMER = Feed("customer", "customers.json.gz", "customer", 2, CUSTOMER_FIELDS)
TRANSACTION = Feed("transaction", "transactions.json.gz", "transaction", 3, TRANSACTION_FIELDS)
FEEDS = {f.name: f for f in (ERASURE, PRODUCT, CUSTOMER, TRANSACTION)}

MONEY = "decimal(30,2)"

# Log records, as the Kafka source delivers them.
LOG_FIELDS = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int, headers array<struct<key:string,value:binary>>"
)

LANDED_FIELDS = {
    "erasure": f"key string, {ERASURE_FIELDS}",
    "product": (
        "key string, sku string, name string, price double, category string, popularity float"
    ),
    "customer": f"key string, {CUSTOMER_FIELDS}, masked boolean",
    "transaction": (
        "key string, transaction_id string, transaction_time string, customer_id string, "
        f"total_cost {MONEY}, {ADDRESS_FIELDS}, sku string, quanitity string, price string, "
        f"total {MONEY}"
    ),
}
LANDED_PARTITIONS = "date string, hour string, batch string"

CURATED_COLUMNS = [
    "address", "city", "country", "email", "first_name", "id", "last_change", "last_name",
    "phone_number", "postcode", "segment", "quanitity", "total", "total_cost",
    "transaction_id", "transaction_time", "total_price", "category", "name", "popularity", "sku",
]
CURATED_FIELDS = ", ".join(
    f"{c} "
    + {
        "total": MONEY,
        "total_cost": MONEY,
        "total_price": "decimal(38,2)",
        "popularity": "float",
    }.get(c, "string")
    for c in CURATED_COLUMNS
)
CURATED_PARTITIONS = "year string, month string, date string, hour string"
