"""The four feeds, derived from the order-processing tables the queries run on.

Faults are planted as real feeds have them: malformed and negative prices, zero popularity,
repeated products, customers without id or phone, customers in two versions, a blank erasure
request, and baskets whose total is 1.00 too high.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup_join
from tillroll.schemas import MONEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _every(key: str, n: int, remainder: int = 0) -> Column:
    return F.col(key) % n == remainder


def _copies(rows: DataFrame, again: Column) -> DataFrame:
    """Each row once, and once more where ``again``; ``_copy`` numbers them."""
    return rows.withColumn(
        "_copy", F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _copies(table(spark, sf_dir, "part"), _every("p_partkey", 10))
    return part.select(
        _text("p_partkey").alias("sku"),
        F.col("p_name").alias("name"),
        F.when(_every("p_partkey", 97), "n/a")
        .when(_every("p_partkey", 89), "-1.00")
        .otherwise(_text(F.col("p_retailprice").cast("decimal(12,2)")))
        .alias("price"),
        F.col("p_type").alias("category"),
        F.when(_every("p_partkey", 83), "0").otherwise(_text("p_size")).alias("popularity"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _copies(table(spark, sf_dir, "customer"), _every("c_custkey", 4))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region")
    located = people.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    first = F.col("_copy") == 0
    return located.select(
        F.when(~_every("c_custkey", 101), _text("c_custkey")).alias("id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        _email(),
        F.when(
            ~_every("c_custkey", 7),
            F.concat(F.lit("07"), F.lpad(_text("c_custkey"), 9, "0")),
        ).alias("phone_number"),
        F.lit(None).cast("string").alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.lit(None).cast("string").alias("postcode"),
        F.when(first, "2020-01-01T00:00:00").otherwise("2020-01-01T12:00:00").alias("last_change"),
        F.when(first, F.col("c_mktsegment")).otherwise("MOVED").alias("segment"),
    )


def _email() -> Column:
    return F.concat(F.lit("c"), _text("c_custkey"), F.lit("@example.com")).alias("email")


def erasures(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").where(_every("c_custkey", 50, 3))
    blank = spark.range(1).select(
        F.lit(None).cast("string").alias("customer-id"), F.lit(None).cast("string").alias("email")
    )
    return people.select(_text("c_custkey").alias("customer-id"), _email()).unionByName(blank)


def bad_erasures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw requests that name no customer: some no JSON, some with a misspelt field."""
    people = table(spark, sf_dir, "customer")
    broken = people.where(_every("c_custkey", 50, 4)).select(
        F.concat(F.lit("no request of "), _text("c_custkey")).alias("value")
    )
    misspelt = people.where(_every("c_custkey", 50, 5)).select(
        F.to_json(F.struct(_text("c_custkey").alias("customer_id"), _email())).alias("value")
    )
    return broken.unionByName(misspelt)


def bad_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions of one line each: no sku, amounts that are none, no line, no JSON."""
    line = lines(spark, sf_dir)
    key = F.col("transaction_id").cast("bigint")
    sku = F.when(F.col("sku").cast("bigint") % 41 != 0, F.col("sku"))
    total = F.when(F.col("sku").cast("bigint") % 43 == 0, "abc").otherwise(_text("total"))
    cost = F.when(key % 47 == 0, "n/a").otherwise(_text("total_cost"))
    product = F.array(F.struct(sku.alias("sku"), "quanitity", "price", total.alias("total")))
    record = F.to_json(
        F.struct(
            "transaction_id", "transaction_time", "customer_id",
            F.struct(product.alias("products"), cost.alias("total_cost")).alias("purchases"),
        )
    )
    empty = F.to_json(
        F.struct(
            "transaction_id", F.struct(F.slice(product, 1, 0).alias("products")).alias("purchases")
        )
    )
    text = F.when(key % 53 == 0, empty).when(key % 59 == 0, F.concat(F.lit("{"), record))
    return line.select(text.otherwise(record).alias("value"))


def _sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a row number and their order's columns, the sum of its lines and their count.

    Line totals are summed per order before any line moves, so a large order is no large task.
    What takes long to work out of an order's columns is worked out here, not for each line.
    """
    item = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("l_quantity"),
        "l_extendedprice",
        # Numbered at the scan, where the order of rows is the same in a repeated task.
        F.monotonically_increasing_id().alias("_row"),
    )
    total = F.col("l_extendedprice").cast(MONEY)  # a number is half as wide while lines move
    sums = item.groupBy("l_orderkey").agg(
        F.sum(total).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    baskets = orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"))
    timed = baskets.withColumns(_time_and_cost()).drop("l_orderkey")
    sold = lookup_join(item, timed, {"l_orderkey": "o_orderkey"})
    return sold.withColumn("total", total).drop("l_extendedprice")


def _time_and_cost() -> dict[str, Column]:
    surplus = F.when(_every("l_orderkey", 20), 1).otherwise(0)
    return {
        "transaction_time": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        "total_cost": (F.col("_sum") + surplus).cast(MONEY),
    }


def _order_texts() -> list[Column]:
    """The columns that all lines of an order share, as a feed has them."""
    key = F.col("l_orderkey")
    return [
        _text(key).alias("transaction_id"),
        F.col("transaction_time"),
        _text("o_custkey").alias("customer_id"),
        F.col("total_cost"),
        F.concat(_text(key), F.lit(" High Street")).alias("address"),
        F.concat(F.lit("P"), _text(F.col("o_custkey") % 100)).alias("postcode"),
        F.col("o_orderpriority").alias("city"),
        F.col("o_orderstatus").alias("country"),
    ]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction lines as landed, with ``o_orderdate``, the basket's line count and a row number."""
    return _sold(spark, sf_dir).select(
        F.lit("transaction").alias("key"),
        *_order_texts(),
        _text("l_partkey").alias("sku"),
        _text("l_quantity").alias("quanitity"),
        _text("total").alias("price"),
        "total",
        "o_orderdate",
        "_n",
        "_row",
    )


def as_text(records: DataFrame) -> DataFrame:
    """Records as JSON lines, column ``value``."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))


def transaction_text(
    spark: SparkSession, sf_dir: str, *, lines_per_record: int = 16, quoted: bool = False
) -> DataFrame:
    """Nested transaction records as JSON lines.

    An order is one record of about ``lines_per_record`` lines at most; the lines of a larger
    one are dealt out to several records, so that no record or task has to hold it whole. Half
    of the lines spell the quantity field as the feed's schema does, half correctly. With
    ``quoted`` the nested parts are JSON text inside JSON.
    """
    basket = ["transaction_id", "transaction_time", "customer_id"]
    place = ["address", "postcode", "city", "country"]

    def product(sku: Column, quantity: Column, price: Column) -> Column:
        odd = sku % 2 == 1
        fields = F.struct(
            _text(sku).alias("sku"),
            F.when(~odd, _text(quantity)).alias("quanitity"),
            F.when(odd, _text(quantity)).alias("quantity"),
            price.alias("price"),
            price.alias("total"),
        )
        return F.to_json(fields) if quoted else fields

    sold = _sold(spark, sf_dir)
    part, quantity, price = F.col("l_partkey"), F.col("l_quantity"), _text("total")
    if lines_per_record == 1:
        products = F.array(product(part, quantity, price))
        grouped = sold.select(*_order_texts(), products.alias("products"))
    else:
        pieces = F.ceil(F.col("_n") / F.lit(lines_per_record)).cast("bigint")
        dealt = F.pmod(F.xxhash64("_row"), pieces)
        # What moves are the columns the texts are made of; those are made once a record, afterwards.
        columns = ["l_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "_sum"]
        gathered = (
            sold.withColumns(
                {
                    "_piece": F.when(pieces > 1, dealt).otherwise(F.lit(0)),
                    "o_orderdate": F.date_trunc("second", "o_orderdate"),  # as in the record
                }
            )
            .groupBy(*columns, "_piece")
            .agg(F.collect_list(F.struct(part, quantity, price.alias("price"))).alias("_bought"))
        )
        bought = F.transform("_bought", lambda b: product(b["l_partkey"], b["l_quantity"], b["price"]))
        timed = gathered.withColumns(_time_and_cost())
        grouped = timed.select(*_order_texts(), bought.alias("products"))
    address = F.struct(*place)
    purchases = F.struct("products", _text("total_cost").alias("total_cost"))
    if quoted:
        address, purchases = F.to_json(address), F.to_json(purchases)
    return as_text(
        grouped.select(
            *basket, address.alias("delivery_address"), purchases.alias("purchases")
        )
    )
