"""Steps whose cost must grow with the input alone: what they shuffle, and how often they compute."""

import json
import re

import pytest
from pyspark.sql import functions as F

from tillroll.functions import envelope as env
from tillroll.operators.basket import running_totals
from tillroll.operators.records import decode_feed, decode_transaction_lines, routed
from tillroll.plans import catalogue
from tillroll.plans.curate import curate
from tillroll.plans.sample_feeds import transaction_text
from tillroll.schemas import TRANSACTION
from tillroll.sinks import landed
from tillroll.sinks.landed import compact_slice, land, unlanded
from tillroll.sinks.log import as_log, write_log_files
from tillroll.sources.tables import read_landed
from tillroll.streaming.feeds import Landing, land_transactions


def records(spark, ids):
    """Decoded records of one hour with these identities."""
    rows = [(i, n, "2020-01-01", "10", rid) for n, (i, rid) in enumerate(ids)]
    fields = "transaction_id string, offset bigint, feed_date string, feed_hour string, record_id string"
    return spark.createDataFrame(rows, fields).withColumn("timestamp", F.lit("2020-01-01").cast("timestamp"))


def kept(rows):
    return sorted(r.transaction_id for r in rows.collect())


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_records_that_are_all_new_or_all_known_do_not_move(spark, tmp_path):
    batch = records(spark, [("a", "1"), ("b", "2"), ("c", None)])
    first = unlanded(batch, str(tmp_path), "transaction", "q-0")
    assert kept(first) == ["a", "b", "c"] and "Exchange" not in plan(first)
    again = unlanded(batch, str(tmp_path), "transaction", "q-1")
    assert kept(again) == ["c"] and "Exchange" not in plan(again)


def test_records_of_which_some_are_known_or_come_twice(spark, tmp_path):
    unlanded(records(spark, [("a", "1")]), str(tmp_path), "transaction", "q-0")
    mixed = records(spark, [("a", "1"), ("b", "2"), ("b", "2"), ("c", None), ("c", None), ("d", "4")])
    for _ in range(2):  # the same batch once more finds the same
        got = unlanded(mixed, str(tmp_path), "transaction", "q-1")
        assert kept(got) == ["b", "c", "c", "d"]
        assert got.columns == mixed.columns


def test_compacting_moves_no_rows_and_makes_files_of_a_size(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).select(
        F.lit("transaction").alias("key"), F.col("id").cast("string").alias("transaction_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("address"),
        F.lit("2020-01-01").alias("date"), F.lit("10").alias("hour"),
    )
    spreads = []
    real = landed.land
    monkeypatch.setattr(
        landed, "land", lambda r, *a, **o: (spreads.append((plan(r), o.get("spread"))), real(r, *a, **o))[1]
    )
    for n in range(3):
        land(rows.where(F.col("transaction_id").cast("int") % 3 == n), str(tmp_path), "transaction", f"q-{n}")
    for size in (1 << 30, 1):
        monkeypatch.setattr(landed, "FILE_BYTES", size)
        compact_slice(spark, str(tmp_path), f"{tmp_path}/to{size}", "transaction", "2020-01-01", "10")
        got = read_landed(spark, f"{tmp_path}/to{size}", "transaction")
        assert got.select("transaction_id").distinct().count() == got.count() == 4000
        files = len(got.inputFiles())
        assert files == 1 if size > 1 else files > 1
    assert spreads and all("Exchange" not in p and spread is False for p, spread in spreads)


def test_a_log_of_many_files_is_few_batches(spark, tmp_path):
    log = as_log(routed(spark.range(40).select(F.lit("{}").alias("value")), TRANSACTION, time=F.lit(0).cast("timestamp")))
    write_log_files(log.repartition(20), f"{tmp_path}/many", 0)
    write_log_files(log.coalesce(1), f"{tmp_path}/one", 0)
    assert catalogue._files_per_trigger(spark, f"{tmp_path}/many") == 3  # 20 files in 8 batches at most
    assert catalogue._files_per_trigger(spark, f"{tmp_path}/one") == 1


def test_undeclared_fields_are_parsed_once(spark):
    texts = ['{"transaction_id":"1","x":null,"y":{"z":[1]}}', '{"transaction_id":"2"}', "no JSON", "{}"]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    log = as_log(routed(raw, TRANSACTION, time=F.lit(0).cast("timestamp")))
    got = decode_feed(log, TRANSACTION, unknown=True).where("_unknown is not null and _corrupt is null")
    assert [(r.transaction_id, r._unknown) for r in got.collect()] == [("1", '{"x":null,"y":{"z":[1]}}')]
    optimized = got._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.lower().count("parsejson") == 1


def test_stored_rows_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = catalogue._stored(spark, spark.range(10).mapInArrow(count, "id bigint"))
    assert rows.count() == rows.where("id < 5").count() * 2 == 10
    assert made.value == 10


@pytest.mark.parametrize("lines", [1, 40])
def test_baskets_land_whole_after_they_are_spread(spark, tmp_path, lines):
    products = F.transform(F.sequence(F.lit(1), F.lit(lines)), lambda i: F.struct(i.cast("string").alias("sku"), F.lit("1.00").alias("total")))
    value = F.to_json(F.struct(F.col("id").cast("string").alias("transaction_id"), F.struct(products.alias("products"), F.lit("1.00").alias("total_cost")).alias("purchases")))
    raw = spark.range(50).select(value.alias("value"), F.lit("2020-01-01").alias("date"), F.concat(F.lit("1"), (F.col("id") % 3).cast("string")).alias("hour"))
    write_log_files(as_log(routed(raw, TRANSACTION, time=F.lit(0).cast("timestamp"))).repartition(6), f"{tmp_path}/log", 0)
    from tillroll.sources.log import read_log_files

    to = Landing(tables=f"{tmp_path}/tables", checkpoints=f"{tmp_path}/checkpoints", once=True)
    land_transactions(read_log_files(spark, f"{tmp_path}/log", [3]), to).awaitTermination()
    got = read_landed(spark, to.tables, "transaction")
    assert got.count() == 50 * lines
    assert {r.hour: r["count"] for r in got.groupBy("hour").count().collect()} == {"10": 17 * lines, "11": 17 * lines, "12": 16 * lines}
    assert len(got.inputFiles()) <= 12  # rebalanced: not a file per task and slice


def parses(rows, what="from_json"):
    return rows._jdf.queryExecution().optimizedPlan().toString().count(what)


def test_quoted_parts_are_parsed_once(spark):
    line = '{"sku":"s","quantity":"1","price":"2","total":"2"}'
    purchases = json.dumps({"products": [line, line], "total_cost": "4"})
    place = json.dumps({"address": "a", "postcode": "p", "city": "c", "country": "l"})
    text = json.dumps({"transaction_id": "t", "delivery_address": place, "purchases": purchases})
    raw = spark.createDataFrame([(text,)], "value string")
    log = as_log(routed(raw, TRANSACTION, time=F.lit(0).cast("timestamp")))
    got = decode_transaction_lines(log)
    assert [(r.transaction_id, r.city, r.sku, str(r.total_cost)) for r in got.collect()] == [("t", "c", "s", "4.00")] * 2
    # The envelope, the record, its text, the address, the basket, a line.
    assert parses(got) == 6


def test_a_line_does_not_carry_its_basket(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    got = decode_transaction_lines(as_log(routed(raw, TRANSACTION, time=F.lit(0).cast("timestamp"))))
    optimized = got._jdf.queryExecution().optimizedPlan().toString()
    above = optimized[: optimized.index("Generate explode")]
    assert "purchases" not in above and "delivery_address" not in above


def test_records_move_as_the_columns_they_are_made_of(spark, tmp_path):
    when = [F.lit(f"2020-01-01 10:00:00.{n}").cast("timestamp_ntz") for n in (1, 2)]
    spark.range(1, 3).select(
        F.lit(7).cast("bigint").alias("o_orderkey"), F.lit(5).cast("bigint").alias("o_custkey"),
        F.when(F.col("id") == 1, when[0]).otherwise(when[1]).alias("o_orderdate"),
        F.lit(None).cast("string").alias("o_orderpriority"), F.lit("s").alias("o_orderstatus"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(3).select(
        F.lit(7).cast("bigint").alias("l_orderkey"), F.when(F.col("id") > 0, F.col("id")).alias("l_partkey"),
        F.lit(2.0).alias("l_quantity"), F.lit(3.5).alias("l_extendedprice"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    text = transaction_text(spark, str(tmp_path))
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)?", plan(text))
    assert not any("transaction_id" in m or "address" in m for m in moved)
    [record] = [json.loads(r.value) for r in text.collect()]  # orders alike but for a part of a second are one
    bought = [{k: v for k, v in p.items() if v is not None} for p in record["purchases"]["products"]]
    price = {"price": "3.50", "total": "3.50"}
    want = [price, {"sku": "1", "quantity": "2", **price}, {"sku": "2", "quanitity": "2", **price}] * 2
    assert sorted(map(str, bought)) == sorted(map(str, want))
    assert record["purchases"]["total_cost"] == "10.50" and "city" not in record["delivery_address"]


def test_quotes_and_brackets_around_records(spark):
    texts = ['"{}"', '""[x]""', "[é]", '"', "", "null", None, '[{"a":"\\u00e9\\""}]', '"x', 'x"']
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", env.strip_quotes(F.col("t")).alias("bare"), env.encode(F.col("t")).alias("coded")).collect()
    assert [r.bare for r in got] == [t if t is None else t.strip('"') for t in texts]
    assert [r.coded and json.loads(r.coded) for r in got] == texts


@pytest.mark.parametrize("query", ["curated_erased_late", "curated_missing_input"])
def test_lines_of_one_slice_land_without_moving(spark, monkeypatch, query):
    landed_as, real = {}, catalogue.land

    def curated(*args, **options):
        raise RuntimeError("landed")

    def seen(rows, root, table, batch, **options):
        landed_as[table] = options
        real(rows, root, table, batch, **options)
        if table == "transaction":
            landed_as["rows"] = read_landed(spark, root, table).count() - rows.count()

    monkeypatch.setattr(catalogue, "land", seen)
    monkeypatch.setattr(catalogue, "curate_slice", curated)
    with pytest.raises(RuntimeError, match="landed"):
        catalogue.QUERIES[query](spark, "/root/testdata/sf0.001")
    assert landed_as["transaction"] == {"spread": False} and landed_as["rows"] == 0


def unbroadcast(conf):
    """Plans as over large tables, and whole before they run."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")


@pytest.mark.parametrize(("slices", "moves"), [(["day"], 2), ([], 2)])
def test_lines_move_once_for_their_basket_and_once_for_their_product(spark, conf, slices, moves):
    unbroadcast(conf)
    text = "day string, customer_id string, transaction_id string, transaction_time string, sku string, quanitity string"
    lines = spark.createDataFrame([], f"{text}, total decimal(30,2), total_cost decimal(30,2)")
    products = spark.createDataFrame([], "sku string, name string, category string, popularity float")
    customers = spark.createDataFrame([], ", ".join(f"{c} string" for c in catalogue.CUSTOMER_COLUMNS))
    tree = curate(lines.repartition(2), products, customers, slices=slices)._jdf.queryExecution().executedPlan()
    exchanges, todo = [], [tree]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.toString():
            exchanges.append(node.output().toString())
    assert sum("transaction_time" in e for e in exchanges) == moves


def test_baskets_of_both_ways_to_a_line_are_shuffled_once(spark, conf):
    unbroadcast(conf)
    got = plan(catalogue.curated_running_by_day(spark, "/root/testdata/sf0.001"))
    assert re.search(r"ReusedExchange \[_lk_0#\d+L, o_custkey#\d+L", got)
    # Days and times are written per order, before its columns meet its lines.
    above = got[: got.index("FileScan")]
    assert "date_format" not in above[: above.rindex("SortMergeJoin")]


def test_only_blocks_with_something_before_them_are_carried(spark):
    lines = spark.createDataFrame([], "customer_id string, total_cost decimal(30,2), total decimal(30,2)")
    optimized = running_totals(lines)._jdf.queryExecution().optimizedPlan().toString()
    carry = optimized[optimized.index("Union") :]
    assert re.search(r"Filter isnotnull\(_we\d+#", carry)


@pytest.mark.parametrize("slices", [["day"], []])
@pytest.mark.parametrize("mode", ["running", "per_transaction"])
def test_curated_lines_are_those_that_plain_steps_give(spark, slices, mode):
    """With unknown and null customers, skus, days and costs, and rows that come twice."""
    text = "day string, customer_id string, transaction_id string, transaction_time string, sku string, quanitity string"
    rows = []
    for n in range(400):
        customer, day = [None, "a", "b", "c", "nobody"][n % 5], [None, "d1", "d2"][n % 3]
        sku, paid = [None, "s1", "s2", "unknown"][n // 5 % 4], n % 7
        cost = [None, paid, paid, 7][n // 20 % 4]
        rows.append((day, customer, f"t{n % 90}", "T", sku, "1", paid, cost))
    rows += rows[:60:7]
    rows += [(f"e{n}", c, f"u{n}", "T", "s1", "1", 2, 2) for n, c in enumerate("ccd")]  # these add up
    lines = spark.createDataFrame(rows, f"{text}, total int, total_cost int")
    lines = lines.withColumns({c: F.col(c).cast("decimal(30,2)") for c in ("total", "total_cost")})
    products = spark.createDataFrame([("s1", "n", "c", 1.0), ("s2", "m", None, None), (None, "x", "x", 1.0)], "sku string, name string, category string, popularity float")
    fields = ", ".join(f"{c} string" for c in catalogue.CUSTOMER_COLUMNS)
    people = [tuple(i if c == "id" else f"{c}{i}" for c in catalogue.CUSTOMER_COLUMNS) for i in ("a", "b", "c", "d", None)]
    customers = spark.createDataFrame(people + people[:1], fields)
    totals = "sum(total) over (partition by {} order by total_cost)" if mode == "running" else "sum(total) over (partition by {})"
    key = "customer_id" if mode == "running" else "transaction_id"
    lines.withColumn("total_price", F.expr(totals.format(", ".join([*slices, key])))).createOrReplaceTempView("plain_lines")
    products.createOrReplaceTempView("plain_products")
    customers.distinct().createOrReplaceTempView("plain_customers")
    got = curate(lines, products, customers, mode=mode, slices=slices)
    want = spark.sql(
        f"""select {", ".join([*slices, *got.columns[len(slices):]])} from (select l.*, p.name, p.category, p.popularity, c.*
from plain_lines l join plain_products p on l.sku = p.sku join plain_customers c on l.customer_id = c.id
where total_price = total_cost)"""
    )
    assert got.count() > 0
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
