"""Batches and tables larger than memory: what is held, moved and left behind."""

import os

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.records import routed
from tillroll.plans import catalogue
from tillroll.plans.curate import curate
from tillroll.plans.sample_feeds import lines as sample_lines
from tillroll.schemas import TRANSACTION
from tillroll.sinks.curated import write_curated
from tillroll.sinks.landed import land
from tillroll.sinks.log import as_log, write_log_files
from tillroll.sources.log import read_log_files
from tillroll.sources.tables import read_curated, read_landed
from tillroll.streaming import feeds
from tillroll.streaming.feeds import Landing, land_transactions

SF = "/root/testdata/sf0.001"


def published(spark, path, hours, n=30):
    """A log of transactions of two lines each, one of them without sku, in so many hours."""
    products = [F.struct(s.alias("sku"), F.lit("1.00").alias("total")) for s in (F.lit("s"), F.lit(None).cast("string"))]
    basket = F.struct(F.array(*products).alias("products"), F.lit("2.00").alias("total_cost"))
    value = F.to_json(F.struct(F.col("id").cast("string").alias("transaction_id"), basket.alias("purchases")))
    hour = F.concat(F.lit("1"), (F.col("id") % hours).cast("string")).alias("hour")
    raw = spark.range(n).select(value.alias("value"), F.lit("2020-01-01").alias("date"), hour)
    bad = spark.createDataFrame([("no JSON", "2020-01-01", "10")], "value string, date string, hour string")
    log = as_log(routed(raw.unionByName(bad), TRANSACTION, time=F.lit(0).cast("timestamp")))
    write_log_files(log.repartition(3), path, 0)
    return read_log_files(spark, path, [TRANSACTION.partition])


@pytest.mark.parametrize("hours", [1, 2])
def test_a_batch_is_kept_in_files_and_parsed_once(spark, tmp_path, monkeypatch, hours):
    def in_memory(*_, **__):
        raise AssertionError("a batch may not fit into memory")

    plans, real = {}, feeds.land

    def seen(rows, root, table, *args, **options):
        plans[table] = rows._jdf.queryExecution().optimizedPlan().toString()
        real(rows, root, table, *args, **options)

    log = published(spark, f"{tmp_path}/log", hours)
    monkeypatch.setattr(type(log), "persist", in_memory)
    monkeypatch.setattr(type(log), "cache", in_memory)
    monkeypatch.setattr(feeds, "land", seen)
    to = Landing(tables=f"{tmp_path}/tables", checkpoints=f"{tmp_path}/checkpoints", once=True)
    query = land_transactions(log, to)
    query.awaitTermination()
    counts = [p.observedMetrics["transaction"] for p in query.recentProgress if p.numInputRows]
    assert [(c.records, c.rejected) for c in counts] == [(31, 1)]
    assert read_landed(spark, to.tables, "transaction").count() == 60
    assert spark.read.parquet(f"{to.tables}/rejected_transaction").count() == 1
    assert spark.read.parquet(f"{to.tables}/rejected_line").count() == 30
    # Records of one hour stay where they are; those of several move by hour, before they are spread.
    assert ("RebalancePartitions" in plans["transaction"]) == (hours > 1)
    assert not any("from_json" in p.lower() or "jsontostructs" in p.lower() for p in plans.values())
    assert os.listdir(f"{to.tables}/_staged/transaction") == []


def test_a_batch_that_failed_is_landed_whole_when_repeated(spark, tmp_path, monkeypatch):
    log = published(spark, f"{tmp_path}/log", 1)
    to = Landing(tables=f"{tmp_path}/tables", checkpoints=f"{tmp_path}/checkpoints", once=True)
    real = feeds.land

    def fails(rows, root, table, *args, **options):
        if table != "transaction":
            raise RuntimeError("died")
        real(rows, root, table, *args, **options)

    monkeypatch.setattr(feeds, "land", fails)
    with pytest.raises(Exception, match="died"):
        land_transactions(log, to).awaitTermination()
    monkeypatch.setattr(feeds, "land", real)
    land_transactions(log, to).awaitTermination()
    assert read_landed(spark, to.tables, "transaction").count() == 60
    assert spark.read.parquet(f"{to.tables}/rejected_line").count() == 30


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in f}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    rows = spark.range(2000).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("2020-01-01").alias("date"),
        F.concat(F.lit("1"), (F.col("id") % 3).cast("string")).alias("hour"),
    )
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    conf, before = spark.conf.get(option), shuffle_files(spark)
    land(rows, str(tmp_path), "transaction", "q-0")
    assert write_curated(rows.repartition(5), f"{tmp_path}/curated") == 2000
    write_log_files(rows.repartition(5).withColumn("partition", F.lit(1)), f"{tmp_path}/log", 0)
    stored = catalogue._stored(spark, rows.repartition(5))
    assert not shuffle_files(spark) - before
    assert spark.conf.get(option) == conf
    assert stored.count() == 2000
    assert read_curated(spark, f"{tmp_path}/curated").count() == 2000
    assert read_landed(spark, str(tmp_path), "transaction").count() == 2000


def test_rows_of_more_slices_than_are_written_at_once(spark, tmp_path):
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("2020-01-01").alias("date"),
        F.lpad((F.col("id") % 24).cast("string"), 2, "0").alias("hour"),
    )
    land(rows, str(tmp_path), "transaction", "q-0")
    counts = read_landed(spark, str(tmp_path), "transaction").groupBy("hour").count().collect()
    assert len(counts) == 24 and {r["count"] for r in counts} == {25}


def exchanges(rows: DataFrame) -> list[str]:
    """What each shuffle of a plan moves."""
    found, todo = [], [rows._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.toString():
            found.append(node.output().toString())
    return found


@pytest.mark.parametrize("mode", ["running", "per_transaction"])
def test_lines_do_not_carry_the_sum_that_is_their_total(spark, conf, mode):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    text = "customer_id string, transaction_id string, transaction_time string, sku string, quanitity string"
    lines = spark.createDataFrame([], f"{text}, total decimal(30,2), total_cost decimal(30,2)")
    products = spark.createDataFrame([], "sku string, name string, category string, popularity float")
    customers = spark.createDataFrame([], ", ".join(f"{c} string" for c in catalogue.CUSTOMER_COLUMNS))
    got = curate(lines.repartition(2), products, customers, mode=mode)
    moved = [e for e in exchanges(got) if "transaction_time" in e]
    assert moved and not any("total_price" in e for e in moved)
    assert got.schema["total_price"].dataType.simpleString() == "decimal(38,2)"


def test_amounts_move_as_the_numbers_they_are(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    moved = [e for e in exchanges(sample_lines(spark, SF)) if "l_partkey" in e]
    assert moved and all("l_extendedprice" in e and "total#" not in e for e in moved)


def test_lines_are_made_once_for_both_uses(spark):
    got = catalogue.curated_per_transaction(spark, SF)
    assert not any("lineitem" in f for f in got.inputFiles())


def test_curated_rows_are_kept_only_while_they_are_stored(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(catalogue, "scratch_dir", lambda _, purpose: f"{tmp_path}/{purpose}")
    with catalogue._kept(spark, spark.range(10).repartition(2)) as kept:
        assert kept.count() == 10
        assert any("kept" in name for name in os.listdir(tmp_path))
    assert not any("kept" in name for name in os.listdir(tmp_path))
