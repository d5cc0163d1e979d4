"""Records that the log holds twice land once; equal lines of a feed are two records."""

import gzip

import pytest
from test_streaming import landed, landing  # noqa: F401

from tillroll.operators.records import routed, with_feed_slice
from tillroll.schemas import CUSTOMER, ERASURE, TRANSACTION
from tillroll.sinks.log import as_log, write_log_files
from tillroll.sources.files import feed_lines, stream_feed_lines
from tillroll.sources.log import read_log_files
from tillroll.streaming.feeds import land_customers, land_transactions


def put(root, feed, hour, *lines, name="part-0.gz", date="2020-01-01"):
    folder = root / "feeds" / f"date={date}" / f"hour={hour}" / feed.file_name
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt") as f:
        f.write("".join(f"{x}\n" for x in lines))


def sale(transaction):
    return (
        f'{{"transaction_id": "{transaction}", "customer_id": "c", "purchases": '
        '{"products": [{"sku": "s", "total": "1"}, {"sku": "t", "total": "2"}], "total_cost": "3"}}'
    )


class Feeds:
    """Publishes the feed files as they are, again and again."""

    def __init__(self, spark, path):
        self.spark, self.path, self.batch = spark, path, 0

    def publish(self, feed, **options):
        lines = feed_lines(self.spark, f"{self.path}/feeds", feed, numbered=True, **options)
        write_log_files(as_log(routed(lines, feed)), f"{self.path}/log", self.batch)
        self.batch += 1

    def read(self, feed):
        return read_log_files(self.spark, f"{self.path}/log", [feed.partition])


@pytest.fixture
def feeds(spark, tmp_path):
    return Feeds(spark, tmp_path)


def transactions(spark, to):
    return [r[0] for r in landed(spark, to, "transaction", "transaction_id")]


def test_published_twice_lands_once(spark, feeds, landing, tmp_path):  # noqa: F811
    put(tmp_path, TRANSACTION, "10", sale("a"), sale("a"), sale("b"), "no record")
    feeds.publish(TRANSACTION)
    feeds.publish(TRANSACTION)  # both in one micro-batch
    land_transactions(feeds.read(TRANSACTION), landing).awaitTermination()
    want = ["a"] * 4 + ["b"] * 2
    assert transactions(spark, landing) == want
    feeds.publish(TRANSACTION, partitions=3)  # in a later one, read in another order
    land_transactions(feeds.read(TRANSACTION), landing).awaitTermination()
    assert transactions(spark, landing) == want
    rejects = spark.read.parquet(f"{landing.tables}/rejected_transaction")
    assert rejects.count() == 1


def test_other_files_and_hours_are_other_records(spark, feeds, landing, tmp_path):  # noqa: F811
    put(tmp_path, TRANSACTION, "10", sale("a"))
    put(tmp_path, TRANSACTION, "10", sale("a"), name="part-1.gz")
    put(tmp_path, TRANSACTION, "11", sale("a"))
    feeds.publish(TRANSACTION)
    put(tmp_path, TRANSACTION, "10", sale("z"), name="part-2.gz")
    feeds.publish(TRANSACTION)
    land_transactions(feeds.read(TRANSACTION), landing).awaitTermination()
    assert transactions(spark, landing) == ["a"] * 6 + ["z"] * 2


def test_a_repeated_micro_batch_lands_the_same(spark, feeds, landing, tmp_path):  # noqa: F811
    """A batch that is written again, as after a crash, finds its own records new again."""
    from tillroll.operators.records import decode_feed
    from tillroll.sinks.landed import unlanded

    put(tmp_path, CUSTOMER, "10", '{"id": "1"}', '{"id": "2"}')
    feeds.publish(CUSTOMER)
    log = read_log_files(spark, f"{tmp_path}/log", [CUSTOMER.partition], streaming=False)
    records = decode_feed(log, CUSTOMER)
    for batch, n in (("q-0", 2), ("q-0", 2), ("q-1", 0)):
        assert unlanded(records, landing.tables, "customer", batch).count() == n
    # Where nothing tells records apart, all of them land.
    plain = records.drop("record_id").selectExpr("*", "cast(null as string) as record_id")
    assert unlanded(plain.union(plain), landing.tables, "customer", "q-2").count() == 4


def test_customers_and_records_without_identity(spark, feeds, landing, tmp_path):  # noqa: F811
    put(tmp_path, CUSTOMER, "10", '{"id": "1"}')
    feeds.publish(CUSTOMER)
    feeds.publish(CUSTOMER)
    unnamed = spark.createDataFrame([('{"id": "2"}',), ('{"id": "2"}',)], "value string")
    write_log_files(as_log(routed(unnamed, CUSTOMER)), f"{tmp_path}/log", 9)
    land_customers(feeds.read(CUSTOMER), landing).awaitTermination()
    assert [r[0] for r in landed(spark, landing, "customer", "id")] == ["1", "2", "2"]


def test_lines_keep_their_numbers(spark, tmp_path):
    lines = [f'{{"customer-id": "{i}"}}' for i in range(25_000)]  # several Arrow batches
    put(tmp_path, ERASURE, "00", *lines, "", "last")
    put(tmp_path, ERASURE, "01", "other")
    got = feed_lines(spark, f"{tmp_path}/feeds", ERASURE, numbered=True, partitions=4).collect()
    ours = sorted((r.line, r.value) for r in got if r.hour == "00")
    assert [v for _, v in ours] == [*lines, "last"]
    assert [n for n, _ in ours] == [*range(25_000), 25_001]
    assert {r.file for r in got} == {
        f"date=2020-01-01/hour={h}/erasure.json.gz/part-0.gz@0" for h in ("00", "01")
    }
    stream = stream_feed_lines(spark, f"{tmp_path}/feeds", ERASURE, numbered=True)
    assert stream.columns == ["value", "date", "hour", "file", "line"]
    again = with_feed_slice(as_log(routed(feed_lines(spark, f"{tmp_path}/feeds", ERASURE, numbered=True), ERASURE)))
    once = with_feed_slice(as_log(routed(spark.createDataFrame(got), ERASURE)))
    assert {r.record_id for r in again.collect()} == {r.record_id for r in once.collect()}
    assert again.select("record_id").distinct().count() == 25_002
