"""The jobs as a user runs them, over a day of hand-made feed files."""

import gzip
import hashlib
import json

import pytest

from tillroll.__main__ import main
from tillroll.schemas import CUSTOMER, ERASURE, PRODUCT, TRANSACTION
from tillroll.sinks.log import stream_to_log_files
from tillroll.sources.log import read_log_files
from tillroll.sources.tables import read_curated, read_landed


def log_files(folder):
    """A log of files in place of a broker."""

    class Log:
        def __init__(self, spark, args):
            self.spark, self.once = spark, getattr(args, "once", True)

        def open(self, feed):
            return read_log_files(self.spark, f"{folder}/{feed.name}")

        def look(self, feed, first, n):
            return read_log_files(self.spark, f"{folder}/{feed.name}", streaming=False)

        def publish(self, records, checkpoint):
            feed = checkpoint.rsplit("publish-")[-1]
            return stream_to_log_files(records, f"{folder}/{feed}", checkpoint, once=self.once)

    return Log


def put(root, feed, hour, *records):
    folder = root / "feeds" / "date=2020-01-01" / f"hour={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / feed.file_name, "wt", encoding="utf-8") as f:
        f.write("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records) + "\n")


def basket(transaction, customer, cost, *lines):
    products = [{"sku": s, "quanitity": "1", "price": t, "total": t} for s, t in lines]
    return {
        "transaction_id": transaction,
        "transaction_time": "2020-01-01T10:05:00",
        "customer_id": customer,
        "delivery_address": {"city": "Paris"},
        "purchases": {"products": products, "total_cost": cost},
    }


def person(id, name):
    return {"id": id, "first_name": name, "email": f"{id}@x", "phone_number": None, "city": "Rome"}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_a_day(spark, conf, tmp_path, fmt, capsys):
    conf(spark__sql__shuffle__partitions="2", **{
        "spark__sql__streaming__stateStore__providerClass": (
            "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
        ),
        "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "false",
    })
    put(tmp_path, ERASURE, "00", {"customer-id": "2", "email": "2@x"})
    put(
        tmp_path, PRODUCT, "00",
        {"sku": "s1", "name": 'a "quoted" name', "price": "2", "category": "c", "popularity": "1"},
        {"sku": "s2", "name": "no price", "price": "", "category": "c", "popularity": "1"},
    )
    put(tmp_path, CUSTOMER, "10", person("1", "Zoë"), person("2", "Åsa"), {"first_name": "no id"})
    put(
        tmp_path, TRANSACTION, "10",
        basket("t1", "1", "5", ("s1", "2"), ("s2", "3")),
        basket("t2", "1", "7", ("s1", "7")),
        basket("t3", "2", "4", ("s1", "4")),
        basket("t4", "3", "4", ("s1", "4")),
    )
    log = ["--kafka", "none:9092"]
    files = log_files(f"{tmp_path}/log")
    salt = tmp_path / "salt"
    salt.write_text("pepper\n")
    mask = ["--mask-salt", str(salt), "--mask-columns", "email,first_name"]
    state = ["--checkpoints", f"{tmp_path}/checkpoints", "--once"]
    tables = ["--tables", f"{tmp_path}/tables", "--format", fmt]
    curated = f"{tmp_path}/curated"

    def run():
        publish = ["publish", "--feeds", f"{tmp_path}/feeds", "--dates", "2020-*", "--partitions", "2"]
        main([*publish, *log, *state], files)
        main(["land", *log, *state, *tables, *mask], files)
        main(["curate", *tables, *mask, "--curated", curated, "2020-01-01", "10"])

    def result():
        rows = read_curated(spark, curated, fmt=fmt)
        picked = rows.select("transaction_id", "first_name", "name", "city", "total").collect()
        return sorted((*r[:4], str(r[4])) for r in picked)

    run()
    want = [
        ("t1", "Zoë", 'a "quoted" name', "Rome", "2.00"),
        ("t3", hashlib.sha256("pepperÅsa".encode()).hexdigest(), 'a "quoted" name', "Rome", "4.00"),
    ]
    assert result() == want
    said = capsys.readouterr().out
    assert "product batch 0: 2 records, 1 rejected" in said
    assert "customer batch 0: 3 records, 1 rejected" in said
    reader = spark.read.format(fmt)
    assert reader.load(f"{tmp_path}/tables/rejected_product").first().reason == "price"
    assert reader.load(f"{tmp_path}/tables/rejected_customer").first().reason == "id"
    emails = {r.id: r.email for r in read_curated(spark, curated, fmt=fmt).collect()}
    assert emails["1"] == "1@x" and len(emails["2"]) == 64
    run()
    assert result() == want

    put(tmp_path, TRANSACTION, "11", basket("t9", "1", "1", ("s1", "1")))
    put(tmp_path, PRODUCT, "01", {"sku": "s1", "name": "again", "price": "3", "popularity": "1"})
    run()
    assert result() == want
    assert read_landed(spark, f"{tmp_path}/tables", "product", fmt=fmt).count() == 1
    snapshots = ["--snapshots", f"{tmp_path}/snapshots"]
    main(["snapshot", *tables, *snapshots, "2020-01-01", "10"])
    latest = ["--curated", curated, "--customers", "latest", *snapshots, *mask]
    main(["curate", *tables, *latest, "2020-01-01", "11"])
    main(["compact", *tables, "--compacted", f"{tmp_path}/few", "2020-01-01", "10"])
    assert read_landed(spark, f"{tmp_path}/few", "transaction", fmt=fmt).count() == 5
    assert [r[0] for r in result()] == ["t1", "t3", "t9"]

    capsys.readouterr()
    main(["peek", *log, "--rows", "1"], files)
    assert "|customer|" in capsys.readouterr().out
