from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillroll.plans.curate import curate, curate_slice
from tillroll.plans.snapshot import last_snapshot, newest_until, write_snapshot
from tillroll.schemas import CURATED_COLUMNS, LANDED_FIELDS
from tillroll.sinks.curated import write_curated, write_curated_slice
from tillroll.sinks.landed import land, sliced
from tillroll.sources.tables import read_curated, read_landed, read_landed_until

DAY = "2020-01-01"


def frame(spark, feed, *records):
    """Landed records from partial dictionaries."""
    schema = spark.createDataFrame([], LANDED_FIELDS[feed]).schema
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in records], schema)


def land_at(rows, root, feed, hour, batch="b0", date=DAY):
    slice_columns = {"date": F.lit(date), "hour": F.lit(hour)}
    land(rows.withColumns(slice_columns), root, feed, batch)


def line(transaction, customer, sku, total, cost):
    return {
        "transaction_id": transaction, "customer_id": customer, "sku": sku, "quanitity": "1",
        "total": Decimal(total), "total_cost": Decimal(cost), "city": "delivery city",
    }


@pytest.fixture
def roots(spark, tmp_path):
    landing = f"{tmp_path}/landing"
    land_at(
        frame(
            spark, "product",
            {"sku": "s1", "name": "n1", "price": 1.0, "category": "c", "popularity": 1.5},
            {"sku": "s1", "name": "n1", "price": 1.0, "category": "c", "popularity": 1.5},
            {"sku": "s2", "name": "n2", "price": 1.0, "category": "c", "popularity": 2.5},
        ),
        landing, "product", "00",
    )
    land_at(
        frame(
            spark, "customer",
            {"id": "c1", "city": "Rome", "email": "1@x", "last_change": "1"},
            {"id": "c1", "city": "Oslo", "email": "1@x", "last_change": "2"},
        ),
        landing, "customer", "10",
    )
    land_at(frame(spark, "customer", {"id": "c2", "city": "Bonn"}), landing, "customer", "09")
    land_at(frame(spark, "customer", {"id": "c2", "city": "Kiel"}), landing, "customer", "11")
    land_at(
        frame(
            spark, "transaction",
            line("t1", "c1", "s1", "2", "5"),
            line("t1", "c1", "gone", "3", "5"),
            line("t2", "c1", "s2", "7", "7"),
            line("t3", "c2", "s2", "4", "4"),
        ),
        landing, "transaction", "10",
    )
    return landing, f"{tmp_path}/curated"


def curated(spark, root):
    rows = read_curated(spark, root).select(
        "transaction_id", "id", "city", "sku", "name", "total", "total_price"
    )
    return sorted((*r[:5], str(r[5]), str(r[6])) for r in rows.collect())


T1 = ("t1", "c1", "Oslo", "s1", "n1", "2.00", "5.00")
T2 = ("t2", "c1", "Oslo", "s2", "n2", "7.00", "7.00")
T3 = ("t3", "c2", "Bonn", "s2", "n2", "4.00", "4.00")


def test_columns_and_values(spark, roots):
    landing, root = roots
    assert curate_slice(spark, landing, root, DAY, "10") == 1
    rows = read_curated(spark, root)
    assert rows.columns == [*CURATED_COLUMNS, "year", "month", "date", "hour"]
    row = rows.first()
    assert (row.year, row.month, row.date, row.hour) == ("2020", "January", DAY, "10")
    # The unknown sku counts towards the basket, though its line drops out.
    assert curated(spark, root) == [T1]


def test_modes_and_customer_scopes(spark, roots):
    landing, root = roots
    options = [("per_transaction", "slice", [T1, T2]), ("running", "latest", [T1, T3])]
    options.append(("per_transaction", "latest", [T1, T2, T3]))
    for mode, scope, want in options:
        n = curate_slice(spark, landing, root, DAY, "10", mode=mode, customer_scope=scope)
        assert curated(spark, root) == want and n == len(want)
    with pytest.raises(ValueError):
        curate_slice(spark, landing, root, DAY, "10", customer_scope="some")


def test_products_of_another_slice(spark, roots):
    landing, root = roots
    renamed = {"sku": "s1", "name": "renamed", "category": "c", "popularity": 1.0}
    land_at(frame(spark, "product", renamed), landing, "product", "03", date="2020-01-02")
    curate_slice(spark, landing, root, DAY, "10", product_slice=("2020-01-02", "03"))
    assert [r[4] for r in curated(spark, root)] == ["renamed"]


def test_products_of_earlier_days(spark, roots):
    """A sku that landed on the first day only, as the stream lands it once, still counts."""
    landing, root = roots
    day = "2020-01-02"
    land_at(frame(spark, "customer", {"id": "c1"}), landing, "customer", "08", date=day)
    sold = frame(
        spark, "transaction", line("t8", "c1", "s1", "2", "2"), line("t7", "c1", "s2", "5", "7")
    )
    land_at(sold, landing, "transaction", "08", date=day)
    renamed = {"sku": "s1", "name": "a new name", "category": "c", "popularity": 1.0}
    land_at(frame(spark, "product", renamed), landing, "product", "00", date=day)
    late = {"sku": "s1", "name": "too late", "category": "c", "popularity": 1.0}
    land_at(frame(spark, "product", late), landing, "product", "00", date="2020-01-03")
    for scope, names in (("slice", {"a new name"}), ("latest", {"a new name", "n2"})):
        curate_slice(spark, landing, root, day, "08", product_scope=scope)
        assert {r[4] for r in curated(spark, root)} == names
    with pytest.raises(ValueError):
        curate_slice(spark, landing, root, day, "08", product_scope="some")


def test_running_a_slice_again_changes_nothing_else(spark, roots):
    landing, root = roots
    later = frame(spark, "transaction", line("t9", "c2", "s2", "1", "1"))
    land_at(later, landing, "transaction", "11")
    for hour in ("10", "11", "10", "10"):
        curate_slice(spark, landing, root, DAY, hour)
    kept = [r for r in curated(spark, root) if r[0] == "t9"]
    assert curated(spark, root) == [T1, *kept] and len(kept) == 1


def test_a_slice_that_came_out_empty_is_emptied(spark, roots):
    landing, root = roots
    curate_slice(spark, landing, root, DAY, "10")
    corrected = frame(spark, "transaction", line("t1", "c1", "s1", "2", "6"))
    land_at(corrected, landing, "transaction", "10")
    assert curate_slice(spark, landing, root, DAY, "10") == 0
    assert curated(spark, root) == []


def test_missing_input_raises_and_leaves_the_slice(spark, roots, tmp_path):
    landing, root = roots
    curate_slice(spark, landing, root, DAY, "10")
    before = curated(spark, root)
    for tables, hour in ((f"{tmp_path}/nothing", "10"), (landing, "23")):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            curate_slice(spark, tables, root, DAY, hour)
    assert curated(spark, root) == before and before
    assert curate_slice(spark, landing, root, DAY, "23", allow_empty=True) == 0
    assert curated(spark, root) == before
    assert read_curated(spark, f"{tmp_path}/never").count() == 0


def test_snapshots_give_what_all_history_gives(spark, roots, tmp_path):
    landing, root = roots
    kept = f"{tmp_path}/snapshots"
    for table in ("product", "customer"):
        write_snapshot(spark, landing, kept, table, DAY, "10")
    day = "2020-01-02"
    renamed = {"sku": "s1", "name": "a new name", "category": "c", "popularity": 1.0}
    land_at(frame(spark, "product", renamed), landing, "product", "00", date=day)
    land_at(frame(spark, "customer", {"id": "c1", "city": "Rome"}), landing, "customer", "08", date=day)
    sold = frame(spark, "transaction", line("t8", "c1", "s1", "2", "2"), line("t7", "c2", "s2", "5", "5"))
    land_at(sold, landing, "transaction", "08", date=day)
    results = []
    for snapshots in (None, kept):
        curate_slice(
            spark, landing, root, day, "08", customer_scope="latest", snapshots=snapshots
        )
        results.append(curated(spark, root))
    assert results[0] == results[1] and {r[4] for r in results[0]} == {"a new name", "n2"}
    # Of the past, the snapshot is read and landed slices before it are not.
    files = newest_until(spark, landing, kept, "product", day, "08").inputFiles()
    assert not any(f"landed/product/date={DAY}" in f for f in files) and len(files) >= 2
    write_snapshot(spark, landing, kept, "product", day, "08")
    again = newest_until(spark, landing, kept, "product", day, "08")
    assert {r.name for r in again.collect() if r.sku == "s1"} == {"a new name"}
    assert last_snapshot(spark, kept, "product", day, "07") == (DAY, "10")


def test_customers_landed_before_their_request_are_masked_once(spark, roots):
    landing, root = roots
    asked = frame(spark, "erasure", {"customer-id": "c1"})
    land_at(asked, landing, "erasure", "00")
    curate_slice(spark, landing, root, DAY, "10")
    once = {r.id: r.email for r in read_curated(spark, root).collect()}
    assert len(once["c1"]) == 64
    curate_slice(spark, landing, root, DAY, "10")
    assert {r.id: r.email for r in read_curated(spark, root).collect()} == once


def rows_at(spark, *slices):
    fields = read_curated(spark, "/no/such/path").select(*CURATED_COLUMNS).schema
    one = spark.createDataFrame([tuple("x" if f.dataType.simpleString() == "string" else None
                                       for f in fields)], fields)
    return one.withColumn("s", F.explode(F.array(*[F.lit(f"{d} {h}") for d, h in slices]))).select(
        "*", F.split("s", " ")[0].alias("date"), F.split("s", " ")[1].alias("hour")
    ).drop("s")


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_several_slices_at_once(spark, tmp_path, fmt):
    root = f"{tmp_path}/curated"
    a, b, c = ("2020-01-31", "23"), ("2020-02-01", "00"), ("2020-02-01", "01")
    assert write_curated(rows_at(spark, a, b, c), root, fmt=fmt) == 3
    assert write_curated(rows_at(spark, c, c), root, slices=[b, c], fmt=fmt) == 2
    rows = read_curated(spark, root, fmt=fmt).select("month", "date", "hour").collect()
    assert sorted(map(tuple, rows)) == [
        ("February", *c), ("February", *c), ("January", *a),
    ]
    assert write_curated_slice(rows_at(spark, a), root, *a, fmt=fmt) == 1


def test_slices_prune_to_their_folders(spark, roots):
    landing, _ = roots
    one = read_landed(spark, landing, "customer", date=DAY, hour="10")
    assert all("hour=10" in f for f in one.inputFiles())
    assert [(r.date, r.hour, r.batch) for r in one.collect()] == [(DAY, "10", "b0")] * 2
    assert read_landed(spark, landing, "customer", date=DAY).count() == 4
    assert read_landed(spark, landing, "customer", hour="09").count() == 1
    until = read_landed_until(spark, landing, "customer", date=DAY, hour="10")
    assert "PartitionFilters: [(" in until._jdf.queryExecution().executedPlan().toString()
    assert {r.city for r in until.collect()} == {"Rome", "Oslo", "Bonn"}


def test_target_files_and_pinned_hours(spark, tmp_path):
    rows = spark.range(0, 100, 1, 8).select(
        F.lit("erasure").alias("key"),
        F.col("id").cast("string").alias("customer-id"),
        F.lit(None).cast("string").alias("email"),
        F.lit("2020-01-01 15:00:00").cast("timestamp").alias("timestamp"),
    )
    land(sliced(rows, hour="00"), str(tmp_path), "erasure", "b", target_files=1)
    landed = read_landed(spark, str(tmp_path), "erasure")
    assert len(landed.inputFiles()) == 1
    assert landed.select("date", "hour").distinct().collect() == [(DAY, "00")]
    assert write_curated(rows_at(spark, *[(DAY, "01")] * 50), f"{tmp_path}/c", target_files=2) == 50
    assert len(read_curated(spark, f"{tmp_path}/c").inputFiles()) == 2


def test_curate_reads_only_what_it_needs(spark, roots, conf):
    landing, _ = roots
    conf(spark__sql__maxMetadataStringLength="2000")
    plan = curate(
        read_landed(spark, landing, "transaction"),
        read_landed(spark, landing, "product"),
        read_landed(spark, landing, "customer"),
    )._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    lines = [s for s in schemas if "total_cost" in s]
    assert len(lines) >= 2
    assert not any("city" in s or "price" in s or "key:" in s for s in lines)
    assert min(lines, key=len).count(":") == 3  # the running total needs three columns
