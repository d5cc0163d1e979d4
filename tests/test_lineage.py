"""Curated slices: replaced at once, read as they were, and curated again when more has landed."""

import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_curated import DAY, T1, T2, curated, frame, land_at, line, roots, rows_at  # noqa: F401

from tillroll.plans.curate import curate_slice
from tillroll.plans.lineage import recurate_late, stale_slices
from tillroll.plans.snapshot import write_snapshot
from tillroll.sinks.curated import vacuum_curated, write_curated
from tillroll.sources.tables import current_slices, read_curated


def failing(rows):
    """The same rows, but a task that writes them dies after some."""
    many = rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20_000))))
    broken = F.when(F.col("n") == 19_999, F.raise_error(F.lit("lost"))).otherwise(F.col("city"))
    return many.withColumn("city", broken).drop("n")


def test_a_write_that_dies_half_way_leaves_the_slice(spark, tmp_path):
    root, slice_ = f"{tmp_path}/curated", (DAY, "10")
    assert write_curated(rows_at(spark, slice_, slice_), root) == 2
    with pytest.raises(PySparkException, match="lost"):
        write_curated(failing(rows_at(spark, slice_)), root, slices=[slice_])
    assert read_curated(spark, root).count() == 2
    # Died between writing and committing: the files are there and do not count.
    files = rows_at(spark, slice_).withColumns(
        {"year": F.lit("2020"), "month": F.lit("January"), "version": F.lit("dead")}
    )
    files.write.mode("append").partitionBy("year", "month", "date", "hour", "version").parquet(root)
    assert read_curated(spark, root).count() == 2
    assert write_curated(rows_at(spark, slice_), root) == 1
    assert read_curated(spark, root).count() == 1
    assert vacuum_curated(spark, root) == []  # too young
    assert len(vacuum_curated(spark, root, least_hours=0)) == 2
    assert len(glob.glob(f"{root}/year=*/month=*/date=*/hour=*/version=*")) == 1
    assert read_curated(spark, root).count() == 1


def test_a_reader_keeps_the_version_it_found(spark, tmp_path):
    root, slice_ = f"{tmp_path}/curated", (DAY, "10")
    write_curated(rows_at(spark, slice_, slice_), root)
    before = read_curated(spark, root)
    write_curated(rows_at(spark, slice_), root)
    assert (before.count(), read_curated(spark, root).count()) == (2, 1)
    write_curated(rows_at(spark, slice_).where("false"), root, slices=[slice_])
    assert read_curated(spark, root).count() == 0 and before.count() == 2
    assert [r.path for r in current_slices(spark, root).collect()] == [None]


def test_some_slices(spark, tmp_path):
    root = f"{tmp_path}/curated"
    write_curated(rows_at(spark, (DAY, "10"), (DAY, "11"), (DAY, "11")), root)
    some = read_curated(spark, root, slices=[(DAY, "11"), (DAY, "23")])
    assert some.count() == 2 and all("hour=11" in f for f in some.inputFiles())


def stale(spark, landing, root, **since):
    return sorted(map(tuple, stale_slices(spark, landing, root, **since).collect()))


def test_late_batches_of_all_tables(spark, roots):  # noqa: F811
    landing, root = roots
    for hour in ("10", "11"):
        curate_slice(spark, landing, root, DAY, hour, mode="per_transaction", allow_empty=True)
    assert stale(spark, landing, root) == [] and recurate_late(spark, landing, root) == []
    late = frame(spark, "transaction", line("t5", "c1", "s3", "6", "6"))
    land_at(late, landing, "transaction", "10", "late-0")
    assert stale(spark, landing, root) == [(DAY, "10", "transaction")]
    assert stale(spark, landing, root, since="9999-01-01") == []
    goods = {"sku": "s3", "name": "n3", "category": "c", "popularity": 1.0}
    land_at(frame(spark, "product", goods), landing, "product", "00", "late-0")
    both = [(DAY, "10", "product"), (DAY, "10", "transaction"), (DAY, "11", "product")]
    assert stale(spark, landing, root) == both
    # What lands for later slices leaves these as they are.
    land_at(frame(spark, "product", goods), landing, "product", "00", "late-1", date="2020-01-02")
    land_at(frame(spark, "customer", {"id": "c9"}), landing, "customer", "12", "late-0")
    assert stale(spark, landing, root) == both
    again = {"mode": "per_transaction", "allow_empty": True}
    assert recurate_late(spark, landing, root, **again) == [(DAY, "10"), (DAY, "11")]
    assert curated(spark, root) == [T1, T2, ("t5", "c1", "Oslo", "s3", "n3", "6.00", "6.00")]
    assert stale(spark, landing, root) == []
    land_at(frame(spark, "erasure", {"customer-id": "c1"}), landing, "erasure", "00", "late-0")
    land_at(frame(spark, "customer", {"id": "c3"}), landing, "customer", "11", "late-1")
    found = [(DAY, "10", "erasure"), (DAY, "11", "customer"), (DAY, "11", "erasure")]
    assert stale(spark, landing, root, tables=("customer", "erasure")) == found
    assert stale(spark, landing, root) == found[1:2]


def test_lineage_of_runs_from_snapshots(spark, roots, tmp_path):  # noqa: F811
    landing, root = roots
    kept = f"{tmp_path}/snapshots"
    write_snapshot(spark, landing, kept, "product", DAY, "09")
    options = {"snapshots": kept, "customer_scope": "latest"}
    curate_slice(spark, landing, root, DAY, "10", **options)
    assert stale(spark, landing, root) == []
    land_at(frame(spark, "customer", {"id": "c1", "city": "Lund", "last_change": "3"}),
            landing, "customer", "09", "late-0")
    assert stale(spark, landing, root) == [(DAY, "10", "customer")]
    assert recurate_late(spark, landing, root, **options) == [(DAY, "10")]
    assert {r[2] for r in curated(spark, root)} >= {"Lund"} and stale(spark, landing, root) == []
