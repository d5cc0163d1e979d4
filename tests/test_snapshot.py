"""Snapshots that miss nothing that lands late, write what is new, and expire."""

import glob

import pytest
from pyspark.sql import functions as F
from test_curated import frame, land_at

from tillroll.plans.snapshot import (
    MOST_SEGMENTS,
    expire_snapshots,
    last_snapshot,
    newest_until,
    taken_until,
    write_snapshot,
)
from tillroll.sinks import commits
from tillroll.sources import ledger

DAY, NEXT = "2020-01-01", "2020-01-02"


def product(sku, name):
    return {"sku": sku, "name": name, "price": 1.0, "category": "c", "popularity": 1.0}


@pytest.fixture
def at(spark, tmp_path):
    return f"{tmp_path}/landed", f"{tmp_path}/snapshots"


def land_products(spark, landing, batch, *pairs, date=DAY, hour="00"):
    rows = frame(spark, "product", *(product(*p) for p in pairs))
    land_at(rows, landing, "product", hour, batch, date)


def newest(spark, at, date=NEXT, hour="10"):
    rows = newest_until(spark, *at, "product", date, hour).collect()
    assert len(rows) == len({r.sku for r in rows})
    return {r.sku: r.name for r in rows}


def test_rows_that_land_late_in_an_old_slice(spark, at):
    land_products(spark, at[0], "q-0", ("a", "a0"), ("b", "b0"))
    write_snapshot(spark, *at, "product", DAY, "10")
    land_products(spark, at[0], "q-1", ("c", "late"))
    assert newest(spark, at, DAY, "10") == newest(spark, at) == {"a": "a0", "b": "b0", "c": "late"}
    write_snapshot(spark, *at, "product", NEXT, "10")
    assert newest(spark, at) == {"a": "a0", "b": "b0", "c": "late"}
    # The later snapshot holds it: its landed rows are not read again.
    files = newest_until(spark, *at, "product", NEXT, "11").inputFiles()
    assert files and not any("/landed/" in f for f in files)
    # A late row of an older version does not replace a newer one.
    land_products(spark, at[0], "q-2", ("a", "newer"), date=NEXT)
    land_products(spark, at[0], "q-3", ("a", "older"))
    assert newest(spark, at)["a"] == "newer"


def test_a_batch_over_several_slices_is_taken_slice_by_slice(spark, at):
    rows = frame(spark, "product", product("a", "a0"), product("z", "z0"))
    when = F.when(F.col("sku") == "a", DAY).otherwise("2020-01-03")
    from tillroll.sinks.landed import land

    land(rows.withColumns({"date": when, "hour": F.lit("00")}), at[0], "product", "q-7")
    write_snapshot(spark, *at, "product", NEXT, "00")
    assert newest(spark, at) == {"a": "a0"}
    assert newest(spark, at, "2020-01-04") == {"a": "a0", "z": "z0"}
    write_snapshot(spark, *at, "product", "2020-01-04", "00")
    assert newest(spark, at, "2020-01-04") == {"a": "a0", "z": "z0"}
    assert newest(spark, at) == {"a": "a0"}  # as of the first one


def test_landing_queries_with_new_checkpoints(spark, at):
    """Batch numbers of another query start again; they are other batches."""
    land_products(spark, at[0], "one-41", ("a", "a0"))
    write_snapshot(spark, *at, "product", DAY, "10")
    land_products(spark, at[0], "two-0", ("b", "b0"))
    assert newest(spark, at) == {"a": "a0", "b": "b0"}
    record = write_snapshot(spark, *at, "product", DAY, "10")
    assert record["clock"] == {"one": 41, "two": 0}
    assert write_snapshot(spark, *at, "product", DAY, "10") is None  # nothing came since
    assert taken_until(spark, *at, "product", DAY, "10") == record["clock"]


def sizes(snapshots):
    return {f.rsplit("/", 1)[1]: len(glob.glob(f"{f}/part-*")) for f in glob.glob(f"{snapshots}/product/segments/*")}


def test_an_hour_writes_what_is_new(spark, at):
    many = [(f"s{i:05d}", "first") for i in range(5000)]
    land_products(spark, at[0], "q-0", *many)
    base = write_snapshot(spark, *at, "product", DAY, "00")["segments"]
    assert [s["rows"] for s in base] == [5000]
    for n in range(1, 4):
        land_products(spark, at[0], f"q-{n}", (f"s{n:05d}", f"at {n}"), ("new", str(n)), hour=f"{n:02d}")
        held = set(sizes(at[1]))
        record = write_snapshot(spark, *at, "product", DAY, f"{n:02d}")
        [name] = set(sizes(at[1])) - held
        assert record["segments"][-1] == {"name": name, "rows": 2}
        assert record["segments"][:1] == base
    assert newest(spark, at)["new"] == "3" and newest(spark, at, DAY, "02")["new"] == "2"
    # News of over half the base are merged into a new one.
    land_products(spark, at[0], "q-9", *[(f"s{i:05d}", "again") for i in range(3000)], hour="09")
    merged = write_snapshot(spark, *at, "product", DAY, "09")["segments"]
    assert [s["rows"] for s in merged] == [5001]
    assert sum(n == "again" for n in newest(spark, at).values()) == 3000
    files = spark.read.parquet(f"{at[1]}/product/segments/{merged[0]['name']}")
    ranges = files.groupBy(F.input_file_name()).agg(F.min("sku").alias("low"), F.max("sku").alias("high"))
    spans = sorted((r.low, r.high) for r in ranges.collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_old_snapshots_expire(spark, at):
    land_products(spark, at[0], "q-0", *[(f"s{i}", "first") for i in range(10)])
    write_snapshot(spark, *at, "product", DAY, "00")
    for n in range(1, 4):
        land_products(spark, at[0], f"q-{n}", *[(f"s{i}", str(n)) for i in range(6)], hour=f"{n:02d}")
        write_snapshot(spark, *at, "product", DAY, f"{n:02d}")  # each a new base
    before = newest(spark, at)
    assert expire_snapshots(spark, at[1], "product", keep=2) == 0  # too young
    n_before = len(sizes(at[1]))
    assert expire_snapshots(spark, at[1], "product", keep=2, least_hours=0) == n_before - 2
    assert newest(spark, at) == before and len(sizes(at[1])) == 2
    assert last_snapshot(spark, at[1], "product", DAY, "01") is None
    assert last_snapshot(spark, at[1], "product", DAY, "02") == (DAY, "02")
    assert MOST_SEGMENTS > 1


def test_tables_that_landed_before_there_was_a_ledger(spark, at):
    import shutil

    land_products(spark, at[0], "q-0", ("a", "a0"))
    land_products(spark, at[0], "q-1", ("b", "b0"), date=NEXT)
    shutil.rmtree(f"{at[0]}/_ledger")
    record = write_snapshot(spark, *at, "product", NEXT, "10")
    assert record["clock"] == {"q": 1} and newest(spark, at) == {"a": "a0", "b": "b0"}


def test_ledger_of_repeated_batches(spark, at):
    for _ in range(2):
        land_products(spark, at[0], "q-5", ("a", "a0"))
    [entry] = ledger.entries(spark, at[0], "product")
    assert (entry.query, entry.number, entry.slice) == ("q", 5, (DAY, "00"))
    assert ledger.entries(spark, at[0], "product", since="9999-01-01") == []
    empty = frame(spark, "product")
    land_at(empty, at[0], "product", "00", "q-6")
    assert len(ledger.entries(spark, at[0], "product")) == 1


def test_records_appear_whole_and_once(spark, tmp_path):
    folder = f"{tmp_path}/records"
    assert commits.put(spark, f"{folder}/000000000.json", [{"a": 1}])
    assert not commits.put(spark, f"{folder}/000000000.json", [{"a": 2}])
    assert commits.put_next(spark, folder, {"a": 3}) == 1
    assert commits.read_records(spark, folder) == {0: {"a": 1}, 1: {"a": 3}}
    assert commits.read_records(spark, f"{tmp_path}/none") == {}
    assert commits.names_in(spark, folder) == ["000000000.json", "000000001.json"]
