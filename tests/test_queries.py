"""Every registered query against its SQL counterpart in another engine."""

import pytest
from compare import oracle_bag, oracle_connection, spark_bag
from conftest import SF

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = oracle_connection(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want, columns = oracle_bag(duck, ORACLE[name])
    assert sorted(got.columns) == sorted(columns)
    assert spark_bag(got) == want


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_counts_worked_out_beforehand(spark):
    """Counts on the smallest tables that two engines agreed on before there was any code."""
    counts = {
        "product_clean": 193,
        "customer_erased": 185,
        "customer_latest": 148,
        "line_enriched": 5788,
        "curated_running": 272,
        "curated_running_by_day": 5430,
        "curated_per_transaction": 5433,
    }
    assert {n: QUERIES[n](spark, SF).count() for n in counts} == counts


def test_murmur3_masks_the_same_rows_as_sha2(spark):
    from pyspark.sql import functions as F

    from tillroll.operators import customer
    from tillroll.plans import sample_feeds as feeds

    sha = QUERIES["customer_erased"](spark, SF)
    known = customer.known_customers(feeds.customers(spark, SF))
    requests = customer.erasure_requests(feeds.erasures(spark, SF))
    murmur = customer.erase_customers(known, requests, method="murmur3")
    hidden = F.count_if(~F.col("email").contains("@")).alias("n")
    assert sha.agg(hidden).first().n == murmur.agg(hidden).first().n == 3
    seen = F.col("email").contains("@")
    assert spark_bag(sha.where(seen)) == spark_bag(murmur.where(seen))


def test_without_the_text_operators_the_others_remain(monkeypatch):
    """Whether their folder is gone, left empty, or needs a package that is not there."""
    import sys

    from tillroll.plans.catalogue import QUERIES as RETAIL

    monkeypatch.setitem(sys.modules, "tillroll.llm", None)
    assert set(entry_points.queries()) == set(RETAIL)
    assert set(entry_points.oracle_sql()) <= set(RETAIL)


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.count() == 272
