"""The audit of sources against plain Python, and its parts."""

from collections import Counter

import brute
import numpy as np
from brute import DOCUMENT, crowded
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import divergence
from tillroll.llm.tables import read_table

COLUMNS = ("lang", "source", "part", "item", "value", "rank")
ROWS = [
    (1, "one two ONE", "en", "a"),
    (2, "one two two", "en", "b"),
    (2, "one two two", "en", "b"),  # a row that repeats
    (3, "Été été ÉTÉ one_two 3one", "en", None),
    (4, None, "en", "c"),  # a source without terms
    (5, "\x00\x7f 12 --", "en", "d"),
    (6, "alone", "xx", "a"),  # a language that keeps no term
    (7, "other", "xx", "b"),
    (8, "nobody else", None, None),
    (None, "one two three three", "en", "a"),
    (9, "x" * 50_000 + " one", "en", "a"),
    (10, "日本 日本 one", "en", "e"),
    (11, "one " * 30_000, "en", "a"),
    (12, "", "", "a"),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], DOCUMENT)


def bag(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_audit_edges(spark):
    docs = crowded(table(spark, ROWS)).repartition(4)
    for least in (1, 2, 3, 5):
        got = divergence.audit(docs, least)
        assert bag(got) == Counter(brute.divergence_rows([r[1:] for r in ROWS], least))
    assert divergence.audit(table(spark, [])).count() == 0


def test_small_blocks_and_flushes_change_nothing(spark, monkeypatch):
    """Terms in many blocks, sources with no term in some of them."""
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    want = Counter(
        brute.divergence_rows([tuple(r) for r in docs.select("text", "lang", "source").collect()])
    )
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 2000)
    assert bag(divergence.audit(docs.repartition(5))) == want


def test_terms_are_combined_before_the_shuffle(spark):
    """One word of all texts moves once per task and source, and each term is moved once."""
    rows = [(i, "same " * 50, "en", f"s{i % 3}") for i in range(300)]
    docs = table(spark, rows).repartition(4)
    counts = divergence.term_counts(docs)
    held = counts.where("term = 'same'").collect()
    assert sorted((r.source, r.n, r.n_lang) for r in held) == [(f"s{i}", 5000, 15000) for i in range(3)]
    assert sum(r.first for r in held) == 1
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_long_texts_are_cut_at_terms(monkeypatch):
    raw = ("one two  three4five " + "y" * 300 + " Zoë ").encode() * 20
    whole = [t for part in divergence.terms_of(raw) for t in part]
    for piece in (1, 7, 64, 1000):
        monkeypatch.setattr(divergence, "PIECE", piece)
        assert [t for part in divergence.terms_of(raw) for t in part] == whole


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 20_000), max_size=300), st.sets(st.integers(0, 20_000), max_size=300))
def test_gallop(a, b):
    x, y = (np.array(sorted(s), np.int32) for s in (a, b))
    at, there = divergence.gallop(x, y)
    assert x[at].tolist() == y[there].tolist() == sorted(a & b)


def test_gallop_over_long_arrays():
    rng = np.random.default_rng(2)
    long = np.unique(rng.integers(0, 10**7, 500_000))
    short = np.unique(np.concatenate((rng.choice(long, 3000), rng.integers(0, 10**7, 3000))))
    at, there = divergence.gallop(short, long)
    assert short[at].tolist() == np.intersect1d(short, long).tolist() == long[there].tolist()


def test_shares_are_exact(spark):
    counts = [0, 1, 7, 10**6 + 3, 10**15, 3 * 10**15]
    total = 3 * 10**15 + 17
    want = [1 + 10**9 * (n + 2) // total for n in counts]
    assert divergence._shares(np.array(counts), total).tolist() == want
    rows = spark.createDataFrame([(n, total) for n in counts], "n bigint, total bigint")
    got = rows.select("n", divergence.share("n", "total", "0").alias("p")).collect()
    assert [r.p for r in sorted(got)] == want
    assert rows.where(F.col("n") < 0).count() == 0
