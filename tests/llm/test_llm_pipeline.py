"""Each stage against brute force on what the stage before it left, and the run as a whole."""

import brute
import numpy as np
import pytest
from brute import make_documents
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tillroll.llm import contamination, quality
from tillroll.llm.rolling import Slices
from tillroll.llm.tables import read_table
from tillroll.session import scratch_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    """What each stage returns, written and read again, the documents first."""
    out = [read_table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_dir(spark, "stage")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_are_the_five_in_order(outputs):
    assert len(corpus_pipeline.STAGES) == 5
    for df in outputs[1:5]:
        assert df.columns == outputs[0].columns and df.dtypes == outputs[0].dtypes
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run


def test_quality_stage(spark, outputs):
    judged = quality.judge(outputs[0], read_table(spark, SF, "labels"))
    kept = {r.doc_id for r in judged.where("kept").collect()}
    assert texts(outputs[1]) == [(i, t) for i, t in texts(outputs[0]) if i in kept]
    assert not any(brute.quality_row(t)[-1] for _, t in texts(outputs[1]))
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    good = [i for i, t in texts(outputs[0]) if labels.get(i) == 1 and not brute.quality_row(t)[-1]]
    assert set(good) <= kept  # clean documents stay


def test_line_stage(outputs):
    before = texts(outputs[1])
    want = []
    for (i, t), (_, _, removed) in zip(before, brute.line_rows(before), strict=True):
        gone = set(map(int, removed.split(","))) if removed else set()
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        want.append((i, left if not gone or left.strip(" \t\n\x0b\f\r") else ""))
    assert texts(outputs[2]) == want
    lengths = outputs[2].where(F.col("n_chars") != F.char_length("text"))
    assert lengths.count() == 0


def test_near_dedup_stage(outputs):
    before = texts(outputs[2])
    kept = {c for _, _, c in brute.simhash_rows(before)}
    assert texts(outputs[3]) == [(i, t) for i, t in before if i in kept]


def test_decontamination_stage(spark, outputs):
    items = []
    for r in read_table(spark, SF, "benchmark").collect():
        joined, starts, ends = contamination._words(r.text.encode())
        items.append(Slices(joined).hashes(starts, ends))
    clean = []
    for i, t in texts(outputs[3]):
        joined, starts, ends = contamination._words(t.encode())
        words = Slices(joined).hashes(starts, ends) if joined else starts
        scores = [contamination.align(x, words)[0] / (2 * len(x)) for x in items]
        if max(scores) < contamination.LEAST_SCORE:
            clean.append((i, t))
    assert texts(outputs[4]) == clean and len(clean) < outputs[3].count()


def test_encoding_stage(outputs):
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    got = sorted(tuple(r) for r in outputs[5].select(*names).collect())
    assert got == sorted(brute.bpe_rows(texts(outputs[4])))


def test_encoding_stage_returns_the_ids(spark):
    tokenizer = brute.tokenizer("byte_bpe_50k.json")
    rows = [(1, "some words, and some more"), (2, "é€😀 " * 300), (3, "some words, and some more"), (4, None)]
    got = corpus_pipeline.encoding(spark, make_documents(spark, *rows), SF).collect()
    ids = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in got}
    assert ids == {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    assert all(r.n_tokens == len(ids[r.doc_id]) for r in got)


def test_run_returns_the_last_stage(spark, outputs):
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, outputs[5].collect()))


def test_no_documents(spark):
    docs = make_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
