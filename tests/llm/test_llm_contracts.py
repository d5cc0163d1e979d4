"""Registered queries against brute force, on whole small tables."""

import brute
import pytest
from pyspark.sql import functions as F

from tillroll.llm import catalogue, pii, secrets
from tillroll.llm.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_simhash(spark, docs):
    got = catalogue.op1_simhash(spark, SF)
    assert rows(got, "doc_id", "fingerprint", "component_id") == sorted(brute.simhash_rows(docs))


def test_quality_statistics(spark, docs):
    got = catalogue.op2_quality_rules(spark, SF)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(got, "doc_id", *names) == sorted((i, *brute.quality_row(t)) for i, t in docs)
    assert got.where("kept and base_failed").count() == 0


def test_quality_verdicts(spark):
    """The learned list against the plain learner, where there are labels enough for one."""
    sf = SF.replace("0.001", "0.01")
    rows = [tuple(r) for r in read_table(spark, sf, "documents").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in read_table(spark, sf, "labels").select("doc_id", "quality").collect()]
    want = brute.quality_verdicts(rows, labels)
    assert any(rule is not None for _, _, rule in want)
    got = catalogue.op2_quality_rules(spark, sf).select("doc_id", "kept", "rule").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_pii(spark, docs):
    got = catalogue.op3_pii(spark, SF)
    kinds = pii.KINDS[: pii.N_BASE]
    want = sorted((i, *brute.span_row(brute.pii_spans(t), kinds)) for i, t in docs)
    assert rows(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want


def test_secrets(spark, docs):
    got = catalogue.op9_secrets(spark, SF)
    kinds = secrets.KINDS[: secrets.N_BASE]
    want = sorted((i, *brute.span_row(brute.secret_spans(t), kinds)) for i, t in docs)
    assert rows(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want


def test_bpe(spark, docs):
    got = catalogue.op5_chunked_bpe(spark, SF)
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert rows(got, *names) == sorted(brute.bpe_rows(docs))


def test_token_planes(spark, docs):
    got = catalogue.op7_token_planes(spark, SF)
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == brute.token_rows(docs)


def test_substring(spark, docs):
    got = catalogue.op8_substring_dedup(spark, SF)
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows(got, *names) == sorted(brute.substring_rows(docs))


def test_lines(spark, docs):
    got = catalogue.op6_line_dedup(spark, SF)
    assert rows(got, "doc_id", "n_lines", "removed") == sorted(brute.line_rows(docs))
    assert got.where(F.size(F.split("removed", ",")) != F.greatest("n_removed", F.lit(1))).count() == 0


@pytest.mark.parametrize("name", ["op6_line_dedup", "op8_substring_dedup"])
def test_repeats_against_sql(spark, name):
    from compare import oracle_bag, oracle_connection, spark_bag

    con = oracle_connection(SF)
    want, columns = oracle_bag(con, catalogue.ORACLE[name])
    con.close()
    got = catalogue.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns) and spark_bag(got) == want


def test_lines_against_sql_on_edited_lines(spark, tmp_path):
    """Bytes beyond ASCII, edits at both ends, chains of edits, blank and short lines."""
    import duckdb

    line = "Gr\u00fc\u00dfe aus dem Norden, wo der Wind \u00fcber die Felder weht"
    near = [line, "x" + line, line[1:], line.replace("\u00fc", "u", 1), line + "zz", line + "zzyy", line[2:-1]]
    texts = ["\n".join([f"{i} of its own", near[i % 7], "", " \t", "short", near[i * 3 % 7] + " "]) for i in range(12)]
    path = str(tmp_path / "documents.parquet")
    rows = [*enumerate(texts), (50, None), (51, ""), (None, texts[0])]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view documents as from '{path}/*.parquet'")
    names = "doc_id, n_lines, n_removed, removed"
    want = con.sql(f"select {names} from ({catalogue.LINES_SQL})").fetchall()
    got = [tuple(r) for r in catalogue.op6_line_dedup(spark, str(tmp_path)).select(*names.split(", ")).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_sharding_against_sql(spark):
    from compare import oracle_bag, oracle_connection, spark_bag

    from tillroll.llm import sharding

    con = oracle_connection(SF)
    sized = read_table(spark, SF, "documents").select("doc_id", sharding.n_bytes().alias("size"))
    for limit in (20_000, 100_000, 10**9):
        got = sharding.shard(sized, limit, size=F.col("size")).select("doc_id", "n_bytes", "shard")
        want, columns = oracle_bag(con, catalogue.sharding_sql(limit))
        assert sorted(got.columns) == sorted(columns) and spark_bag(got) == want
    con.close()


def test_shards_are_written_and_read_back(spark, monkeypatch):
    from compare import oracle_bag, oracle_connection, spark_bag

    from tillroll.llm import sharding

    monkeypatch.setattr(catalogue, "QUERY_SHARD_BYTES", 20_000)
    got = catalogue.op10_sharding(spark, SF)
    con = oracle_connection(SF)
    want, _ = oracle_bag(con, catalogue.sharding_sql(20_000))
    con.close()
    assert spark_bag(got) == want
    shards = got.groupBy("shard").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")).collect()
    assert len(shards) > 10 and all(r.bytes <= 20_000 or r.n == 1 for r in shards)
    files = [f.rsplit("/", 2)[1] for f in got.inputFiles()]
    assert len(set(files)) == len(shards) and len(files) < 2 * len(shards)
    plan = sharding.shard(read_table(spark, SF, "documents"), 20_000)
    moved = plan._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")
    assert sum("_row#" in part.split("\n")[1] for part in moved[1:]) <= 1  # texts move once
