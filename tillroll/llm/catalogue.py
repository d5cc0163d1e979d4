"""One query per operator, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    alignment,
    chunked_bpe,
    contamination,
    divergence,
    lines,
    pii,
    planes,
    quality,
    secrets,
    sharding,
    simhash,
    substring,
    tree_bpe,
)
from tillroll.llm.tables import read_table
from tillroll.session import scratch_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(_documents(spark, sf), read_table(spark, sf, "labels"))
    return judged.select("doc_id", *quality.STATISTICS, "base_failed", "kept", "rule")


def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find_pii(_documents(spark, sf)))


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contamination.find_contamination(
        _documents(spark, sf), read_table(spark, sf, "benchmark")
    )


def op5_chunked_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return chunked_bpe.encode_decode(_documents(spark, sf), BYTE_BPE).drop("ids")


def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lines.count_lines(_documents(spark, sf))


def op7_token_planes(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "ids")
    planes.write_ids(_documents(spark, sf), path, WORD_BPE, end_id=1)
    return planes.read_ids(spark, path, with_ids=False).drop("ids")


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.remove_repeats(_documents(spark, sf), kept_text=False).drop("kept")


def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf))
    return pii.digest(found, secrets.KINDS, secrets.N_BASE)


#: Splits small tables too; :data:`sharding.SHARD_BYTES` is what a library would use for files.
QUERY_SHARD_BYTES = 1024 * 1024


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents written by shard and read back: the shard and the bytes of each."""
    sharded = sharding.shard(_documents(spark, sf), QUERY_SHARD_BYTES).drop("n_bytes")
    path = scratch_dir(spark, "shards")
    sharding.write_shards(sharded, path)
    written = sharding.read_shards(spark, path, sharded.schema)
    return written.select("doc_id", sharding.n_bytes().alias("n_bytes"), "shard")


def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf))


def op12_tree_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return tree_bpe.encode_decode(_documents(spark, sf), MULTI_BPE, with_ids=False).drop("ids")


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(_documents(spark, sf), BYTE_BPE, PIECES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_quality_rules,
        op3_pii,
        op4_decontamination,
        op5_chunked_bpe,
        op6_line_dedup,
        op7_token_planes,
        op8_substring_dedup,
        op9_secrets,
        op10_sharding,
        op11_source_divergence,
        op12_tree_bpe,
        op13_token_alignment,
    )
}


def sharding_sql(limit: int) -> str:
    """The shortest hash prefix of each document that holds no more than the limit."""
    return f"""with sized as (
  select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as h
  from documents),
sums as (
  select depth, h >> (60 - depth)::int as prefix, sum(n_bytes) as bytes
  from sized, range(0, 41) r(depth) group by all),
placed as (
  select doc_id, n_bytes, h, min(depth) as depth
  from sized, sums
  where prefix = h >> (60 - depth)::int and bytes <= {limit} group by all)
select doc_id, n_bytes,
  case when depth = 0 then '' else right(lpad(bin(h >> (60 - depth)::int), 64, '0'), depth::int)
  end as shard
from placed"""


#: Words of a window of 50 that also starts in an earlier document, window by window.
REPEATS_SQL = r"""with docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
windows as (
  select r, doc_id, i, array_to_string(words[i:i + 49], ' ') as w
  from docs, unnest(range(1, len(words) - 48)) s(i)
  where doc_id is not null),
firsts as (select w, min(doc_id) as least from windows group by w having min(doc_id) < max(doc_id)),
hits as (select r, i from windows join firsts using (w) where doc_id > least),
words as (select r, j, words[j] as word from docs, unnest(range(1, len(words) + 1)) s(j)),
judged as (
  select words.r, j, word, count(i) over (
    partition by words.r order by j rows between 49 preceding and current row) > 0 as gone
  from words left join hits on words.r = hits.r and words.j = hits.i),
kept as (
  select r, count(*) as n_words, count_if(gone)::bigint as n_removed,
    string_agg(word, ' ' order by j) filter (not gone) as kept
  from judged group by r)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from docs left join kept using (r)"""

#: Edit distance of all lines of like length, of which one holds a third of the other unchanged.
LINES_SQL = f"""with recursive docs as (
  select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as parts
  from documents),
lines as (
  select r, doc_id, place, trim(parts[place + 1], e' \\t\\n\\x0b\\x0c\\r') as line
  from docs, unnest(range(0, len(parts))) s(place)),
own as (select * from lines where line <> ''),
sized as materialized (
  select line, strlen(line) as n, left(line, length(line) // 3) as head,
    substr(line, length(line) // 3 + 1, length(line) // 3) as middle,
    substr(line, 2 * (length(line) // 3) + 1) as tail
  from (select distinct line from own) where strlen(line) >= {lines.LEAST_BYTES}),
like_long as materialized (
  select a.line as a, a.head, a.middle, a.tail, b.line as b
  from sized a join sized b
  on b.n between a.n and a.n + {lines.MAX_EDITS} and a.line <> b.line),
near as materialized (
  select a, b from like_long where contains(b, head) or contains(b, middle) or contains(b, tail)),
links as (select a, b from near where levenshtein(a, b) <= {lines.MAX_EDITS}),
both_ways as (select a, b from links union select b, a from links),
reached(a, b) as (
  select a, b from both_ways union select reached.a, both_ways.b from reached join both_ways on reached.b = both_ways.a),
classes as (
  select line, coalesce(least(line, min(b)), line) as class
  from (select distinct line from own) left join reached on line = a group by line),
placed as (
  select r, place, row(doc_id is null, doc_id, r, place) as spot,
    min(row(doc_id is null, doc_id, r, place)) over (partition by class) as first
  from own join classes using (line)),
counted as (
  select r, count(*) as n_lines, count_if(spot > first)::bigint as n_removed,
    string_agg(place::varchar, ',' order by place) filter (spot > first) as removed
  from placed group by r)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
  coalesce(removed, '') as removed
from docs left join counted using (r)"""


ORACLE = {
    "op6_line_dedup": LINES_SQL,
    "op8_substring_dedup": REPEATS_SQL,
    "op10_sharding": sharding_sql(QUERY_SHARD_BYTES),
    "op11_source_divergence": divergence.AUDIT_SQL,
}
