"""How far the sources of a language stray from each other in the terms they use.

A term is a run of ASCII letters and characters beyond ASCII, only A-Z lower-cased. A language keeps the
terms that occur in at least ``least_docs`` of its documents. Each source's share of a kept term, in parts
of 10**9, is ``p = 1 + floor(10**9 * (count + 2) / (N + 2 * V))`` with N its occurrences of kept terms and V
their number; two shares are ``floor((p - q)**2 / (p + q))`` apart. All in whole numbers.

Terms are counted per task first, per text in pieces, so that a shuffle sees each once per task and
source. Kept terms are dealt into blocks; in each, every source has a sorted array of (term id, count). Two
sources of a language meet once, unordered, as one co-group per block, where a galloping intersection of
their arrays prices the terms of both, of the first alone and of the second alone. Terms that neither has
cost the same each, so their number does. Blocks add up, and a pair counts both ways. An array goes to as
many tasks as its language has other sources, as the result has a row for each of those pairs.

The language's own shares price single terms: the ten that most exceed them are each source's terms.

Null texts, languages and sources are empty. A source without terms has rows all the same; without kept
terms all distances are 0. Repeated rows count each time; doc_id and other columns play no part. An empty
table has an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.packed import pack, unpack
from tillroll.llm.tables import whole_text
from tillroll.operators.lookup import lookup_join
from tillroll.session import scratch_dir

LEAST_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
HELD_TERMS = 300_000  # that a task holds before it sends them on
BLOCK_ROWS = 1 << 18  # rows of (source, term) that a block of terms is planned for
PIECE = 1 << 22  # bytes of a text that are cut into terms at once
STRIDE = 1024  # ids of the shorter array that are looked up at once

# A-Z as a-z; other letters and bytes beyond ASCII as they are; all else a space.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(raw: bytes):
    """Lists of a text's terms, piece by piece."""
    at = 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        part = raw[at:end].translate(_TERMS)
        if end < len(raw):
            # Up to the last term that surely ends here; a longer one goes on to its end.
            cut = part.rfind(b" ") + 1
            while not cut and end < len(raw):
                end = min(end + PIECE, len(raw))
                part = raw[at:end].translate(_TERMS)
                cut = part.find(b" ") + 1
            if cut:
                part, end = part[:cut], at + cut
        yield part.split()
        at = end


COUNTED = "lang string, source string, term binary, n bigint, n_docs bigint"
_COUNTED = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()),
     ("n", pa.int64()), ("n_docs", pa.int64())]
)


def _count_terms(batches):
    """Per task, how often and in how many documents each term occurs in each source.

    A source sends the empty term once besides, which tells that it is there.
    """
    held, size, told = defaultdict(lambda: (Counter(), Counter())), 0, set()

    def sent():
        for (lang, source), (times, docs) in held.items():
            terms = list(times)
            counts = [times[t] for t in terms], [docs[t] for t in terms]
            if (lang, source) not in told:
                told.add((lang, source))
                terms.append(b"")
                for c in counts:
                    c.append(0)
            names = pa.array([lang] * len(terms)), pa.array([source] * len(terms))
            yield pa.RecordBatch.from_arrays(
                [*names, pa.array(terms, pa.binary()), *map(pa.array, counts)], schema=_COUNTED
            )
        held.clear()

    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in range(2))
        for i, key in enumerate(zip(langs, sources, strict=True)):
            times, docs = held[key]
            size -= len(times)
            own = set()
            for terms in terms_of(batch.column(2)[i].as_py()):
                times.update(terms)
                own.update(terms)
            docs.update(own)
            size += len(times)
            if size > HELD_TERMS:
                yield from sent()
                size = 0
    yield from sent()


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Kept terms per language and source: ``lang, source, term, n``, with ``n_lang`` in the language.

    ``first`` is 1 on one row of each term. A source also has a row with an empty term and no occurrences.
    """
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    texts = docs.select(*named, whole_text().cast("binary").alias("text"))
    # Dealt out by term, so that sources, documents and the language are counted without moving again.
    dealt = texts.mapInArrow(_count_terms, COUNTED).repartition("lang", "term")
    per_source = dealt.groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")
    )
    term = Window.partitionBy("lang", "term")
    return (
        per_source.withColumns(
            {
                "_docs": F.sum("n_docs").over(term),
                "n_lang": F.sum("n").over(term),
                "first": (
                    (F.col("source") == F.min("source").over(term)) & (F.length("term") > 0)
                ).cast("bigint"),
            }
        )
        .where((F.col("_docs") >= least_docs) | (F.length("term") == 0))
        .select("lang", "source", F.col("term").cast("string").alias("term"), "n", "n_lang", "first")
    )


def source_totals(counts: DataFrame) -> DataFrame:
    """Per source: its occurrences of kept terms, its language's, and the number of kept terms."""
    lang = Window.partitionBy("lang")
    return (
        counts.groupBy("lang", "source")
        .agg(F.sum("n").alias("total"), F.sum("first").alias("_first"))
        .withColumns({"lang_total": F.sum("total").over(lang), "v": F.sum("_first").over(lang)})
        .drop("_first")
    )


def share(n: str, total: str, v: str = "v") -> Column:
    """The share of a term with so many occurrences, exactly."""
    return F.expr(f"1 + ({SCALE}BD * ({n} + 2)) div ({total} + 2 * {v})")


def distance(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _shares(counts: np.ndarray, total: int) -> np.ndarray:
    """The same for arrays: three digits at a time, so that no product overflows."""
    rest, out = counts + 2, np.zeros(len(counts), np.int64)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def _distances(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) * (p - q) // (p + q)).sum())


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two sorted arrays of ids agree: places in the one and in the other.

    The longer array is searched from where the last ids were found, in steps that double.
    """
    mine, theirs, at = [], [], 0
    for begin in range(0, len(short), STRIDE):
        part = short[begin : begin + STRIDE]
        step = STRIDE
        while at + step < len(long) and long[at + step - 1] < part[-1]:
            step *= 2
        window = long[at : at + step]
        found = np.searchsorted(window, part)
        same = window[np.minimum(found, len(window) - 1)] == part if len(window) else found < 0
        mine.append(begin + np.flatnonzero(same))
        theirs.append(at + found[same])
        at += int(found[-1])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(mine or none), np.concatenate(theirs or none)


ARRAYS = "lang string, block int, source string, payload binary"


def _sorted_arrays(table: pa.Table) -> pa.Table:
    """Each source's sorted (term id, count) array in one block; ids are the terms' ranks there."""
    terms = pc.dictionary_encode(table.column("term").combine_chunks())
    rank = np.empty(len(terms.dictionary), np.int64)
    rank[pc.sort_indices(terms.dictionary).to_numpy()] = np.arange(len(rank))
    ids = rank[terms.indices.to_numpy()]
    names = pc.dictionary_encode(table.column("source").combine_chunks())
    which, n = names.indices.to_numpy(), table.column("n").to_numpy()
    order = np.lexsort((ids, which))
    cuts = np.flatnonzero(np.diff(which[order])) + 1
    parts = np.split(order, cuts)
    rows = [
        (names.dictionary[int(which[part[0]])].as_py(), pack(ids[part].astype(np.int32), n[part]))
        for part in parts
    ]
    lang, block = table.column("lang")[0].as_py(), table.column("block")[0].as_py()
    return pa.table(
        {
            "lang": pa.array([lang] * len(rows)),
            "block": pa.array([block] * len(rows), pa.int32()),
            "source": pa.array([r[0] for r in rows]),
            "payload": pa.array([r[1] for r in rows], pa.binary()),
        }
    )


PRICED = "lang string, a string, b string, apart bigint, n_terms bigint"
_PRICED = pa.schema(
    [("lang", pa.string()), ("a", pa.string()), ("b", pa.string()),
     ("apart", pa.int64()), ("n_terms", pa.int64())]
)


def _merge(one: pa.Table, other: pa.Table) -> pa.Table:
    """What the terms of one block cost that either source of a pair has, and how many they are."""
    row = (one if one.num_rows else other).slice(0, 1).to_pylist()[0]
    (ids, n), (other_ids, m) = (
        unpack(t.column("payload")[0].as_py()) if t.num_rows else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        for t in (one, other)
    )
    p, q = _shares(n, row["a_size"]), _shares(m, row["b_size"])
    at, there = gallop(ids, other_ids) if len(ids) <= len(other_ids) else gallop(other_ids, ids)[::-1]
    absent = np.zeros(1, np.int64)
    apart = _distances(p[at], q[there])
    apart += _distances(np.delete(p, at), _shares(absent, row["b_size"]))
    apart += _distances(_shares(absent, row["a_size"]), np.delete(q, there))
    n_terms = len(ids) + len(other_ids) - len(at)
    return pa.Table.from_pylist(
        [{"lang": row["lang"], "a": row["a"], "b": row["b"], "apart": apart, "n_terms": n_terms}],
        schema=_PRICED,
    )


def pair_distances(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of every two sources of a language, ``a`` before ``b``."""
    size = F.expr("total + 2 * v")
    one = totals.select("lang", F.col("source").alias("a"), size.alias("a_size"), "v")
    two = totals.select("lang", F.col("source").alias("b"), size.alias("b_size"))
    pairs = one.join(two, "lang").where("a < b")
    rows = counts.where("term <> ''")
    blocks = max(1, ceil(rows.count() / BLOCK_ROWS))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    arrays = (
        rows.select("lang", block.alias("block"), "source", "term", "n")
        .groupBy("lang", "block")
        .applyInArrow(_sorted_arrays, ARRAYS)
    )
    # One task per pair and block; a side that has no term there is missing.
    sides = [
        arrays.withColumnRenamed("source", c).join(pairs.drop("v"), ["lang", c]) for c in ("a", "b")
    ]
    keys = ["lang", "block", "a", "b"]
    one, two = (s.toDF(*s.columns).groupBy(*keys) for s in sides)  # columns of their own
    merged = one.cogroup(two).applyInArrow(_merge, PRICED)
    summed = merged.groupBy("lang", "a", "b").agg(
        F.sum("apart").alias("apart"), F.sum("n_terms").alias("n_terms")
    )
    absent = {
        c: F.expr(f"case when v > 0 then 1 + ({SCALE}BD * 2) div {c[0]}_size end")
        for c in ("a_none", "b_none")
    }
    neither = distance("a_none", "b_none") * (F.col("v") - F.coalesce("n_terms", F.lit(0)))
    value = F.coalesce("apart", F.lit(0)) + F.coalesce(neither, F.lit(0))
    return (
        pairs.join(summed, ["lang", "a", "b"], "left")
        .withColumns(absent)
        .select("lang", "a", "b", value.cast("bigint").alias("value"))
    )


def source_terms(counts: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank`` of the terms whose share most exceeds the language's."""
    own = lookup_join(
        counts.where("term <> ''").withColumns({"_l": F.col("lang"), "_s": F.col("source")}),
        totals,
        {"_l": "lang", "_s": "source"},
    )
    priced = (
        own.withColumns({"p": share("n", "total"), "q": share("n_lang", "lang_total")})
        .where("n > 0 and p > q")
        .select("lang", "source", F.col("term").alias("item"), distance("p", "q").alias("value"))
    )
    return _ranked(priced).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Per source, the distance to every other source of its language, and its own terms.

    ``lang, source, part, item, value, rank``: with part ``pair`` the item is a source, with ``term`` a term.
    Counts are written to a scratch table once, and read for both parts.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "terms")
    term_counts(docs, least_docs).write.parquet(path)
    counts = spark.read.parquet(path)
    totals = source_totals(counts)
    pairs = pair_distances(counts, totals)
    ways = [
        pairs.select("lang", F.col(x).alias("source"), F.col(y).alias("item"), "value")
        for x, y in (("a", "b"), ("b", "a"))
    ]
    columns = ["lang", "source", "part", "item", "value", "rank"]
    apart = _ranked(ways[0].unionByName(ways[1])).withColumn("part", F.lit("pair"))
    terms = source_terms(counts, totals, top).withColumn("part", F.lit("term"))
    return apart.select(*columns).unionByName(terms.select(*columns))


AUDIT_SQL = r"""with d as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
  from documents),
w as (select lang, source, r, unnest(words) as term from d),
kept as (select lang, term from w group by all having count(distinct r) >= 10),
counts as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
dense as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n
  from (select distinct lang, source from d) g join kept k on g.lang = k.lang
    left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
whole as (select lang, term, sum(n) as n from dense group by all),
p as (
  select *, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over s + 2 * count(*) over s)::hugeint as p
  from dense window s as (partition by lang, source)),
q as (
  select lang, term,
    1 + (1000000000::hugeint * (n + 2)) // (sum(n) over s + 2 * count(*) over s)::hugeint as q
  from whole window s as (partition by lang)),
apart as (
  select a.lang, a.source, b.source as item,
    sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
others as (
  select distinct a.lang, a.source, b.source as item from d a join d b
    on a.lang = b.lang and a.source <> b.source),
rows as (
  select o.lang, o.source, 'pair' as part, o.item, coalesce(a.value, 0)::bigint as value
  from others o left join apart a on a.lang = o.lang and a.source = o.source and a.item = o.item
  union all
  select p.lang, p.source, 'term', p.term, ((p - q) * (p - q) // (p + q))::bigint
  from p join q on p.lang = q.lang and p.term = q.term where n > 0 and p > q)
select lang, source, part, item, value,
  (row_number() over (partition by lang, source, part order by value desc, encode(item)))::int as rank
from rows qualify part = 'pair' or rank <= 10"""
