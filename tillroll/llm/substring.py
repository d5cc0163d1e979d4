"""Repeated passages: windows of words that also start in an earlier document.

Super-k-mers: each window of ``window`` words has a minimiser, the least hash of the ``minimiser``
words at any of its places. Consecutive windows that share it travel as one string of words to the
bucket of that hash, so equal windows meet, and words are sent about three times instead of fifty.
A bucket lays its strings out by minimiser and counts windows by their very words.

Hot passages: a task sends a string once with the list of places where it has met it, but at the edges
of a passage each document's string reaches into its own words. Minimisers are therefore counted
first, and those of more than ``HOT`` strings do not go to a bucket: their windows are told apart one by
one, by a 128-bit BLAKE2 digest of their words. The least doc_id per digest is combined before its
shuffle, and only digests of two documents or more are joined back, by a join that splits hot keys.
A task counts ``COUNTED`` strings at a time and leaves out minimisers it met once among them, so a bucket
gets at most ``HOT`` strings of a minimiser and one for each such count. Tasks are sent the ``MOST_HOT``
most frequent of them, 8 MB at any size; a minimiser beyond those has less than one in ``MOST_HOT`` of all
strings. Which way a window goes decides no result.

A document is its doc_id. Rows that repeat are treated alike, as each row's words are compared with
smaller ids only. A row without doc_id keeps all its words and removes none. A null or empty text
has no words. Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.packed import (
    PACKED,
    bucket_count,
    bucket_runs,
    pack,
    packed_batch,
    unpack,
)
from tillroll.llm.rolling import Slices, words_of
from tillroll.llm.tables import shuffle_partitions, text_bytes, whole_text
from tillroll.operators.lookup import lookup_join

WINDOW = 50
MINIMISER = 8
FLUSH_BYTES = 24 * 1024 * 1024
LEVEL = 3
HOT = 10_000  # strings of one minimiser, wherever they lie, that one task may lay out
MOST_HOT = 1 << 20  # minimisers whose windows are told apart one by one
COUNTED = 1_000_000
GROWTH = 3.2  # bytes of super-k-mers per byte of text, to plan buckets with


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    have, least = 1, values
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def _runs(raw: bytes, window: int, minimiser: int):
    """Words, their starts and ends; minimiser's hash, first window and stop of each run of windows."""
    joined, starts, ends = words_of(raw)
    if len(starts) < window:
        return None
    places = len(starts) - minimiser + 1
    hashes = Slices(joined).hashes(starts[:places], ends[minimiser - 1 :])
    least = _least_of(hashes, window - minimiser + 1)
    cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
    begins = np.concatenate(([0], cuts))
    return joined, starts, ends, least[begins], begins, np.append(cuts, len(least))


NONE_HOT = np.zeros(0, np.uint64)


def super_kmers(
    raw: bytes, window: int, minimiser: int, hot: np.ndarray = NONE_HOT, of_hot: bool = False
):
    """(minimiser's hash, first word, words) of every run of windows with one minimiser.

    ``hot`` is ascending; only runs whose minimiser is in it, or only the others, come out.
    """
    found = _runs(raw, window, minimiser)
    if found is None:
        return
    joined, starts, ends, least, begins, stops = found
    if len(hot):
        at = np.minimum(np.searchsorted(hot, least), len(hot) - 1)
        own = (hot[at] == least) == of_hot
        least, begins, stops = least[own], begins[own], stops[own]
    elif of_hot:
        return
    spans = zip(
        least.tolist(), begins.tolist(), starts[begins].tolist(),
        ends[stops - 2 + window].tolist(), strict=True,
    )
    for h, first, a, b in spans:
        yield h, first, joined[a:b]


class _Outgoing:
    """Strings met so far by a task, each with the places it was met at."""

    def __init__(self, buckets: int):
        self.buckets, self.met, self.size = buckets, {}, 0

    def add(self, h: int, words: bytes, doc_id: int, text_hash: int, first: int) -> None:
        places = self.met.get(words)
        if places is None:
            self.met[words] = places = (h, [])
            self.size += len(words) + 120
        places[1].append((doc_id, text_hash, first))
        self.size += 40

    def flush(self) -> pa.RecordBatch:
        strings = list(self.met)
        hashes = np.array([v[0] for v in self.met.values()], np.uint64)
        places = [v[1] for v in self.met.values()]
        to = (hashes >> np.uint64(16)) % np.uint64(self.buckets)
        order, runs = bucket_runs(to)
        numbers, payloads = [], []
        for bucket, begin, end in runs:
            own = order[begin:end].tolist()
            at = np.array([p for i in own for p in places[i]], np.int64)
            numbers.append(bucket)
            payloads.append(
                pack(
                    hashes[own],
                    np.array([len(strings[i]) for i in own], np.int64),
                    np.array([len(places[i]) for i in own], np.int64),
                    np.ascontiguousarray(at[:, 0]),
                    np.ascontiguousarray(at[:, 1]),
                    at[:, 2].astype(np.int32),
                    b"".join([strings[i] for i in own]),
                    level=LEVEL,
                )
            )
        self.met, self.size = {}, 0
        return packed_batch(numbers, payloads)


def _rows(batches):
    """(doc_id, text hash, bytes) one by one."""
    for batch in batches:
        for start in range(0, batch.num_rows, 100):
            columns = [c.to_pylist() for c in batch.slice(start, 100).columns]
            yield from zip(*columns, strict=True)


def _hot_minimisers(texts: DataFrame, window: int, minimiser: int) -> np.ndarray:
    """Hashes, ascending, of the most frequent minimisers among those of more than ``HOT`` strings."""

    def counted(parts):
        values, n = np.unique(np.concatenate(parts), return_counts=True)
        often = n > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(values[often].view(np.int64)), pa.array(n[often], pa.int64())],
            names=["minimiser", "n"],
        )

    def run(batches):
        parts, size = [], 0
        for _, _, raw in _rows(batches):
            found = _runs(raw, window, minimiser)
            if found is not None:
                parts.append(found[3])
                size += len(found[3])
            if size >= COUNTED:
                yield counted(parts)
                parts, size = [], 0
        if parts:
            yield counted(parts)

    counts = texts.mapInArrow(run, "minimiser bigint, n bigint").groupBy("minimiser")
    hot = counts.agg(F.sum("n").alias("n")).where(F.col("n") > HOT)
    most = hot.orderBy(F.desc("n"), "minimiser").limit(MOST_HOT).select("minimiser").toArrow()
    return np.sort(most.column("minimiser").to_numpy().view(np.uint64))


def _scan(window: int, minimiser: int, buckets: int, hot: np.ndarray):
    def run(batches):
        out = _Outgoing(buckets)
        for doc_id, text_hash, raw in _rows(batches):
            for h, first, words in super_kmers(raw, window, minimiser, hot):
                out.add(h, words, doc_id, text_hash, first)
            if out.size > FLUSH_BYTES:
                yield out.flush()
        if out.met:
            yield out.flush()

    return run


def _windows(words: bytes, window: int) -> list[bytes]:
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(words)]
    return [words[a:b] for a, b in zip(starts, ends[window - 1 :], strict=False)]


def _repeats_of_group(strings: dict[bytes, list], window: int, out: list) -> None:
    """Covered words, as (doc_id, text hash, first, end), among the strings of one minimiser."""
    cut = {s: _windows(s, window) for s in strings}
    least_doc: dict[bytes, int] = {}
    for s, places in strings.items():
        doc = min(p[0] for p in places)
        for w in cut[s]:
            if least_doc.get(w, doc) >= doc:
                least_doc[w] = doc
    for s, places in strings.items():
        firsts = np.array([least_doc[w] for w in cut[s]], np.int64)
        top, n = int(firsts.max()), len(firsts)
        for doc, text_hash, first in places:
            if doc > top:
                out.append((doc, text_hash, first, first + n - 1 + window))
                continue
            hit = np.flatnonzero(firsts < doc)
            if not len(hit):
                continue
            for run in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
                begin, end = int(run[0]), int(run[-1]) + window
                out.append((doc, text_hash, first + begin, first + end))


RANGES = "doc_id bigint, text_hash bigint, first int, stop int"


def _count(window: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int32()), ("stop", pa.int32())]
    )

    def run(table: pa.Table) -> pa.Table:
        got = [unpack(p) for p in table.column("payload").to_pylist()]
        hashes = np.concatenate([g[0] for g in got])
        lengths = np.concatenate([g[1] for g in got])
        counts = np.concatenate([g[2] for g in got])
        docs, texts, firsts = (np.concatenate([g[i] for g in got]) for i in (3, 4, 5))
        blob = b"".join([g[6] for g in got])
        del got
        ends = np.cumsum(lengths)
        until = np.cumsum(counts)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(ranked)) + 1, [len(ranked)])).tolist()
        out: list[tuple] = []
        for a, b in pairwise(cuts):
            if b - a == 1 and counts[order[a]] == 1:
                continue
            strings: dict[bytes, list] = defaultdict(list)
            for i in order[a:b].tolist():
                words = blob[ends[i] - lengths[i] : ends[i]]
                at = slice(until[i] - counts[i], until[i])
                strings[words] += zip(
                    docs[at].tolist(), texts[at].tolist(), firsts[at].tolist(), strict=True
                )
            if len({p[0] for places in strings.values() for p in places}) > 1:
                _repeats_of_group(strings, window, out)
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


HOT_WINDOWS = "digest binary, doc_id bigint, text_hash bigint, first int"


def _hot_windows(window: int, minimiser: int, hot: np.ndarray):
    schema = pa.schema(
        [("digest", pa.binary()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int32())]
    )

    def batch(rows):
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches):
        rows, digests = [], {}
        for doc_id, text_hash, raw in _rows(batches):
            for _, first, words in super_kmers(raw, window, minimiser, hot, of_hot=True):
                own = digests.get(words)
                if own is None:
                    if len(digests) >= 5000:
                        digests.clear()
                    own = [hashlib.blake2b(w, digest_size=16).digest() for w in _windows(words, window)]
                    digests[words] = own
                rows += [(d, doc_id, text_hash, first + i) for i, d in enumerate(own)]
            if len(rows) > 20_000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    return run


def _as_runs(window: int):
    """Windows of one document that overlap or touch, as far as a batch holds them, as one range."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            docs, texts, firsts = (c.to_numpy() for c in batch.columns)
            order = np.lexsort((firsts, texts, docs))
            docs, texts, firsts = docs[order], texts[order], firsts[order]
            apart = (np.diff(firsts) > window) | (docs[1:] != docs[:-1]) | (texts[1:] != texts[:-1])
            begins = np.concatenate(([0], np.flatnonzero(apart) + 1))
            last = np.append(begins[1:], len(docs)) - 1
            stops = (firsts[last] + window).astype(np.int32)
            arrays = [pa.array(a) for a in (docs[begins], texts[begins], firsts[begins], stops)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_hash", "first", "stop"])

    return run


def _hot_ranges(texts: DataFrame, window: int, minimiser: int, hot: np.ndarray) -> DataFrame:
    """Ranges to remove among the windows of hot minimisers."""
    windows = texts.mapInArrow(_hot_windows(window, minimiser, hot), HOT_WINDOWS)
    ids = windows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = ids.where(F.col("least") < F.col("most")).select(F.col("digest").alias("d"), "least")
    met = lookup_join(windows, shared, {"digest": "d"}).where(F.col("doc_id") > F.col("least"))
    return met.select("doc_id", "text_hash", "first").mapInArrow(_as_runs(window), RANGES)


def repeated_ranges(
    docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER
) -> DataFrame:
    """Ranges of words [first, stop) to remove, by ``doc_id`` and ``text_hash``; they may overlap."""
    minimiser = min(minimiser, window)
    known = docs.where(F.col("doc_id").isNotNull())
    least = 4 * shuffle_partitions(docs)
    buckets = bucket_count(text_bytes(docs) * GROWTH, least)
    texts = known.select(
        F.col("doc_id").cast("bigint"),
        F.xxhash64(whole_text()).alias("text_hash"),
        whole_text().cast("binary").alias("text"),
    )
    hot = _hot_minimisers(texts, window, minimiser)
    strings = texts.mapInArrow(_scan(window, minimiser, buckets, hot), PACKED)
    ranges = strings.groupBy("bucket").applyInArrow(_count(window), RANGES)
    return ranges.unionByName(_hot_ranges(texts, window, minimiser, hot)) if len(hot) else ranges


def _kept_words(raw: bytes, ranges: list) -> tuple[list[bytes], int]:
    words = raw.split()
    if not ranges:
        return words, 0
    gone = np.zeros(len(words), bool)
    for r in ranges:
        gone[r["first"] : r["stop"]] = True
    keep = np.flatnonzero(~gone).tolist()
    return [words[i] for i in keep], len(words) - len(keep)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, kept_text: bool = True
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``, ``kept``.

    ``kept`` is the text that stays; without ``kept_text`` it is not sent back and null.
    """
    ranges = repeated_ranges(docs, window, minimiser)
    by_doc = ranges.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("first", "stop")).alias("ranges")
    )
    texts = docs.select(
        F.col("doc_id").cast("bigint"), F.xxhash64(whole_text()).alias("text_hash"),
        whole_text().cast("binary").alias("text"),
    )
    met = lookup_join(texts, by_doc, {"doc_id": "doc_id", "text_hash": "text_hash"}, "left")
    fields = [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()), ("kept", pa.string()),
    ]
    schema = pa.schema(fields)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                rows = []
                columns = [c.to_pylist() for c in batch.slice(start, 200).columns]
                for doc_id, raw, ranges in zip(*columns, strict=True):
                    kept, gone = _kept_words(raw, ranges)
                    text = b" ".join(kept)
                    rows.append(
                        (doc_id, len(kept) + gone, gone, hashlib.sha256(text).hexdigest(),
                         text.decode() if kept_text else None)
                    )
                arrays = [
                    pa.array(c, f.type)
                    for c, f in zip(zip(*rows, strict=True), schema, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return met.select("doc_id", "text", "ranges").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    )
