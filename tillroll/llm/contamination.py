"""Benchmark decontamination: rare word pairs as seeds, then Smith-Waterman alignment.

A seed is two words of an item that are neighbours or have one word between them; a document holds it
where the two words are neighbours or have one word between them. Where an alignment has m matches and
e edits, at least m - 1 - e / 2 neighbouring matches have one edit or none between them, and those are
seeds. A score of ``least_score`` thus takes at least least_score * n - 1 seeds of an item of n words,
whichever words were changed, dropped or added, on diagonals at most 2 * n * (1 - least_score) apart.

A share of a short item is a phrase that anybody writes. So a passage must also score as much as
``LEAST_WORDS`` words in order, or as the whole item where that is shorter: an item of up to so many words is
found where it stands whole, each word next to the other. A one-word item is its own seed.

First pass: in how many documents each seed occurs, over the whole corpus. Seeds in more than ``COMMON``
of all documents are left out, the most common first and never more than half of those any alignment
must have. Second pass: where a document holds enough of an item's seeds on near diagonals, the
passage around them is aligned with the item by Smith-Waterman over words. No passage that scores
enough is missed: the result is that of aligning every document with every item.

Test items are taken in blocks of at most ``BLOCK_BYTES`` of text, which is what a task is sent; a
larger benchmark takes more blocks, each read against the whole corpus. Nothing else is broadcast,
texts are not shuffled, and a document's work depends on the document alone, so neither a hot source
nor a popular passage makes a slow task. Only counts and matches leave the tasks.

Words are compared lower-cased (A-Z) and without ASCII punctuation. Null or empty texts and items
match nothing, items without an id are left out, rows that repeat give repeated rows, and columns
beyond ids and texts play no part.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.rolling import BASE, Slices, words_of
from tillroll.llm.tables import keyed_texts, text_bytes, text_rows
from tillroll.operators.lookup import lookup_join

LEAST_SCORE = 0.45
LEAST_WORDS = 6  # in order, or the whole item, that a passage scores as much as
LEAST_ITEM = 3  # words of an item that costs a document its place
BLOCK_BYTES = 16 * 1024 * 1024
MATCH, MISMATCH, GAP = 2, -1, -1
COMMON = 0.01  # of all documents; a seed in more of them may be left out

_TO_WORDS = bytes(
    c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower()
)


def _words(raw: bytes):
    return words_of(raw.translate(_TO_WORDS))


def _seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each two words that are neighbours or have one word between them."""
    n = len(words)
    if n == 1:
        return words, np.zeros(1, np.int64)
    first = words * BASE
    return (
        np.concatenate((first[:-1] + words[1:], first[:-2] + words[2:])),
        np.concatenate((np.arange(n - 1), np.arange(n - 2))),
    )


def least_share(sizes: np.ndarray, least_score: float) -> np.ndarray:
    """The share of its greatest score that a copy of an item of so many words must reach."""
    return np.maximum(least_score, np.minimum(sizes, LEAST_WORDS) / np.maximum(sizes, 1))


class Items:
    """A block of test items: their words, and which seeds they have where."""

    def __init__(self, items: list[tuple[int, bytes]], least_score: float):
        self.ids, self.words, seeds, owners, places = [], [], [], [], []
        for item_id, raw in items:
            joined, starts, ends = _words(raw)
            if not len(starts):
                continue
            words = Slices(joined).hashes(starts, ends)
            h, at = _seeds(words)
            owners.append(np.full(len(h), len(self.ids)))
            seeds.append(h)
            places.append(at)
            self.ids.append(item_id)
            self.words.append(words)
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.share = least_share(sizes, least_score)
        self.singles = bool((sizes == 1).any())
        # A little is taken off before rounding up, as the product may lie just above a whole number.
        must = np.ceil(self.share * sizes - 1e-9).astype(np.int64) - 1
        self.need = np.maximum(must, 1)
        self.reach = np.ceil(2 * (1 - self.share) * sizes).astype(np.int64) + 1
        none = np.zeros(0, np.int64)
        self._take(
            np.concatenate(seeds) if seeds else none.astype(np.uint64),
            np.concatenate(owners) if owners else none,
            np.concatenate(places) if places else none,
        )

    def _take(self, seeds, owners, places) -> None:
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owners, self.places = seeds[order], owners[order], places[order]
        self.known, self.first = np.unique(self.seeds, return_index=True)
        self.stop = np.append(self.first[1:], len(self.seeds))
        # A bit per hash prefix tells most words of a text apart from any seed at once.
        self.bits = max(16, int(len(self.known)).bit_length() + 6)
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(self.known >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``seeds`` that are known, and which they are."""
        at = np.flatnonzero(self.maybe[(seeds >> np.uint64(64 - self.bits)).astype(np.int64)])
        if not len(at) or not len(self.known):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.known, seeds[at]), len(self.known) - 1)
        real = self.known[which] == seeds[at]
        return at[real], which[real]

    def only_rare(self, counts: np.ndarray, n_docs: int) -> None:
        """Leave out common seeds by ``counts`` per known seed, and those that occur nowhere."""
        if not len(self.seeds):
            return
        seen = counts[np.searchsorted(self.known, self.seeds)]
        ranked = np.lexsort((self.places, -seen, self.owners))
        owner = self.owners[ranked]
        place = np.arange(len(ranked)) - np.searchsorted(owner, owner)
        left_out = (place < self.need[owner] // 2) & (seen[ranked] > COMMON * n_docs)
        self.need = self.need - np.bincount(owner[left_out], minlength=len(self.need))
        kept = ranked[~left_out & (seen[ranked] > 0)]
        self._take(self.seeds[kept], self.owners[kept], self.places[kept])


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two sequences of words, and where it ends in the passage."""
    n = len(passage)
    slope = -GAP * np.arange(n + 1)
    above = np.zeros(n + 1, np.int64)
    best, end = 0, 0
    for w in item:
        row = np.maximum(above + GAP, 0)
        np.maximum(row[1:], above[:-1] + np.where(passage == w, MATCH, MISMATCH), out=row[1:])
        # A gap along the passage costs the same per word, so its best start is a running maximum.
        above = np.maximum.accumulate(row + slope) - slope
        top = int(above.argmax())
        if above[top] > best:
            best, end = int(above[top]), top
    return best, end


def _document_seeds(words: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """A document's seeds and their first words; single words too, if an item is one."""
    seeds, first = _seeds(words)
    if not items.singles or len(words) == 1:
        return seeds, first
    return np.concatenate((seeds, words)), np.concatenate((first, np.arange(len(words))))


def _passages(words: np.ndarray, items: Items):
    """(item, begin, stop) of the parts of a document that hold enough of an item's seeds."""
    seeds, first = _document_seeds(words, items)
    at, which = items.hits(seeds)
    if not len(at):
        return
    sizes = items.stop[which] - items.first[which]
    places = np.repeat(first[at], sizes)
    steps = np.arange(len(places)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    entry = np.repeat(items.first[which], sizes) + steps
    owner, diagonal = items.owners[entry], places - items.places[entry]
    # Owner and diagonal as one number, owners farther apart than any diagonals of one may be.
    low = int(diagonal.min())
    span = int(diagonal.max()) - low + 1 + int(items.reach.max())
    ranked = np.sort(owner * span + (diagonal - low))
    owner = ranked // span
    until = np.searchsorted(ranked, ranked + items.reach[owner], side="right")
    dense = np.flatnonzero(until - np.arange(len(ranked)) >= items.need[owner])
    if not len(dense):
        return
    item, begin, stop = -1, 0, 0
    for i in dense.tolist():
        own = int(owner[i])
        size, reach = len(items.words[own]), int(items.reach[own])
        a = max(0, int(ranked[i]) - own * span + low - reach)
        b = min(len(words), int(ranked[until[i] - 1]) - own * span + low + size + reach)
        if own == item and a < stop:
            stop = max(stop, b)
            continue
        if item >= 0:
            yield item, begin, stop
        item, begin, stop = own, a, b
    yield item, begin, stop


def _whole_copies(target: np.ndarray, words: np.ndarray, begin: int, stop: int):
    """The same for an item that must be there whole: from left to right, none overlapping."""
    n = len(target)
    starts = np.arange(begin, stop - n + 1)
    for i, w in enumerate(target):
        starts = starts[words[starts + i] == w]
    free = begin
    for at in starts.tolist():
        if at >= free:
            free = at + n
            yield MATCH * n, at, free


def _copies(target: np.ndarray, words: np.ndarray, begin: int, stop: int, least: float):
    """(score, first, stop) of the copies of an item in [begin, stop), the best first."""
    if least >= MATCH * len(target):
        yield from _whole_copies(target, words, begin, stop)
        return
    parts = [(begin, stop)]
    while parts:
        a, b = parts.pop()
        if MATCH * (b - a) < least:
            continue
        score, end = align(target, words[a:b])
        if score < least or not score:
            continue
        # The same alignment read backwards tells where it begins.
        _, back = align(target[::-1], words[a : a + end][::-1])
        yield score, a + end - back, a + end
        parts += [(a, a + end - back), (a + end, b)]


def _matches(raw: bytes, items: Items):
    """(item id, score, first word, stop) of each passage of a document that copies an item."""
    joined, starts, ends = _words(raw)
    if not len(starts):
        return
    words = Slices(joined).hashes(starts, ends)
    for item, begin, stop in _passages(words, items):
        target = items.words[item]
        top = MATCH * len(target)
        # Scores are whole numbers: a little off the least one lets none below it pass.
        least = items.share[item] * top - 1e-9
        least = top if least > top - 1 else least
        for score, first, end in _copies(target, words, begin, stop, least):
            yield items.ids[item], score / top, first, end


MATCHES = "doc_id bigint, item_id bigint, score double, first int, stop int"


def _counted(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """In how many documents each known seed occurs, and how many there are.

    One number per seed comes back, as columns: those of a block, whose size is bounded.
    """

    def run(batches):
        counts, n_docs = np.zeros(len(items.known), np.int64), 0
        for _, raw in text_rows(batches):
            n_docs += 1
            joined, starts, ends = _words(raw)
            if len(starts):
                words = Slices(joined).hashes(starts, ends)
                _, which = items.hits(_document_seeds(words, items)[0])
                counts[np.unique(which)] += 1
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *seen.tolist()], pa.int64()),
             pa.array([n_docs, *counts[seen].tolist()], pa.int64())], names=["seed", "n"],
        )

    found = keyed_texts(docs).mapInArrow(run, "seed bigint, n bigint")
    sums = found.groupBy("seed").agg(F.sum("n").alias("n")).toArrow()
    seeds, n = (sums.column(c).to_numpy() for c in ("seed", "n"))
    out = np.zeros(len(items.known), np.int64)
    out[seeds[seeds >= 0]] = n[seeds >= 0]
    n_docs = int(n[seeds < 0].sum())
    return out, n_docs


def _block_matches(docs: DataFrame, items: Items) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
         ("first", pa.int32()), ("stop", pa.int32())]
    )

    def run(batches):
        rows = []
        for doc_id, raw in text_rows(batches):
            rows += [(doc_id, *m) for m in _matches(raw, items)]
            if len(rows) > 5000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                rows = []
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return keyed_texts(docs).mapInArrow(run, MATCHES)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """Rows (doc_id, item_id, score, first, stop): passages [first, stop) of words that copy items.

    ``score`` is the alignment's share of the item's greatest score. Passages of one item that lie
    in one document are reported one by one.
    """
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    blocks = max(1, ceil(text_bytes(items) / BLOCK_BYTES))
    numbered = items.select(
        F.col("item_id").cast("bigint"), F.col("text").cast("binary").alias("text"),
        F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"),
    )
    found = []
    for b in range(blocks):
        rows = numbered.where(F.col("block") == b).orderBy("item_id", "text").collect()
        block = Items([(r["item_id"], bytes(r["text"])) for r in rows], least_score)
        block.only_rare(*_counted(docs, block))
        found.append(_block_matches(docs, block))
    return reduce(DataFrame.unionByName, found)


def _n_words(text: Column) -> Column:
    """Words as they are compared here."""
    return F.size(F.filter(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != ""))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, least_item: int = LEAST_ITEM, **options
) -> DataFrame:
    """The documents without a passage that copies a test item of ``least_item`` words or more.

    Shorter items, a word or two, are found by :func:`find_contamination`, but stand in clean texts too.
    Rows are told apart by id and text together, so one without id is judged by its own text.
    """
    marked = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("key"))
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    benchmark = benchmark.where(_n_words(F.col("text")) >= least_item)
    bad = find_contamination(keyed, benchmark, **options).select(F.col("doc_id").alias("bad"))
    clean = lookup_join(marked, bad.distinct(), {"key": "bad"}, "left_anti")
    return clean.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
