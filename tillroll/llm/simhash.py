"""Near-duplicates by SimHash, found with vantage-point trees.

Distinct fingerprints are parted by their Hamming distance to vantage points: those within the
median distance m go left, the others right, and those closer to the border than the radius go both
ways. If two fingerprints differ in at most ``radius`` bits, their distances to the vantage point do
too, so sending the left ones beyond ``m - radius`` to the right as well brings every such pair
together in some leaf. Each leaf is a shard that is searched by a tree of its own; what comes out are
links that span its groups, not all pairs. Components of the links are the near-duplicates.

The vantage points come from a sample of at most ``Tree.sample`` fingerprints. It decides how shards
are cut and nothing else: every fingerprint goes through the tree, and a shard of any size is
searched exactly.

A null or empty text has the fingerprint zero. A row without doc_id is linked by its text like any
other, and is never the smallest. Rows that repeat share a fingerprint. Columns beyond doc_id and
text play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.rolling import words_of
from tillroll.llm.tables import shuffle_partitions, whole_text
from tillroll.operators.lookup import lookup_join
from tillroll.session import scratch_dir

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42


@dataclass(frozen=True)
class Tree:
    """How fingerprints are parted: what a shard should hold, what a leaf compares outright."""

    sample: int = 32768
    shard_rows: int = 16384
    leaf_rows: int = 1024


def fingerprint(raw: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes; no words, no bits."""
    joined, starts, ends = words_of(raw.lower())  # bytes.lower() changes A-Z only
    n = len(starts)
    if not n:
        return 0
    last = ends[min(n, shingle_words) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), last, strict=False)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``tie`` (a hash of the text) and ``fp``, the fingerprint as a signed number."""
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                ids, ties, texts = batch.slice(start, 500).columns
                fps = [fingerprint(raw, shingle_words) for raw in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [ids, ties, pa.array(np.array(fps, np.uint64).view(np.int64))], schema=schema
                )

    texts = docs.select(
        F.col("doc_id").cast("bigint"), F.xxhash64(whole_text()).alias("tie"),
        whole_text().cast("binary").alias("text"),
    )
    return texts.mapInArrow(run, "doc_id bigint, tie bigint, fp bigint")


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _split(points: np.ndarray, radius: int, seed: int) -> tuple[np.uint64, int] | None:
    """The vantage point and distance that part ``points`` with the least overlap, if any does."""
    rng = np.random.default_rng(seed)
    best, chosen = 0.9 * len(points), None
    for v in points[rng.integers(0, len(points), 6)]:
        d = np.bitwise_count(points ^ v)
        m = int(np.median(d))
        larger = max(int((d <= m).sum()), int((d > m - radius).sum()))
        if larger < best:
            best, chosen = larger, (v, m)
    return chosen


def grow_tree(points: np.ndarray, leaf: float, radius: int, seed: int = 0) -> list | None:
    """[vantage point, distance, left, right] down to leaves (None) of about ``leaf`` points."""
    if len(points) <= max(leaf, 8):
        return None
    found = _split(points, radius, seed)
    if found is None:
        return None
    v, m = found
    d = np.bitwise_count(points ^ v)
    left, right = points[d <= m], points[d > m - radius]
    return [v, m, grow_tree(left, leaf, radius, seed + 1), grow_tree(right, leaf, radius, seed + 2)]


def leaves_of(tree: list | None, points: np.ndarray, radius: int, path: int = 1):
    """(leaf, places) of all leaves that the points belong to, or come close to."""
    stack = [(tree, np.arange(len(points)), path)]
    while stack:
        node, places, path = stack.pop()
        if not len(places):
            continue
        if node is None:
            yield path, places
            continue
        v, m, left, right = node
        d = np.bitwise_count(points[places] ^ v)
        stack.append((left, places[d <= m], 2 * path))
        stack.append((right, places[d > m - radius], 2 * path + 1))


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking places a and b; equal labels mean linked, the least place wins."""
    while True:
        least = np.minimum(labels[a], labels[b])
        if (labels[a] == least).all() and (labels[b] == least).all():
            return labels
        for side in (a, b):
            np.minimum.at(labels, labels[side], least)
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels = shorter


def _all_pairs(points: np.ndarray, places: np.ndarray, labels: np.ndarray, radius: int):
    own = points[places]
    for at in range(0, len(own), 256):
        part = own[at : at + 256]
        near = np.bitwise_count(part[:, None] ^ own[None, at:]) <= radius
        i, j = np.nonzero(near)
        labels = _joined(labels, places[at + i], places[at + j])
    return labels


def _common_neighbours(points: np.ndarray, places: np.ndarray, labels: np.ndarray):
    """For a radius of 2: fingerprints at most 2 bits apart share one at most 1 bit from both.

    Linear in the number of points, however close they lie. For points too dense to be parted.
    Keys are worked off in classes, so that memory stays that of some ten thousand points.
    """
    own = points[places]
    flips = np.append(np.uint64(1) << np.arange(64, dtype=np.uint64), np.uint64(0))
    classes = np.uint64(1 + len(own) // 32768)
    for c in range(int(classes)):
        found = []
        for flip in flips:
            keys = own ^ flip
            at = np.flatnonzero(keys % classes == np.uint64(c))
            found.append((keys[at], places[at]))
        keys, owner = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        same = np.flatnonzero(keys[1:] == keys[:-1])
        labels = _joined(labels, owner[same], owner[same + 1])
    return labels


def search(points: np.ndarray, radius: int, leaf_rows: int) -> np.ndarray:
    """The place of the least linked point for each of the distinct, ascending ``points``."""
    labels = np.arange(len(points))
    stack = [(labels.copy(), 0)]
    while stack:
        places, seed = stack.pop()
        if len(places) <= leaf_rows:
            labels = _all_pairs(points, places, labels, radius)
            continue
        found = _split(points[places], radius, seed)
        if found is None:
            dense = radius == 2 and len(places) > 4 * leaf_rows
            labels = (
                _common_neighbours(points, places, labels)
                if dense
                else _all_pairs(points, places, labels, radius)
            )
            continue
        v, m = found
        d = np.bitwise_count(points[places] ^ v)
        stack += [(places[d <= m], seed + 1), (places[d > m - radius], seed + 2)]
    return labels


def fingerprint_links(distinct: DataFrame, radius: int = MAX_BITS, tree: Tree = Tree()) -> DataFrame:
    """Links (a, b) that span the groups of distinct fingerprints ``fp`` within ``radius`` bits."""
    n = distinct.count()
    drawn = distinct.orderBy(F.xxhash64("fp"), "fp").limit(tree.sample).collect()
    sample = np.array([r.fp for r in drawn], np.int64).view(np.uint64)
    root = grow_tree(sample, tree.shard_rows * len(sample) / max(n, 1), radius)

    def place(batches):
        schema = pa.schema([("shard", pa.int64()), ("fp", pa.int64())])
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False)
            for leaf, places in leaves_of(root, points.view(np.uint64), radius):
                yield _batch(schema, np.full(len(places), leaf), points[places])

    def link(table: pa.Table) -> pa.Table:
        points = np.unique(table.column("fp").to_numpy().view(np.uint64))
        labels = search(points, radius, tree.leaf_rows)
        linked = np.flatnonzero(labels != np.arange(len(points)))
        signed = points.view(np.int64)
        return pa.table({"a": signed[linked], "b": signed[labels[linked]]})

    shards = distinct.select("fp").mapInArrow(place, "shard bigint, fp bigint")
    return shards.groupBy("shard").applyInArrow(link, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    tree: Tree = Tree(),
) -> DataFrame:
    """One row per document: ``doc_id``, ``tie``, ``fp``, ``component_id``, the least doc_id reachable.

    ``group`` is the least fingerprint reachable, which also names groups without any doc_id.
    Fingerprints are written once, as everything after them is small beside the texts.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "fingerprints")
    fingerprints(docs, shingle_words).write.parquet(path)
    marked = spark.read.parquet(path)
    path = scratch_dir(spark, "distinct")
    marked.groupBy("fp").agg(F.min("doc_id").alias("least")).write.parquet(path)
    distinct = spark.read.parquet(path)
    spread = distinct.repartition(shuffle_partitions(docs), "fp")
    linked = components(fingerprint_links(spread, max_bits, tree))
    whole = distinct.join(linked, distinct.fp == linked.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    first = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    named = lookup_join(whole.select("fp", "component"), first, {"component": "component"})
    return lookup_join(marked, named, {"fp": "fp"}).select(
        "doc_id", "tie", "fp", "component_id", F.col("component").alias("group")
    )


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One document, all columns, of each group of near-duplicates: that of the least doc_id.

    Among rows of that id, the one with the least hash of its text; of rows that repeat, one.
    """
    found = near_duplicates(docs, shingle_words, max_bits)
    firsts = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = firsts.groupBy("group").agg(
        F.first("component_id").alias("first_id"), F.min("tie").alias("first_tie")
    )
    marked = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"),
        F.xxhash64(whole_text()).alias("tie"),
    )
    keys = {"id": "first_id", "tie": "first_tie"}
    kept = lookup_join(
        marked, chosen.select(*keys.values()).distinct(), keys, "left_semi", nulls_match=True
    )
    kept = kept.dropDuplicates(["id", "tie"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def hex_digits(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
