"""Line de-duplication: lines within a few edits of an earlier line, by a segment-partition join.

A line of length l is split into ``max_edits + 1`` segments. Lines within ``max_edits`` of each other
share at least one segment: the longer one holds some segment of the shorter one, at a place that the
difference in length and the segment's number allow. So every line leaves its segments in an index,
by length, number and content, and probes the index of its own length and of each length down to
``max_edits`` less with its substrings at those places. Lines that meet are candidates; a banded
bit-parallel edit distance decides. What comes out are links that span the groups; components of
the links, with lines that are equal, are the classes of lines.

Index entries and probes are twelve bytes in packed buckets: part of a hash, and the line's hash.
Only lines that meet are looked up as texts. A group of many lines is cut into blocks, and pairs of
blocks are checked as tasks of their own.

Lines are the parts between line breaks without white space at their ends; edits are counted in
UTF-8 bytes. Blank lines are no lines and always stay. Lines shorter than ``least_bytes`` are only
compared for equality. Null and empty texts have no lines. "Earlier" goes by doc_id, then text, then
place; a row without doc_id comes after all others. Rows that repeat are told apart by nothing,
so both keep and lose the same lines. Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.packed import PACKED, bucket_count, bucket_runs, pack, packed_batch, unpack
from tillroll.llm.rolling import Slices, mixed
from tillroll.llm.tables import SPACES, shuffle_partitions, text_bytes, text_rows, whole_text
from tillroll.operators.lookup import lookup_join
from tillroll.session import scratch_dir

MAX_EDITS = 2
LEAST_BYTES = 32
FLUSH_BYTES = 16 * 1024 * 1024
HASH_BYTES = 1024 * 1024  # of lines hashed at once
RECORDS_PER_BYTE = 0.6  # bytes of records per byte of text, to plan buckets with
FILTER_BITS = 27  # of the bitmap of candidate lines that every task is sent: 16 MB at any size
BLOCK = 1024  # lines of a group that are checked together
_WHITE = SPACES.encode()


def lines_of(raw: bytes) -> list[tuple[int, bytes]]:
    """(number, line) of the lines that are not blank."""
    return [(i, s) for i, x in enumerate(raw.split(b"\n")) if (s := x.strip(_WHITE))]


def line_hash(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line)


def _segment(lengths: np.ndarray, number: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the segment of that number starts in lines of those lengths, and its length.

    Segments are as even as can be; the longer ones come last.
    """
    base, longer = lengths // parts, lengths % parts
    first_longer = parts - longer
    return number * base + np.maximum(0, number - first_longer), base + (number >= first_longer)


def _places(max_edits: int) -> list[tuple[int, int, int]]:
    """(difference in length, segment, shift) of all substrings a line probes with.

    With i segments before it, a segment can have moved by at most i places if at most i edits lie
    before it, and by at most max_edits - i from the line's other end; if both fail, another segment
    is intact.
    """
    out = []
    for less in range(max_edits + 1):
        for i in range(max_edits + 1):
            low = max(-i, less - (max_edits - i))
            high = min(i, less + (max_edits - i))
            out += [(less, i, shift) for shift in range(low, high + 1)]
    return out


def segment_keys(lines: list[bytes], max_edits: int, least_bytes: int):
    """(line, key, is a probe) arrays of all index entries and probes of the lines.

    An entry stands for the probe of the same length and place as well.
    """
    parts = max_edits + 1
    lengths = np.array([len(x) for x in lines], np.int64)
    starts = np.cumsum(lengths) - lengths
    slices = Slices(b"".join(lines))
    out = []
    for less, i, shift in _places(max_edits):
        length = lengths - less
        at, size = _segment(length, i, parts)
        at = at + shift
        ok = np.flatnonzero((length >= least_bytes) & (at >= 0) & (at + size <= lengths))
        if not len(ok):
            continue
        begin = starts[ok] + at[ok]
        hashed = slices.hashes(begin, begin + size[ok])
        salt = (length[ok].astype(np.uint64) << np.uint64(8)) + np.uint64(i)
        key = mixed(hashed + mixed(salt))
        out.append((ok, key, np.full(len(ok), not (less == 0 and shift == 0))))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(bool)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def within_edits(a: bytes, b: bytes, max_edits: int) -> bool:
    """Whether the edit distance of two byte strings is at most ``max_edits``.

    One integer per number of errors d holds the band of the current column: bit t tells whether
    the first j of b and the first j + t - max_edits of a are within d edits.
    """
    if abs(len(a) - len(b)) > max_edits:
        return False
    # Equal ends never cost an edit.
    n = min(len(a), len(b))
    head = _common(a, b, n)
    a, b, n = a[head:], b[head:], n - head
    tail = _common(a[::-1], b[::-1], n) if n else 0
    if tail:
        a, b = a[:-tail], b[:-tail]
    k, m = max_edits, len(a)
    full = (1 << (2 * k + 1)) - 1
    band = [((1 << (d + 1)) - 1) << k for d in range(k + 1)]  # column 0: the first i of a cost i
    for j, c in enumerate(b, 1):
        equal = 0
        for t in range(max(0, k + 1 - j), min(2 * k, m - j + k) + 1):
            if a[j + t - k - 1] == c:
                equal |= 1 << t
        before = band[0]
        band[0] = now = before & equal
        for d in range(1, k + 1):
            old = band[d]
            now = ((old & equal) | before | (before >> 1) | (now << 1)) & full
            band[d], before = now, old
        if not band[k]:
            return False
    return bool(band[k] >> (m - len(b) + k) & 1)


def _common(a: bytes, b: bytes, n: int) -> int:
    """Length of the common beginning of two strings, up to n."""
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _send_keys(buckets: int, max_edits: int, least_bytes: int):
    def records(lines: dict[int, bytes]):
        hashes, texts, size = [], [], 0
        for h, line in lines.items():
            hashes.append(h)
            texts.append(line)
            size += len(line)
            if size > HASH_BYTES:
                yield np.array(hashes, np.uint64), texts
                hashes, texts, size = [], [], 0
        if texts:
            yield np.array(hashes, np.uint64), texts

    def flush(lines: dict[int, bytes]) -> pa.RecordBatch:
        refs, keys, probes = [], [], []
        for hashes, texts in records(lines):
            line, key, probe = segment_keys(texts, max_edits, least_bytes)
            refs.append(hashes[line])
            keys.append(key)
            probes.append(probe)
        ref, key, probe = (np.concatenate(x) for x in (refs, keys, probes))
        order, runs = bucket_runs(((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
        short = (key & np.uint64(0xFFFFFFFE)).astype(np.uint32) | probe
        ref, short = ref[order], short[order].astype(np.uint32)
        return packed_batch(
            [b for b, _, _ in runs], [pack(short[x:y], ref[x:y]) for _, x, y in runs]
        )

    def run(batches):
        lines, size = {}, 0
        for _, raw in text_rows(batches):
            for _, line in lines_of(raw):
                if len(line) >= least_bytes:
                    h = line_hash(line)
                    if h not in lines:
                        lines[h] = line
                        size += len(line) + 200
            if size > FLUSH_BYTES:
                yield flush(lines)
                lines, size = {}, 0
        if lines:
            yield flush(lines)

    return run


GROUPS = "grp bigint, line bigint, probe boolean"


def _meet(table: pa.Table) -> pa.Table:
    """Groups of lines with one key: at least two lines, and an index entry among them."""
    bucket = table.column("bucket")[0].as_py()
    got = [unpack(p) for p in table.column("payload").to_pylist()]
    short = np.concatenate([g[0] for g in got])
    refs = np.concatenate([g[1] for g in got])
    order = np.lexsort((refs, short))  # entries before probes of a key are told apart by the last bit
    short, refs = short[order], refs[order]
    fresh = np.ones(len(short), bool)
    fresh[1:] = (short[1:] != short[:-1]) | (refs[1:] != refs[:-1])
    short, refs = short[fresh], refs[fresh]
    key, probe = short >> np.uint32(1), (short & np.uint32(1)).astype(bool)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
    sizes = np.diff(cuts)
    entries = np.add.reduceat(~probe, cuts[:-1]) if len(key) else sizes
    wanted = np.repeat((sizes > 1) & (entries > 0), sizes)
    # A line that probes its own entry is no pair.
    group = np.repeat(np.arange(len(sizes)), sizes)[wanted]
    refs, key, probe = refs[wanted], key[wanted], probe[wanted]
    if len(group):
        starts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1))
        other = np.minimum.reduceat(refs, starts) != np.maximum.reduceat(refs, starts)
        keep = np.repeat(other, np.diff(np.append(starts, len(group))))
        refs, key, probe = refs[keep], key[keep], probe[keep]
    name = (np.uint64(bucket) << np.uint64(32)) + key.astype(np.uint64)
    return pa.table({"grp": name.view(np.int64), "line": refs.view(np.int64), "probe": probe})


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """A bit for each value of the first ``FILTER_BITS`` bits of a hash, set where a wanted line has it.

    Its size is the same however many lines are wanted; it comes back in pieces of 4 kB.
    """
    value = F.expr(f"shiftrightunsigned(line, {64 - FILTER_BITS}) + 1")
    pieces = wanted.groupBy(F.bitmap_bucket_number(value).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")
    )
    found = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    rows = pieces.toArrow()
    for piece, bits in zip(rows.column("piece").to_pylist(), rows.column("bits"), strict=True):
        raw = np.frombuffer(bits.as_buffer(), np.uint8)
        found[(piece - 1) * len(raw) : piece * len(raw)] = raw
    return found


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``line`` and ``text`` of the wanted line hashes, and of others that a bitmap lets through.

    Only these leave the tasks that read them. With n lines wanted, about one in 2**FILTER_BITS / n of the
    others is let through; the join that follows drops it.
    """
    known = _bitmap(wanted)
    schema = pa.schema([("line", pa.int64()), ("text", pa.binary())])

    def batch(lines: dict[int, bytes]) -> pa.RecordBatch:
        hashes = np.array(list(lines), np.uint64)
        texts = list(lines.values())
        at = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        keep = np.flatnonzero(known[at >> 3] >> (at & 7).astype(np.uint8) & 1)
        hashes, texts = hashes[keep], [texts[i] for i in keep.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(texts, pa.binary())], schema=schema
        )

    def run(batches):
        lines, size = {}, 0
        for _, raw in text_rows(batches):
            for _, line in lines_of(raw):
                h = line_hash(line)
                if h not in lines:
                    lines[h] = line
                    size += len(line) + 200
            if size > FLUSH_BYTES:
                yield batch(lines)
                lines, size = {}, 0
        if lines:
            yield batch(lines)

    texts = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    return texts.mapInArrow(run, "line bigint, text binary").distinct()


LINKS = "a string, b string"


def node_of(line: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(line)


def _close_pairs(lines: list[bytes], entries: int, max_edits: int):
    """Pairs of places, the first among the ``entries`` that come first, that may be close enough.

    An edit changes how often bytes occur by two at most, which tells most other pairs apart.
    """
    few = len(lines) <= 16
    counts = None if few else np.array(
        [np.bincount(np.frombuffer(x, np.uint8) & 63, minlength=64) for x in lines], np.int32
    )
    for at in range(entries):
        if few:
            yield from ((at, to) for to in range(at + 1, len(lines)))
        else:
            apart = np.abs(counts[at + 1 :] - counts[at]).sum(axis=1)
            yield from ((at, at + 1 + int(k)) for k in np.flatnonzero(apart <= 2 * max_edits))


def _check(max_edits: int):
    """Links that span the lines of each group (or pair of blocks of one) within ``max_edits``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("i", "ascending"), ("j", "ascending")])
        groups = table.column("grp").to_numpy()
        blocks = [table.column(c).to_numpy() for c in ("i", "j", "block")]
        texts, probes = table.column("text").to_pylist(), table.column("probe").to_pylist()
        moved = (np.diff(groups) != 0) | (np.diff(blocks[0]) != 0) | (np.diff(blocks[1]) != 0)
        cuts = [0, *(np.flatnonzero(moved) + 1).tolist(), len(groups)]
        links: dict[tuple[str, str], None] = {}
        tried: set[tuple[bytes, bytes]] = set()
        for x, y in pairwise(cuts):
            members = sorted(range(x, y), key=lambda r: (probes[r], texts[r]))
            root = {texts[r]: texts[r] for r in members}

            def find(t: bytes, root=root) -> bytes:
                while root[t] != t:
                    root[t] = root[root[t]]
                    t = root[t]
                return t

            apart = blocks[0][x] != blocks[1][x]
            own = [texts[r] for r in members]
            for at, to in _close_pairs(own, sum(not probes[r] for r in members), max_edits):
                if apart and blocks[2][members[at]] == blocks[2][members[to]]:
                    continue  # checked within their own block
                a, b = own[at], own[to]
                if a == b or find(a) == find(b):
                    continue
                pair = (a, b) if a < b else (b, a)
                if pair in tried:
                    continue
                tried.add(pair)
                if within_edits(a, b, max_edits):
                    root[find(b)] = find(a)
                    links[node_of(a), node_of(b)] = None
        return pa.table(
            [pa.array([k[i] for k in links], pa.string()) for i in (0, 1)], names=["a", "b"]
        )

    return run


def line_links(
    docs: DataFrame, max_edits: int = MAX_EDITS, least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """Links (a, b), by ``node_of``, that span the groups of different lines within ``max_edits``."""
    spark = docs.sparkSession
    buckets = bucket_count(text_bytes(docs) * RECORDS_PER_BYTE, 4 * shuffle_partitions(docs))
    texts = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    keys = texts.mapInArrow(_send_keys(buckets, max_edits, least_bytes), PACKED)
    path = scratch_dir(spark, "candidates")
    keys.groupBy("bucket").applyInArrow(_meet, GROUPS).write.parquet(path)
    met = spark.read.parquet(path)
    found = _texts_of(docs, met.select("line").distinct())
    sizes = met.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    sized = lookup_join(met, sizes, {"grp": "grp"})
    k = F.ceil(F.col("n") / BLOCK).cast("int")
    blocked = sized.withColumn("block", F.pmod(F.xxhash64("line"), k).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), k - 1))
    )
    rows = blocked.select(
        "grp", "line", "probe", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    with_text = rows.join(found, "line")
    # Groups are checked many at a time; the bucket only says which ones together.
    many = shuffle_partitions(docs) * 4
    packs = F.pmod(F.xxhash64("grp", "i", "j"), F.lit(many)).alias("pack")
    checked = with_text.select(packs, "grp", "i", "j", "block", "probe", "text")
    return checked.groupBy("pack").applyInArrow(_check(max_edits), LINKS)


def _occurrences(docs: DataFrame) -> DataFrame:
    """A row per line of each document that is not blank: ``node``, ``doc_id``, ``tie``, ``place``."""
    schema = pa.schema(
        [("node", pa.string()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("place", pa.int32())]
    )

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                nodes, ids, ties, places = [], [], [], []
                columns = [c.to_pylist() for c in batch.slice(start, 1000).columns]
                for doc_id, tie, raw in zip(*columns, strict=True):
                    for i, line in lines_of(raw):
                        nodes.append(node_of(line))
                        ids.append(doc_id)
                        ties.append(tie)
                        places.append(i)
                arrays = [
                    pa.array(c, f.type)
                    for c, f in zip((nodes, ids, ties, places), schema, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    texts = docs.select(
        F.col("doc_id").cast("bigint"), _tie().alias("tie"),
        whole_text().cast("binary").alias("text"),
    )
    return texts.mapInArrow(run, "node string, doc_id bigint, tie bigint, place int")


def _tie() -> Column:
    return F.xxhash64(whole_text())


def repeated_lines(
    docs: DataFrame, max_edits: int = MAX_EDITS, least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """Per document that loses lines: ``doc_id``, ``tie`` and ``places``, the lines' numbers."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "lines")
    _occurrences(docs).write.parquet(path)
    rows = spark.read.parquet(path).withColumn(
        "at", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie", "place")
    )
    classes = components(line_links(docs, max_edits, least_bytes))
    nodes = rows.groupBy("node").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    named = nodes.join(classes.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    named = named.withColumn("class", F.coalesce("component", "node")).select(
        "node", "class", "first", "n"
    )
    path = scratch_dir(spark, "classes")
    named.write.parquet(path)
    named = spark.read.parquet(path)
    repeated = (
        named.groupBy("class")
        .agg(F.min("first").alias("first"), F.sum("n").alias("n"))
        .where(F.col("n") > 1)
        .select("class", "first")
    )
    of_node = lookup_join(named.select("node", "class"), repeated, {"class": "class"})
    met = lookup_join(rows, of_node.select("node", "first"), {"node": "node"})
    gone = met.where(F.col("at") > F.col("first"))
    return gone.groupBy("doc_id", "tie").agg(F.collect_set("place").alias("places"))


def count_lines(
    docs: DataFrame, max_edits: int = MAX_EDITS, least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_removed`` and ``removed``, their numbers.

    Lines are numbered from 0, blank ones included; ``removed`` is ascending and comma-joined.
    """
    blank = F.lit(SPACES)
    n_lines = F.size(F.filter(F.split(whole_text(), "\n", -1), lambda x: F.btrim(x, blank) != ""))
    texts = docs.select(
        F.col("doc_id").cast("bigint"), _tie().alias("tie"), n_lines.cast("bigint").alias("n_lines")
    )
    gone = repeated_lines(docs, max_edits, least_bytes).withColumn("places", F.sort_array("places"))
    met = lookup_join(texts, gone, {"doc_id": "doc_id", "tie": "tie"}, "left", nulls_match=True)
    return met.select(
        "doc_id", "n_lines",
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("places", lambda p: p.cast("string")), ","), F.lit("")).alias("removed"),
    )


def drop_lines(
    docs: DataFrame, max_edits: int = MAX_EDITS, least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """The documents, all columns, without their repeated lines; ``n_chars`` follows the text.

    A document whose lines all go keeps its row, with an empty text. A null text stays null.
    """
    gone = repeated_lines(docs, max_edits, least_bytes)
    marked = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), _tie().alias("tie"),
        "text",
    )
    met = lookup_join(marked, gone, {"id": "doc_id", "tie": "tie"}, "left", nulls_match=True)
    kept = F.filter(
        F.split("text", "\n", -1), lambda x, i: ~F.array_contains(F.col("places"), i)
    )
    left = F.array_join(kept, "\n")
    # Breaks around lines that went are no text.
    left = F.when(F.btrim(left, F.lit(SPACES)) == "", "").otherwise(left)
    text = F.when(F.col("places").isNotNull(), left).otherwise(F.col("text"))
    changed = met.select("row", text.alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(
            F.col("text").eqNullSafe(F.col("row")["text"]), F.col("row")["n_chars"]
        ).otherwise(F.char_length("text").cast(kind))
    return changed.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
