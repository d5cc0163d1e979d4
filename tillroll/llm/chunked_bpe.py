"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over the last bytes cuts texts at places that depend on content alone, so texts that
share a passage share its chunks. Chunks travel to the bucket of their hash, where equal ones meet
and each distinct one is encoded once; its ids go to the texts that hold it, once per bucket of texts.
There chunks are joined, once for each distinct text: where the cut is one that the library always makes, the joined
ids are the library's; elsewhere the text around the cut is encoded anew, out to the nearest such
places on both sides, beyond which old and new ids agree exactly. A text without such places is encoded
whole.

A text is known by the first 128 bits of its SHA-256. Copies of one text are joined, decoded and hashed
once, and a join that splits hot keys gives the result to their documents. A task sends a chunk once with
the list of texts where it has met it, so one passage in a third of all documents arrives as a few rows. A null text is empty, and has no ids. Rows
that repeat give repeated rows; a row without doc_id is one like any other. Columns beyond doc_id and
text play no part.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.encoding import Encoder, decoder, encoder
from tillroll.llm.packed import PACKED, bucket_count, bucket_runs, pack, packed_batch, unpack
from tillroll.llm.rolling import byte_values, powers_for
from tillroll.llm.tables import shuffle_partitions, text_bytes, text_rows, whole_text
from tillroll.operators.lookup import lookup_join

ROLLING_BYTES = 32
CUT_BITS = 11  # a cut every 2**11 bytes on average
LEAST_CHUNK, MOST_CHUNK = 256, 8192
FLUSH_BYTES = 32 * 1024 * 1024
LEVEL = 6


def cut_places(raw: bytes) -> list[int]:
    """Where chunks begin after the first: at a space after a place that the rolling hash picks.

    Without a space near by, at the next character.
    """
    n = len(raw)
    if n <= LEAST_CHUNK:
        return []
    data = np.frombuffer(raw, np.uint8)
    powers, inverse = powers_for(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_values[data] * powers[:n], out=prefix[1:])
    rolling = (prefix[ROLLING_BYTES:] - prefix[:-ROLLING_BYTES]) * inverse[: n + 1 - ROLLING_BYTES]
    picked = (np.flatnonzero(rolling >> np.uint64(64 - CUT_BITS) == 0) + ROLLING_BYTES).tolist()
    cuts, last, i = [], 0, 0
    while n - last > LEAST_CHUNK:
        while i < len(picked) and picked[i] < last + LEAST_CHUNK:
            i += 1
        at = min(picked[i] if i < len(picked) else n, last + MOST_CHUNK)
        if at >= n:
            break
        space = raw.find(b" ", at, at + LEAST_CHUNK)
        if space < 0:
            while at < n and raw[at] & 0xC0 == 0x80:
                at += 1
        else:
            at = space
        if at >= n:
            break
        cuts.append(at)
        last = at
    return cuts


def chunks(raw: bytes) -> list[bytes]:
    cuts = cut_places(raw)
    return [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)], strict=True)]


class _Places:
    """Chunks, each with the (halves of the text's key, number) it was met at."""

    def __init__(self) -> None:
        self.met: dict[bytes, list] = {}
        self.texts: set[bytes] = set()
        self.size = 0

    def add(self, chunk: bytes, place: tuple) -> None:
        places = self.met.get(chunk)
        if places is None:
            self.met[chunk] = places = []
            self.size += len(chunk) + 150
        places.append(place)
        self.size += 100


def _columns(places: list[tuple]) -> list[np.ndarray]:
    at = np.array(places, np.int64).reshape(-1, 3)
    return [at[:, 0].copy(), at[:, 1].copy(), at[:, 2].astype(np.int32)]


def _send_chunks(buckets: int):
    def flush(held: _Places) -> pa.RecordBatch:
        texts = list(held.met)
        to = np.array([xxhash.xxh3_64_intdigest(t) % buckets for t in texts], np.int64)
        order, runs = bucket_runs(to)
        numbers, payloads = [], []
        for bucket, begin, end in runs:
            own = [texts[i] for i in order[begin:end].tolist()]
            places = [held.met[t] for t in own]
            numbers.append(bucket)
            payloads.append(
                pack(
                    np.array([len(t) for t in own], np.int64),
                    np.array([len(p) for p in places], np.int64),
                    *_columns([x for p in places for x in p]),
                    b"".join(own),
                    level=LEVEL,
                )
            )
        return packed_batch(numbers, payloads)

    def run(batches):
        held = _Places()
        for key, raw in text_rows(batches):
            if key in held.texts:
                continue
            held.texts.add(key)
            halves = struct.unpack("<qq", key)
            for number, chunk in enumerate(chunks(raw)):
                held.add(chunk, (*halves, number))
            if held.size > FLUSH_BYTES:
                yield flush(held)
                held = _Places()
        if held.met:
            yield flush(held)

    return run


def _gathered(table: pa.Table) -> list:
    """The columns of all payloads, end to end; the last column is bytes."""
    got = [unpack(p) for p in table.column("payload").to_pylist()]
    columns = [np.concatenate([g[i] for g in got]) for i in range(len(got[0]) - 1)]
    return [*columns, b"".join([g[-1] for g in got])]


def _encode_chunks(path: str, buckets: int):
    """Ids of each distinct chunk of a bucket, sent on once to each bucket of texts."""

    def run(table: pa.Table) -> pa.Table:
        lengths, counts, texts, rest, numbers, blob = _gathered(table)
        ends = np.cumsum(lengths).tolist()
        which: dict[bytes, int] = {}
        chunk_of = np.empty(len(lengths), np.int64)
        for i, (n, end) in enumerate(zip(lengths.tolist(), ends, strict=True)):
            chunk_of[i] = which.setdefault(blob[end - n : end], len(which))
        del blob
        coder, distinct, ids = encoder(path), list(which), []
        for at in range(0, len(distinct), 512):
            ids += coder.encode([c.decode() for c in distinct[at : at + 512]])
        chunk = np.repeat(chunk_of, counts)
        # A text that several tasks or flushes met has each of its places several times.
        order = np.lexsort((numbers, rest, texts))
        moved = np.diff(texts[order]) | np.diff(rest[order]) | np.diff(numbers[order])
        once = order[np.concatenate(([True], moved != 0))]
        chunk, texts, rest, numbers = chunk[once], texts[once], rest[once], numbers[once]
        to = ((texts.view(np.uint64) >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((chunk, to))
        out_buckets, payloads = [], []
        for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
            own, starts = np.unique(chunk[part], return_index=True)
            own_ids = [ids[c] for c in own.tolist()]
            out_buckets.append(int(to[part[0]]))
            payloads.append(
                pack(
                    np.array([len(b) for b in own_ids], np.int64),
                    np.diff(np.append(starts, len(part))),
                    texts[part], rest[part], numbers[part],
                    b"".join(own_ids),
                    level=LEVEL,
                )
            )
        return pa.Table.from_batches([packed_batch(out_buckets, payloads)])

    return run


@lru_cache(maxsize=4)
def _edges(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Per id: begins with one space and a plain character; ends with a plain character.

    Between a token that ends so and one that begins so the library always cuts: no step of its
    pattern crosses from a character that is no white space to a space, and the space with what
    follows begins the same match wherever the scan came from. Plain are ASCII characters that show
    and letters of U+00C0 to U+00FF.
    """
    table = decoder(path).table

    def shows(b: bytes) -> bool:
        return len(b) >= 1 and (33 <= b[0] <= 126 or b[0] == 0xC3)

    def ends(b: bytes) -> bool:
        return len(b) >= 1 and (33 <= b[-1] <= 126 or (len(b) > 1 and b[-2] == 0xC3))

    opens = np.array([b[:1] == b" " and shows(b[1:]) for b in table])
    return opens, np.array([ends(b) for b in table])


def _safe(ids: np.ndarray, edges) -> np.ndarray:
    """Places in ``ids`` before which the library always cuts."""
    opens, closes = edges
    return np.flatnonzero(opens[ids[1:]] & closes[ids[:-1]]) + 1


def joined(parts: list[np.ndarray], coder: Encoder, path: str) -> np.ndarray:
    """The ids of a whole text from those of its chunks."""
    edges, texts = _edges(path), decoder(path)
    opens, closes = edges
    whole = parts[0]
    done = [whole]
    for part in parts[1:]:
        before = done[-1]
        if not len(part):
            continue
        if len(before) and opens[part[0]] and closes[before[-1]]:
            done.append(part)
            continue
        # Out from the cut to the nearest place on each side where old and new must agree.
        left, right = _safe(before, edges), _safe(part, edges)
        while not len(left) and len(done) > 1:
            part_before = done.pop()
            done[-1] = before = np.concatenate((done[-1], part_before))
            left = _safe(before, edges)
        begin = int(left[-1]) if len(left) else 0
        end = int(right[0]) if len(right) else len(part)
        around = np.concatenate((before[begin:], part[:end]))
        again = np.frombuffer(coder.encode([texts.text(around)])[0], coder.dtype)
        done[-1] = np.concatenate((before[:begin], again, part[end:]))
    return np.concatenate(done)


RESULT = "key binary, n_tokens bigint, ids_sha256 binary, decoded_sha256 binary, ids binary"


def _join_chunks(path: str, with_ids: bool):
    schema = pa.schema(
        [("key", pa.binary()), ("n_tokens", pa.int64()), ("ids_sha256", pa.binary()),
         ("decoded_sha256", pa.binary()), ("ids", pa.binary())]
    )

    def run(table: pa.Table) -> pa.Table:
        lengths, counts, texts, rest, numbers, blob = _gathered(table)
        coder, words = encoder(path), decoder(path)
        ends = np.cumsum(lengths)
        chunk = np.repeat(np.arange(len(lengths)), counts)
        order = np.lexsort((numbers, rest, texts))
        moved = np.diff(texts[order]) | np.diff(rest[order])
        rows = []
        for part in np.split(order, np.flatnonzero(moved) + 1):
            ids = joined(
                [
                    np.frombuffer(blob, coder.dtype, int(lengths[c]) // coder.dtype.itemsize,
                                  int(ends[c] - lengths[c]))
                    for c in chunk[part].tolist()
                ],
                coder, path,
            )
            wide = ids.astype("<u4").tobytes()
            rows.append(
                (
                    struct.pack("<qq", int(texts[part[0]]), int(rest[part[0]])),
                    len(ids),
                    hashlib.sha256(wide).digest(),
                    hashlib.sha256(words.text(ids).encode()).digest(),
                    wide if with_ids else None,
                )
            )
        return pa.table(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
            schema=schema,
        )

    return run


def encode_decode(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, hashes of ids and of the text they give back.

    ``tokenizer`` is the path of a byte-level BPE file, on every machine. ``ids`` are the ids as
    little-endian unsigned 32-bit integers, null unless ``with_ids``.
    """
    key = F.unhex(F.left(F.sha2(whole_text().cast("binary"), 256), F.lit(32)))
    keyed = docs.select(F.col("doc_id").cast("bigint"), key.alias("key"), "text")
    buckets = bucket_count(text_bytes(docs), 2 * shuffle_partitions(docs))
    texts = keyed.select("key", whole_text().cast("binary").alias("text"))
    sent = texts.mapInArrow(_send_chunks(buckets), PACKED)
    ids = sent.groupBy("bucket").applyInArrow(_encode_chunks(tokenizer, buckets), PACKED)
    found = ids.groupBy("bucket").applyInArrow(_join_chunks(tokenizer, with_ids), RESULT)
    met = lookup_join(keyed.select("doc_id", "key"), found.withColumnRenamed("key", "k"), {"key": "k"})
    hashes = [F.lower(F.hex(c)).alias(c) for c in ("ids_sha256", "decoded_sha256")]
    return met.select("doc_id", "n_tokens", *hashes, "ids")
