"""How the tokens of two tokenizers line up: inverted bitmaps of id pairs.

A text with a space before it is cut by tokenizer A (byte-level BPE) and by tokenizer B (pieces, with a
space of its own before the text). Two tokens are *linked* where their byte ranges overlap; places where
tokens of both end cut the text into *groups*. An id pair counts as many links as hold it linked in the
whole corpus.

Documents are numbered within blocks, each of so many links that a task holds it with ease. A block keeps
one inverted index: for each id pair, which documents hold it, as a bitmap of 64-bit words, one for each
page of 64 documents that has any, OR-merged from the documents' bits; and how often, in planes: bit k of a
document is set in plane k if its number of links has that bit. The popcount of the planes' OR is the
pair's number of documents, the popcounts of the planes, each by its power of two, its number of links.
Blocks share no document, so the OR of their bitmaps is one after the other and its popcount a sum: only
numbers per block and pair meet in a shuffle, never bitmaps. The sums go back to the blocks that hold the
pair, where its postings return them to the documents.

A pair in a third of all documents is one row per block, added up before the shuffle; the join that sends
sums back splits hot keys. The largest count of a B id is found among at most as many rows as A has ids.

A text that is null, empty, or not given back by the tokens of both (one that holds the mark that stands
for a space in pieces, say) has no tokens: zeros, and an empty hash. Special tokens' strings are ordinary
text. Rows that repeat count each time and give repeated rows; a row without doc_id is one like any other.
Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.encoding import Decoder, Encoder
from tillroll.llm.packed import pack, unpack
from tillroll.llm.tables import keyed_texts, text_rows
from tillroll.operators.lookup import lookup_join
from tillroll.session import scratch_dir

BLOCK_LINKS = 4_000_000  # that a block holds, but for the last document's
PAGE_BITS = 6  # documents of a page are the bits of a word
ORDINAL_BITS = 16  # most documents of a block: 2**16
# Fixed value: how pieces write a space.
SPACE_MARK = "▁"


class Aligner:
    """Cuts a text by both tokenizers and lines the tokens up."""

    def __init__(self, a_path: str, b_path: str):
        self.coder = Encoder(a_path)
        self.coder.special = []
        self.coder.tokenizer.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = Decoder(a_path).table
        self.n_b = self.pieces.piece_size()
        self.b_bytes = [self._piece(i) for i in range(self.n_b)]
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        # Ids as they are written in groups: within one, and at its end.
        self.written = [
            b"%d%s" % (i, mark)
            for n, marks in ((len(self.a_bytes), b",|"), (self.n_b, b",;"))
            for mark in (marks[:1], marks[1:])
            for i in range(n)
        ]

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, none where the text does not come back."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        spaced = " " + text
        a = np.frombuffer(self.coder.encode([spaced])[0], self.coder.dtype).astype(np.int64)
        b = np.array(self.pieces.encode(text, num_threads=1), np.int64)
        raw = spaced.encode()
        # A vocabulary of all bytes without a normaliser gives back any text.
        lossless = self.coder.kind == "bytes"
        if not lossless and b"".join(map(self.a_bytes.__getitem__, a.tolist())) != raw:
            return none, none
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != raw:
            return none, none
        return a, b

    def align(self, text: str) -> tuple[tuple, bytes, np.ndarray]:
        """(tokens of A, of B, groups, links), the groups as text, and the pair of every link."""
        a, b = self.tokens(text)
        if not len(a):
            return (0, 0, 0, 0), b"", a
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        to_b, to_a = np.searchsorted(b_ends, a_ends), np.searchsorted(a_ends, b_ends)
        a_last, b_last = b_ends[to_b] == a_ends, a_ends[to_a] == b_ends
        # The group of each token: how many have ended before.
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        # Between two neighbouring ends, of whichever side, lies one token of each, and one link.
        a_link = np.arange(len(a)) + to_b - a_group
        b_link = np.arange(len(b)) + to_a - b_group
        of_a = np.repeat(a, np.diff(a_link, prepend=-1))
        pairs = of_a * self.n_b + np.repeat(b, np.diff(b_link, prepend=-1))
        # In the text, a group's tokens of A stand before its tokens of B.
        a_after, b_after = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        order, n_a = np.empty(len(a) + len(b), np.int64), len(self.a_bytes)
        order[np.arange(len(a)) + np.append(0, b_after)[a_group]] = a + n_a * a_last
        order[np.arange(len(b)) + a_after[b_group]] = 2 * n_a + b + self.n_b * b_last
        text_of = b"".join(map(self.written.__getitem__, order.tolist()))[:-1]
        return (len(a), len(b), len(a_after), len(pairs)), text_of, pairs


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process, kept over tasks."""
    return Aligner(a_path, b_path)


def pair_planes(pairs: np.ndarray, ordinals: np.ndarray) -> list[np.ndarray]:
    """The inverted index of links: id pairs, and per plane words per pair, pages and words.

    One entry of ``pairs`` and ``ordinals`` is one link in one document of the block.
    """
    keys = np.sort(pairs << ORDINAL_BITS | ordinals)
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.diff(np.append(starts, len(keys)))
    keys = keys[starts]
    own = np.unique(keys >> ORDINAL_BITS)
    planes = [own]
    for k in range(int(times.max(initial=0)).bit_length()):
        held = keys[times >> k & 1 == 1]
        bits = np.uint64(1) << (held & 63).astype(np.uint64)
        places = held >> PAGE_BITS
        first = np.flatnonzero(np.diff(places, prepend=-1))
        words = np.bitwise_or.reduceat(bits, first) if len(first) else bits
        places = places[first]
        of_pair = np.searchsorted(own, places >> (ORDINAL_BITS - PAGE_BITS))
        planes += [
            np.bincount(of_pair, minlength=len(own)).astype(np.uint16),
            (places & ((1 << (ORDINAL_BITS - PAGE_BITS)) - 1)).astype(np.uint16),
            words,
        ]
    return planes


def each_plane(index: list[np.ndarray]):
    """(weight, which pair, page, word) of the planes of an index."""
    for k, at in enumerate(range(1, len(index), 3)):
        counts, pages, words = index[at : at + 3]
        yield 1 << k, np.repeat(np.arange(len(counts)), counts), pages.astype(np.int64), words


def pair_numbers(index: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How many documents and links each pair of an index has."""
    n_links = np.zeros(len(index[0]), np.int64)
    places, words = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for weight, which, pages, plane in each_plane(index):
        np.add.at(n_links, which, weight * np.bitwise_count(plane).astype(np.int64))
        places.append(which << (ORDINAL_BITS - PAGE_BITS) | pages)
        words.append(plane)
    places, words = np.concatenate(places), np.concatenate(words)
    order = np.argsort(places, kind="stable")
    places, words = places[order], words[order]
    first = np.flatnonzero(np.diff(places, prepend=-1))
    merged = np.bitwise_or.reduceat(words, first) if len(first) else words
    n_docs = np.zeros(len(index[0]), np.int64)
    np.add.at(n_docs, places[first] >> (ORDINAL_BITS - PAGE_BITS), np.bitwise_count(merged))
    return n_docs, n_links


def returned(index: list[np.ndarray], n: int, scores: np.ndarray) -> np.ndarray:
    """Per document, the sum of its links' scores, carried back along the postings."""
    sums = np.zeros(n, np.int64)
    for weight, which, pages, words in each_plane(index):
        for at in range(0, len(words), 1 << 18):
            part = np.ascontiguousarray(words[at : at + (1 << 18)])
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, bit = np.nonzero(bits)
            documents = pages[at + word] << PAGE_BITS | bit
            np.add.at(sums, documents, weight * scores[which[at + word]])
    return sums


class _Block:
    """Documents of a block, and their links."""

    def __init__(self) -> None:
        self.ids: list = []
        self.counts: list[tuple] = []
        self.hashes: list[bytes] = []
        self.pairs: list[np.ndarray] = []
        self.n_links = 0

    def add(self, doc_id, counts: tuple, groups: bytes, pairs: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.counts.append(counts)
        self.hashes.append(hashlib.sha256(groups).digest())
        self.pairs.append(pairs)
        self.n_links += len(pairs)

    def full(self) -> bool:
        return self.n_links >= BLOCK_LINKS or len(self.ids) == 1 << ORDINAL_BITS

    def payload(self) -> bytes:
        ordinals = np.repeat(np.arange(len(self.ids)), [len(p) for p in self.pairs])
        known = np.array([i is not None for i in self.ids])
        return pack(
            known,
            np.array([0 if i is None else i for i in self.ids], np.int64),
            np.array(self.counts, np.int64).ravel(),
            b"".join(self.hashes),
            *pair_planes(np.concatenate(self.pairs), ordinals),
        )


BLOCK = "block bigint, payload binary"


def _blocks(a_path: str, b_path: str):
    def run(batches):
        lines_up = aligner(a_path, b_path)
        first, number, block = TaskContext.get().partitionId() << 32, 0, _Block()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": [first + number], "payload": [block.payload()]})

        for doc_id, raw in text_rows(batches):
            block.add(doc_id, *lines_up.align(raw.decode()))
            if block.full():
                yield row()
                number, block = number + 1, _Block()
        if block.ids:
            yield row()

    return run


def index_blocks(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The blocks of all documents, written to a scratch table: both tokenizers run once."""
    keyed = keyed_texts(docs.select(F.col("doc_id").cast("bigint"), "text"))
    path = scratch_dir(spark, "blocks")
    keyed.mapInArrow(_blocks(a_path, b_path), BLOCK).write.parquet(path)
    return spark.read.schema(BLOCK).parquet(path)


def _numbers(batches):
    for batch in batches:
        for block, payload in zip(*(batch.column(i) for i in range(2)), strict=True):
            index = unpack(payload.as_py())[4:]
            n_docs, n_links = pair_numbers(index)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(index[0]), block.as_py())), *map(pa.array, (index[0], n_docs, n_links))],
                names=["block", "pair", "n_docs", "n_links"],
            )


def block_pairs(blocks: DataFrame) -> DataFrame:
    """The id pairs of each block: documents and links there."""
    return blocks.mapInArrow(_numbers, "block bigint, pair bigint, n_docs bigint, n_links bigint")


def scored_pairs(pairs: DataFrame, n_b: int) -> DataFrame:
    """All id pairs with their documents and links in the corpus, and whether none of the B id has more."""
    total = pairs.groupBy("pair").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")
    )
    ids = {"a_id": F.floor(F.col("pair") / F.lit(n_b)), "b_id": F.col("pair") % n_b}
    most = F.max("n_links").over(Window.partitionBy("b_id"))
    return total.withColumns(ids).withColumn("best", F.col("n_links") == most)


RESULT = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)


def _return_scores(blocks: pa.Table, pairs: pa.Table) -> pa.Table:
    parts = []
    for payload in blocks.column("payload"):
        known, ids, counts, hashes, *index = unpack(payload.as_py())
        order = np.argsort(pairs.column("pair").to_numpy())
        links = pairs.column("total").to_numpy()[order]
        best = pairs.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        counts = counts.reshape(-1, 4)
        digests = [hashes[i : i + 32].hex() for i in range(0, len(hashes), 32)]
        held = counts[:, 0].tolist()
        columns = [
            pa.array(ids, mask=~known),
            *(pa.array(np.ascontiguousarray(counts[:, i])) for i in range(4)),
            pa.array(returned(index, len(ids), best)),
            pa.array(returned(index, len(ids), links)),
            pa.array([d if n else "" for d, n in zip(digests, held, strict=True)], pa.string()),
        ]
        parts.append(pa.Table.from_arrays(columns, schema=RESULT))
    return pa.concat_tables(parts) if parts else RESULT.empty_table()


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: its tokens, groups and links, how good and how common its links are.

    ``a_path`` is a byte-level BPE file, ``b_path`` a model of pieces, on every machine. ``n_best`` counts
    links whose pair has the most links of all with its B id, ties included; ``count_sum`` adds up the
    pairs' links over the document's links; ``groups_sha256`` is of the groups as text, each the ids of A
    and of B in order: ``a1,a2|b1;a3|b2,b3``.
    """
    spark = docs.sparkSession
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).piece_size()
    blocks = index_blocks(spark, docs, a_path, b_path)
    pairs = block_pairs(blocks)
    scores = scored_pairs(pairs, n_b).select("pair", F.col("n_links").alias("total"), "best")
    back = lookup_join(pairs.select("block", "pair"), scores, {"pair": "pair"})
    met = blocks.groupBy("block").cogroup(back.groupBy("block"))
    fields = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'bigint'}" for f in RESULT)
    return met.applyInArrow(_return_scores, fields)


def pair_table(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per id pair that is linked anywhere: ``a_id, b_id, n_docs, n_links, best``."""
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).piece_size()
    blocks = index_blocks(docs.sparkSession, docs, a_path, b_path)
    return scored_pairs(block_pairs(blocks), n_b).drop("pair")


def aligned_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: ``doc_id`` and its groups as text, empty without tokens."""

    def run(batches):
        lines_up = aligner(a_path, b_path)
        for doc_id, raw in text_rows(batches):
            text = lines_up.align(raw.decode())[1].decode()
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id], pa.int64()), pa.array([text])], names=["doc_id", "groups"]
            )

    keyed = keyed_texts(docs.select(F.col("doc_id").cast("bigint"), "text"))
    return keyed.mapInArrow(run, "doc_id bigint, groups string")
