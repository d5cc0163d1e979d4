"""Byte-level BPE by a tree of halves: encoding as tiktoken does, and decoding.

A text is halved until its parts are short; a part is encoded by the library, and neighbours are joined
up the tree. Joining is associative: each join gives the ids of the two parts' whole text. It encodes a
window around the seam anew and keeps the tokens outside it, where they provably stay as they are:

* At a *fence*, two neighbouring characters that no match of the pattern holds together, every scan of
  the pattern cuts, wherever it came from. As a scan remembers nothing but its place, a part and the whole
  are cut alike beyond a fence with both its characters in that part. Fences are where one kind of
  character ends and another begins, but for the end of white space (a space may belong to what follows,
  and how white space is cut depends on what follows) and a letter after an apostrophe.
* Inside one long match (a run of letters, of digits or of other signs) there is no fence. Tokens of such a
  run are its byte-pair merges exactly if every two neighbouring ones merge to themselves: the first merge
  across a border in the whole would be one in those two tokens alone, as until then both have gone the
  same way. So a window inside a run stands if that holds at its borders; else it grows, at most out to the
  fences. It stays longer than any token, as the library takes a match that is a token without merging.

The kinds of characters are those of Unicode 3.2, which later versions keep; a character it does not know
is of no kind and makes no fence, so no table of another version can change an id.

Decoding looks bytes up and concatenates them up a tree of halves of the ids. A null text is empty and has
no ids. Rows that repeat give repeated rows, a row without doc_id is one like any other, and columns beyond
doc_id and text play no part. A text is one value of the input and one task's work; nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from unicodedata import ucd_3_2_0

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import keyed_texts, text_rows

LEAF = 4096  # characters encoded at once, ids decoded at once
WINDOW = 64  # characters on each side of a seam that a window inside a run begins with
# White space that every version of Unicode counts as such.
WHITE = " \t\n\r\x0b\x0c"


@lru_cache(maxsize=1 << 14)
def kind(c: str) -> str:
    """Of a character: white, L, N, sign, or nothing where tables may differ."""
    if c in WHITE:
        return "white"
    category = ucd_3_2_0.category(c)[0]
    return category if category in "LN" else "sign" if category in "PSM" else ""


def is_fence(before: str, after: str) -> bool:
    """No match of the pattern holds these two neighbours, whatever stands around them."""
    a, b = kind(before), kind(after)
    return bool(a and b) and a != b and a != "white" and not (before == "'" and b == "L")


class TreeCoder:
    """Encodes and decodes with the ranks and the pattern of one vocabulary."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF, window: int = WINDOW):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.table = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.table[rank] = token
        self.lengths = np.array([len(t) for t in self.table], np.int64)
        self.longest = int(self.lengths.max())
        self.leaf, self.window = leaf, window
        self.library = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={}
        )
        self.stands = lru_cache(maxsize=1 << 16)(self._stands)

    def encode(self, text: str) -> np.ndarray:
        return self._encode(text, 0, len(text))

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_ordinary(text), np.uint32)

    def _encode(self, text: str, begin: int, end: int) -> np.ndarray:
        if end - begin <= self.leaf:
            return self._library(text[begin:end])
        seam = (begin + end) // 2
        left, right = self._encode(text, begin, seam), self._encode(text, seam, end)
        return self.join(text, begin, seam, end, left, right)

    def join(
        self, text: str, begin: int, seam: int, end: int, left: np.ndarray, right: np.ndarray
    ) -> np.ndarray:
        """The ids of ``text[begin:end]`` from those of its parts before and after ``seam``."""
        size = self.window
        while True:
            n_left, low, fenced_left = self._border(text, seam, begin, left, size)
            n_right, high, fenced_right = self._border(text, seam, end, right, size)
            again = self._library(text[low:high])
            kept = left[: len(left) - n_left], right[n_right:]
            if (fenced_left or self.stands(int(kept[0][-1]), int(again[0]))) and (
                fenced_right or self.stands(int(again[-1]), int(kept[1][0]))
            ):
                return np.concatenate((kept[0], again, kept[1]))
            size *= 2

    def _border(
        self, text: str, seam: int, limit: int, ids: np.ndarray, size: int
    ) -> tuple[int, int, bool]:
        """How far a window goes from the seam towards ``limit``, over the part with these ids.

        The number of the part's tokens in it, the place in the text, and whether that is a fence or the
        part's end, beyond which nothing can change.
        """
        step = -1 if limit < seam else 1
        near = self.longest + 4  # longer than any token, and than a contraction with the next letter
        far = max(size, near) + 8 * self.longest
        at, first, run = seam + step, "", True
        while (limit - at) * step > 0:
            c = text[at] if step < 0 else text[at - 1]
            first = first or kind(c)
            run = run and c != "'" and kind(c) == first and first in ("L", "N", "sign")
            if is_fence(text[at - 1], text[at]):
                part = text[at:seam] if step < 0 else text[seam:at]
                return self._tokens_of(len(part.encode()), ids, step), at, True
            if run and (at - seam) * step >= far + near:
                n, raw = self._tokens_beyond(max(size, near), ids, step)
                n_characters = len(raw.decode())
                if n_characters <= far:
                    return n, seam + step * n_characters, False
            at += step
        return len(ids), limit, True

    def _tokens_of(self, n_bytes: int, ids: np.ndarray, step: int) -> int:
        """How many tokens next to the seam it takes for so many bytes."""
        ends = np.cumsum(self.lengths[ids[::step][:n_bytes]])
        return int(np.searchsorted(ends, n_bytes)) + 1

    def _tokens_beyond(self, size: int, ids: np.ndarray, step: int) -> tuple[int, bytes]:
        """The tokens next to the seam of so many bytes or more, up to a border between characters."""
        n = self._tokens_of(size, ids, step)
        while True:
            # The token that would be first of a part must begin with a whole character.
            follows = ids[len(ids) - n] if step < 0 else ids[n]
            if self.table[follows][0] & 0xC0 != 0x80:
                return n, self._bytes(ids[len(ids) - n :] if step < 0 else ids[:n])
            n += 1

    def _stands(self, left: int, right: int) -> bool:
        """The merges of two tokens' bytes lead to these two tokens."""
        a, b = self.table[left], self.table[right]
        parts = [bytes([x]) for x in a + b]
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(x + y, len(self.table)), i)
                for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False))
            )
            if rank == len(self.table):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts == [a, b]

    def _bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.leaf:
            return self._bytes(ids)
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> TreeCoder:
    """One per worker process and vocabulary, kept over tasks."""
    return TreeCoder(path, pattern)


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
     ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32()))]
)
ROWS = 256  # rows of a result batch


def _run(path: str, pattern: str, with_ids: bool):
    def run(batches):
        tree = coder(path, pattern)
        decimal = [b"%d" % i for i in range(len(tree.table))]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=RESULT)

        for doc_id, raw in text_rows(batches):
            ids = tree.encode(raw.decode())
            digits = b",".join(map(decimal.__getitem__, ids.tolist()))
            rows.append(
                (
                    doc_id,
                    len(ids),
                    hashlib.sha256(digits).hexdigest(),
                    hashlib.sha256(tree.decode(ids)).hexdigest(),
                    ids.astype(np.int32) if with_ids else None,
                )
            )
            if len(rows) == ROWS:
                yield batch()
                rows.clear()
        if rows:
            yield batch()

    return run


def encode_decode(
    docs: DataFrame,
    ranks: str,
    pattern: str = public_tokenizers.PATTERN,
    with_ids: bool = True,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, hashes of ids and of the bytes they give back, ``ids``.

    ``ranks`` is the path of a rank file, on every machine; ``pattern`` cuts texts before the merges.
    ``ids_sha256`` is of the decimal ids joined by commas; ``ids`` are null without ``with_ids``.
    """
    keyed = keyed_texts(docs.select(F.col("doc_id").cast("bigint"), "text"))
    fields = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids array<int>"
    return keyed.mapInArrow(_run(ranks, pattern, with_ids), fields)
