"""Ids of texts as one tokenizer library gives them, by a faster one where both must agree.

Byte-pair merges go by rank. One library merges the listed pairs only, the other any two neighbours
whose bytes together are a token. The second can differ from the first only through a token that
its own merges do not lead to: whatever stands around a token's bytes, the merges of lower rank
within them are the same, so when a token's rank is due, its bytes are the two parts of its listed
pair, or the token is one that the listed merges never make. Such tokens are left out here, and
both libraries give the same ids. Texts with special tokens, or characters that the libraries may
normalise or cut by different tables, go to the first library whole.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Other characters are normalised, lower-cased or cut by tables that may differ between libraries.
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
# The pattern of the library's ByteLevel step, and that of the word vocabulary.
_BYTE_LEVEL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORDS = regex.compile(_WORD_LEVEL)
#: The same without digits, other numbers and apostrophes: what is left is letters, marks and space.
_NO_LETTERS_OR_MARKS = re.compile(r"[^\t\n\r\x20-&(-/:-~\xa1-±´-¸º»¿-ɏ]")
_MARKS = re.compile(r"([^\s" + "a-zªµºß-öø-ɏ" + "]+)")


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 onwards."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Byte-pair merges one by one: the listed pair of the lowest rank first, leftmost of equals."""
    while len(symbols) > 1:
        rank, at = min(
            (ranks.get(pair, len(ranks)), i)
            for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))
        )
        if rank == len(ranks):
            break
        symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
    return symbols


class Encoder:
    """Encodes texts to ids as ``tokenizer.encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        unlimited = config | {"truncation": None, "padding": None}
        self.tokenizer = Tokenizer.from_str(json.dumps(unlimited))
        self.special = [t["content"] for t in config["added_tokens"]]
        model = config["model"]
        size = max([*model["vocab"].values(), *(t["id"] for t in config["added_tokens"])]) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.kind = _kind(config)
        if self.kind:
            self._fast(model, _BYTE_LEVEL if self.kind == "bytes" else "[^ ]+ ")

    def _fast(self, model: dict, pattern: str) -> None:
        """The same vocabulary for the faster library; a word's end is a space there."""
        suffix = model.get("end_of_word_suffix") or ""
        to_byte = {c: b for b, c in byte_alphabet().items()}

        def as_bytes(token: str) -> bytes:
            end = b" " if suffix and token.endswith(suffix) else b""
            return bytes(to_byte[c] for c in token.removesuffix(suffix if end else "")) + end

        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ranks = {pair: i for i, pair in enumerate(pairs)}
        # Single bytes come first; a last byte with its end is no merge, so it outranks all merges.
        order = [(bytes([b]), to_byte_token) for b, to_byte_token in byte_alphabet().items()]
        if suffix:
            order += [(bytes([b]) + b" ", c + suffix) for b, c in byte_alphabet().items()]
        for left, right in pairs:
            token = left + right
            symbols = list(token.removesuffix(suffix)) if suffix else list(token)
            if suffix and token.endswith(suffix):
                symbols[-1] += suffix
            if merged(symbols, ranks) == [token]:
                order.append((as_bytes(token), token))
        own = {raw: i for i, (raw, _) in enumerate(order)}
        self.ids = np.array([model["vocab"].get(t, 0) for _, t in order], self.dtype)
        self.fast = tiktoken.Encoding(
            "merges", pat_str=pattern, mergeable_ranks=own, special_tokens={}
        )

    def whole(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, self.dtype).tobytes()
            for t in texts
        ]

    def _one(self, text: str) -> bytes:
        plain = self.kind == "words" and not _NO_LETTERS_OR_MARKS.search(text)
        if not plain and (self.kind is None or _UNUSUAL.search(text)):
            return self.whole([text])[0]
        if any(mark in text for mark in self.special):
            return self.whole([text])[0]
        if self.kind == "words":
            # Each piece is followed by one space.
            text = text.lower()
            pieces = _MARKS.sub(r" \1 ", text).split() if plain else _WORDS.findall(text)
            pieces.append("")
            text = " ".join(pieces)
        return self.ids[np.array(self.fast.encode_ordinary(text), np.int64)].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian, in ``dtype``."""
        return [self._one(t) for t in texts]


def _kind(config: dict) -> str | None:
    """Which of the two known ways a tokenizer cuts texts in, if any."""
    model, before = config["model"], config.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges")
    ):
        return None
    suffix = model.get("end_of_word_suffix")
    if before.get("type") == "ByteLevel" and not config.get("normalizer") and not suffix:
        if before.get("use_regex") and not before.get("add_prefix_space"):
            return "bytes"
    steps = before.get("pretokenizers", [])
    if [x.get("type") for x in steps] == ["Split", "ByteLevel"] and suffix:
        normal = [x.get("type") for x in (config["normalizer"] or {}).get("normalizers", [])]
        split, level = steps
        if (
            split["pattern"] == {"Regex": _WORD_LEVEL}
            and split["invert"]
            and split["behavior"] == "Removed"
            and not level.get("use_regex")
            and not level.get("add_prefix_space")
            and normal == ["NFC", "Replace", "Lowercase"]
        ):
            return "words"
    return None


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary, kept over tasks."""
    return Encoder(path)


class Decoder:
    """Bytes of ids of a byte-level vocabulary, as the library's ByteLevel decoder has them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        alphabet = {c: b for b, c in byte_alphabet().items()}
        tokens = dict(config["model"]["vocab"])
        tokens |= {t["content"]: t["id"] for t in config["added_tokens"]}
        self.table = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            if all(c in alphabet for c in token):
                self.table[i] = bytes(alphabet[c] for c in token)
            else:
                self.table[i] = token.encode()

    def pieces(self, ids: np.ndarray) -> list[bytes]:
        return list(map(self.table.__getitem__, ids.tolist()))

    def text(self, ids: np.ndarray) -> str:
        return b"".join(self.pieces(ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)
