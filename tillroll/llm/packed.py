"""Records packed by bucket: one compressed row per bucket and flush instead of a row per record.

A task gathers records, sorts them by bucket and sends each bucket's share as columns of bytes. The
shuffle then moves few, well compressed rows, and the receiving task works on whole arrays.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import zstandard

PACKED = "bucket int, payload binary"
PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])
BUCKET_BYTES = 8 * 1024 * 1024  # of records before compression that a bucket is planned for


def bucket_count(n_bytes: float, least: int) -> int:
    """Buckets for so many bytes of records; ``least`` keeps small inputs spread."""
    return max(least, ceil(n_bytes / BUCKET_BYTES))


def pack(*arrays: np.ndarray | bytes, level: int = 1) -> bytes:
    """Columns, each with its type and length, compressed together."""
    parts = []
    for a in arrays:
        kind, raw = ("S", a) if isinstance(a, bytes) else (a.dtype.str, a.tobytes())
        head = f"{kind}:{len(raw)}\n".encode()
        parts += [head, raw]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(payload: bytes) -> list:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    out, at = [], 0
    while at < len(raw):
        end = raw.index(b"\n", at)
        kind, length = raw[at:end].decode().split(":")
        at = end + 1 + int(length)
        part = raw[end + 1 : at]
        out.append(part if kind == "S" else np.frombuffer(part, dtype=kind))
    return out


def packed_batch(buckets: list[int], payloads: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(payloads, pa.binary())], schema=PACKED_ARROW
    )


def bucket_runs(buckets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order that sorts records by bucket, and (bucket, begin, end) in that order."""
    order = np.argsort(buckets, kind="stable")
    ranked = buckets[order]
    cuts = np.flatnonzero(np.diff(ranked)) + 1
    begins = [0, *cuts.tolist()] if len(ranked) else []
    ends = [*cuts.tolist(), len(ranked)] if len(ranked) else []
    return order, [(int(ranked[b]), b, e) for b, e in zip(begins, ends, strict=True)]
