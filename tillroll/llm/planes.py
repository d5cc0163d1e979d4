"""Token ids in files of bit or byte planes.

Ids are held as unsigned 32-bit integers in blocks of a fixed number; a block is transposed into
its 4 byte planes, or 32 bit planes, and each plane is compressed with zstandard: the high planes of
small ids are almost nothing. Blocks are gathered in chunks of whole documents. A chunk is a row of
the ``chunks`` table: its planes, block by block, and its documents; the ``index`` table gives the
place of each chunk in the sequence of all ids, so any document can be read without the others.

Documents are written in ascending order of doc_id, nulls first, rows of one id by their text: a
range partitioning, in which rows that repeat may be dealt over several tasks. Tables are Spark's
own files, so a task that is run twice, or whose executor is lost, leaves nothing behind, and any
store that Spark can write will do.

A null or empty text has no ids but the end id. Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.encoding import encoder
from tillroll.llm.tables import shuffle_partitions, text_bytes, whole_text

BLOCK_IDS = 16384
CHUNK_IDS = 131072
PART_BYTES = 64 * 1024 * 1024  # of text, that a task is planned for
LEVEL = 3
CHUNKS = (
    "part int, chunk int, n_ids bigint, n_docs int, doc_ids array<bigint>, lengths array<bigint>, "
    "kind string, planes array<binary>"
)
_CHUNKS = pa.schema(
    [("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()), ("n_docs", pa.int32()),
     ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("kind", pa.string()),
     ("planes", pa.list_(pa.binary()))]
)


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of one block, most significant first."""
    rows = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        rows = np.unpackbits(rows, axis=1)
        return [np.packbits(plane).tobytes() for plane in rows.T]
    return [plane.tobytes() for plane in rows.T]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "bit":
        bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes]
        rows = np.packbits(np.array(bits).T, axis=1)
    else:
        rows = np.array([np.frombuffer(p, np.uint8) for p in planes]).T
    return np.ascontiguousarray(rows).view(">u4").ravel().astype("<u4")


def n_planes(kind: str) -> int:
    return 32 if kind == "bit" else 4


def _compressed(ids: np.ndarray, kind: str) -> list[bytes]:
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    return [
        squeeze(plane)
        for at in range(0, len(ids), BLOCK_IDS)
        for plane in to_planes(ids[at : at + BLOCK_IDS], kind)
    ]


def chunk_ids(planes: list[bytes], n_ids: int, kind: str) -> np.ndarray:
    """All ids of a chunk."""
    expand, each = zstandard.ZstdDecompressor().decompress, n_planes(kind)
    blocks = []
    for i, at in enumerate(range(0, n_ids, BLOCK_IDS)):
        raw = [expand(p) for p in planes[i * each : (i + 1) * each]]
        blocks.append(from_planes(raw, min(BLOCK_IDS, n_ids - at), kind))
    return np.concatenate(blocks) if blocks else np.zeros(0, "<u4")


def _write_chunks(tokenizer: str, end_id: int, kind: str):
    def row(part, number, doc_ids, lengths, ids) -> pa.RecordBatch:
        whole = np.concatenate(ids)
        values = [part, number, len(whole), len(doc_ids), doc_ids, lengths, kind]
        arrays = [
            pa.array([v], f.type)
            for v, f in zip([*values, _compressed(whole, kind)], _CHUNKS, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=_CHUNKS)

    def run(batches):
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        number, doc_ids, lengths, ids, held = 0, [], [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                few = batch.slice(start, 128)
                texts = [t.decode() for t in few.column(1).to_pylist()]
                encoded = coder.encode(texts)
                for doc_id, raw in zip(few.column(0).to_pylist(), encoded, strict=True):
                    own = np.append(np.frombuffer(raw, coder.dtype).astype("<u4"), end)
                    doc_ids.append(doc_id)
                    lengths.append(len(own))
                    ids.append(own)
                    held += len(own)
                    if held >= CHUNK_IDS:
                        yield row(part, number, doc_ids, lengths, ids)
                        number, doc_ids, lengths, ids, held = number + 1, [], [], [], 0
        if doc_ids:
            yield row(part, number, doc_ids, lengths, ids)

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, kind: str = "byte") -> None:
    """Encode every text and write ``chunks`` and ``index`` under ``path``.

    ``tokenizer`` is the path of its file, on every machine; ``end_id`` ends each document.
    """
    if kind not in ("byte", "bit"):
        raise ValueError(f"planes are of kind byte or bit, not {kind!r}")
    parts = max(shuffle_partitions(docs), -(-text_bytes(docs) // PART_BYTES))
    # Rows that repeat differ in their place in the input only; that deals them out, too.
    order = ["doc_id", "tie", "place"]
    ranged = (
        docs.select(
            F.col("doc_id").cast("bigint"),
            whole_text().cast("binary").alias("text"),
            F.xxhash64("text").alias("tie"),
            F.monotonically_increasing_id().alias("place"),
        )
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
    )
    rows = ranged.select("doc_id", "text").mapInArrow(
        _write_chunks(tokenizer, end_id, kind), CHUNKS
    )
    rows.write.option("compression", "none").parquet(f"{path}/chunks")
    spark = docs.sparkSession
    sizes = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").select(
        "part", "chunk", "n_ids", "n_docs"
    )
    # One row per task here: a short table.
    whole = sizes.groupBy("part").agg(F.sum("n_ids").alias("all"))
    before = whole.select(
        "part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("before")
    )
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("chunk")) - F.col("n_ids")
    index = sizes.withColumn("within", within).join(before, "part")
    index.select(
        "part", "chunk", (F.col("before") + F.col("within")).alias("start"), "n_ids", "n_docs"
    ).write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``chunk``, ``start`` in the sequence of all ids, ``n_ids``, ``n_docs``."""
    return spark.read.parquet(f"{path}/index")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents back from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers, null without ``with_ids``.
    """
    fields = "part int, chunk int, at bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    schema = pa.schema(
        [("part", pa.int32()), ("chunk", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()),
         ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, chunk, n_ids, doc_ids, lengths, kind, planes = (
                    c[0].as_py() for c in batch.slice(i, 1).columns
                )
                ids = chunk_ids(planes, n_ids, kind).tobytes()
                ends = np.cumsum(lengths, dtype=np.int64)
                raw = [ids[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(raw), pa.int32()),
                        pa.array([chunk] * len(raw), pa.int32()),
                        pa.array(ends - np.array(lengths, np.int64)),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                        pa.array(raw if with_ids else [None] * len(raw), pa.binary()),
                    ],
                    schema=schema,
                )

    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    docs = chunks.select("part", "chunk", "n_ids", "doc_ids", "lengths", "kind", "planes")
    found = docs.mapInArrow(run, fields)
    starts = read_index(spark, path).select("part", "chunk", "start")
    return found.join(starts, ["part", "chunk"]).select(
        "doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
