"""Sharding by extendible hashing: a directory of hash prefixes, none over the byte limit.

The hash of a document's key is read bit by bit; a bucket over the limit is split on its next bit,
and only such a bucket is. As a bucket's parent is never smaller than the bucket, the shard of a
document is its shortest hash prefix that holds no more bytes than the limit. Sizes are summed per
fine cell first, so levels are added up over cells and not over documents.

A null text counts no bytes, a null key is a key of its own. Documents that share a key share all
bits; where the bits run out, such a bucket is dealt into as many parts as it needs. A document
over the limit has a shard of its own, marked by its size. Other columns are carried along, and
columns named like the results are replaced.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators.lookup import lookup_join
from tillroll.session import scratch_dir

BITS = 60
SHARD_BYTES = 64 * 1024 * 1024


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key's text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.left(digest, F.lit(BITS // 4)), 16, 10).cast("bigint")


def _prefix(bits: Column, depth: int) -> Column:
    return F.shiftright(bits, BITS - depth)


def _coarser(cell: str, by: Column) -> Column:
    return F.call_function("shiftright", F.col(cell), by)


def directory(sized: DataFrame, limit: int, step: int) -> DataFrame:
    """The cells of depth ``step`` and finer, each with the shard it belongs to.

    ``sized`` has ``hash`` and ``bytes``. Returns ``cell_depth``, ``cell``, ``depth``, ``prefix``
    of all cells, ``depth`` being null where even the whole hash holds too much.
    """
    spark = sized.sparkSession
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    fine = min(BITS, max(1, ceil(log2(max(1, total) / limit) if total > limit else 0) + step))
    above, parts = 0, []
    rows = sized
    while True:
        path = scratch_dir(spark, "cells")
        (
            rows.groupBy(_prefix(F.col("hash"), fine).alias("cell"))
            .agg(F.sum("bytes").alias("bytes"))
            .write.parquet(path)
        )
        cells = spark.read.parquet(path)
        depths = F.sequence(F.lit(above), F.lit(fine))
        levels = (
            cells.select("bytes", "cell", F.explode(depths).alias("depth"))
            .select(
                "bytes", "depth",
                _coarser("cell", F.lit(fine) - F.col("depth")).alias("prefix"),
            )
            .groupBy("depth", "prefix")
            .agg(F.sum("bytes").alias("bytes"))
        )
        fits = levels.where(F.col("bytes") <= limit).select("depth", "prefix")
        # A shard is a prefix that fits and whose parent does not; it has the cells below it. All keys
        # here are unique, so no join has a hot one.
        below = fits.select(
            (F.col("depth") + 1).alias("depth"),
            F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"),
        )
        shards = fits.join(below, ["depth", "prefix"], "left_anti")
        first, stop = (
            F.call_function("shiftleft", p, F.lit(fine) - F.col("depth"))
            for p in (F.col("prefix"), F.col("prefix") + 1)
        )
        found = shards.select("depth", F.explode(F.sequence(first, stop - 1)).alias("cell"))
        placed = cells.select("cell").join(found, "cell", "left")
        path = scratch_dir(spark, "directory")
        placed.write.parquet(path)
        placed = spark.read.parquet(path)
        full = placed.where(F.col("depth").isNull()).select("cell")
        if fine == BITS or full.isEmpty():
            parts.append(placed.withColumn("cell_depth", F.lit(fine)))
            break
        parts.append(placed.where(F.col("depth").isNotNull()).withColumn("cell_depth", F.lit(fine)))
        rows = rows.join(
            full.withColumnRenamed("cell", "_full"), _prefix(F.col("hash"), fine) == F.col("_full"),
            "left_semi",
        )
        above, fine = fine + 1, min(BITS, fine + 2 * step)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(
        "prefix", _coarser("cell", F.col("cell_depth") - F.col("depth"))
    )


def _own(bits: Column, depth: Column) -> Column:
    return F.call_function("shiftright", bits, F.lit(BITS) - depth)


def _shards_near(cells: DataFrame, depth: int) -> DataFrame:
    """Per prefix of a depth (``near``), the depths and prefixes of the ``shards`` within it or around it."""
    d, p = F.col("depth"), F.col("prefix")
    down = [
        F.call_function("shiftleft", x, F.greatest(F.lit(depth) - d, F.lit(0))) for x in (p, p + 1)
    ]
    around = F.sequence(down[0], down[1] - 1)
    within = F.array(F.call_function("shiftright", p, F.greatest(d - F.lit(depth), F.lit(0))))
    found = cells.where(d.isNotNull()).select("depth", "prefix").distinct()
    met = found.select("depth", "prefix", F.explode(F.when(d < depth, around).otherwise(within)).alias("near"))
    return met.groupBy("near").agg(F.collect_list(F.struct("depth", "prefix")).alias("shards"))


def n_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")


def shard(
    rows: DataFrame,
    limit: int = SHARD_BYTES,
    *,
    key: str = "doc_id",
    size: Column | None = None,
    step: int = 6,
) -> DataFrame:
    """The rows with ``shard``, a string of hash bits, and ``n_bytes``, what they count for.

    ``size`` is by default the text's. ``shard`` is empty where everything fits into one. A part
    of a bucket whose bits ran out has its number after a dash.
    """
    placed = rows.select(
        F.struct("*").alias("_row"),
        hash_bits(F.col(key)).alias("_hash"),
        (n_bytes() if size is None else size).alias("n_bytes"),
    )
    sized = placed.select(F.col("_hash").alias("hash"), F.col("n_bytes").alias("bytes"))
    cells = directory(sized, limit, step)
    depths = [r[0] for r in cells.select("cell_depth").distinct().collect()]
    # A prefix that a few shards share, so that one join brings each shard's rows together.
    n_shards = cells.select("depth", "prefix").distinct().count()
    depth = max(0, n_shards.bit_length() - 2)
    near = _shards_near(cells, depth)
    met = lookup_join(
        placed.withColumn("_near", _prefix(F.col("_hash"), depth)),
        near.hint("merge"),  # at every size, as broadcasting would leave the rows where they are
        {"_near": "near"},
        "left",
    ).drop("_near")
    held = F.filter("shards", lambda x: _own(F.col("_hash"), x["depth"]) == x["prefix"])
    out = met.withColumn("_shard", F.get(held, F.lit(0))).drop("shards")
    out = out.select("*", F.col("_shard.depth").alias("_depth"), F.col("_shard.prefix").alias("_prefix"))
    out = out.drop("_shard")
    bits = F.lpad(F.conv(F.col("_prefix").cast("string"), 10, 2), F.col("_depth"), F.lit("0"))
    named = out.withColumn("_name", F.when(F.col("_depth") == 0, "").otherwise(bits))
    dealt = _dealt(named, limit, max(depths, default=0))
    kept = [F.col("_row").getField(c).alias(c) for c in rows.columns if c not in ("shard", "n_bytes")]
    return dealt.select(*kept, "n_bytes", "shard")


def _dealt(named: DataFrame, limit: int, max_depth: int) -> DataFrame:
    """Names of shards, with the parts of the buckets whose bits ran out.

    Such a bucket holds one key. Its documents over the limit become parts of their own; the others
    are dealt round in equal numbers, into so many parts that none is too large whatever falls
    into it: the limit holds at least ``limit // largest`` of them.
    """
    open_ = named.where(F.col("_depth").isNull())
    closed = named.where(F.col("_depth").isNotNull()).withColumn("shard", F.col("_name"))
    if max_depth < BITS or open_.isEmpty():
        return closed
    spark = named.sparkSession
    path = scratch_dir(spark, "overflow")  # written, so that numbers given to rows stay
    open_.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    part = F.shiftright("_at", 33)
    # Row numbers per key without one task per key: counts per writing task, then offsets.
    within = Window.partitionBy("_hash", "_part").orderBy("_at")
    counted = rows.withColumn("_part", part).groupBy("_hash", "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.max("n_bytes").alias("_most")
    )
    before = Window.partitionBy("_hash").orderBy("_part")
    offsets = counted.select(
        "_hash", "_part",
        (F.sum("_n").over(before) - F.col("_n")).alias("_before"),
        F.max("_most").over(Window.partitionBy("_hash")).alias("_largest"),
    )
    numbered = rows.withColumn("_part", part).withColumn("_k", F.row_number().over(within) - 1)
    met = numbered.join(offsets, ["_hash", "_part"])
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("_largest", F.lit(1))))
    number = F.floor((F.col("_before") + F.col("_k")) / each)
    bits = F.lpad(F.conv(F.col("_hash").cast("string"), 10, 2), BITS, "0")
    dealt = met.withColumn("shard", F.concat(bits, F.lit("-"), number.cast("string")))
    return closed.unionByName(dealt.select(*closed.columns))


def shard_sizes(sharded: DataFrame) -> DataFrame:
    """``shard``, its documents and its bytes."""
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("shard_docs"), F.sum("n_bytes").alias("shard_bytes")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard: ``shard=<bits>``; the shard of everything is ``shard=all``.

    Rows as they come from :func:`shard` are together by shard, so a task writes whole shards: those of
    a prefix, one file each. Only a shard larger in hash space than most has several files.
    """
    named = sharded.withColumn("shard", F.when(F.col("shard") == "", "all").otherwise(F.col("shard")))
    named.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, fields: StructType) -> DataFrame:
    """The rows of all shards, or with a filter on ``shard`` of some, as they were written.

    ``fields`` are those of the sharded rows; a shard's bits stay text.
    """
    rows = spark.read.schema(fields).parquet(path)
    return rows.withColumn("shard", F.when(F.col("shard") == "all", "").otherwise(F.col("shard")))
