"""Sharding by extendible hashing.

Keys hash to strings of bits. The directory names shards by bit prefixes: a
bucket over the byte limit splits on the next bit, and only such a bucket, until
every shard fits. Instead of splitting rows one bit at a time, sizes are added
up once for fine buckets and then for all their prefixes; the shard of a row is
its shortest prefix that fits. Only what is still too large at the fine level
is looked at again, on more bits.

The address has 64 bits of the key's hash and 64 bits of a hash of the row's
number in the stored input, so a key with a third of all rows still spreads
over as many shards as it needs. A single row over the limit is a shard of its
own. Null keys are a key like any other; null sizes count as 0; repeated rows
are placed each; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import small, stored

KEY_BITS, ROW_BITS, SPARE = 64, 64, 5


def _bits(value: Column) -> Column:
    """The first 64 bits of the MD5 as a string of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(value.cast("binary")), 1, 16), 16, 2), 64, "0")


def _directory(bins: DataFrame, low: int, depth: int, max_bytes: int) -> DataFrame:
    """``bin`` and its ``shard``: the shortest prefix of ``low`` bits or more that fits; null if none does."""
    parts = bins.select("bin", "bytes", "rows", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("d"))
    parts = parts.withColumn("prefix", F.substring("bin", F.lit(1), F.col("d")))
    sums = parts.groupBy("prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
    fits = sums.where((F.col("shard_bytes") <= max_bytes) | (F.col("shard_rows") == 1))
    found = parts.select("bin", "d", "prefix").join(small(fits), "prefix")
    leaf = found.groupBy("bin").agg(F.min(F.struct("d", "prefix", "shard_bytes", "shard_rows")).alias("leaf"))
    return bins.select("bin").join(leaf, "bin", "left").select(
        "bin", F.col("leaf.prefix").alias("shard"), F.col("leaf.shard_bytes").alias("shard_bytes"), F.col("leaf.shard_rows").alias("shard_rows")
    )


def extendible_shards(rows: DataFrame, key: list[str], size: Column, max_bytes: int) -> DataFrame:
    """``rows`` with ``n_bytes``, ``shard`` (its bit prefix), ``shard_bytes`` and ``shard_rows``.

    ``size`` gives a row's bytes. The input is stored once, so that rows keep
    their numbers.
    """
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    own = {"n_bytes", "shard", "shard_bytes", "shard_rows"}
    names = [c for c in rows.columns if c not in own]
    named = F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in key))
    base = stored(
        rows.select(
            *(F.col(f"`{c}`") for c in names),
            F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"),
            named.alias("__key"),
            F.monotonically_increasing_id().alias("__row"),
        )
    )
    address = F.concat(_bits(F.col("__key")), _bits(F.concat_ws(":", "__key", F.col("__row").cast("string"))))
    pending, low, done = base.withColumn("__address", address), 0, None
    largest = base.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    depth = 0
    while True:
        more = max(0, math.ceil(math.log2(max(largest, 1) / max_bytes)))
        depth = min(KEY_BITS + ROW_BITS, depth + more + SPARE if low <= KEY_BITS else KEY_BITS + ROW_BITS)
        pending = pending.withColumn("bin", F.substring("__address", 1, depth))
        bins = stored(pending.groupBy("bin").agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")))
        directory = stored(_directory(bins, low, depth, max_bytes))
        placed = pending.join(small(directory), "bin")
        here = placed.where("shard is not null").select(*(f"`{c}`" for c in names), "n_bytes", "shard", "shard_bytes", "shard_rows")
        done = here if done is None else done.unionByName(here)
        open_bins = directory.where("shard is null").select("bin")
        largest = bins.join(open_bins, "bin", "left_semi").agg(F.max("bytes").alias("n")).first()["n"]
        if largest is None:
            return done
        if depth == KEY_BITS + ROW_BITS:
            raise ValueError(f"rows of {largest} bytes share all {depth} bits of their address")
        pending = pending.join(small(open_bins), "bin", "left_semi").drop("bin")
        # Rows of one key part on the row's bits only, so the next look takes these in.
        low, depth = depth + 1, max(depth, KEY_BITS)


def write_shards(rows: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder a shard, each written by one task; shards are bounded, so tasks are."""
    rows.repartition(shard).write.partitionBy(shard).parquet(path)
