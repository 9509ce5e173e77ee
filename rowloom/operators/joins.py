"""Joins against a side that has each key once, safe when a few keys of the other side are hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.rows import row_fingerprint
from rowloom.session import checkpointed, fits_broadcast

#: A key with more than this share of the rows is hot, so there are fewer hot keys than its inverse.
HOT_SHARE = 1 / 1024
#: Below so many rows no key is hot: one task reads them easily.
LEAST_HOT = 100_000


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE, least: int | None = None) -> DataFrame:
    """``keys`` and ``__parts`` of the hot keys: in how many parts their counted rows go to stay within the target.

    One scan of the key columns; counts are added up in the tasks before the
    shuffle, and fewer than ``1 / share`` rows are left.
    """
    counts = checkpointed(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
    rows = counts.agg(F.sum("__n")).first()[0] or 0
    target = max(int(rows * share), LEAST_HOT if least is None else least, 1)
    hot = counts.where(F.col("__n") > target)
    return hot.select(*keys, F.ceil(F.col("__n") / F.lit(target)).cast("int").alias("__parts"))


def lookup_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, share: float = HOT_SHARE, least: int | None = None
) -> DataFrame:
    """Join ``left`` to a ``right`` that holds each key once; null keys match null keys.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. A right side of
    proven size is broadcast. Otherwise both sides are hashed on the key. The
    rows of hot keys, found by counting, are dealt to as many parts as their
    number asks for, by a hash of the row and the task they come from (both stay
    the same when a task is run again), and their few right rows are repeated
    for each part.
    """
    for k in keys:
        kinds = left.schema[k].dataType, right.schema[k].dataType
        if kinds[0] != kinds[1]:
            raise ValueError(f"key {k!r} is {kinds[0]} on one side and {kinds[1]} on the other")
    other = right.withColumnsRenamed(dict(zip(keys, _marks(keys))))
    if fits_broadcast(right):
        other = F.broadcast(other)
        return left.join(other, _same(left, other, keys), how).drop(*_marks(keys))
    hot = hot_keys(left, keys, share, least)
    if hot.isEmpty():
        return left.join(other, _same(left, other, keys), how).drop(*_marks(keys))
    # Fewer rows than 1 / share, whatever the table's size.
    hot = F.broadcast(hot.withColumnsRenamed({k: f"__hot_{k}" for k in keys}))
    hot_names = [*(f"__hot_{k}" for k in keys), "__parts"]

    def with_parts(df: DataFrame, names: list[str]) -> DataFrame:
        cond = F.lit(True)
        for k, n in zip(keys, names):
            cond = cond & df[n].eqNullSafe(hot[f"__hot_{k}"])
        return df.join(hot, cond, "left")

    parts = F.coalesce("__parts", F.lit(1))
    by = F.xxhash64(row_fingerprint(left, 0), F.spark_partition_id())
    dealt = with_parts(left.withColumn("__by", by), keys).withColumn("__part", F.pmod("__by", parts).cast("int"))
    dealt = dealt.drop("__by", *hot_names)
    each = F.explode(F.sequence(F.lit(0), parts - 1))
    other = with_parts(other, _marks(keys)).withColumn("__right_part", each).drop(*hot_names)
    cond = _same(dealt, other, keys) & (F.col("__part") == F.col("__right_part"))
    return dealt.join(other, cond, how).drop("__part", "__right_part", *_marks(keys))


def _marks(keys: list[str]) -> list[str]:
    return [f"__right_{k}" for k in keys]


def _same(left: DataFrame, right: DataFrame, keys: list[str]):
    cond = F.lit(True)
    for k, m in zip(keys, _marks(keys)):
        cond = cond & left[k].eqNullSafe(right[m])
    return cond
