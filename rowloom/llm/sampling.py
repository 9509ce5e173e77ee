"""Bounded samples of labelled rows, by a hash of the row's key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import small

def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text is divisible by five; a null key counts as the text ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def bounded_sample(rows: DataFrame, key: str, bound: int, by: str | None = None) -> DataFrame:
    """About ``bound`` rows at most, whatever their number: those with the least 64-bit hashes of the key.

    With ``by`` (not null), about as many for each of its values.
    """
    place = F.xxhash64(F.lit("sample"), F.col(key))
    if by is None:
        n = rows.count()
        return rows if n <= bound else rows.where(place < (bound << 64) // n - (1 << 63))
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    limit = (F.lit(float(bound)) / F.col("__n") * 2.0**64 - 2.0**63).cast("bigint")
    limits = sizes.where(F.col("__n") > bound).select(by, limit.alias("__limit"))
    kept = F.col("__limit").isNull() | (place < F.col("__limit"))
    return rows.join(small(limits), by, "left").where(kept).select(*(F.col(f"`{c}`") for c in rows.columns))
