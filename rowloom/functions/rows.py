"""Whole rows as text and as hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import quoted

JSON_OF_ROWS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_text(df: DataFrame) -> Column:
    """The whole row as text; equal texts mean equal rows."""
    return F.to_json(F.struct(*(quoted(n) for n in df.columns)), JSON_OF_ROWS)


def row_fingerprint(df: DataFrame, salt: int) -> Column:
    """A 64-bit hash of the whole row, nulls and their places included."""
    parts = [F.lit(salt)]
    for f in df.schema:
        c = quoted(f.name)
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c, JSON_OF_ROWS)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c.cast("string")
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)
