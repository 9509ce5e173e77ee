"""Complement by key and union of class parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from rowloom.functions.content import need_columns
from rowloom.operators.joins import lookup_join


def complement(df: DataFrame, taken: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``df`` whose key is not among the rows of ``taken``."""
    need_columns(df, key, "key")
    need_columns(taken, key, "key")
    return lookup_join(df, taken.select(*key).distinct(), key, "left_anti")


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    if not parts:
        raise ValueError("no parts to unite")
    return reduce(DataFrame.unionByName, parts)
