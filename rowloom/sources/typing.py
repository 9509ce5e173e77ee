"""Column types for text read from files: missing-value words and one-pass type decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import quoted

# The words a CSV reader takes for a missing value.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# What counts as a whole number, a number and a truth value.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
TRUE_WORDS = ["True", "TRUE", "true"]
FALSE_WORDS = ["False", "FALSE", "false"]


def trimmed_names(names: list[str]) -> list[str]:
    """Column names as trimmed text; refused when two become the same."""
    trimmed = [str(n).removeprefix("\ufeff").strip() for n in names]
    seen: dict[str, str] = {}
    for n in trimmed:
        if n.lower() in seen:
            raise ValueError(f"column names collide: {seen[n.lower()]!r} and {n!r}")
        seen[n.lower()] = n
    return trimmed


def trim_header(df: DataFrame) -> DataFrame:
    return df.toDF(*trimmed_names(df.columns))


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(MISSING_WORDS), c)


def decided_types(
    df: DataFrame, names: list[str], surely_text: dict[str, Column] | None = None
) -> dict[str, T.DataType]:
    """The narrowest type that fits all values of each text column, found in one pass.

    Whole numbers, numbers, truth values, else text. A column without any value
    counts as numbers. ``surely_text`` says for a column which values were stored
    as text, whatever they look like.
    """
    marks = surely_text or {}

    def kind(name: str) -> Column:
        looks = _kind(quoted(name))
        if name not in marks:
            return looks
        return F.when(quoted(name).isNotNull() & marks[name], F.lit(_TEXT)).otherwise(looks)

    seen = df.agg(*(F.bit_or(kind(n)).alias(f"k{i}") for i, n in enumerate(names))).first()
    return {n: _type_of_kinds(seen[f"k{i}"]) for i, n in enumerate(names)}


_FITS, _TOO_LONG, _NUMBER, _TRUTH, _TEXT = 1, 2, 4, 8, 16


def _kind(c: Column) -> Column:
    """What one text looks like, as a bit; null for null."""
    whole = c.rlike(INTEGER_TEXT)
    return (
        F.when(c.isNull(), F.lit(None).cast("int"))
        .when(whole & c.try_cast("bigint").isNotNull(), F.lit(_FITS))
        .when(whole, F.lit(_TOO_LONG))
        .when(c.rlike(NUMBER_TEXT), F.lit(_NUMBER))
        .when(c.isin(TRUE_WORDS + FALSE_WORDS), F.lit(_TRUTH))
        .otherwise(F.lit(_TEXT))
    )


def _type_of_kinds(kinds: int | None) -> T.DataType:
    if kinds is None:
        return T.DoubleType()
    if kinds == _FITS:
        return T.LongType()
    if kinds & _NUMBER and not kinds & (_TRUTH | _TEXT):
        return T.DoubleType()
    return T.BooleanType() if kinds == _TRUTH else T.StringType()


def cast_columns(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Text columns as the decided types, in table order."""
    return df.select(
        *(
            quoted(n) if isinstance(t, T.StringType) else quoted(n).cast(t).alias(n)
            for n, t in types.items()
        )
    )
