"""Column expressions for text: Python-style printing, trimming and cutting.

Everything here is a built-in expression, so it stays inside whole-stage code
generation, moves no rows and is legal on a stream.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: length of a prompt preview.
PREVIEW_CHARS = 500


def quoted(name: str) -> Column:
    """The column called exactly ``name``, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def py_trim(c: Column) -> Column:
    """Strip what Python calls whitespace (Spark's plain ``trim`` only knows the space)."""
    return F.btrim(c, F.lit(PYTHON_WHITESPACE))


def lower_trim(c: Column) -> Column:
    return F.lower(py_trim(c))


def _py_float(c: Column, dtype: T.DataType) -> Column:
    """Print a float as Python does.

    Java switches to exponent form outside [1e-3, 1e7), Python outside
    [1e-4, 1e16), so only text that carries an ``E`` has to be rewritten.
    """
    text = c.cast("string")
    negative = text.startswith("-")
    mantissa = F.regexp_replace(
        F.substring_index(F.ltrim(text, F.lit("-")), "E", 1), r"\.0$", ""
    )
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    whole_len = exponent + F.lit(1)
    positional = (
        F.when(exponent == -4, F.concat(F.lit("0.000"), digits))
        .when(
            F.length(digits) <= whole_len,
            F.concat(F.rpad(digits, whole_len, F.lit("0")), F.lit(".0")),
        )
        .otherwise(
            F.concat(
                F.substring(digits, F.lit(1), whole_len),
                F.lit("."),
                F.substring(digits, whole_len + F.lit(1), F.length(digits)),
            )
        )
    )
    # Java may print digits beyond the shortest text that reads back as the same
    # number; the first candidate that does read back is the one Python prints.
    shortest = mantissa
    for pattern in ("%.16e", "%.15e"):
        candidate = F.format_string(pattern, F.abs(c))
        trimmed = F.regexp_replace(F.substring_index(candidate, "e", 1), r"\.?0+$", "")
        same = candidate.try_cast(dtype) == F.abs(c)
        shortest = F.when(same, trimmed).otherwise(shortest)
    scientific = F.concat(
        shortest,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    magnitude = F.when((exponent >= -4) & (exponent < 16), positional).otherwise(scientific)
    signed = F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), magnitude)
    size = F.abs(c)
    return (
        F.when(F.isnan(c), F.lit(None).cast("string"))
        .when((c == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when(size == float("inf"), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .otherwise(signed)
    )


def _py_timestamp(c: Column) -> Column:
    seconds = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", seconds).otherwise(F.concat_ws(".", seconds, micros))


def py_str(c: Column, dtype: T.DataType) -> Column:
    """``str(value)`` for a column of type ``dtype``; null and NaN give null."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return _py_float(c, dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _py_timestamp(c)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def str_of(df: DataFrame, name: str) -> Column:
    """``py_str`` of a named column, using the type the table declares for it."""
    return py_str(quoted(name), df.schema[name].dataType)


def safe_str(df: DataFrame, name: str) -> Column:
    """``str(value)``, with null and NaN printed as the empty string."""
    return F.coalesce(str_of(df, name), F.lit(""))


def preview(c: Column, n: int = PREVIEW_CHARS) -> Column:
    return F.substring(c, 1, n)


def text_length(c: Column) -> Column:
    return F.length(c).cast("bigint")


def remove_tokens(c: Column, tokens: list[str]) -> Column:
    """Delete every occurrence of the tokens in one pass; a longer token wins over its prefix."""
    wanted = sorted({t for t in tokens if t}, key=lambda t: (-len(t), t))
    if not wanted:
        return c
    # a plain search is much cheaper than a pattern, and most texts hold no token
    present = reduce(or_, (F.contains(c, F.lit(t)) for t in wanted))
    return F.when(present, F.regexp_replace(c, "|".join(map(re.escape, wanted)), "")).otherwise(c)
