"""Columns of JSON lines: keys in the order of their first place, and types that keep what a value prints as."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import py_str, py_trim, quoted

#: Different keys of a table at most; more of them are data, not columns.
KEYS = 10_000
INTEGER = r"^-?[0-9]+$"

_WHOLE, _LONG, _NUMBER, _OTHER = 1, 2, 4, 8
#: Words that Python writes for floats, though they are no JSON; types are decided as if 0.5 stood there.
_NOT_JSON = r"([:\[,]\s*)-?(?:NaN|Infinity)(?=\s*[,}\]])"
_DUPLICATES = "spark.sql.variant.allowDuplicateKeys"


def _kind(value: Column) -> Column:
    name = F.schema_of_variant(value)
    long = name.rlike(r"^DECIMAL\((19|[2-9][0-9]),0\)$")
    return (
        F.when(name == "VOID", F.lit(0))
        .when(name == "BIGINT", F.lit(_WHOLE))
        .when(long, F.lit(_LONG))
        .when(name.rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.lit(_NUMBER))
        .otherwise(F.lit(_OTHER))
    )


def spark_type(name: str) -> T.DataType:
    """The type that the name of a variant's type stands for; text where values are of several kinds, or of none."""
    parts = re.split(r"(`(?:[^`]|``)*`)", name)
    for i in range(0, len(parts), 2):
        plain = re.sub(r"\bOBJECT<>|\bVOID\b|\bVARIANT\b|\bDECIMAL\((?:19|[2-9][0-9]),0\)", "STRING", parts[i])
        parts[i] = re.sub(r"\bDECIMAL\([0-9, ]+\)", "DOUBLE", plain).replace("OBJECT<", "STRUCT<")
    return T.DataType.fromDDL("".join(parts))


def key_columns(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]]:
    """The schema of JSON lines in the order of keys, and the columns of mixed numbers, whose texts are kept.

    One scan and one aggregate, a row for each key: its first place (file, range,
    line, place in the line), its merged type, and the kinds of its values. Lines
    that are no objects are left to the reader to refuse.
    """
    before = spark.conf.get(_DUPLICATES, "false")
    spark.conf.set(_DUPLICATES, "true")
    try:
        found = _keys(spark.read.text(path)).orderBy("first").limit(KEYS + 1).collect()
    finally:
        spark.conf.set(_DUPLICATES, before)
    if len(found) > KEYS:
        raise ValueError(f"{path!r} has more than {KEYS} different keys")
    if spark.conf.get("spark.sql.caseSensitive") != "true":
        _need_different([r["key"] for r in found])
    fields, mixed = [], []
    for r in found:
        numbers_only = not r["kinds"] & _OTHER
        as_text = numbers_only and bool(r["kinds"] & _LONG or r["kinds"] == _WHOLE | _NUMBER)
        fields.append(T.StructField(r["key"], T.StringType() if as_text else spark_type(r["type"])))
        mixed += [r["key"]] if as_text else []
    return T.StructType(fields), mixed


def _keys(texts: DataFrame) -> DataFrame:
    """key, first, type and kinds, a row for each key of the objects."""
    line = py_trim(F.col("value"))
    spelt = F.when(line.rlike(_NOT_JSON) & F.try_parse_json(line).isNull(), F.regexp_replace(line, _NOT_JSON, "$1 0.5")).otherwise(line)
    lines = texts.select(
        spelt.alias("line"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("no"),
        ).alias("at"),
    )
    objects = lines.where(F.startswith("line", F.lit("{"))).select(
        "at", F.json_object_keys("line").alias("names"), F.try_parse_json("line").alias("object")
    )
    each = objects.lateralJoin(texts.sparkSession.tvf.variant_explode(F.col("object").outer()))
    place = F.struct("at", F.array_position("names", F.col("key")).alias("place"))
    return each.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min(place).alias("first"), F.schema_of_variant_agg("value").alias("type"), F.bit_or(_kind(F.col("value"))).alias("kinds")
    )


def _need_different(names: list[str]) -> None:
    seen: dict[str, str] = {}
    for n in names:
        if n.lower() in seen:
            raise ValueError(f"keys {seen[n.lower()]!r} and {n!r} differ in case only; set spark.sql.caseSensitive to keep both")
        seen[n.lower()] = n


def number_texts(table: DataFrame, names: list[str]) -> DataFrame:
    """Columns of mixed numbers as texts: whole numbers as they stand, others as Python prints them."""
    printed = {n: py_str(quoted(n).try_cast("double"), T.DoubleType()) for n in names}
    return table.withColumns({n: F.when(quoted(n).rlike(INTEGER), quoted(n)).otherwise(p) for n, p in printed.items()}) if names else table
