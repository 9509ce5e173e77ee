"""Audits and counts over a normalised label."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.content import need_columns
from rowloom.functions.labels import NEGATIVE_LABELS, POSITIVE_LABELS, binary_label
from rowloom.functions.text import quoted, str_of

# How many unknown values an error message spells out; the audit table has them all.
SHOWN = 50


class UnknownLabelsError(ValueError):
    """Some rows carry a label that is neither positive nor negative."""


def with_label(
    df: DataFrame,
    name: str,
    positive: str | Iterable[str] = POSITIVE_LABELS,
    negative: str | Iterable[str] = NEGATIVE_LABELS,
    out: str = "label",
) -> DataFrame:
    need_columns(df, [name], "label column")
    return df.withColumn(out, binary_label(df, name, positive, negative))


def of_class(df: DataFrame, positive: bool, label: str = "label") -> DataFrame:
    flag = quoted(label)
    return df.where(flag if positive else ~flag)


def unknown_labels(df: DataFrame, raw: str, label: str = "label") -> DataFrame:
    """``(value, n)`` for every raw value whose label is unknown, null counted as a value."""
    return (
        df.where(quoted(label).isNull())
        .groupBy(str_of(df, raw).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def refuse_unknown_labels(df: DataFrame, raw: str, label: str = "label") -> None:
    """Raise with the most frequent unknown values and their counts, if there are any."""
    worst = unknown_labels(df, raw, label).orderBy(F.desc("n"), "value").limit(SHOWN).collect()
    if worst:
        counts = {r["value"]: r["n"] for r in worst}
        raise UnknownLabelsError(f"unrecognised label values in {raw!r}: {counts}")


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(quoted(split).alias("split")).agg(F.count(F.lit(1)).alias("n"))
