"""Binary labels of mixed types as one nullable boolean column."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import lower_trim, py_str, py_trim, quoted, safe_str

logger = logging.getLogger(__name__)

# The words read as yes and as no when the caller names none.
POSITIVE_LABELS = "是,true,1,yes,y,t"
NEGATIVE_LABELS = "否,false,0,no,n,f"


def label_set(values: str | Iterable[str]) -> frozenset[str]:
    """Comma-separated text (or a list of words) as a set of trimmed lower-case words."""
    words = values.split(",") if isinstance(values, str) else values
    return frozenset(str(w).strip().lower() for w in words) - {""}


def label_sets(
    positive: str | Iterable[str] = POSITIVE_LABELS,
    negative: str | Iterable[str] = NEGATIVE_LABELS,
) -> tuple[frozenset[str], frozenset[str]]:
    """Both sets, refused when a word is in each of them."""
    yes, no = label_set(positive), label_set(negative)
    if yes & no:
        raise ValueError(f"labels named as positive and as negative: {sorted(yes & no)}")
    return yes, no


def _look_up(text: Column, yes: frozenset[str], no: frozenset[str]) -> Column:
    """One lookup in a constant map, so the text is worked out once per row."""
    if not yes and not no:
        return F.lit(None).cast("boolean")
    pairs = [(w, True) for w in sorted(yes)] + [(w, False) for w in sorted(no)]
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in pairs for x in pair)), text)


def binary_label(
    df: DataFrame,
    name: str,
    positive: str | Iterable[str] = POSITIVE_LABELS,
    negative: str | Iterable[str] = NEGATIVE_LABELS,
) -> Column:
    """True, False or null (unknown) for the raw label column ``name``.

    The rule follows the column's type: booleans stand for themselves, floats
    are first looked up without their fraction, everything is then looked up as
    trimmed lower-case text.
    """
    yes, no = label_sets(positive, negative)
    raw, dtype = quoted(name), df.schema[name].dataType
    if isinstance(dtype, T.BooleanType):
        return raw
    text = py_str(raw, dtype)
    as_text = _look_up(F.lower(text), yes, no)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        # the words hold no outer whitespace, so trimming is only needed after a miss
        as_text = F.coalesce(as_text, _look_up(lower_trim(text), yes, no))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        whole = raw.try_cast("bigint").cast("string")
        finite = F.abs(raw) < F.lit(float("inf"))
        return F.when(finite, F.coalesce(_look_up(whole, yes, no), as_text))
    return as_text


def label_text(df: DataFrame, name: str | None) -> Column:
    """The label as trimmed text, null when empty; null throughout when there is no such column."""
    if not name or name not in df.columns:
        if name:
            logger.warning("no label column %r; the table has %s", name, df.columns)
        return F.lit(None).cast("string")
    return F.nullif(py_trim(safe_str(df, name)), F.lit(""))
