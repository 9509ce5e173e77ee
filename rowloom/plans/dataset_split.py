"""A labelled table cut into train and test, from file to files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from rowloom.functions.labels import NEGATIVE_LABELS, POSITIVE_LABELS
from rowloom.operators.labels import UnknownLabelsError, refuse_unknown_labels, with_label
from rowloom.operators.split import split_by_count, split_by_ratio
from rowloom.sources.writers import columns_as_text

_FLAG = "__label"


def train_test_split(
    df: DataFrame,
    label_col: str,
    mode: str = "ratio",
    train_ratio: float = 0.8,
    train_pos: int = 0,
    train_neg: int = 0,
    test_pos: int = 0,
    test_neg: int = 0,
    positive: str | Iterable[str] = POSITIVE_LABELS,
    negative: str | Iterable[str] = NEGATIVE_LABELS,
    seed: int = 42,
    key: list[str] | None = None,
    text_columns: Iterable[str] = (),
    split_col: str = "split",
) -> DataFrame:
    """The input's rows and columns with a ``split`` column of ``train`` and ``test``.

    Unknown labels stop it with their values and counts. The count of classes
    that the split needs anyway tells whether there are any, so tables without
    them are not scanned for an audit.
    """
    if mode not in ("ratio", "count"):
        raise ValueError(f"split mode has to be ratio or count, not {mode!r}")
    name = label_col.strip()
    rows = with_label(df, name, positive, negative, _FLAG)
    digest_key = list(df.columns) if key is None else key
    try:
        if mode == "ratio":
            parts = split_by_ratio(rows, _FLAG, train_ratio, seed, digest_key, split_col)
        else:
            parts = split_by_count(
                rows, _FLAG, train_pos, train_neg, test_pos, test_neg, seed, digest_key, split_col
            )
    except UnknownLabelsError:
        refuse_unknown_labels(rows, name, _FLAG)
        raise
    return columns_as_text(parts.drop(_FLAG), text_columns)
