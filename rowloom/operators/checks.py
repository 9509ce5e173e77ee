"""Checks of generated texts: labels, tokens and the result table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.chat import extract_label, first_candidate, token_checks
from rowloom.functions.content import need_columns
from rowloom.functions.labels import label_text
from rowloom.functions.text import quoted, remove_tokens


def with_first_candidate(df: DataFrame, candidates: str, out: str = "generated_text") -> DataFrame:
    need_columns(df, [candidates], "candidates")
    return df.withColumn(out, first_candidate(quoted(candidates), df.schema[candidates].dataType))


def with_clean_text(df: DataFrame, raw: str, tokens: list[str], out: str = "content") -> DataFrame:
    """The text without special tokens, beside the raw text."""
    need_columns(df, [raw], "generated text")
    return df.withColumn(out, remove_tokens(quoted(raw), tokens))


def with_label_check(df: DataFrame, text: str, tokens: list[str]) -> DataFrame:
    """Adds ``has_special_token``, ``matched_tokens`` and ``extracted_label``."""
    need_columns(df, [text], "generated text")
    return df.select("*", F.inline(F.array(extract_label(quoted(text), tokens))))


def token_report(
    df: DataFrame, keys: list[str], text: str, output_ids: str, token_ids: dict[str, int | None]
) -> DataFrame:
    """One row for each key and token: found in the text, found among the ids, the token's id."""
    need_columns(df, [*keys, text, output_ids], "token report")
    checks = token_checks(quoted(text), quoted(output_ids), token_ids)
    return df.select(*(quoted(k) for k in keys), F.inline(checks))


def result_rows(
    df: DataFrame, keys: list[str], label: str | None, text: str, tokens: list[str] | None = None
) -> DataFrame:
    """Keys, label text, generated text and, when tokens are given, the label check."""
    need_columns(df, [*keys, text], "result rows")
    rows = df.select(
        *(quoted(k) for k in keys),
        label_text(df, label).alias("label_text"),
        quoted(text).alias("generated_text"),
    )
    return with_label_check(rows, "generated_text", tokens) if tokens else rows
