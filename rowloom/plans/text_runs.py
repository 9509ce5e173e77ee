"""From table rows to prompts, generated texts and checked results, for whole tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.chat import PromptFormat, chat_messages, checked_messages, prompt_text, token_checks
from rowloom.functions.content import need_columns, user_text
from rowloom.functions.labels import label_text
from rowloom.functions.text import preview, quoted, text_length
from rowloom.operators.checks import with_clean_text, with_label_check
from rowloom.operators.generation import Generator, generate


def prompt_rows(
    df: DataFrame,
    keys: list[str],
    fmt: PromptFormat,
    system_prompt: str = "",
    text_col: str | None = None,
    template: str | None = None,
    label_col: str | None = None,
    reasoning: bool | None | Column = None,
    strict: bool = False,
) -> DataFrame:
    """``keys``, ``label_text`` and ``prompt`` of each row; nothing is shuffled."""
    need_columns(df, keys, "keys")
    messages = chat_messages(system_prompt, user_text(df, text_col, template))
    return df.select(
        *(quoted(k) for k in keys),
        label_text(df, label_col).alias("label_text"),
        prompt_text(messages, fmt, reasoning, strict).alias("prompt"),
    )


def generation_results(
    prompts: DataFrame,
    factory: Callable[..., Generator],
    tokens: list[str] | None = None,
    options: dict[str, Any] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Label text, generated text and, when tokens are given, the label found in it, for each prompt."""
    done = generate(prompts, "prompt", factory, options=options, partitions=partitions)
    return with_label_check(done, "generated_text", tokens) if tokens else done


def list_prompts(
    df: DataFrame,
    keys: list[str],
    messages: str,
    fmt: PromptFormat,
    label_col: str | None = None,
    reasoning: bool | None | Column = None,
    strict: bool = False,
) -> DataFrame:
    """``keys``, ``label_text`` and ``prompt`` of rows that hold message lists; an empty list or a bad message fails the query."""
    need_columns(df, [*keys, messages], "message lists")
    return df.select(
        *(quoted(k) for k in keys),
        label_text(df, label_col).alias("label_text"),
        prompt_text(checked_messages(quoted(messages)), fmt, reasoning, strict).alias("prompt"),
    )


def token_run(
    prompts: DataFrame,
    factory: Callable[..., Generator],
    token_ids: dict[str, int | None],
    special: list[str] | None = None,
    labels: list[str] | None = None,
    options: dict[str, Any] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The whole run of a generator that gives texts with ids, in one plan without a shuffle.

    Beside the columns of the prompts: ``raw_text`` as generated,
    ``generated_text`` without the ``special`` tokens, ``output_ids``, the label
    found in the raw text (if ``labels`` are given), and ``token_checks``: of
    every token of ``token_ids``, whether it is in the raw text and its id among
    the ids.
    """
    done = generate(prompts, "prompt", factory, out="raw_text", options=options, partitions=partitions, ids="output_ids")
    done = with_clean_text(done, "raw_text", special or [], "generated_text")
    if labels:
        done = with_label_check(done, "raw_text", labels)
    return done.withColumn("token_checks", token_checks(F.col("raw_text"), F.col("output_ids"), token_ids))


def prompt_lengths(prompts: DataFrame, prompt: str = "prompt") -> DataFrame:
    """The table with ``preview`` and ``n_chars`` of its prompts."""
    return prompts.withColumns(
        {"preview": preview(F.col(prompt)), "n_chars": text_length(F.col(prompt))}
    )
