"""Column expressions over message lists, prompts, generated texts and scores."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

# What label extraction says when no token or several tokens occur.
NO_LABEL = "NONE"
SEVERAL_LABELS = "MULTIPLE"


# --- messages ---------------------------------------------------------------

def chat_messages(system_prompt: str | Column, user_content: Column) -> Column:
    """A system message (kept even when empty) followed by a user message."""
    system = F.lit(system_prompt) if isinstance(system_prompt, str) else system_prompt
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user_content.alias("content")),
    )


def message_is_bad(role: Column, content: Column) -> Column:
    return role.isNull() | content.isNull()


def message_faults(messages: Column) -> Column:
    """``(empty, n_bad, first_bad)`` of a message list; ``first_bad`` is a zero-based position."""
    bad = F.transform(
        messages,
        lambda m, i: F.when(m.isNull() | message_is_bad(m["role"], m["content"]), i),
    )
    positions = F.array_compact(bad)
    return F.struct(
        (F.coalesce(F.size(messages), F.lit(0)) <= 0).alias("empty"),
        F.coalesce(F.size(positions), F.lit(0)).cast("bigint").alias("n_bad"),
        F.array_min(positions).alias("first_bad"),
    )


def checked_messages(messages: Column) -> Column:
    """The list itself, failing the query on an empty list or on a bad message."""
    faults = message_faults(messages)
    return (
        F.when(faults["empty"], F.raise_error(F.lit("the message list is empty")))
        .when(
            faults["n_bad"] > 0,
            F.raise_error(
                F.concat(
                    F.lit("message without role or content at position "),
                    faults["first_bad"].cast("string"),
                )
            ),
        )
        .otherwise(messages)
    )


# --- prompts ----------------------------------------------------------------

def parse_toggle(value: str | None) -> bool | None:
    """``"true"`` and ``"false"`` switch reasoning on and off; anything else leaves the default."""
    return {"true": True, "false": False}.get(value)


@dataclass(frozen=True)
class PromptFormat:
    """How a model family writes messages; supplied by the caller.

    ``generation`` opens the answer. ``reasoning_on`` and ``reasoning_off``
    replace it when reasoning is switched; a format that leaves both out does
    not support the switch.
    """

    before_role: str
    after_role: str
    after_content: str
    generation: str
    reasoning_on: str | None = None
    reasoning_off: str | None = None

    def message(self, role: Column, content: Column) -> Column:
        return F.concat(
            F.lit(self.before_role),
            F.coalesce(role, F.lit("")),
            F.lit(self.after_role),
            F.coalesce(content, F.lit("")),
            F.lit(self.after_content),
        )

    def ending(self, reasoning: bool | None | Column = None, strict: bool = False) -> Column:
        """The text that opens the answer, for one switch or for a column of true/false/other words."""
        default = F.lit(self.generation)
        if reasoning is None:
            return default
        if self.reasoning_on is None and self.reasoning_off is None:
            problem = "this prompt format has no reasoning switch"
            if strict:
                raise ValueError(problem)
            logger.warning("%s; its default ending is used", problem)
            return default
        on = F.lit(self.generation if self.reasoning_on is None else self.reasoning_on)
        off = F.lit(self.generation if self.reasoning_off is None else self.reasoning_off)
        if isinstance(reasoning, bool):
            return on if reasoning else off
        return F.when(reasoning == "true", on).when(reasoning == "false", off).otherwise(default)


def prompt_text(
    messages: Column,
    fmt: PromptFormat,
    reasoning: bool | None | Column = None,
    strict: bool = False,
) -> Column:
    """The whole prompt of a message list, ending where the answer begins."""
    body = F.array_join(
        F.transform(messages, lambda m: fmt.message(m["role"], m["content"])), ""
    )
    return F.concat(body, fmt.ending(reasoning, strict))


# --- generated texts --------------------------------------------------------

def first_candidate(candidates: Column, dtype: T.DataType) -> Column:
    """The text of the first candidate, empty when there is none."""
    first = F.get(candidates, F.lit(0))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        first = first["text"]
    return F.coalesce(first, F.lit(""))


def allowed_ids(ids: Iterable[int | None]) -> list[int]:
    """The usable ids, sorted and each once; refused when none is left."""
    usable = sorted({i for i in ids if isinstance(i, int) and not isinstance(i, bool) and i >= 0})
    if not usable:
        raise ValueError("none of the tokens has a usable id")
    return usable


def best_allowed(scores: Column, ids: Iterable[int | None]) -> Column:
    """The allowed id with the highest score; the lowest id wins a tie."""
    ranked = F.array_max(
        F.array(
            *(
                F.struct(F.get(scores, F.lit(i)).alias("score"), F.lit(-i).alias("rank"))
                for i in allowed_ids(ids)
            )
        )
    )
    return F.when(ranked["score"].isNotNull(), -ranked["rank"])


def extract_label(text: Column, tokens: list[str]) -> Column:
    """``(has_special_token, matched_tokens, extracted_label)`` of a generated text."""
    none = F.array().cast("array<string>")
    if tokens:
        hits = [F.when(F.contains(text, F.lit(t)), F.array(F.lit(t))).otherwise(none) for t in tokens]
        matched = F.concat(*hits)
    else:
        matched = none
    return F.struct(
        (F.size(matched) > 0).alias("has_special_token"),
        matched.alias("matched_tokens"),
        F.when(F.size(matched) == 0, F.lit(NO_LABEL))
        .when(F.size(matched) == 1, F.get(matched, F.lit(0)))
        .otherwise(F.lit(SEVERAL_LABELS))
        .alias("extracted_label"),
    )


def token_checks(text: Column, output_ids: Column, token_ids: dict[str, int | None]) -> Column:
    """One struct per token: is it in the text, is its id among the generated ids."""
    def check(token: str, token_id: int | None) -> Column:
        in_ids = (
            F.lit(False)
            if token_id is None
            else F.coalesce(F.array_contains(output_ids, F.lit(token_id)), F.lit(False))
        )
        return F.struct(
            F.lit(token).alias("token"),
            F.coalesce(F.contains(text, F.lit(token)), F.lit(False)).alias("found_in_text"),
            in_ids.alias("found_in_ids"),
            F.lit(token_id).cast("bigint").alias("token_id"),
        )

    return F.array(*(check(t, i) for t, i in token_ids.items()))
