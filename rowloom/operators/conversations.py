"""Messages kept one per row: validation and prompts per conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.chat import PromptFormat, message_faults, message_is_bad
from rowloom.functions.content import need_columns
from rowloom.functions.text import quoted
from rowloom.session import fits_broadcast

# Messages gathered into one list at a time; longer conversations are put together in two steps.
BLOCK = 1024


def validate_messages(
    df: DataFrame, conv: str, turn: str, role: str = "role", content: str = "text"
) -> DataFrame:
    """``(conv, n_bad, first_bad)``: messages without role or content, and the first turn of them.

    Counts and minima are combined before the shuffle, so a conversation with
    very many messages costs no more than others.
    """
    need_columns(df, [conv, turn, role, content], "messages")
    bad = message_is_bad(quoted(role), quoted(content))
    return df.groupBy(quoted(conv).alias(conv)).agg(
        F.count_if(bad).alias("n_bad"), F.min(F.when(bad, quoted(turn))).alias("first_bad")
    )


def validate_message_lists(df: DataFrame, messages: str) -> DataFrame:
    """The table with ``empty``, ``n_bad`` and ``first_bad`` of its message list column."""
    need_columns(df, [messages], "messages")
    return df.select("*", F.inline(F.array(message_faults(quoted(messages)))))


def refuse_bad_messages(report: DataFrame) -> None:
    """Raise when a validation report names a bad or an empty message list."""
    wrong = F.col("n_bad") > 0
    if "empty" in report.columns:
        wrong = wrong | F.col("empty")
    first = report.where(wrong).limit(1).collect()
    if first:
        raise ValueError(f"bad messages: {first[0].asDict()}")


def prompt_blocks(
    df: DataFrame,
    conv: str,
    turn: str,
    fmt: PromptFormat,
    role: str = "role",
    content: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``(conv, block, text)``: rendered messages in runs of ``block`` turns.

    Read in block order and followed by the format's ending, the texts are the
    prompt. No group holds more than a run, however long the conversation.
    """
    need_columns(df, [conv, turn, role, content], "messages")
    if not isinstance(df.schema[turn].dataType, T.IntegralType):
        raise ValueError(f"turn column {turn!r} has to be an integer, not {df.schema[turn].dataType}")
    run = F.floor(quoted(turn) / F.lit(block)).cast("bigint")
    return _rendered(df, [quoted(conv).alias(conv), run.alias("block")], turn, fmt, role, content)


def _rendered(
    df: DataFrame, by: list[Column], turn: str, fmt: PromptFormat, role: str, content: str
) -> DataFrame:
    piece = F.struct(
        quoted(turn).alias("turn"), fmt.message(quoted(role), quoted(content)).alias("piece")
    )
    in_order = F.sort_array(F.collect_list(piece))["piece"]
    return df.groupBy(*by).agg(F.array_join(in_order, "").alias("text"))


def conversation_prompts(
    df: DataFrame,
    conv: str,
    turn: str,
    fmt: PromptFormat,
    role: str = "role",
    content: str = "text",
    reasoning: bool | None = None,
    strict: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """``(conv, prompt)``, one row for each conversation.

    Texts are shuffled once. Conversations of more than ``block`` messages are
    found by a count beforehand; theirs are first joined run by run, so many
    tasks share the work. One prompt is one string and so has to fit Spark's
    2 GB limit for a value; ``prompt_blocks`` has no such limit.
    """
    need_columns(df, [conv, turn, role, content], "messages")
    ending = fmt.ending(reasoning, strict)

    def finish(texts: DataFrame) -> DataFrame:
        return texts.select(quoted(conv), F.concat("text", ending).alias("prompt"))

    def in_two_steps(rows: DataFrame) -> DataFrame:
        runs = prompt_blocks(rows, conv, turn, fmt, role, content, block)
        in_order = F.sort_array(F.collect_list(F.struct("block", "text")))["text"]
        return finish(runs.groupBy(quoted(conv)).agg(F.array_join(in_order, "").alias("text")))

    def in_one_step(rows: DataFrame) -> DataFrame:
        return finish(_rendered(rows, [quoted(conv).alias(conv)], turn, fmt, role, content))

    long_ones = (
        df.groupBy(quoted(conv).alias("__conv"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > block)
        .select("__conv")
    )
    if long_ones.isEmpty():
        return in_one_step(df)
    if not fits_broadcast(long_ones):
        return in_two_steps(df)
    is_long = F.broadcast(long_ones)
    same = quoted(conv).eqNullSafe(F.col("__conv"))
    return in_one_step(df.join(is_long, same, "left_anti")).unionByName(
        in_two_steps(df.join(is_long, same, "left_semi"))
    )
