"""Text generation by a function of the caller, run where the rows are."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rowloom.functions.content import need_columns

Generator = Callable[[list[str]], Iterable]


def generate(
    df: DataFrame,
    prompt: str,
    factory: Callable[..., Generator],
    keep: list[str] | None = None,
    out: str = "generated_text",
    options: dict[str, Any] | None = None,
    partitions: int | None = None,
    ids: str | None = None,
) -> DataFrame:
    """A generated text beside the ``keep`` columns of each row (all others by default).

    ``factory(**options)`` is called once in each task that has rows and returns
    the function that turns a batch of prompts into as many texts, in order.
    Options reach it unchanged. With ``ids`` it returns pairs of a text and the
    list of its token ids, which go to that column. Only the kept columns and the prompt are handed
    to Python, in Arrow batches.
    """
    kept = [c for c in df.columns if c != prompt] if keep is None else list(keep)
    need_columns(df, [*kept, prompt], "generation")
    for name in filter(None, (out, ids)):
        if name in kept:
            raise ValueError(f"output column {name!r} is already there")
    settings = dict(options or {})
    rows = df.select(*dict.fromkeys([*kept, prompt]))
    if partitions is not None:
        rows = rows.repartition(partitions)
    made = [T.StructField(out, T.StringType())]
    if ids is not None:
        made.append(T.StructField(ids, T.ArrayType(T.LongType())))
    schema = T.StructType([*(df.schema[c] for c in kept), *made])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        texts_of = None
        for batch in batches:
            if texts_of is None:
                texts_of = factory(**settings)
            prompts = batch.column(prompt).to_pylist()
            texts = list(texts_of(prompts))
            if len(texts) != len(prompts):
                raise ValueError(f"{len(prompts)} prompts gave {len(texts)} texts")
            columns = [batch.column(c) for c in kept]
            if ids is None:
                columns.append(pa.array(texts, pa.string()))
            else:
                found = list(zip(*texts)) or [(), ()]
                columns += [pa.array(found[0], pa.string()), pa.array(found[1], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
