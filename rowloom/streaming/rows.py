"""Operators on growing folders: rows read, transformed and written once, counts kept up to date.

Labels, row texts, messages, prompts, clean-up and checks are plain column
expressions, so the functions of ``rowloom.functions`` apply to a streaming table
as they are. Audits and counts (unknown labels, class counts, bad messages) are
aggregates of the same functions, whose changed rows each batch adds to a folder.
Exact splits and samples need the whole input and stay batch work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowloom.functions.text import quoted
from rowloom.session import shared_dir
from rowloom.sources.files import parsed_lines
from rowloom.sources.typing import cast_columns, missing_to_null


def stream_table(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """A folder of CSV, JSON-lines or parquet files as a stream; a stream cannot infer its schema."""
    if fmt == "csv":
        texts = T.StructType([T.StructField(n, T.StringType()) for n in schema.names])
        reader = spark.readStream.schema(texts).options(
            header=True, quote='"', escape='"', multiLine=multi_line
        )
        table = reader.csv(path).select(*(missing_to_null(quoted(n)).alias(n) for n in texts.names))
        return cast_columns(table, {f.name: f.dataType for f in schema})
    if fmt == "jsonl":
        return parsed_lines(spark.readStream.text(path), schema)
    if fmt == "parquet":
        return spark.readStream.schema(schema).parquet(path)
    raise ValueError(f"cannot stream format {fmt!r}")


def write_stream(df: DataFrame, path: str, name: str, available_now: bool = True) -> StreamingQuery:
    """Append to a parquet folder; progress is kept under ``name`` in the shared folder."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", f"{shared_dir(df.sparkSession)}/streams/{name}")
        .queryName(name)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_updates(df: DataFrame, path: str, name: str, available_now: bool = True) -> StreamingQuery:
    """An aggregate of a stream, kept up to date: every batch writes the rows it changed to a folder of its own.

    A batch that is run again after a restart replaces its folder, so each
    counts once. ``current_rows`` reads the latest state.
    """

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = (
        df.writeStream.outputMode("update")
        .foreachBatch(put)
        .option("checkpointLocation", f"{shared_dir(df.sparkSession)}/streams/{name}")
        .queryName(name)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def current_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The latest row of every key of a folder of updates; null is a key as any other."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in {*keys, "batch"}]
    last = F.max_by(F.struct(*(quoted(c) for c in rest)), "batch").alias("__last")
    return rows.groupBy(*(quoted(k) for k in keys)).agg(last).select(*(quoted(k) for k in keys), "__last.*")


def compact_updates(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """The latest rows written to another folder as its first batch, for folders of very many batches."""
    current_rows(spark, path, keys).write.mode("errorifexists").parquet(f"{target}/batch=0")
