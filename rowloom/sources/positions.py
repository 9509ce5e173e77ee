"""One row by its position: in an order of the caller, or in the order of the files."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from rowloom.functions.content import need_columns
from rowloom.functions.text import quoted
from rowloom.functions.rows import row_text
from rowloom.session import checkpointed
from rowloom.sources.files import load_table, read_csv, resolve_format
from rowloom.sources.workbook import read_workbooks

# Up to this position a top-k per task is the cheapest way.
TOP_K = 10_000
# Characters of a row's text that order rows of one key.
FRONT = 200
_ROW_NO = "__row_no"
_PLACE = ("__file", "__block", "__nth")


def _need_position(index: int) -> None:
    if index < 0:
        raise ValueError(f"a position has to be zero or more, not {index}")


def _key_at(keys: DataFrame, index: int) -> tuple[Row, int]:
    """The key at ``index`` in ascending order, and how many equal keys come before it."""
    columns = [quoted(c) for c in keys.columns]
    if index < TOP_K:
        front = keys.orderBy(*columns)
        found = front.offset(index).limit(1).first()
        if found is None:
            raise ValueError(f"position {index} is out of range: there are {keys.count()} rows")
        return found, front.limit(index + 1).where(_is(keys.columns, found)).count() - 1
    counts = keys.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    ranges = checkpointed(counts.repartitionByRange(*columns).sortWithinPartitions(*columns))
    ranges = ranges.withColumn("__range", F.spark_partition_id())
    by_range = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = _covering(
        ranges.groupBy("__range").agg(F.sum("__n").alias("__n")), by_range, index
    )
    if place is None:
        raise ValueError(f"position {index} is out of range: there are {keys.count()} rows")
    left = index - place["__before"]
    by_key = Window.orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    key = _covering(ranges.where(F.col("__range") == place["__range"]), by_key, left)
    return key, left - key["__before"]


def _is(names: list[str], key: Row) -> Column:
    """Rows with this key; null is equal to null, NaN to NaN."""
    return reduce(and_, (quoted(c).eqNullSafe(F.lit(key[c])) for c in names))


def _covering(counted: DataFrame, running: WindowSpec, index: int) -> Row | None:
    """The row of a counted table that position ``index`` falls into, with the count before it."""
    before = F.sum("__n").over(running) - F.col("__n")
    return (
        counted.withColumn("__before", before)
        .where((F.col("__before") <= index) & (F.col("__before") + F.col("__n") > index))
        .first()
    )


def row_at(df: DataFrame, index: int, order: list[str]) -> DataFrame:
    """The row at ``index`` (from zero) in ascending order of the given columns.

    Only the order columns are sorted: near the front by a top-k, further back
    by counting distinct keys, sorting those by range and adding up the ranges'
    sizes. Then the rows of the one key found are read. Rows of equal keys follow
    each other by the front of their text, then by its digest.
    """
    _need_position(index)
    need_columns(df, order, "order")
    key, among = _key_at(df.select(*(quoted(c) for c in order)), index)
    ties = df.where(_is(order, key))
    front, digest = F.substring(row_text(df), 1, FRONT), F.md5(row_text(df))
    found, _ = _key_at(ties.select(front.alias("front"), digest.alias("digest")), among)
    return ties.where(digest == found["digest"]).limit(1)


# --- positions in files -----------------------------------------------------

#: With one partition asked for at least, where a scan cuts files depends on this size alone, not on what files it reads.
_SPLIT = "spark.sql.files.maxPartitionBytes"
_PARTITIONS = "spark.sql.files.minPartitionNum"


@contextmanager
def _cut_alike(spark: SparkSession, size: str) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in (_SPLIT, _PARTITIONS)}
    spark.conf.set(_SPLIT, size)
    spark.conf.set(_PARTITIONS, "1")
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@dataclass(frozen=True)
class PositionIndex:
    """Where the rows of a table's files are: ``file, block, first, n``, a row for each range that a scan reads.

    ``split`` is the size at which files were cut. Of columnar files a range is the whole file.
    """

    ranges: DataFrame
    split: str
    columnar: bool


def position_index(df: DataFrame) -> PositionIndex:
    """The stored index of a table read from files, made by one scan that counts rows."""
    spark = df.sparkSession
    columnar = "row_index" in df.select("_metadata").schema[0].dataType.names
    block = F.lit(0).cast("bigint") if columnar else F.col("_metadata.file_block_start")
    split = spark.conf.get(_SPLIT)
    with _cut_alike(spark, split):
        counts = checkpointed(
            df.groupBy(F.col("_metadata.file_path").alias("file"), block.alias("block")).agg(F.count(F.lit(1)).alias("n"))
        )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    files = counts.groupBy("file").agg(F.sum("n").alias("rows"))
    # A row for each file in this window, for each range in the next.
    starts = files.select("file", F.coalesce(F.sum("rows").over(before.orderBy("file")), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum("n").over(before.partitionBy("file").orderBy("block")), F.lit(0))
    first = (F.col("start") + F.col("inside")).alias("first")
    ranges = counts.withColumn("inside", inside).join(starts, "file").select("file", "block", first, "n")
    return PositionIndex(ranges, split, columnar)


def _targets(index: PositionIndex, positions: list[int]) -> DataFrame:
    """file, block, nth in the range, and position of every wanted row; nothing for positions past the end."""
    spark = index.ranges.sparkSession
    asked = spark.createDataFrame([(p,) for p in sorted(set(positions))], "at bigint").select("at", F.lit(None).alias("r"))
    marks = index.ranges.where("n > 0").select(F.col("first").alias("at"), F.struct("file", "block", "first", "n").alias("r"))
    # Ranges and positions in one order: a position is in the last range that starts at or before it.
    upto = Window.orderBy("at", F.col("r").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    merged = marks.unionByName(asked.select("at", F.col("r").cast(marks.schema["r"].dataType).alias("r")))
    placed = merged.withColumn("last", F.last("r", True).over(upto)).where("r is null and last is not null")
    nth = F.col("at") - F.col("last.first")
    return placed.where(nth < F.col("last.n")).select("last.file", "last.block", nth.alias("nth"), F.col("at").alias("position"))


def _picked(batches: Iterator[pa.RecordBatch], wanted: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows counted within each range; those wanted, with their positions. The last column: the range's number.

    ``wanted``: for each range the ascending places of its rows, and their positions.
    """
    held, seen = None, 0
    for batch in batches:
        names, at = batch.schema.names, 0
        ranges = batch.columns[-1].to_numpy()
        while at < batch.num_rows:
            key = int(ranges[at])
            other = np.flatnonzero(ranges[at:] != key)
            end = at + int(other[0]) if len(other) else batch.num_rows
            seen = seen if key == held else 0
            held = key
            nths, places = wanted[key]
            first, last = np.searchsorted(nths, [seen, seen + end - at])
            if first < last:
                own = [c.take(pa.array(at + nths[first:last] - seen)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(places[first:last])], names=[*names[:-1], "position"])
            seen, at = seen + end - at, end


def rows_at(df: DataFrame, positions: list[int], index: PositionIndex | None = None, position: str = "position") -> DataFrame:
    """The rows at many positions of a table read from files, in the order of files and their lines, with their ``position``.

    One scan counts (none, with an index at hand), one reads: only files that
    hold a position are opened, and of them only the rows of the ranges that
    hold one are looked at. Files must not have changed since. The caller's list
    bounds the result, which is kept in the shared folder.
    """
    for p in positions:
        _need_position(p)
    spark, index = df.sparkSession, index or position_index(df)
    places = _targets(index, positions).collect()  # no longer than the caller's own list
    missing = len(set(positions)) - len(places)
    if missing:
        raise ValueError(f"{missing} of the positions are out of range: there are {index.ranges.agg(F.sum('n')).first()[0] or 0} rows")
    targets = spark.createDataFrame(places, "file string, block bigint, nth bigint, position bigint")
    files = sorted({r["file"] for r in places})
    names = [f"c{i}" for i in range(len(df.columns))]
    place = F.col("_metadata.row_index") if index.columnar else F.col("_metadata.file_block_start")
    read = df.where(F.col("_metadata.file_path").isin(files)).select(
        *(quoted(c).alias(n) for c, n in zip(df.columns, names)), F.col("_metadata.file_path").alias("file"), place.alias("at")
    )
    if index.columnar:
        wanted = targets.select("file", F.col("nth").alias("at"), "position")
        found = read.join(F.broadcast(wanted), ["file", "at"]).select(*names, "position")
    else:
        by_range: dict[tuple[str, int], list[Row]] = {}
        for r in sorted(places, key=lambda r: r["nth"]):
            by_range.setdefault((r["file"], r["block"]), []).append(r)
        wanted = [tuple(np.array([r[k] for r in rows], np.int64) for k in ("nth", "position")) for rows in by_range.values()]
        # A row carries its range's number only: the lists of positions would travel with every row.
        numbers = spark.createDataFrame([(*k, i) for i, k in enumerate(by_range)], "file string, at bigint, range int")
        near = read.join(F.broadcast(numbers), ["file", "at"]).select(*names, "range")
        kinds = T.StructType([*near.select(*names).schema, T.StructField("position", T.LongType())])
        found = near.mapInArrow(lambda it: _picked(it, dict(enumerate(wanted))), kinds)
    with _cut_alike(spark, index.split):
        kept = checkpointed(found)
    if kept.count() != len(set(positions)):
        raise ValueError("the files are not those that the index was made of")
    return kept.select(*(F.col(n).alias(c) for c, n in zip(df.columns, names)), F.col("position").alias(position))


def file_row_at(df: DataFrame, index: int) -> DataFrame:
    """The row at ``index`` of a table read from files, in the order of files and their lines."""
    _need_position(index)
    place = "__position"
    return rows_at(df, [index], position=place).drop(place)


def json_line_at(spark: SparkSession, path: str, index: int) -> dict:
    """The JSON object on line ``index``; blank lines count and give an empty object."""
    line = file_row_at(spark.read.text(path), index).first()["value"].strip()
    if not line:
        return {}
    row = json.loads(line)
    if not isinstance(row, dict):
        raise ValueError(f"line {index} of {path!r} is not a JSON object")
    return row


def load_row(
    spark: SparkSession, path: str, index: int, fmt: str = "auto", sheet: str | int | None = None
) -> dict:
    """The one row at ``index`` of a file, as a dict: its names and values in column order."""
    kind = resolve_format(path, fmt)
    if kind == "jsonl":
        return json_line_at(spark, path, index)
    if kind == "xlsx":
        rows = read_workbooks(spark, path, sheet, row_no=_ROW_NO)
        found = row_at(rows, index, [_ROW_NO]).drop(_ROW_NO)
    elif kind == "csv":
        rows = read_csv(spark, path, place=_PLACE)
        placed = _PLACE[0] in rows.columns
        found = row_at(rows, index, list(_PLACE)).drop(*_PLACE) if placed else file_row_at(rows, index)
    else:
        found = file_row_at(load_table(spark, path, kind), index)
    return found.first().asDict(recursive=True)
