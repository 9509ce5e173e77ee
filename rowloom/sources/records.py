"""CSV records with line breaks inside quotes, found by many tasks.

A text scan cuts files into ranges of whole lines. Whether a line starts inside
quotes depends on all lines before it, so every range is first read as a function
from "starts outside" and "starts inside" to the state it ends in. These functions
are chained along each file, range by range, which gives the state every range
really starts in. Then the ranges are read again and their lines joined to
records; only the first and last piece of a range may belong to a record that
crosses ranges, and those few pieces are put together at the end.

A quote opens only at the start of a field, as in a data-frame reader; one inside
an unquoted field is text. Doubled quotes stand for one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.session import checkpointed, fits_broadcast

_PIECES = "file string, block bigint, nth bigint, whole boolean, opened boolean, text string"


def open_after(line: str, inside: bool) -> bool:
    """Whether a line that starts inside or outside quotes ends inside."""
    line = line.replace('""', "")
    if inside:
        at = line.find('"') + 1
        if not at:
            return True
    elif line.startswith('"'):
        at = line.find('"', 1) + 1
        if not at:
            return True
    else:
        at = 0
    while (at := line.find(',"', at) + 2) > 1:
        if not (at := line.find('"', at) + 1):
            return True
    return False


def suspicious(line: Column) -> Column:
    """True for every line that may leave a quote open, and for few others."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    quotes = F.length(single) - F.length(F.replace(single, F.lit('"'), F.lit("")))
    return (quotes % 2 == 1) | single.rlike('[^,\r\n]"[^,\r\n]')


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where its range starts) and value of every line, in order within a range."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def first_lines(lines: DataFrame) -> DataFrame:
    """file, its first line that is not blank and whether any line is suspicious: one scan, a row for each file."""
    numbered = lines.where(F.trim("value", F.lit(" \t\r")) != "").withColumn("line", F.monotonically_increasing_id())
    first = F.min_by("value", F.struct("block", "line"))
    return numbered.groupBy("file").agg(first.alias("head"), F.bool_or(suspicious(F.col("value"))).alias("open"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batches cut where the range changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block")
        same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(block[1:], block[:-1]))
        edges = [0, *(i + 1 for i, x in enumerate(same.to_pylist()) if not x), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield (file[a].as_py(), block[a].as_py()), batch.slice(a, b - a)


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block, and the state at the end of a range for both states at its start."""
    held, rows = None, []
    for key, run in _runs(batches):
        if key != held:
            held = key
            rows.append([*key, False, True])
        last = rows[-1]
        quoted = pc.match_substring(run.column("value"), '"')
        for line in run.column("value").filter(quoted).to_pylist():
            # Once both ends are one state they stay so.
            a = open_after(line, last[2])
            last[2], last[3] = a, a if last[2] == last[3] else open_after(line, last[3])
    names = ["file", "block", "from_outside", "from_inside"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows) if rows else [()] * 4, kinds)], names=names)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and, at both ends of a range, parts of records: ``opened`` where a part begins its record."""
    names = [f.split()[0] for f in _PIECES.split(", ")]
    held, lines, inside, nth, opened = None, [], False, 0, True
    out: list[tuple] = []

    def put(whole: bool):
        nonlocal nth, lines
        out.append((*held, nth, whole and opened, opened, "\n".join(lines)))
        nth, lines = nth + 1, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    for key, run in _runs(batches):
        if key != held:
            if lines:
                put(False)
            held, inside, nth = key, run.column("inside")[0].as_py(), 0
            opened = not inside
        quoted = pc.match_substring(run.column("value"), '"').to_pylist()
        for line, has in zip(run.column("value").to_pylist(), quoted):
            lines.append(line)
            if has:
                inside = open_after(line, inside)
            if not inside:
                put(True)
                opened = True
        if len(out) >= 10_000:
            yield batch_of(out)
            out = []
    if lines:
        put(False)
    if out:
        yield batch_of(out)


def _states(lines: DataFrame) -> DataFrame:
    """file and block of the ranges that start inside quotes."""
    ends = checkpointed(lines.mapInArrow(_functions, "file string, block bigint, from_outside boolean, from_inside boolean"))
    # A range either ends in one state whatever it starts in, or keeps the state, or turns it.
    fixed = F.col("from_outside") == F.col("from_inside")
    turns = (~fixed & F.col("from_outside")).cast("int")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turned = ends.withColumn("turned", F.sum(turns).over(upto))
    base = F.when(fixed, F.struct("from_outside", "turned"))
    known = turned.withColumn("base", F.last(base, True).over(before)).withColumn("past", F.coalesce(F.lag("turned").over(
        Window.partitionBy("file").orderBy("block")), F.lit(0)))
    odd = (F.col("past") - F.coalesce("base.turned", F.lit(0))) % 2 == 1
    inside = F.coalesce("base.from_outside", F.lit(False)) != odd
    return known.where(inside).select("file", "block", F.lit(True).alias("inside"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, nth, text`` of every record of the CSV files; (block, nth) orders the records of a file.

    The pieces of records that cross ranges are shuffled, nothing else is. A
    file that ends inside quotes ends with what is there.
    """
    lines = text_lines(spark, path)
    states = _states(lines)
    marked = F.coalesce("inside", F.lit(False)).alias("inside")
    if fits_broadcast(states):
        started = lines.join(F.broadcast(states), ["file", "block"], "left").select("file", "block", "value", marked)
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        joined = numbered.join(states, ["file", "block"], "left").repartition("file", "block")
        started = joined.sortWithinPartitions("file", "block", "line").select("file", "block", "value", marked)
    pieces = started.mapInArrow(_pieces, _PIECES)
    whole = pieces.where("whole").select("file", "block", "nth", "text")
    return whole.unionByName(_across(pieces.where("not whole")))


def _across(parts: DataFrame) -> DataFrame:
    """Records put together from the parts that ranges begin and end with."""
    order = Window.partitionBy("file").orderBy("block", "nth").rowsBetween(Window.unboundedPreceding, 0)
    numbered = parts.withColumn("record", F.sum(F.col("opened").cast("int")).over(order))
    joined = F.array_sort(F.collect_list(F.struct("block", "nth", "text")))
    whole = numbered.groupBy("file", "record").agg(joined.alias("p"))
    return whole.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["nth"].alias("nth"), F.array_join("p.text", "\n").alias("text"))
