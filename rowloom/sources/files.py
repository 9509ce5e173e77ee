"""Tables from CSV, JSON lines, workbooks and parquet, and token templates."""

from __future__ import annotations

import csv
import io
import json
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import py_trim, quoted
from rowloom.operators.joins import lookup_join
from rowloom.session import checkpointed
from rowloom.sources.json_keys import key_columns, number_texts
from rowloom.sources.records import first_lines, records, text_lines
from rowloom.sources.typing import cast_columns, decided_types, missing_to_null, trimmed_names
from rowloom.sources.workbook import read_workbooks

# The format each file suffix stands for.
FORMAT_OF_SUFFIX = {
    ".xlsx": "xlsx",
    ".csv": "csv",
    ".jsonl": "jsonl",
    ".json": "jsonl",
    ".parquet": "parquet",
}
FORMATS = sorted(set(FORMAT_OF_SUFFIX.values()))

#: Header lines that differ, if only in white space, at most.
HEADERS = 100

_SURPLUS = "__surplus"
_CSV = {"quote": '"', "escape": '"'}


def resolve_format(path: str, fmt: str = "auto", fallback: str | None = None) -> str:
    """An explicit format, else the one the suffix stands for, else ``fallback``."""
    if fmt != "auto":
        if fmt not in FORMATS:
            raise ValueError(f"unsupported format {fmt!r}; known are {FORMATS}")
        return fmt
    found = FORMAT_OF_SUFFIX.get(PurePosixPath(path).suffix.lower(), fallback)
    if found is None:
        raise ValueError(f"cannot tell the format of {path!r}; name one of {FORMATS}")
    return found


def load_table(
    spark: SparkSession,
    path: str,
    fmt: str = "auto",
    sheet: str | int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One file, or a folder of files of one format, as a table."""
    kind = resolve_format(path, fmt)
    if kind == "csv":
        return read_csv(spark, path, schema)
    if kind == "jsonl":
        return read_json_lines(spark, path, schema)
    if kind == "xlsx":
        return read_workbooks(spark, path, sheet, schema)
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _header(heads: DataFrame, path: str) -> list[str]:
    """The one header that all files have; ``heads`` is a row for each file."""
    fields: dict[tuple[str, ...], str] = {}
    plain = F.rtrim(F.regexp_replace("head", "^\ufeff", ""), F.lit("\r"))
    spelt = heads.groupBy(plain.alias("head")).agg(F.min("file").alias("file")).orderBy("file").limit(HEADERS + 1).collect()
    if len(spelt) > HEADERS:
        raise ValueError(f"more than {HEADERS} different header lines under {path!r}")
    for row in spelt:
        found = next(csv.reader(io.StringIO(row["head"], newline="")), [])
        fields.setdefault(tuple(n.strip() for n in found), row["file"])
    if not fields:
        raise ValueError(f"{path!r} has no header line")
    if len(fields) > 1:
        (a, one), (b, other) = fields.items()
        raise ValueError(f"files with different headers: {list(a)} in {one}, {list(b)} in {other}")
    return trimmed_names([n or f"Unnamed: {i}" for i, n in enumerate(next(iter(fields)))])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool | None = None,
    place: tuple[str, str, str] | None = None,
) -> DataFrame:
    """A CSV table with a header line; names trimmed, missing-value words null, types decided.

    One scan of the lines tells whether a quote may stay open over a line break
    (``multi_line`` answers that beforehand) and gives the header of every file;
    they have to be the same. Without such quotes Spark's reader takes the files
    apart; with them records are found by ``rowloom.sources.records``. Either way
    large files are split over tasks. Lines with more fields than the header fail the
    query, fewer leave nulls. With a schema, which names as many columns as the header has,
    columns are matched by position; without one a second scan decides types.
    ``place`` names columns for file, range and number of a record; it is added
    only where quotes stay open.
    """
    heads = checkpointed(first_lines(text_lines(spark, path)))
    if multi_line is None:
        multi_line = not heads.where("open").isEmpty()
    if multi_line:
        found = records(spark, path).where(F.trim("text", F.lit(" \t\r")) != "")
        first = F.min_by(F.struct("block", "nth", "text"), F.struct("block", "nth")).alias("r")
        heads = checkpointed(found.groupBy("file").agg(first).select("file", "r.block", "r.nth", F.col("r.text").alias("head")))
    names = _header(heads, path)
    if schema is not None:
        if len(schema) != len(names):
            raise ValueError(f"the schema has {len(schema)} columns, the header of {path!r} has {len(names)}")
        names = schema.names
    wanted = _text_columns([*names, _SURPLUS])
    if multi_line:
        body = lookup_join(found, heads.select("file", "block", "nth"), ["file", "block", "nth"], "left_anti")
        parsed = _from_csv(wanted)
        placed = [F.col(c).alias(p) for c, p in zip(("file", "block", "nth"), place or ())]
        table = body.select(*placed, parsed.alias("r")).select(*(p for p in place or ()), "r.*")
    else:
        table = spark.read.options(**_CSV).option("header", True).option("enforceSchema", True).schema(wanted).csv(path)
    message = F.concat(F.lit("a line has more fields than the header; the first is "), F.col(_SURPLUS))
    fits = F.when(F.col(_SURPLUS).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    extra = {p: table.schema[p].dataType for p in place or () if multi_line}
    table = table.where(fits).select(*(missing_to_null(quoted(n)).alias(n) for n in names), *extra)
    types = decided_types(table, names) if schema is None else {f.name: f.dataType for f in schema}
    return cast_columns(table, types | extra)


def _from_csv(wanted: T.StructType) -> Column:
    ddl = ", ".join("`{}` string".format(f.name.replace("`", "``")) for f in wanted)
    return F.from_csv(F.rtrim("text", F.lit("\r")), ddl, _CSV)


def _text_columns(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """One JSON object per line, blank lines left out; any other line fails the query, quoting it.

    Without a schema the columns are all keys, in the order of their first
    place in the files. Numbers that are whole in some lines only, or too long
    for 64 bits, stay texts as Python prints them; of a key that a line repeats
    the last value counts.
    """
    mixed: list[str] = []
    if schema is None:
        schema, mixed = key_columns(spark, path)
    if not schema.fields:
        raise ValueError(f"{path!r} holds no JSON objects")
    return number_texts(parsed_lines(spark.read.text(path), schema), mixed)


def parsed_lines(texts: DataFrame, schema: T.StructType, bad: str = "__unparsed") -> DataFrame:
    """Rows from a table of lines; also for a stream, which has to name its schema."""
    lines = texts.select(py_trim(F.col("value")).alias("line")).where("line != ''")
    with_bad = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json("line", with_bad, {"columnNameOfCorruptRecord": bad})
    # a filter on the columns may be run together with the one on blank lines, so those must not fail
    fine = (F.col("line") == "") | (
        F.startswith("line", F.lit("{")) & F.col("row")[bad].isNull()
    )
    message = F.concat(F.lit("not a JSON object: "), F.substring("line", 1, 200))
    return (
        lines.withColumn("row", parsed)
        .select(F.when(fine, F.col("row")).otherwise(F.raise_error(message)).alias("row"))
        .select(*(F.col("row")[f.name].alias(f.name) for f in schema))
    )


def token_entries(texts: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, pos, name and token of every entry of the JSON objects in a column, in the order of the text.

    A name that an object repeats stands at its first place with its last value.
    Values that are no texts are given as JSON; null texts have no entries, and
    any other text that is no object fails the query.
    """
    names = [f"k{i}" for i in range(len(keep))]
    read = texts.select(*(quoted(c).alias(n) for c, n in zip(keep, names)), quoted(text).cast("string").alias("t"))

    def work(batches):
        for batch in batches:
            rows = []
            for i, body in enumerate(batch.column(len(names)).to_pylist()):
                entries = {} if body is None else json.loads(body)
                if not isinstance(entries, dict):
                    raise ValueError(f"not a JSON object: {body[:200]}")
                for pos, (name, value) in enumerate(entries.items()):
                    printed = value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)
                    rows.append((i, pos, name, printed))
            at, *found = (list(x) for x in zip(*rows)) if rows else ([], [], [], [])
            own = [batch.column(k).take(pa.array(at, pa.int64())) for k in range(len(names))]
            made = [pa.array(v, t) for v, t in zip(found, (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*own, *made], names=[*names, "pos", "name", "token"])

    kinds = "".join(f"{n} {texts.schema[c].dataType.simpleString()}, " for c, n in zip(keep, names))
    out = read.mapInArrow(work, kinds + "pos bigint, name string, token string")
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), "pos", "name", "token")


def read_token_template(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, name, token)`` from a JSON object of names and tokens, in file order."""
    return token_entries(spark.read.text(path, wholetext=True), "value", [])
