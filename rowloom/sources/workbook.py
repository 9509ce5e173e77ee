"""Workbooks: each file is unpacked by one task into rows, Spark does the rest."""

from __future__ import annotations

import io
import math
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import str_of
from rowloom.session import checkpointed
from rowloom.sources.typing import decided_types, cast_columns, missing_to_null, trimmed_names

_ROWS = "row_no bigint, names array<string>, cells map<string, struct<kind:string,text:string>>"


def sheet_place(names: list[str], wanted: str | int | None) -> int:
    """The place in a book of the sheet asked for: by name, by place (ASCII digits are one), or the first."""
    if isinstance(wanted, str) and not re.fullmatch("[0-9]+", wanted):
        if wanted not in names:
            raise ValueError(f"no sheet {wanted!r}; there are {names}")
        return names.index(wanted)
    place = int(wanted or 0)
    if not 0 <= place < len(names):
        raise ValueError(f"no sheet number {place}; there are {len(names)}")
    return place


def _unpacker(sheet: str | int | None):
    """The function that turns batches of files into rows; one workbook holds about a million at most."""

    def sheet_rows(content: bytes) -> Iterator[tuple[int, dict]]:
        def tag(e) -> str:
            return e.tag.rsplit("}", 1)[-1]

        def text_of(e) -> str:
            plain = [p for p in e if tag(p) == "t"]
            runs = [t for p in e if tag(p) == "r" for t in p if tag(t) == "t"]
            return "".join(t.text or "" for t in plain + runs)

        book = zipfile.ZipFile(io.BytesIO(content))
        sheets = [e for e in ElementTree.fromstring(book.read("xl/workbook.xml")).iter() if tag(e) == "sheet"]
        wanted = sheets[sheet_place([e.get("name") for e in sheets], sheet)]
        link = next(v for k, v in wanted.attrib.items() if k.endswith("}id"))
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = next(e.get("Target") for e in links if e.get("Id") == link)
        member = posixpath.normpath(posixpath.join("/xl", target)).lstrip("/")
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as f:
                for _, e in ElementTree.iterparse(f):
                    if tag(e) == "si":
                        shared.append(text_of(e))
                        e.clear()

        def value(c) -> tuple[str, str] | None:
            kind = c.get("t", "n")
            if kind == "inlineStr":
                return "text", "".join(text_of(e) for e in c if tag(e) == "is")
            stored = next((e.text for e in c if tag(e) == "v"), None)
            if stored is None:
                return None
            if kind == "s":
                return "text", shared[int(stored)]
            if kind == "b":
                return "truth", "True" if stored == "1" else "False"
            return ("number" if kind == "n" else "text"), stored

        row_no = 0
        with book.open(member) as f:
            for _, row in ElementTree.iterparse(f):
                if tag(row) != "row":
                    continue
                row_no = int(row.get("r", row_no + 1))
                cells, column = {}, -1
                for c in row:
                    letters = re.match("[A-Z]*", c.get("r", "")).group()
                    column += 1
                    if letters:
                        column = -1
                        for ch in letters:
                            column = (column + 1) * 26 + ord(ch) - ord("A")
                    found = value(c)
                    if found is not None:
                        cells[column] = {"kind": found[0], "text": found[1]}
                yield row_no, cells
                row.clear()

    def unpack(batches: Iterator) -> Iterator:
        import pandas as pd

        columns = ["row_no", "names", "cells"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                names, out, last = None, [], 0
                for row_no, cells in sheet_rows(content):
                    if names is None:
                        width = max(cells, default=-1) + 1
                        names = [cells[i]["text"].strip() if i in cells else f"Unnamed: {i}" for i in range(width)]
                        if len(set(names)) < len(names):
                            raise ValueError(f"{path}: two columns have the same name: {names}")
                        out.append((row_no, names, None))
                    else:
                        # rows the file leaves out are empty rows
                        out += [(n, None, {}) for n in range(last + 1, row_no)]
                        out.append((row_no, None, {n: cells[i] for i, n in enumerate(names) if i in cells}))
                    last = row_no
                    if len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=columns)

    return unpack


def read_workbooks(
    spark: SparkSession,
    path: str | DataFrame,
    sheet: str | int | None = None,
    schema: T.StructType | None = None,
    row_no: str | None = None,
) -> DataFrame:
    """The chosen sheet of each workbook under ``path`` as one table, columns matched by name.

    ``path`` may also be a table of ``path`` and ``content``. Without a schema the
    workbooks are unpacked once into the shared folder, where names, types and
    rows come from: the headers of all workbooks name the columns, by their
    first place in a header, and one pass decides their types: numbers and truth values as stored, everything else text.
    ``row_no`` names an extra column for the row's number in its sheet.
    """
    books = path if isinstance(path, DataFrame) else spark.read.format("binaryFile").load(path)
    rows = books.select("path", "content").mapInPandas(_unpacker(sheet), _ROWS)
    if schema is None:
        rows = checkpointed(rows)
        named = rows.where("names is not null").select(F.posexplode("names").alias("pos", "name"))
        heads = named.groupBy("name").agg(F.min("pos").alias("pos")).orderBy("pos", "name").collect()
        if not heads:
            raise ValueError(f"no workbook with a header row under {path!r}")
        names = trimmed_names([r["name"] for r in heads])
    else:
        names = schema.names
    extra = [] if row_no is None else [F.col("row_no").alias(row_no)]
    cells = rows.where("cells is not null").select(
        *(F.try_element_at("cells", F.lit(n)).alias(n) for n in names), *extra
    )
    marks = {n: f"__stored_{i}" for i, n in enumerate(names)}
    texts = cells.select(
        *(missing_to_null(F.col(f"`{n}`.text")).alias(n) for n in names),
        *((F.col(f"`{n}`.kind") == "text").alias(m) for n, m in marks.items()),
        *([] if row_no is None else [row_no]),
    )
    if schema is None:
        types = decided_types(texts, names, {n: F.col(m) for n, m in marks.items()})
    else:
        types = {f.name: f.dataType for f in schema}
    return cast_columns(texts, types | ({} if row_no is None else {row_no: T.LongType()}))


# --- writing ----------------------------------------------------------------

#: Rows of a sheet at most, its header line included.
SHEET_ROWS = 1_048_576
_UNPRINTABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
# The parts of a workbook with one sheet, and their links.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _book_parts(sheet: str) -> dict[str, str]:
    """The small parts of a workbook, by their names in the archive."""
    link = '<Relationships xmlns="{}/relationships"><Relationship Id="r1" Type="{}/{}" Target="{}"/></Relationships>'
    kinds = f'<Override PartName="/xl/workbook.xml" ContentType="{_KIND}.sheet.main+xml"/>'
    kinds += f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_KIND}.worksheet+xml"/>'
    rels = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    one = f'<sheet name={quoteattr(sheet)} sheetId="1" r:id="r1"/>'
    return {
        "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types">{rels}{kinds}</Types>',
        "_rels/.rels": link.format(_PACKAGE, _OFFICE, "officeDocument", "xl/workbook.xml"),
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{one}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": link.format(_PACKAGE, _OFFICE, "worksheet", "worksheets/sheet1.xml"),
    }


def _cell(value) -> str:
    """A cell; missing values are empty cells, and what is neither number nor truth value is text."""
    if value is None or isinstance(value, float) and math.isnan(value):
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int) or isinstance(value, float) and math.isfinite(value):
        return f"<c><v>{value!r}</v></c>"
    text = str(value)
    if _UNPRINTABLE.search(text):
        raise ValueError(f"a workbook cannot hold the control character in {text[:50]!r}")
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text, {chr(13): "&#13;"})}</t></is></c>'


def _book(sheet: str, names: list[str], rows: Iterator[tuple]) -> bytes:
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in _book_parts(sheet).items():
            book.writestr(name, text)
        with book.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            for row in (names, *rows):
                f.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
            f.write(b"</sheetData></worksheet>")
    return held.getvalue()


def workbook_contents(df: DataFrame, sheet: str = "Sheet1", rows_per_book: int = SHEET_ROWS - 1) -> DataFrame:
    """``path`` and ``content`` of workbooks that hold the rows, each task writing its own, one after the other.

    Whole numbers, floats and truth values are stored as such, other types as
    the text that Python prints. ``read_workbooks`` reads the table as it is;
    it may be stored as Parquet, or its contents be put out as files.
    """
    if not 0 < rows_per_book < SHEET_ROWS:
        raise ValueError(f"a workbook holds 1 to {SHEET_ROWS - 1} rows")
    plain = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType, T.StringType)
    names = df.columns
    ready = df.select(*(F.col(f"`{n}`") if isinstance(df.schema[n].dataType, plain) else str_of(df, n).alias(n) for n in names))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held = TaskContext.get().partitionId(), 0, []

        def put(rows):
            path = f"part-{task:05d}-{number:05d}.xlsx"
            return pa.RecordBatch.from_pydict({"path": [path], "content": [_book(sheet, names, rows)]})

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= rows_per_book:
                yield put(held[:rows_per_book])
                number, held = number + 1, held[rows_per_book:]
        if held:
            yield put(held)

    return ready.mapInArrow(work, "path string, content binary")
