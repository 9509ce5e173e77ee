"""Tables written as CSV, JSON lines or parquet folders."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.content import need_columns
from rowloom.functions.text import quoted, str_of
from rowloom.sources.files import resolve_format

_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def columns_as_text(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns as Python-style text, null staying null; names the table lacks are ignored."""
    wanted = {n: str_of(df, n) for n in names if n in df.columns}
    return df.withColumns(wanted) if wanted else df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "auto",
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
) -> None:
    """The table as a folder of files; CSV has a header line and prints values as Python does."""
    kind = resolve_format(path, fmt)
    if kind == "xlsx":
        raise ValueError("workbooks can be read but not written; choose csv, jsonl or parquet")
    parts = list(partition_by or [])
    if kind == "csv":
        df = columns_as_text(df, [c for c in df.columns if c not in parts])
    writer = df.write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    if kind == "csv":
        writer.options(**_CSV).csv(path)
    elif kind == "jsonl":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)


def write_split(
    df: DataFrame, path: str, fmt: str = "auto", split: str = "split", mode: str = "errorifexists"
) -> None:
    """All parts in one pass, one sub-folder ``split=<name>`` each."""
    need_columns(df, [split], "split column")
    write_table(df, path, fmt, mode, [split])


def part_path(input_path: str, part: str, suffix: str) -> str:
    """``folder/<stem>-<part><suffix>`` beside the input."""
    scheme, rest = re.match(r"((?:[a-z][a-z0-9+.-]*:)?(?://[^/]*)?)(.*)", input_path).groups()
    where = PurePosixPath(rest)
    return scheme + str(where.with_name(f"{where.stem}-{part}{suffix}"))


def split_paths(
    input_path: str,
    train_path: str | None = None,
    test_path: str | None = None,
    fmt: str = "auto",
    input_format: str = "csv",
) -> tuple[str, str, str]:
    """Paths of both parts and their one format, which an automatic choice takes from the train path.

    A workbook input gives CSV parts, as workbooks are not written.
    """
    made = "csv" if input_format == "xlsx" else input_format
    train = train_path or part_path(input_path, "train", f".{made}")
    test = test_path or part_path(input_path, "test", f".{made}")
    return train, test, resolve_format(train, fmt, fallback=made)


def write_train_test(
    df: DataFrame,
    input_path: str,
    train_path: str | None = None,
    test_path: str | None = None,
    fmt: str = "auto",
    input_format: str = "csv",
    split: str = "split",
    mode: str = "errorifexists",
) -> tuple[str, str]:
    """Train and test rows under two paths, without the split column.

    One job reads the table once and writes both parts to a folder beside the train path; when all is written, the
    parts are moved to their paths. If anything fails, what stood there before is back and nothing else is left.
    A part without rows is a table without rows. ``append`` and ``ignore``, and paths in two stores, take a pass a part.
    """
    need_columns(df, [split], "split column")
    train, test, kind = split_paths(input_path, train_path, test_path, fmt, input_format)
    paths = {"train": train, "test": test}
    store = _Store(df, train)
    if mode in ("append", "ignore") or not store.has(test):
        for part, path in paths.items():
            write_table(df.where(quoted(split) == F.lit(part)).drop(split), path, kind, mode)
        return train, test
    if mode != "overwrite":
        for path in paths.values():
            if store.exists(path):
                raise FileExistsError(f"{path} exists already")
    staged = f"{part_path(train, uuid.uuid4().hex, '')}.parts"
    moved = []
    try:
        mark = "part" + "_" * max((len(c) for c in df.columns if c.startswith("part")), default=0)
        rows = df.where(quoted(split).isin(*paths)).withColumn(mark, quoted(split)).drop(split)
        write_table(rows, staged, kind, partition_by=[mark])
        for part, path in paths.items():
            if not store.exists(f"{staged}/{mark}={part}"):
                write_table(rows.drop(mark).limit(0), f"{staged}/{mark}={part}", kind)
            else:
                store.touch(f"{staged}/{mark}={part}/_SUCCESS")
        for part, path in paths.items():
            if store.exists(path):
                store.move(path, f"{staged}/old-{part}")
                moved.append((path, f"{staged}/old-{part}"))
            store.move(f"{staged}/{mark}={part}", path)
            moved.append((f"{staged}/{mark}={part}", path))
    except BaseException:
        # Should this fail too, the older parts are still in the folder, which is then kept.
        for before, now in reversed(moved):
            store.move(now, before)
        store.drop(staged)
        raise
    store.drop(staged)
    return train, test


class _Store:
    """The file system of a path, as Spark sees it."""

    def __init__(self, df: DataFrame, path: str):
        self.path = df.sparkSession._jvm.org.apache.hadoop.fs.Path
        self.conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        self.files = self.path(path).getFileSystem(self.conf)

    def has(self, path: str) -> bool:
        return self.path(path).getFileSystem(self.conf).getUri() == self.files.getUri()

    def exists(self, path: str) -> bool:
        return self.files.exists(self.path(path))

    def touch(self, path: str) -> None:
        self.files.create(self.path(path), True).close()

    def move(self, path: str, to: str) -> None:
        self.files.mkdirs(self.path(to).getParent())
        if not self.files.rename(self.path(path), self.path(to)):
            raise OSError(f"{path} could not be moved to {to}")

    def drop(self, path: str) -> None:
        self.files.delete(self.path(path), True)
