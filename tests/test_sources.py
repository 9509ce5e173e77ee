import json
import math
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import types as T

from rowloom.sources.files import (
    load_table, read_csv, read_json_lines, read_token_template, resolve_format, token_entries,
)
from rowloom.sources.typing import MISSING_WORDS, trim_header
from rowloom.sources.workbook import read_workbooks, sheet_place, workbook_contents
from rowloom.sources.writers import (
    columns_as_text, part_path, split_paths, write_split, write_table, write_train_test,
)


def put(path, text, newline=""):
    with open(path, "w", encoding="utf-8", newline=newline) as f:
        f.write(text)
    return str(path)


def values(df):
    return [tuple(r) for r in df.collect()]


# --- formats ----------------------------------------------------------------

def test_formats():
    assert resolve_format("a/b.XLSX") == "xlsx"
    assert resolve_format("a.json") == resolve_format("a.jsonl") == "jsonl"
    assert resolve_format("a.csv", "parquet") == "parquet"
    assert resolve_format("a", fallback="csv") == "csv"
    for path, fmt in (("a.txt", "auto"), ("a", "auto"), ("a.xls", "auto"), ("a.csv", "orc")):
        with pytest.raises(ValueError):
            resolve_format(path, fmt)


# --- CSV --------------------------------------------------------------------

def test_csv_missing_words_in_every_column(spark, tmp_path):
    lines = ["i,x,b,s"] + [f"{w},{w},{w},{w}" for w in MISSING_WORDS if w] + ["4,1.5,True,yes"]
    df = read_csv(spark, put(tmp_path / "a.csv", "\n".join(lines)))
    assert df.dtypes == [("i", "bigint"), ("x", "double"), ("b", "boolean"), ("s", "string")]
    assert values(df.where("i is not null")) == [(4, 1.5, True, "yes")]
    assert df.count() == len(lines) - 1


@pytest.mark.parametrize(
    "cells,kind",
    [
        (["1", " -2 ", "+3"], "bigint"), (["1", "1.0"], "double"), (["1e3", ".5", "5."], "double"),
        (["inf", "-Infinity"], "double"), (["1", "1d"], "string"), (["True", "false", "TRUE"], "boolean"),
        (["true", "t"], "string"), (["yes", "no"], "string"), (["1", "True"], "string"),
        (["99999999999999999999"], "string"), (["NA", "n/a"], "double"), (["0x10"], "string"),
    ],
)
def test_csv_types(spark, tmp_path, cells, kind):
    path = put(tmp_path / "a.csv", "a,z\n" + "".join(f"{c},q\n" for c in cells))
    assert dict(read_csv(spark, path).dtypes)["a"] == kind


def test_csv_quotes_newlines_and_header(spark, tmp_path):
    path = put(tmp_path / "a.csv", '﻿ a ,"b ""x"""\n"1\n2","say ""hi"", ok"\n" p ",\n')
    df = read_csv(spark, path)
    assert df.columns == ["a", 'b "x"']
    assert values(df) == [("1\n2", 'say "hi", ok'), (" p ", None)]


def test_csv_without_quoted_newlines_is_split_over_tasks(spark, tmp_path, monkeypatch):
    path = put(tmp_path / "a.csv", "a,b\n" + "".join(f'{i},"x ""{i}"""\n' for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 50_000 and df.where("b = 'x \"49999\"'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_with_schema_and_refusals(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b\n1,x\nNA,y\n")
    schema = T.StructType().add("a", "integer").add("b", "string")
    assert values(load_table(spark, path, schema=schema)) == [(1, "x"), (None, "y")]
    with pytest.raises(ValueError, match="collide"):
        read_csv(spark, put(tmp_path / "b.csv", "a, a\n1,2\n"))
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, put(tmp_path / "c.csv", ""))
    with pytest.raises(ValueError, match="collide"):
        trim_header(spark.sql("select 1 `a `, 2 a"))
    assert trim_header(spark.sql("select 1 ` a\t`")).columns == ["a"]


# --- JSON lines and templates -----------------------------------------------

def test_json_lines(spark, tmp_path):
    path = put(tmp_path / "a.jsonl", '{"a": 1, " b": {"c": [1, 2]}}\n\n  \n{"a": 2.5}\n')
    df = load_table(spark, path)
    assert df.columns == ["a", " b"]
    assert {r.a for r in df.collect()} == {"1", "2.5"}
    assert [r.a for r in df.where("coalesce(cast(a as double), 0) > 2").select("a").collect()] == ["2.5"]


@pytest.mark.parametrize("line", ["[1]", '[{"a": 3}]', "7", '{"a": ', "oops"])
def test_json_lines_that_are_no_objects(spark, tmp_path, line):
    path = put(tmp_path / "a.json", '{"a": 1}\n' + line + "\n")
    with pytest.raises(Exception, match="not a JSON object"):
        read_json_lines(spark, path, T.StructType().add("a", "integer")).collect()
    with pytest.raises(Exception, match="not a JSON object"):
        read_json_lines(spark, path).collect()


def test_token_template(spark, tmp_path):
    path = put(tmp_path / "t.json", json.dumps({"z": "<Z>", "a": "<A>", "m": "<Z>"}, indent=1))
    got = values(read_token_template(spark, path).orderBy("pos"))
    assert got == [(0, "z", "<Z>"), (1, "a", "<A>"), (2, "m", "<Z>")]


def test_token_entries_repeats_and_odd_values(spark):
    texts = ['{"b": "<B>", "a": 1.5, "b": "<C>", "n": null, "o": {"x": [1]}}', None, "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "name int, t string")
    got = [tuple(r) for r in token_entries(df, "t", ["name"]).collect()]
    assert got == [(0, 0, "b", "<C>"), (0, 1, "a", "1.5"), (0, 2, "n", None), (0, 3, "o", '{"x": [1]}')]
    with pytest.raises(Exception, match="not a JSON object"):
        token_entries(spark.sql("select '[1]' t"), "t", []).collect()


# --- workbooks --------------------------------------------------------------

def column(i):
    return chr(ord("A") + i) if i < 26 else column(i // 26 - 1) + chr(ord("A") + i % 26)


def workbook(path, sheets):
    """Sheets are name -> rows; text goes to the shared strings, every other text inline."""
    shared, parts = [], {}
    for n, rows in enumerate(sheets.values(), 1):
        out = []
        for r, row in enumerate(rows, 1):
            if row is None:
                continue
            cells = []
            for i, v in enumerate(row):
                at = f'r="{column(i)}{r}"'
                if v is None:
                    continue
                if isinstance(v, bool):
                    cells.append(f'<c {at} t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, (int, float)):
                    cells.append(f"<c {at}><v>{v}</v></c>")
                elif i % 2:
                    cells.append(f'<c {at} t="inlineStr"><is><t>{escape(v)}</t></is></c>')
                else:
                    shared.append(v)
                    cells.append(f'<c {at} t="s"><v>{len(shared) - 1}</v></c>')
            out.append(f'<row r="{r}">{"".join(cells)}</row>')
        parts[f"xl/worksheets/sheet{n}.xml"] = f"<worksheet><sheetData>{''.join(out)}</sheetData></worksheet>"
    ns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    parts["xl/workbook.xml"] = f"<workbook {ns}><sheets>" + "".join(
        f'<sheet name="{escape(s)}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(sheets, 1)
    ) + "</sheets></workbook>"
    parts["xl/_rels/workbook.xml.rels"] = "<Relationships>" + "".join(
        f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(sheets) + 1)
    ) + "</Relationships>"
    half = [f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r></si>" for s in shared]
    parts["xl/sharedStrings.xml"] = f"<sst>{''.join(half)}</sst>"
    with zipfile.ZipFile(path, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return str(path)


def test_workbook_sheets_and_types(spark, tmp_path):
    path = workbook(tmp_path / "a.xlsx", {
        "One": [[" n ", "x", "b", "code", "mixed", "empty"], [1, 2.5, True, "007", 1, None],
                None, [2, 3, False, "NA", "t&<x>", None]],
        "Two": [["k"], ["v"]],
    })
    df = load_table(spark, path)
    assert df.dtypes == [("n", "bigint"), ("x", "double"), ("b", "boolean"), ("code", "string"),
                         ("mixed", "string"), ("empty", "double")]
    assert values(df) == [(1, 2.5, True, "007", "1", None), (None,) * 6, (2, 3.0, False, None, "t&<x>", None)]
    for sheet in ("Two", 1, "1"):
        assert values(load_table(spark, path, sheet=sheet)) == [("v",)]
    for sheet in ("Three", 2):
        with pytest.raises(Exception, match="no sheet"):
            load_table(spark, path, sheet=sheet)


def test_a_folder_of_workbooks(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {"S": [["x", "y"], [1, "a"]]})
    workbook(tmp_path / "b.xlsx", {"S": [["y", "z", "x"], ["b", 0, 2], ["c", 0, 3]]})
    df = load_table(spark, str(tmp_path), "xlsx")
    assert df.columns == ["x", "y", "z"]
    assert sorted(values(df)) == [(1, "a", None), (2, "b", 0), (3, "c", 0)]
    schema = T.StructType().add("z", "integer").add("x", "double")
    got = sorted(values(load_table(spark, str(tmp_path), "xlsx", schema=schema)), key=repr)
    assert got == [(0, 2.0), (0, 3.0), (None, 1.0)]


def test_a_wide_workbook(spark, tmp_path):
    names = [f"c{i}" for i in range(60)]
    df = load_table(spark, workbook(tmp_path / "a.xlsx", {"S": [names, list(range(60))]}))
    assert df.columns == names and values(df) == [tuple(range(60))]


# --- sinks ------------------------------------------------------------------

def test_csv_round_trip(spark, tmp_path):
    rows = [("a,\"b\"\n c ", 1, 1e7, True), (" ", None, math.inf, False), (None, 3, 1.5e-8, None)]
    df = spark.createDataFrame(rows, "s string, i bigint, f double, b boolean")
    path = str(tmp_path / "new" / "deeper" / "t.csv")
    write_table(df, path)
    assert sorted(values(load_table(spark, path)), key=repr) == sorted(rows, key=repr)
    raw = [r.value for r in spark.read.text(path).collect()]
    assert any("10000000.0,True" in line for line in raw) and any("1.5e-08" in line for line in raw)
    with pytest.raises(Exception, match="exists"):
        write_table(df, path)
    write_table(df.limit(1), path, mode="overwrite")
    assert load_table(spark, path).count() == 1


@pytest.mark.parametrize("fmt", ["jsonl", "parquet"])
def test_other_round_trips(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a\nb", 1, [1, 2]), (None, 2, None)], "s string, i bigint, a array<bigint>")
    path = str(tmp_path / f"t.{fmt}")
    write_table(df, path)
    assert sorted(values(load_table(spark, path).select(*df.columns)), key=repr) == sorted(values(df), key=repr)


def test_workbooks_are_not_written(spark, tmp_path):
    with pytest.raises(ValueError, match="not written"):
        write_table(spark.range(1), str(tmp_path / "a.xlsx"))


def test_split_paths():
    assert part_path("hdfs://n:1/a/b.c.csv", "train", ".csv") == "hdfs://n:1/a/b.c-train.csv"
    assert split_paths("/d/in.csv") == ("/d/in-train.csv", "/d/in-test.csv", "csv")
    assert split_paths("/d/in.xlsx", input_format="xlsx") == ("/d/in-train.csv", "/d/in-test.csv", "csv")
    assert split_paths("/d/in.csv", "/e/t.parquet") == ("/e/t.parquet", "/d/in-test.csv", "parquet")
    assert split_paths("/d/in.csv", "/e/t", fmt="auto")[2] == "csv"
    assert split_paths("/d/in.csv", "/e/t.csv", fmt="jsonl")[2] == "jsonl"


def test_split_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "i bigint, split string")
    write_split(df, str(tmp_path / "s.csv"))
    assert sorted(values(spark.read.option("header", True).csv(str(tmp_path / "s.csv")))) == [
        ("1", "train"), ("2", "test"), ("3", "train")]
    train, test = write_train_test(df, str(tmp_path / "in.csv"))
    assert (train, test) == (str(tmp_path / "in-train.csv"), str(tmp_path / "in-test.csv"))
    assert sorted(values(load_table(spark, train))) == [(1,), (3,)]
    assert values(load_table(spark, test)) == [(2,)]


def test_split_is_written_in_one_pass_or_not_at_all(spark, tmp_path, monkeypatch):
    spark.range(20).selectExpr("id", "if(id % 4 = 0, 'test', if(id = 7, null, 'train')) split", "id part").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    train, test = write_train_test(df.mapInArrow(counted, df.schema), str(tmp_path / "a" / "in.parquet"), input_format="parquet")
    assert seen.value == 20
    assert sorted(values(spark.read.parquet(test))) == [(i, i) for i in range(0, 20, 4)]
    assert spark.read.parquet(train).count() == 14 and spark.read.parquet(train).columns == ["id", "part"]
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["in-test.parquet", "in-train.parquet"]
    with pytest.raises(FileExistsError):
        write_train_test(df, str(tmp_path / "a" / "in.parquet"), input_format="parquet")
    few = df.where("split = 'train' and id < 3")
    write_train_test(few, str(tmp_path / "a" / "in.parquet"), input_format="parquet", mode="overwrite")
    assert spark.read.parquet(test).count() == 0 and spark.read.parquet(train).count() == 2
    bad = df.selectExpr("assert_true(id < 19) x", "split", "id")
    with pytest.raises(Exception, match="(?i)true"):
        write_train_test(bad, str(tmp_path / "a" / "in.parquet"), input_format="parquet", mode="overwrite")
    with pytest.raises(Exception, match="(?i)true"):
        write_train_test(bad, str(tmp_path / "b" / "in.parquet"), input_format="parquet")
    from rowloom.sources import writers

    move = writers._Store.move

    def broken(self, path, to):
        if to == test and path.endswith("=test"):
            raise OSError("store is gone")
        move(self, path, to)

    monkeypatch.setattr(writers._Store, "move", broken)
    with pytest.raises(OSError):
        write_train_test(df, str(tmp_path / "a" / "in.parquet"), input_format="parquet", mode="overwrite")
    monkeypatch.undo()
    assert spark.read.parquet(test).count() == 0 and spark.read.parquet(train).count() == 2
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["in-test.parquet", "in-train.parquet"]
    assert not [p for p in (tmp_path / "b").rglob("*") if p.is_file()]


def test_cast_to_text_skips_absent_columns(spark):
    df = columns_as_text(spark.sql("select 1.0D a, true b, cast(null as int) c, 5 d"), ["a", "b", "c", "zz"])
    assert values(df) == [("1.0", "True", None, 5)]


def test_files_of_a_folder_that_do_not_fit_together(spark, tmp_path):
    for name, text in {"a/1": "a,b\n1,x\n", "a/2": "b,a\ny,2\n", "s/1": "a,b\n1,x\n2,y,z\n", "f/1": "a,b\n1,x\n", "f/2": "a,b\n2\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)header"):
        load_table(spark, str(tmp_path / "a"), "csv").collect()
    with pytest.raises(Exception, match="more fields"):
        load_table(spark, str(tmp_path / "s"), "csv").collect()
    assert sorted(values(load_table(spark, str(tmp_path / "f"), "csv"))) == [(1, "x"), (2, None)]
    spark.range(1).write.parquet(str(tmp_path / "p" / "k=1"))
    spark.range(1).selectExpr("id", "'v' more").write.parquet(str(tmp_path / "p" / "k=2"))
    assert set(load_table(spark, str(tmp_path / "p"), "parquet").columns) == {"id", "more", "k"}


def test_workbooks_written_and_read_again(spark):
    rows = [
        (1, 0.5, True, " padded <&> \r\n\t", "7", [1]), (2**62, 1e300, None, None, "é日👩", None), (-3, 2.0, False, "x" * 40_000, "0.1", [2, 3]),
    ] * 5
    df = spark.createDataFrame(rows, "i bigint, x double, b boolean, s string, t string, l array<int>").repartition(2)
    books = workbook_contents(df, "It's <1>", rows_per_book=4)
    found = read_workbooks(spark, books, "It's <1>")
    assert books.count() >= 4 and found.dtypes == [
        ("i", "bigint"), ("x", "double"), ("b", "boolean"), ("s", "string"), ("t", "string"), ("l", "string"),
    ]
    want = [(*r[:5], None if r[5] is None else str(r[5]).replace(" ", "")) for r in rows]
    assert sorted(map(repr, values(found))) == sorted(map(repr, want))
    with pytest.raises(Exception, match="control character"):
        workbook_contents(spark.sql("select '\\u0001' s")).collect()
    with pytest.raises(ValueError):
        workbook_contents(df, rows_per_book=0)


def test_written_workbooks_are_unpacked_once(spark, monkeypatch):
    from rowloom.sources import workbook

    seen = []
    monkeypatch.setattr(workbook, "checkpointed", lambda df: seen.append(df) or df.cache())
    assert read_workbooks(spark, workbook_contents(spark.range(3).toDF("a"))).count() == 3 and len(seen) == 1


def test_sheet_place():
    names = ["a", "2", "b"]
    assert [sheet_place(names, x) for x in (None, 0, "1", "b", 2)] == [0, 0, 1, 2, 2]
    for bad in (3, "3", "c", -1, "²"):
        with pytest.raises(ValueError, match="no sheet"):
            sheet_place(names, bad)
