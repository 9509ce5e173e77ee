"""CSV records across line breaks and ranges, against Python's own reader."""

import csv
import io
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.sources.files import read_csv
from rowloom.sources.positions import load_row
from rowloom.sources.records import open_after, records


@pytest.fixture
def short_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    for n, v in zip(names, ("1500", "1")):
        spark.conf.set(n, v)
    yield
    for n in names:
        spark.conf.unset(n)


def state_by_characters(line, inside):
    """The same question answered one character at a time."""
    state = "Q" if inside else "S"
    for c in line:
        if state == "S":
            state = "Q" if c == '"' else "S" if c == "," else "U"
        elif state == "Q":
            state = "E" if c == '"' else "Q"
        elif state == "E":
            state = "Q" if c == '"' else "S" if c == "," else "U"
        elif c == ",":
            state = "S"
    return state == "Q"


@settings(max_examples=2000, deadline=None)
@given(st.text(st.sampled_from(list('",a')), max_size=14), st.booleans())
def test_open_after(line, inside):
    assert open_after(line, inside) == state_by_characters(line, inside)


def written(tmp_path, name, rows, header=("a", "b c", ""), end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerows([header, *rows])
    (tmp_path / name).write_text(out.getvalue(), encoding="utf-8", newline="")
    return rows


def rows_like(n, every):
    for i in range(n):
        text = f'line {i}\nnext "{i}", end' if i % every == 0 else f'say "hi" {i}' if i % 3 else f"plain {i}"
        yield (str(i), text, f'5" nail {i}' if i % 4 == 0 else "")


def test_a_folder_with_line_breaks_is_read_by_many_tasks(spark, tmp_path, short_ranges):
    want = Counter()
    for name, every in (("a.csv", 7), ("b.csv", 1), ("c.csv", 10_000)):
        want.update((int(a), b, c or None) for a, b, c in written(tmp_path, name, list(rows_like(200, every))))
    long = [("-1", "\n".join(f"row {i}, x" for i in range(400)), "z")]
    want.update((int(a), b, c) for a, b, c in written(tmp_path, "d.csv", long, end="\r\n"))
    df = read_csv(spark, str(tmp_path))
    assert df.dtypes == [("a", "bigint"), ("b c", "string"), ("Unnamed: 2", "string")]
    assert Counter(map(tuple, df.collect())) == want
    found = records(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 10
    assert found.count() == sum(want.values()) + 4


def test_rows_by_position_across_line_breaks(spark, tmp_path, short_ranges):
    rows = written(tmp_path, "a.csv", list(rows_like(60, 5)), header=("a", "b", "c"))
    for i in (0, 5, 41, 59):
        assert load_row(spark, str(tmp_path / "a.csv"), i) == {"a": i, "b": rows[i][1], "c": rows[i][2] or None}
    with pytest.raises(ValueError, match="out of range"):
        load_row(spark, str(tmp_path / "a.csv"), 60)


def test_a_quote_inside_an_unquoted_field_opens_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n5" nail,x\n"q\nr",6" pipe\n1"2,"open\nend"\n')
    got = {tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {('5" nail', "x"), ("q\nr", '6" pipe'), ('1"2', "open\nend")}


@pytest.mark.parametrize("text", ["a,,b\n1,2,3\n", 'a,,b\n1,"2\n2",3\n'])
def test_headers_of_all_files_count(spark, tmp_path, text):
    (tmp_path / "1.csv").write_text(text)
    (tmp_path / "2.csv").write_text("﻿a ,,b\r\n4,5,6\r\n")
    assert read_csv(spark, str(tmp_path)).columns == ["a", "Unnamed: 1", "b"]
    assert read_csv(spark, str(tmp_path)).count() == 2
    with pytest.raises(ValueError, match="schema has 2"):
        read_csv(spark, str(tmp_path), read_csv(spark, str(tmp_path)).select("a", "b").schema)
    (tmp_path / "3.csv").write_text("a,c,b\n4,5,6\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv(spark, str(tmp_path))


def test_an_open_end_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n \na,b\n\n1,"x\n\ny"\n2,"open\n')
    got = {tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert (1, "x\n\ny") in got and len(got) == 2
