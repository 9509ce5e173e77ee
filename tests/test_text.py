import math
import random

import pytest
from pyspark.sql import functions as F

from rowloom.functions.text import (
    preview, py_trim, remove_tokens, safe_str, str_of, text_length,
)


def test_floats_print_as_in_python(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 1.0, -1.5, 1e-4, 1.2345e-4, 9.99e-5, 1e7, 12345678.9, -1e15, 1e16, 1.5e16,
              1e-8, 1e22, 1e100, -2.5e-300, math.inf, -math.inf, 0.1, 2 / 3]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 15) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", str_of(df, "v").alias("s")).collect():
        assert r.s == str(r.v)


def test_null_and_nan_print_as_nothing(spark):
    df = spark.createDataFrame([(None, None), (math.nan, "x")], "v double, s string")
    assert [tuple(r) for r in df.select(safe_str(df, "v"), safe_str(df, "s")).collect()] == [("", ""), ("", "x")]


def test_other_types_print_as_in_python(spark):
    df = spark.sql(
        "select true b, 7 i, date'2024-02-03' d, timestamp'2024-02-03 04:05:06' t,"
        " timestamp'2024-02-03 04:05:06.5' u, array(1,2) a, cast(0.5 as float) f, 1.50bd x"
    )
    row = df.select(*(str_of(df, c).alias(c) for c in df.columns)).first()
    assert tuple(row) == ("True", "7", "2024-02-03", "2024-02-03 04:05:06",
                          "2024-02-03 04:05:06.500000", "[1,2]", "0.5", "1.50")


def test_trim_agrees_with_python_on_every_character(spark):
    chars = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    kept = {r.c for r in df.where(py_trim(F.col("c")) != "").collect()}
    assert kept == {c for c in chars if c.strip()}


@pytest.mark.parametrize("tokens", [["<a>"], ["<a>", "<a><b>"], ["+", "a.b", "\\E"], ["", "x"], []])
def test_remove_tokens(spark, tokens):
    text = "1<a><b>2+a.b\\Eaxb<a>"
    want, i = "", 0
    longest_first = sorted([t for t in tokens if t], key=len, reverse=True)
    while i < len(text):
        hit = next((t for t in longest_first if text.startswith(t, i)), None)
        want += "" if hit else text[i]
        i += len(hit) if hit else 1
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(remove_tokens(F.col("t"), tokens)).first()[0] == want


def test_preview_and_length_count_characters(spark):
    df = spark.createDataFrame([("é😀" * 400,)], "t string")
    row = df.select(preview(F.col("t")), text_length(F.col("t"))).first()
    assert row[0] == ("é😀" * 400)[:500] and row[1] == 800
