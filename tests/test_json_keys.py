"""Columns of JSON lines: order of keys, kinds of numbers, odd lines."""

import json

import pytest
from pyspark.sql import types as T

from rowloom.functions.content import key_value_text
from rowloom.sources.files import read_json_lines
from rowloom.sources.json_keys import spark_type


def put(folder, name, lines):
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def test_keys_of_several_files_in_their_first_order(spark, tmp_path):
    put(tmp_path, "1.jsonl", [{"z": 1, "b": "x"}, "", {"m": None, "z": 2, "a": True}])
    put(tmp_path, "2.jsonl", [{"q": [1, 2.5], "z": 3, "b": "y", "o": {"k": 1}}, {"o": {"j": "t"}}])
    df = read_json_lines(spark, str(tmp_path))
    assert df.dtypes == [
        ("z", "bigint"), ("b", "string"), ("m", "string"), ("a", "boolean"), ("q", "array<double>"), ("o", "struct<j:string,k:bigint>"),
    ]
    assert sorted(r.z or 0 for r in df.collect()) == [0, 1, 2, 3]


def test_numbers_print_as_they_were(spark, tmp_path):
    rows = [{"n": 1, "f": 1.0, "x": 1.5}, {"n": 2.5, "f": 2e20, "x": -3.25}, {"n": 10**25, "f": 0.1, "x": 7.0}, {"n": 1e30, "f": None, "x": 3.0}]
    put(tmp_path, "a.jsonl", rows)
    df = read_json_lines(spark, str(tmp_path))
    assert df.dtypes == [("n", "string"), ("f", "double"), ("x", "double")]
    got = [r.t for r in df.select(key_value_text(df).alias("t")).collect()]
    assert got == ["\n".join(f"{k}: {'' if v is None else v}" for k, v in r.items()) for r in rows]


def test_long_whole_numbers_and_words_that_are_no_json(spark, tmp_path):
    put(tmp_path, "a.jsonl", ['{"big": 12345678901234567890, "f": NaN, "t": "a, NaN, b"}', '{"big": 1, "f": -Infinity}'])
    df = read_json_lines(spark, str(tmp_path))
    assert df.dtypes == [("big", "string"), ("f", "double"), ("t", "string")]
    one, two = df.collect()
    assert one.big == "12345678901234567890" and one.f != one.f and one.t == "a, NaN, b" and two.f == float("-inf")


def test_repeated_keys_take_the_last_value(spark, tmp_path):
    put(tmp_path, "a.jsonl", ['{"b": 1, "a": 2, "b": 3}'])
    df = read_json_lines(spark, str(tmp_path))
    assert df.columns == ["b", "a"] and tuple(df.first()) == (3, 2)


def test_keys_that_differ_in_case(spark, tmp_path):
    put(tmp_path, "a.jsonl", [{"Id": 1, "id": "x"}])
    with pytest.raises(ValueError, match="differ in case"):
        read_json_lines(spark, str(tmp_path))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = read_json_lines(spark, str(tmp_path))
        assert df.dtypes == [("Id", "bigint"), ("id", "string")] and tuple(df.first()) == (1, "x")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_types_of_variants():
    assert spark_type("OBJECT<`a OBJECT<x`: VOID, y: ARRAY<DECIMAL(21,1)>>") == T.StructType(
        [T.StructField("a OBJECT<x", T.StringType()), T.StructField("y", T.ArrayType(T.DoubleType()))]
    )
    assert spark_type("VARIANT") == spark_type("DECIMAL(25,0)") == spark_type("OBJECT<>") == T.StringType()
    assert spark_type("DECIMAL(1,0)") == T.DoubleType()
