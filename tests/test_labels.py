import math

import pytest

from rowloom.functions.labels import label_set, label_sets, label_text
from rowloom.operators.labels import (
    UnknownLabelsError, class_counts, of_class, refuse_unknown_labels, unknown_labels, with_label,
)


def labels(df, **kw):
    return [r.label for r in with_label(df, "l", **kw).collect()]


def test_label_words_of_each_type(spark):
    words = ["是", " TRUE ", "1", "\tYes　", "y", "T", "否", "False", "0", "no", "N", "f",
             "1.0", "maybe", "", None]
    df = spark.createDataFrame([(w,) for w in words], "l string")
    assert labels(df) == [True] * 6 + [False] * 6 + [None] * 4
    df = spark.createDataFrame([(v,) for v in (1.0, 1.7, 0.5, -0.5, 2.5, math.nan, math.inf, None)], "l double")
    assert labels(df) == [True, True, False, False, None, None, None, None]
    df = spark.createDataFrame([(v,) for v in (1, 0, 2, None)], "l int")
    assert labels(df) == [True, False, None, None]


def test_booleans_ignore_the_words(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "l boolean")
    assert labels(df, positive="false", negative="true") == [True, False, None]


def test_a_float_may_match_its_own_text(spark):
    df = spark.createDataFrame([(2.5,), (2.0,), (-1.9,)], "l double")
    assert labels(df, positive="2.5", negative="2,-1") == [False, False, False]


def test_label_sets():
    assert label_set(" A, b ,,A") == {"a", "b"}
    with pytest.raises(ValueError, match="yes"):
        label_sets("yes,1", "YES")


def test_unknown_audit_counts_null_too(spark):
    df = with_label(spark.createDataFrame([("a",), ("a",), (None,), ("y",)], "l string"), "l")
    assert {r.value: r.n for r in unknown_labels(df, "l").collect()} == {"a": 2, None: 1}
    with pytest.raises(UnknownLabelsError, match="'a': 2"):
        refuse_unknown_labels(df, "l")


def test_classes(spark):
    df = with_label(spark.createDataFrame([("y",), ("y",), ("n",)], "l string"), "l")
    assert {r.label: r.n for r in class_counts(df).collect()} == {True: 2, False: 1}
    assert of_class(df, True).count() == 2 and of_class(df, False).count() == 1


def test_label_text(spark):
    df = spark.createDataFrame([(" x　",), ("  ",), (None,)], "l string")
    assert [r[0] for r in df.select(label_text(df, "l")).collect()] == ["x", None, None]
    assert [r[0] for r in df.select(label_text(df, "other")).collect()] == [None] * 3


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="'z'"):
        with_label(spark.range(1), "z")


def test_labels_need_no_python(spark, capsys):
    with_label(spark.createDataFrame([("a",)], "l string"), "l").explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan
