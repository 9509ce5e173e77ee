import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rowloom.operators import joins, vocab as vocab_module
from rowloom.operators.vocab import (
    alignment_report, append_tokens, grow_embeddings, initialise_tokens, lookup_tokens,
    merge_token_lists, ordered_union, refuse_misalignment, token_rows,
)


@pytest.fixture
def vocab(spark):
    return spark.createDataFrame([("a", 0), ("b", 1), ("</s>", 2)], "token string, id bigint")


@pytest.fixture
def matrix(spark):
    return spark.createDataFrame([(i, [float(i), -float(i)]) for i in range(3)], "id bigint, vector array<float>")


def mapped(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("limit", [1000, 0])
def test_lookup(spark, vocab, monkeypatch, limit):
    monkeypatch.setattr(vocab_module, "LISTED_IN_FILTER", limit)
    want = {"b": (1, True), "+": (None, False), "": (None, False)}
    assert mapped(lookup_tokens(vocab, ["b", "+", "b", ""])) == want
    asked = spark.createDataFrame([("b", [1]), ("+", [7, 8])], "token string, encoded array<int>")
    got = mapped(lookup_tokens(vocab, asked, "encoded"))
    assert got == {"b": (1, True, [1], True), "+": (None, False, [7, 8], False)}


def test_lookup_of_a_table_with_a_hot_token(spark, vocab, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    asked = spark.range(900).select(F.when(F.col("id") < 400, "b").otherwise(F.col("id").cast("string")).alias("token"))
    got = lookup_tokens(vocab, asked)
    assert got.count() == 900 and got.where("in_vocab").count() == 400


def test_ordered_union(spark):
    a, b = token_rows(spark, ["x", "y", "x"]), token_rows(spark, ["y", "z"])
    assert [r.token for r in ordered_union(a, b).orderBy("pos").collect()] == ["x", "y", "z"]
    row = spark.sql("select array('x','y','x') a, array('y','z') b").select(merge_token_lists(F.col("a"), F.col("b")))
    assert row.first()[0] == ["x", "y", "z"]
    with pytest.raises(ValueError):
        ordered_union()


def test_append(spark, vocab, monkeypatch):
    want = {"a": (0,), "b": (1,), "</s>": (2,), "<N>": (3,), "<M>": (4,)}
    tokens = ["<N>", "b", "<M>", "<N>"]
    assert mapped(append_tokens(vocab, tokens)) == want
    monkeypatch.setattr(vocab_module, "NUMBERED_AT_ONCE", 2)
    assert mapped(append_tokens(vocab, tokens)) == want
    table = spark.createDataFrame([(t, i * 10) for i, t in enumerate(tokens)], "token string, pos bigint")
    assert mapped(append_tokens(vocab, table)) == want
    assert mapped(append_tokens(vocab.where("false"), ["p", "q"])) == {"p": (0,), "q": (1,)}
    assert append_tokens(vocab, ["a"]).count() == 3


def test_numbering_in_many_runs(spark, vocab, monkeypatch):
    monkeypatch.setattr(vocab_module, "NUMBERED_AT_ONCE", 10)
    table = spark.range(500).select(F.concat(F.lit("n"), "id").alias("token"), (F.col("id") * 3).alias("pos"))
    got = mapped(append_tokens(vocab, table).where("token like 'n%'"))
    assert got == {f"n{i}": (3 + i,) for i in range(500)}


def test_alignment(vocab, matrix):
    fine = alignment_report(vocab, matrix, ["a", "b"])
    assert fine.count() == 0
    refuse_misalignment(fine)
    report = alignment_report(append_tokens(vocab, ["<N>"]), matrix, ["a", "<N>", "<Q>"])
    assert sorted(map(tuple, report.collect()), key=repr) == sorted([
        ("bad_token_id", "error", "<N>", 3), ("bad_token_id", "error", "<Q>", None),
        ("vocab_larger", "error", None, None), ("sizes_differ", "warning", None, None)], key=repr)
    with pytest.raises(ValueError, match="bad_token_id"):
        refuse_misalignment(report)
    smaller = alignment_report(vocab.where("id < 2"), matrix, [])
    assert [r.check for r in smaller.collect()] == ["sizes_differ"]
    refuse_misalignment(smaller)


def test_grow(matrix):
    assert mapped(grow_embeddings(matrix, 5)) == mapped(matrix) | {3: (None,), 4: (None,)}
    assert mapped(grow_embeddings(matrix, 2)) == mapped(matrix)


def test_initialise(vocab, matrix):
    tokens = ["<N>", "b"]
    bigger = append_tokens(vocab, tokens)
    wide = grow_embeddings(matrix, 5)
    got = mapped(initialise_tokens(wide, bigger, tokens, 2, 3))
    assert got == {0: ([0.0, 0.0],), 1: ([1.0, -1.0],), 2: ([2.0, -2.0],), 3: ([2.0, -2.0],), 4: (None,)}
    got = mapped(initialise_tokens(wide, bigger, tokens, 2, 3, overwrite_existing=True))
    assert got[1] == got[3] == ([2.0, -2.0],)
    with pytest.raises(Exception, match="no embedding row 9"):
        initialise_tokens(wide, bigger, tokens, 9, 3).collect()


def test_a_million_sparse_positions(spark, vocab):
    """Positions far apart: the ranges are by rows, not by the numbers between them."""
    tokens = spark.range(1_000_000).select(F.format_string("s%07d", "id").alias("token"), (F.col("id") * 10_000_019 % 999_983_000_011).alias("pos"))
    top = vocab.agg(F.max("id")).first()[0]
    got = append_tokens(vocab, tokens).where("token like 's%'")
    seen = got.agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id")).first()
    assert tuple(seen) == (1_000_000, 1_000_000, top + 1, top + 1_000_000)
    joined = got.join(tokens, "token").select("id", F.lag("pos").over(Window.orderBy("id")).alias("before"), "pos")
    assert joined.where("before >= pos").count() == 0


def test_long_lists_are_joined(spark, vocab, matrix, monkeypatch):
    monkeypatch.setattr(vocab_module, "LISTED_IN_FILTER", 1)
    tokens = ["a", "<N>", "<M>"]
    bigger = append_tokens(vocab, tokens)
    assert vocab_module.vocabulary_state(bigger, tokens) == (
        {r.token: r.id for r in bigger.where(F.col("token").isin(tokens)).collect()}, bigger.agg(F.max("id")).first()[0] + 1,
    )
    old = vocab_module.vocabulary_state(vocab, [])[1]
    wide = grow_embeddings(matrix, old + 2)
    long = initialise_tokens(wide, bigger, tokens, 0, old)
    monkeypatch.setattr(vocab_module, "LISTED_IN_FILTER", 1000)
    assert sorted(map(str, long.collect())) == sorted(map(str, initialise_tokens(wide, bigger, tokens, 0, old).collect()))
