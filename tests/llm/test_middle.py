"""Fill-in-middle against regular expressions, slices and SQL."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowloom.llm import middle as M
from rowloom.llm.queries import ORACLE, op13_fill_in_middle
from tests.compare import connect, same_rows

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, output string, form string, k0 array<int>"
ALPHABET = st.sampled_from(list(" \t\nab<é日👩　\x0b"))


def by_regex(key, text, seed=42):
    text = text or ""
    tokens = TOKEN.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(x in text for x in M.MARKS) or h3 % 100 >= 50:
        return len(tokens), "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return len(tokens), "spm" if h4 % 100 < 80 else "psm", len(p), len(m), out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), min_size=1, max_size=8))
def test_boundaries(texts):
    places, tokens = M.boundaries(texts)
    want, base = [], 0
    for t in texts:
        want += [base, *(base + m.end() for m in TOKEN.finditer(t))]
        base += len(t)
    assert places.tolist() == want and tokens.tolist() == [len(TOKEN.findall(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000) | st.just(0), min_size=1, max_size=600), st.integers(1, 64), st.integers(0, 127))
def test_rank_index_is_exact(steps, span, error):
    places = np.cumsum(steps)
    index = M.RankIndex(places, span, error)
    assert np.array_equal(index[np.arange(len(places))], places)
    assert np.abs(index.residual).max() <= error


def test_rank_index_is_small():
    places = np.cumsum(np.random.default_rng(2).integers(2, 12, 200_000))
    index = M.RankIndex(places)
    assert np.array_equal(index[np.arange(len(places))], places) and len(index.first) < 500
    assert len(M.RankIndex(np.zeros(0, np.int64)).first) == 0


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ab é日👩 \n\t\x0c<PSM>"), rng.integers(0, 200))) for _ in range(300)]
    texts += [None, "", " ", "\n\n", "x", "a <P> b", "<S>", "<M", "a<", "<<P", "word " * 50_000, "é" * 100_000]
    out = [(i if i != 4 else None, t, "x", "y", [1, i]) for i, t in enumerate(texts)]
    return [*out, out[3], out[3]]


def test_against_regex(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = M.fill_in_middle(docs, "doc_id", ["doc_id", "k0", "output"])
    assert found.columns == ["doc_id", "k0", "output", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = M.fill_in_middle(docs, "doc_id", ["doc_id", "text"]).withColumn("back", M.restored(F.col("output"), F.col("form")))
    got = found.collect()
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(by_regex(k, t) for k, t, *_ in rows)
    assert all(r["back"] == (r["text"] or "") for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_own_marks_and_shares(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = ("«pre»", "«suf»", "«mid»")
    found = M.fill_in_middle(docs, "doc_id", ["text"], seed=1, share=100, suffix_first=0, marks=marks)
    got = found.withColumn("back", M.restored(F.col("output"), F.col("form"), marks)).collect()
    assert {r["form"] for r in got if r["text"]} == {"psm"} and all(r["back"] == (r["text"] or "") for r in got)
    for bad in (("a", "a", "b"), ("<a", "<b", "c"), ("<a<", "<b", "<c"), ("", "", "")):
        with pytest.raises(ValueError):
            M.restored(F.col("output"), F.col("form"), bad)


def test_empty_table(spark):
    assert M.fill_in_middle(spark.createDataFrame([], SCHEMA), "doc_id", ["doc_id"]).count() == 0


def test_query_agrees_with_sql(spark, tables):
    assert same_rows(op13_fill_in_middle(spark, tables), connect(tables), ORACLE["op13_fill_in_middle"]) is None
