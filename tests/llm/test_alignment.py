"""Alignment of two tokenizers against a direct walk over the library's own tokens."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowloom.llm import alignment as L
from rowloom.llm.queries import BYTES_50K, PIECES_32K

SCHEMA = "doc_id bigint, text string, groups string, k0 string, n_a string"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES_50K)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES_32K)


def raw_tokens(libraries, text):
    a, b = libraries
    symbols = L.byte_symbols()
    ids = a.encode(" " + text, add_special_tokens=False).ids
    one = [(i, bytes(symbols[c] for c in a.id_to_token(i))) for i in ids]
    two = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        two.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    return one, two


def walked(libraries, text):
    """Groups by a walk along both token lists; None where a list does not give the text back."""
    if not text:
        return None
    one, two = raw_tokens(libraries, text)
    whole = (" " + text).encode()
    if b"".join(t for _, t in one) != whole or b"".join(t for _, t in two) != whole:
        return None
    groups, a, b, at_a, at_b, j = [], [], [], 0, 0, 0
    for i, t in one:
        a.append(i)
        at_a += len(t)
        while j < len(two) and at_b + len(two[j][1]) <= at_a:
            at_b += len(two[j][1])
            b.append(two[j][0])
            j += 1
            if at_b == at_a:
                groups.append((a, b))
                a, b = [], []
    return groups


def expected(libraries, texts):
    groups = [walked(libraries, t) for t in texts]
    links = [[(a[-1], b[-1]) for a, b in g] if g else [] for g in groups]
    total = Counter(p for some in links for p in some)
    most = {}
    for (_, b), n in total.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for g, some in zip(groups, links):
        if not g:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        best = sum(total[p] == most[p[1]] for p in some)
        n_a, n_b = sum(len(a) for a, _ in g), sum(len(b) for _, b in g)
        out.append((n_a, n_b, len(g), len(some), best, sum(total[p] for p in some), hashlib.sha256(text.encode()).hexdigest()))
    return out, [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or []) for g in groups]


TEXTS = [
    "The quick brown fox, isn't it?",
    "the the  the   the\n\nthe\t the ",
    None,
    "",
    " ",
    "<|endoftext|> is text </s> <s>",
    "Größe ½ ﬁ é 日本語のテキスト 👩‍👩‍👧 naïve",
    "a▁mark in it",
    "nul\x00 and \x7f and   space　wide",
    "don't they're I'LL 'tis 12345 67 8.9e-10",
    "é" * 5000,
    "x" * 9000,
    " " * 6000 + "end",
    "ab 12 " * 3000,
]


def same(df, texts, libraries):
    want, _ = expected(libraries, texts)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(want)


def test_counts_and_groups(spark, libraries):
    texts = [*TEXTS, TEXTS[0], TEXTS[0]]
    rows = [(i if i != 3 else None, t, "x", "y", "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0]], SCHEMA).repartition(3)
    for links in (1, 50, L.STRETCH_LINKS):
        found = L.alignment_counts(docs, BYTES_50K, PIECES_32K, ["doc_id"], stretch_links=links)
        assert same(found, [*texts, texts[0]], libraries)
    assert [r["doc_id"] for r in found.collect()].count(None) == 1
    named = L.token_groups(docs, BYTES_50K, PIECES_32K, ["doc_id", "n_a"]).collect()
    assert Counter(r["groups"] for r in named) == Counter(expected(libraries, [*texts, texts[0]])[1])


def test_pair_counts(spark, libraries):
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(TEXTS)], SCHEMA).repartition(2)
    links = Counter((a[-1], b[-1]) for t in TEXTS for a, b in walked(libraries, t) or [])
    found = {(r["a_id"], r["b_id"]): r["total"] for r in L.pair_counts(docs, BYTES_50K, PIECES_32K).collect()}
    assert found == links


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    found = L.alignment_counts(none, BYTES_50K, PIECES_32K, ["doc_id", "k0"])
    assert found.count() == 0 and found.columns[:2] == ["doc_id", "k0"]


def test_invalid_bytes_have_no_tokens():
    found = L.aligner(BYTES_50K, PIECES_32K)
    bad, good = L._documents(found, iter([b"a\xffb", b"fine"]), False)
    assert bad[:3] == (0, 0, "") and not len(bad[3]) and good[0] > 0


def test_whole_table_against_walk(spark, tables, libraries):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    texts = [r["text"] for r in docs.collect()]
    assert same(L.alignment_counts(docs, BYTES_50K, PIECES_32K, ["doc_id"], stretch_links=5000), texts, libraries)


def test_long_text_in_chunks(monkeypatch, libraries):
    monkeypatch.setattr(L, "CHUNK", 200)
    found = L.Aligner(BYTES_50K, PIECES_32K)
    rng = np.random.default_rng(1)
    text = " ".join(rng.choice(["the", "x1", "über", "日本", "a  b", "no.", "\n"], 4000))
    assert len(found.chunks(text.encode())) > 20
    (row,) = L._documents(found, iter([text.encode()]), True)
    assert row[4] == expected(libraries, [text])[1][0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.lists(st.integers(1, 4), min_size=1, max_size=40))
def test_pointer_jumping_finds_common_ends(one, two):
    a, b = np.cumsum(one), np.cumsum(two)
    end = max(a[-1], b[-1])
    a, b = (x if x[-1] == end else np.append(x, end) for x in (a, b))
    follow = L.terminals(a, b)
    common = np.intersect1d(a, b)
    want = common[np.searchsorted(common, np.concatenate([a, b]))]
    assert np.array_equal(a[follow], want)


def test_fast_encoder_equals_the_tokenizer(libraries):
    found = L.aligner(BYTES_50K, PIECES_32K)
    assert found.one.fast is not None
    for text in filter(None, TEXTS):
        for run in (True, False):
            assert found.one.encode([" " + text], [run])[0].tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
