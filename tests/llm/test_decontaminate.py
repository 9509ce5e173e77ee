"""Decontamination by suffix arrays against a direct search for windows and common stretches."""

import re
from collections import Counter

import numpy as np
import pytest

from rowloom.llm import decontaminate as D
from rowloom.llm.queries import ORACLE, op12_benchmark_decontamination
from tests.compare import connect, same_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, spans string, n_words int, k0 string, items string"
ITEMS = "item_id string, text string, spans string"
A_Z = {65 + i: 97 + i for i in range(26)}


def words(text):
    return WORD.findall((text or "").translate(A_Z))


def searched(docs, items, window):
    """(words, hit words, items) of every text by looking at every place."""
    found = {}
    for name, text in items:
        w = words(text)
        k = min(window, len(w))
        for p in range(len(w) - k + 1 if k else 0):
            found.setdefault(tuple(w[p : p + k]), set()).add(name or "")
    sizes = {len(k) for k in found}
    out = []
    for text in docs:
        w, hit, names = words(text), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if some := found.get(tuple(w[p : p + k])):
                    hit.update(range(p, p + k))
                    names |= some
        out.append((len(w), len(hit), tuple(sorted(names))))
    return out


@pytest.fixture(scope="module")
def tables():
    rng = np.random.default_rng(3)
    pool = ["the", "Ñu", "日本", "x1", "Äb", "eth", "Ion", "42"]
    prose = lambda n: " ".join(rng.choice(pool, n))
    items = [(str(i), prose(int(rng.integers(5, 30)))) for i in range(30)]
    items += [("30", "lone"), ("31", ""), ("32", None), (None, prose(14)), ("0", items[0][1]), ("33", items[4][1] + "!"), ("34", "z z z")]
    docs = [prose(int(rng.integers(0, 80))) for _ in range(40)]
    docs += [f"{prose(9)}\n{t.upper() if i % 2 else t}, {prose(5)}" for i, (_, t) in enumerate(items) if t]
    docs += [None, "", "...", "lone", "z z z z z", items[2][1], items[2][1], items[3][1] + " " + items[3][1], "z z"]
    docs.append(" ".join([prose(3000), items[5][1], prose(3000), items[6][1]]))
    return docs, items


def test_against_search(spark, tables):
    texts, items = tables
    rows = [(i if i != 7 else None, t, "a", 1, "b", "c") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[45]], DOCS).repartition(3)
    benchmark = spark.createDataFrame([(n, t, "s") for n, t in items], ITEMS)
    want = searched([*texts, texts[45]], items, 10)
    for block_bytes, shard_words in ((D.BLOCK_BYTES, D.SHARD_WORDS), (700, 50)):
        found = D.affected(docs, benchmark, ["doc_id", "k0"], block_bytes=block_bytes, shard_words=shard_words)
        got = [(r["n_words"], r["h"], tuple(r["items"])) for r in found.withColumn("h", D.n_hit(found["spans"])).collect()]
        assert Counter(got) == Counter(want)
    kept = D.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter(r["text"] for r in kept.collect()) == Counter(t for t, w in zip([*texts, texts[45]], want) if not w[1])


def test_longest_matches(spark, tables):
    texts, items = tables
    docs = spark.createDataFrame([(i, t, "", 1, "", "") for i, t in enumerate(texts)], DOCS).repartition(4)
    benchmark = spark.createDataFrame([(n, t, "s") for n, t in items], ITEMS)
    want, worded = {}, [words(t) for t in texts]
    for name, text in items:
        w = words(text)
        for at in range(len(w)):
            best = (0, 0, 0)
            for d, v in enumerate(worded):
                for p in range(len(v)):
                    n = 0
                    while at + n < len(w) and p + n < len(v) and w[at + n] == v[p + n]:
                        n += 1
                    best = min(best, (-n, d, p)) if n else best
            if -best[0] >= 6:
                want[name or "", at] = min(want.get((name or "", at), best), best)
    for shard_words in (D.SHARD_WORDS, 60):
        found = D.longest_matches(docs, benchmark, ["doc_id"], least=6, shard_words=shard_words).collect()
        assert {(r["item"], r["item_at"]): (-r["n_words"], r["doc_id"], r["doc_at"]) for r in found} == want


def test_empty_tables(spark, tables):
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    docs = spark.createDataFrame([(1, "a b c", "", 1, "", "")], DOCS)
    assert D.affected(none, no_items, ["doc_id"]).count() == 0
    assert [tuple(r["spans"]) for r in D.affected(docs, no_items, ["doc_id"]).collect()] == [()]
    assert D.longest_matches(docs, no_items, ["doc_id"]).count() == 0
    assert D.decontaminated(docs, spark.createDataFrame([(None, "a", "")], ITEMS)).count() == 0


def test_stretches_of_a_long_item():
    import pyarrow as pa

    text = " ".join(f"w{i}" for i in range(500)) + " " + "v" * 300 + " a b"
    batch = pa.RecordBatch.from_pydict({"item": ["i", "j"], "text": [text, "a " + "b" * 200 + " c"]})
    (out,) = D._stretches(iter([batch]), 100, 9)
    rows = out.to_pylist()
    own = [r for r in rows if r["item"] == "i"]
    every = text.encode().split()
    assert len(own) > 10 and all(every[r["at"] : r["at"] + len(r["body"].split())] == r["body"].split() for r in own)
    starts = {r["at"] + k for r in own for k in range(len(r["body"].split()) - 9)}
    assert starts == set(range(len(every) - 9))
    assert [r["body"] for r in rows if r["item"] == "j"] == [b"a " + b"b" * 200 + b" c"]


def test_suffix_array_order():
    rng = np.random.default_rng(5)
    for end, depth in ((3, 40), (2000, 10), (1 << 33, 7)):
        ids = rng.integers(0, min(end, 4), 3000)
        ids[1000:1400] = ids[:400]
        found = D.SuffixArray(ids, end, depth).sa
        padded = np.concatenate([ids, np.zeros(depth, np.int64)])
        # Words behind an unknown one do not count: no match goes past it.
        rows = [padded[i : i + depth] for i in found]
        keys = [tuple((x * np.logical_and.accumulate(x > 0)).tolist()) for x in rows]
        assert keys == sorted(keys) and sorted(found) == np.flatnonzero(ids).tolist()


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    name = "op12_benchmark_decontamination"
    assert same_rows(op12_benchmark_decontamination(spark, folder), connect(folder), ORACLE[name]) is None
