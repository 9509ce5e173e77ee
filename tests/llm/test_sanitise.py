"""Personal data in texts with very many matches, and disclosure against counting by hand."""

import math
import re
import time

import pytest
from pyspark.sql import functions as F

from rowloom.llm import sanitise as S


def spans_of(df):
    digits = F.length(F.regexp_replace("text", "[^0-9]+", ""))
    return df.select("doc_id", "text", S.base_spans(F.col("text"), digits).alias("spans"))


def test_fifty_thousand_matches_in_one_text(spark):
    mails = [f"user{i}@host{i % 97}.org" for i in range(50_000)]
    numbers = " ".join(f"{i} +1 555 {1000000 + i}" for i in range(20_000))
    df = spark.createDataFrame([(1, "é " + ", ".join(mails) + " end"), (2, numbers), (3, "x" * 255 + "@a.b"), (4, "")], "doc_id int, text string")
    start = time.time()
    got = {r["doc_id"]: r for r in spans_of(df).withColumn("clean", S.sanitised(F.col("text"), F.col("spans"))).collect()}
    assert time.time() - start < 60
    assert [x["v"] for x in got[1]["spans"]] == mails
    assert all(got[1]["text"][x["s"] : x["e"]] == x["v"] for x in got[1]["spans"])
    assert got[1]["clean"] == "é " + ", ".join(["[EMAIL]"] * 50_000) + " end"
    assert all(got[2]["text"][x["s"] : x["e"]] == x["v"] for x in got[2]["spans"])
    assert got[3]["clean"] == "[EMAIL]" and got[4]["clean"] == "" and got[4]["spans"] == []


@pytest.mark.parametrize("matches", [0, 1, 255, 256, 257, 600])
def test_borders_of_blocks(spark, matches):
    text = "a " + " ".join(f"m{i}@h.org z" for i in range(matches))
    row = spans_of(spark.createDataFrame([(1, text)], "doc_id int, text string")).withColumn(
        "clean", S.sanitised(F.col("text"), F.col("spans"))
    ).first()
    assert [(x["s"], x["e"]) for x in row["spans"]] == [m.span() for m in re.finditer(r"m\d+@h\.org", text)]
    assert row["clean"] == re.sub(r"m\d+@h\.org", "[EMAIL]", text)


def test_overlapping_spans_keep_the_first(spark):
    df = spark.sql("select 'abcdefghij' text, array(named_struct('s',1L,'k',0,'e',5L,'v','x'), named_struct('s',3L,'k',2,'e',7L,'v','y')) spans")
    assert df.select(S.sanitised(F.col("text"), F.col("spans")).alias("c")).first()["c"] == "a[EMAIL]hij"


def by_hand(texts, rule):
    """entity, term -> disclosure at or above the lower threshold."""
    mail, term = re.compile(r"[\w.]+@[\w]+\.org"), re.compile(r"(?<![\w-])[^\W\d_][\w-]{2,}")
    different = sorted(set(filter(None, texts)))
    words = [set(term.findall(t.lower())) for t in different]
    near, holds = {}, {}
    for k, t in enumerate(different):
        for m in mail.finditer(t):
            e = m.group().lower()
            holds.setdefault(e, set()).add(k)
            a, b = t[max(m.start() - rule.reach, 0) : m.start()], t[m.end() : m.end() + rule.reach]
            a = re.sub(r"^\S+", "", a) if m.start() > rule.reach else a
            b = re.sub(r"\S+$", "", b) if len(b) == rule.reach else b
            for w in set(term.findall((a + "\n" + b).lower())):
                near.setdefault((e, w), set()).add(k)
    out = {}
    for (e, w), ks in near.items():
        n, te, en, t = len(different), len(ks), len(holds[e]), sum(w in x for x in words)
        if te >= rule.support and n > en:
            d = math.log(n * te / (t * en)) / math.log(n / en)
            if d >= rule.generalise:
                out[e, w] = round(d, 9)
    return out


@pytest.mark.parametrize("small", [True, False])
def test_disclosure_against_counting(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(S, "fits_broadcast", lambda df: False)
    texts = [f"Falkner wrote me{i % 3}@x.org about river{i} and the stone" for i in range(30)]
    texts += [f"The stone by river{i} is old, says Falkner{i}" for i in range(40)] + ["nothing here", None, ""]
    texts += ["Falkner wrote me0@x.org about river0 and the stone"] * 50 + ["The stone by river3 is old, says Falkner3"] * 50
    rule = S.Disclosure(generalise=0.3)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").repartition(5)
    entities = spans_of(docs).where(F.size("spans") > 0).withColumn("h", F.sha2("text", 256)).dropDuplicates(["h"])
    found = S.revealing_terms(docs.select("text"), entities.select("h", "text", "spans"), rule).collect()
    want = by_hand(texts, rule)
    # Null and empty texts are no evidence by hand; the empty text is a text of the corpus.
    size, different = S._different(docs.where("text is not null").select("text"))
    assert size == different.count() == len(set(filter(lambda t: t is not None, texts)))
    assert {(r["entity"], r["term"]) for r in found} == set(want) and len(want) > 3
    spans = S.personal_spans(docs, rule)
    assert spans.count() == len(texts) and spans.where("doc_id is null").count() == 0
