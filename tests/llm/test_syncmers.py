"""Syncmer fingerprints against a plain version of every column."""

import hashlib
import struct

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from rowloom.llm import syncmers
from rowloom.llm.syncmers import edited_fingerprints

UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
RUN = regex.compile(rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]+")


def plain_symbols(text):
    out = []
    for run in RUN.findall(text):
        out += [run] if len(run) <= 32 else list(run)
    return out


def chained(*values):
    seed = 42
    for v in values:
        body = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(body, seed)
    return struct.unpack("<q", struct.pack("<Q", seed))[0]


def plain_anchors(text):
    words = plain_symbols(text)
    twos = [-(1 << 63)] * 7 + [chained(*words[max(i - 1, 0) : i + 1]) for i in range(len(words))]
    out = []
    for end in range(len(words)):
        mers = twos[end : end + 8]
        if min(mers) in (mers[0], mers[7]):
            out.append((chained(mers[0], mers[2], mers[4], mers[6], mers[7]) & 0xFFFFFFFF, end))
    return out


def plain_print(found):
    places = [0] + [p for _, p in found]
    return ".".join(f"{h:x}:{p - before}".upper().lower() for (h, p), before in zip(found, places))


def plain_likeness(a, b):
    both = sorted([(h if h < 1 << 31 else h - (1 << 32), p, 0) for h, p in a] + [(h if h < 1 << 31 else h - (1 << 32), p, 1) for h, p in b])
    alike = lambda i, first: 0 <= i < len(both) - 1 and both[i][0] == both[i + 1][0] and (both[i][2], both[i + 1][2]) == (first, 1 - first)
    pairs = []
    for i in range(len(both) - 1):
        if alike(i, 0):
            pairs.append((both[i][1], both[i + 1][1]))
        elif alike(i, 1) and not alike(i - 1, 0) and not alike(i + 1, 0):
            pairs.append((both[i + 1][1], both[i][1]))
    pairs = [(-1, -1), *sorted(pairs)]
    near = lambda p, q: q[0] > p[0] and q[1] > p[1] and abs(q[0] - p[0] - q[1] + p[1]) <= 8
    n = sum(near(pairs[i - 1], pairs[i]) or (i + 1 < len(pairs) and near(pairs[i], pairs[i + 1])) for i in range(1, len(pairs)))
    return n / (len(a) + len(b) - n) if a or b else 1.0


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    han = "".join(chr(c) for c in rng.integers(0x4E00, 0x9000, 3000))
    rows = [prose(rng, int(n)) for n in [1, 2, 4, 8, 9, 10, 60, 128, 130, 200, 3000]]
    rows += [None, "", " \n", han, "々" + han, "x" * 900, "q " * 700, "la le " * 90 + "lo", "\U0001f600é ü " * 20, han[:40] + " word " + han[:9]]
    rows += [prose(rng, 130) for _ in range(30)] + [prose(rng, 200) for _ in range(30)]
    return rows


@pytest.mark.parametrize("size", [700, 16 << 20])
def test_every_column_equals_the_plain_version(spark, texts, monkeypatch, size):
    monkeypatch.setattr(syncmers, "BUCKET_BYTES", size)
    docs = spark.createDataFrame([(i, t, 1.0, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, near_next double, a string")
    found = {r["doc_id"]: r for r in edited_fingerprints(docs.repartition(5)).collect()}
    whole = [t or "" for t in texts]
    assert len(found) == len(whole)
    for i, text in enumerate(whole):
        following, q, row = whole[(i + 1) % len(whole)], len(text) // 4, found[i]
        edited = text[: len(text) - q] + following[:q]
        a, e, b = plain_anchors(text), plain_anchors(edited), plain_anchors(following)
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row["fingerprint"], row["edited_fingerprint"]) == (plain_print(a), plain_print(e)), i
        assert row["near_edited"] == pytest.approx(plain_likeness(a, e), abs=0), i
        assert row["near_next"] == pytest.approx(plain_likeness(a, b), abs=0), i
    # One character before a text without spaces moves all places and leaves the anchors.
    assert found[14]["near_next"] > 0.9
    shorter, longer = (np.mean([found[i]["near_edited"] for i in at]) for at in (range(21, 51), range(51, 81)))
    assert abs(shorter - longer) < 0.05 and min(shorter, longer) > 0.45
    assert all(found[i]["near_edited"] > found[i]["near_next"] for i in range(6, 11))


def test_order_and_distance_count(spark):
    rng = np.random.default_rng(5)
    one, two = prose(rng, 60), prose(rng, 60)
    texts = [f"{one} {two}", f"{two} {one}", f"{two} {one}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: r for r in edited_fingerprints(docs).collect()}
    assert found[0]["near_next"] < 0.95 < found[1]["near_next"] == 1.0


def test_null_and_repeated_keys(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, None), (3, "x y"), (3, "x y"), (3, "x y")], "doc_id bigint, text string")
    rows = edited_fingerprints(docs).collect()
    assert len(rows) == 5 and sum(r["doc_id"] is None for r in rows) == 2
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 3}) == 1
    assert edited_fingerprints(docs.where(F.lit(False))).count() == 0
