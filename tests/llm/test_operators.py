"""Each operator against brute force on a small table with nulls, empty and long texts, copies and odd columns."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from rowloom.llm import queries as Q
from rowloom.llm.components import connected_components
from rowloom.llm.languages import held_out_languages, viterbi, viterbi_in_blocks
from rowloom.llm.packing import GAP, best_fit, best_pattern, configuration_program, packed, packing_plan, program_plan
from rowloom.llm.pieces import PieceModel, encoded, piece_digests
from rowloom.llm.quality import BASE, quality_rules
from rowloom.llm.repeats import without_repeats
from rowloom.llm.sanitise import KINDS, Disclosure, personal_spans, sanitised, span_text
from rowloom.llm.sharding import extendible_shards
from rowloom.llm.simhash import BLOCKS, first_of_components, forest, simhash_components
from rowloom.llm.syncmers import edited_fingerprints
from rowloom.llm.toxicity import composed, fitted, held_out_toxicity
from rowloom.llm.toxicity import _denials, _machine, _reports, _targets, clause_matches, fixed_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, piece string, d2 string, spans string"


def _texts():
    rng = np.random.default_rng(7)
    syllables = {"en": ["the", "ing", "on", "er", "th"], "de": ["sch", "ung", "ein", "ß", "ch"], "es": ["ción", "ado", "ñ", "la", "os"]}

    def prose(lang, n):
        words = ["".join(rng.choice(syllables[lang], rng.integers(1, 4))) for _ in range(n)]
        return " ".join(words) + "."

    rows = []
    for i in range(60):
        lang = ["en", "de", "es"][i % 3]
        rows.append((prose(lang, int(rng.integers(60, 200))), lang))
    rows.append((rows[0][0], "en"))
    rows.append((rows[0][0].replace("the", "xyz", 1), "en"))
    rows += [(rows[3][0][:600] + " " + rows[4][0][:700], None), (None, "en"), ("", None), (" \n\t ", "de"), ("?!", "es")]
    rows += [(prose("en", 12_000), "en"), ("日本語" * 300, None), ("a b a b a b " * 30, "en")]
    rows += [("call +1 (555) 123-4567 or me@x.org.de 10.0.0.256 4111 1111-1111 1111 é 9.8.7.6", "en")]
    return rows


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    out = [(i, t, lang, f"s{i % 2}" if i % 7 else None, 1, "x", "y", "z") for i, (t, lang) in enumerate(texts)]
    return [*out, out[5]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding(docs, none, rows, spark):
    size = F.octet_length("text")
    found = extendible_shards(docs, ["doc_id"], size, 3000).collect()
    assert len(found) == len(rows)
    held = Counter()
    for r in found:
        held[r["shard"]] += r["n_bytes"]
    for r in found:
        assert held[r["shard"]] == r["shard_bytes"] and (r["shard_bytes"] <= 3000 or r["shard_rows"] == 1)
    shards = sorted(held)
    assert not any(b.startswith(a) for a, b in itertools.pairwise(shards))
    # A shard's sibling and it were one bucket over the limit.
    for s in shards:
        if s:
            assert sum(v for k, v in held.items() if k.startswith(s[:-1])) > 3000
    hot = spark.range(900).select(F.when(F.col("id") < 300, F.lit(None)).otherwise(F.col("id")).alias("k"), F.lit(10).alias("b"))
    assert extendible_shards(hot, ["k"], F.col("b"), 100).agg(F.max("shard_bytes")).first()[0] <= 100
    assert extendible_shards(none, ["doc_id"], size, 3000).count() == 0


def _simhash(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(values, near):
    parent = list(range(len(values)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(values)), 2):
        if near(values[i], values[j]):
            a, b = sorted((top(i), top(j)))
            parent[b] = a
    return [top(i) for i in range(len(values))]


def test_simhash(docs, none, rows):
    found = {r["doc_id"]: r for r in simhash_components(docs).collect()}
    prints = [_simhash(r[1]) for r in rows]
    assert all(found[r[0]]["fp"] % 2**64 == p for r, p in zip(rows, prints))
    tops = _components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    assert all(found[r[0]]["component_id"] == rows[t][0] for r, t in zip(rows, tops))
    kept = first_of_components(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({rows[t][0] for t in tops})
    assert simhash_components(none).count() == first_of_components(none).count() == 0


def test_simhash_lists(monkeypatch, spark):
    for bad in itertools.combinations(range(8), 3):
        assert any(not set(bad) & set(b) for b in BLOCKS)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 4, dtype=np.uint64)
    values = np.unique([int(b) ^ sum(1 << int(x) for x in rng.choice(64, 3)) for b in base for _ in range(60)]).astype(np.uint64)
    tops = _components(values.tolist(), lambda a, b: (a ^ b).bit_count() <= 3)
    a, b = forest(values)
    assert np.all(np.bitwise_count(a ^ b) <= 3) and len(a) == len(values) - len(set(tops))
    # Long lists are cut up without losing a component.
    from rowloom.llm import simhash

    monkeypatch.setattr(simhash, "MAX_LIST", 8)
    classes = spark.createDataFrame([(int(v.astype(np.int64)),) for v in values], "fp bigint")
    roots = connected_components(simhash.fingerprint_links(classes)).collect()
    name = {r["node"] % 2**64: r["root"] for r in roots}
    groups = {}
    for v, t in zip(values.tolist(), tops):
        groups.setdefault(t, set()).add(name.get(v, v))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert len({roots[i] for i in range(201)}) == 1 and roots[500] == roots[501] != roots[0]


def test_quality(docs, none, rows):
    found = {r["doc_id"]: r for r in quality_rules(docs, keep_text=True).collect()}
    for i, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
        assert tuple(found[i][c] for c in BASE) == expected
        assert found[i]["base_failed"] == (len(words) < 50 or 100 * len(again) > 50 * len(words))
        assert not (found[i]["base_failed"] and found[i]["kept"])
    assert found[0]["kept"] and found[0]["text"] == rows[0][1]
    assert quality_rules(none).count() == 0


def test_outliers_are_rejected(spark):
    rng = np.random.default_rng(3)
    make = lambda mark: " ".join("".join(rng.choice(list("abcdef"), 5)) + mark for _ in range(120))
    rows = [(i, make("#$" if i % 10 == 0 else ""), "en", "s", 0) for i in range(300)]
    found = quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    assert all(r["kept"] == (r["doc_id"] % 10 != 0) for r in found.collect())


def test_packing(docs, none, rows):
    from tokenizers import Tokenizer

    found = packed(docs, Q.WORDS_49K, ["doc_id"], capacity=256).collect()
    tokenizer = Tokenizer.from_file(Q.WORDS_49K)
    expected = Counter()
    for i, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for p, at in enumerate(range(0, len(ids), 256)):
            expected[i, p, at, len(ids[at : at + 256]), zlib.crc32(ids[at : at + 256].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    ends = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 256 and len(ends) <= 1.1 * sum(ends.values()) / 256 + 1
    assert packed(none, Q.WORDS_49K, ["doc_id"]).count() == 0


def test_packing_plan():
    rng = np.random.default_rng(0)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 101, 3000), return_counts=True))}
    plan = packing_plan(histogram, 100)
    used = Counter()
    for pattern, n in plan:
        assert sum(pattern) <= 100 and n > 0
        for length in pattern:
            used[length] += n
    assert used == Counter(histogram)
    bound = max(-(-sum(k * v for k, v in histogram.items()) // 100), sum(v for k, v in histogram.items() if k > 50))
    assert sum(n for _, n in plan) <= 1.03 * bound
    assert sum(best_fit([60, 40, 30], [2, 2, 1], 100).values()) == 3
    lengths, value = np.array([3, 5, 7]), np.array([1.0, 2.0, 2.9])
    best = max(sum(value[list(c)]) for n in range(5) for c in itertools.combinations_with_replacement(range(3), n) if lengths[list(c)].sum() <= 13)
    assert np.isclose(value[best_pattern(lengths, value, 13)].sum(), best)


def test_configuration_program():
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(1, 2048, 4000), rng.integers(1, 400, 4000)])
    histogram = {int(k): 25 * int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
    placed, rest, program = program_plan(histogram, 2048)
    assert program.gap <= GAP
    assert sum(rest.values()) <= 0.25 * sum(histogram.values())
    alone = sum(best_fit(list(histogram), list(histogram.values()), 2048).values())
    assert sum(n for _, n in packing_plan(histogram, 2048)) <= 1.001 * alone + 1
    # The fractional solution covers all demand with patterns that fit, and its bound is below any covering.
    sizes, demand = np.array([3, 5, 7]), np.array([40.0, 30.0, 20.0])
    small = configuration_program(sizes, demand, 13)
    assert all(sizes[list(p)].sum() <= 13 for p in small.patterns) and 0 <= small.gap <= GAP
    covered = sum(x * np.bincount(p, minlength=3) for p, x in zip(small.patterns, small.use))
    assert np.all(covered >= demand * (1 - 1e-9)) and small.bound >= sizes @ demand / 13 - 1e-9
    assert program_plan({}, 2048)[2] is None and packing_plan({2048: 3}, 2048) == [((2048,), 3)]


def test_samples(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 200 == 0, "rare").otherwise("often").alias("kind"))
    from rowloom.llm.sampling import bounded_sample

    assert bounded_sample(rows, "id", 20_000).count() == 20_000
    assert 800 < bounded_sample(rows, "id", 1000).count() < 1200
    sizes = {r["kind"]: r["count"] for r in bounded_sample(rows, "id", 1000, by="kind").groupBy("kind").count().collect()}
    assert sizes["rare"] == 100 and 800 < sizes["often"] < 1200
    assert bounded_sample(rows.limit(0), "id", 5, by="kind").count() == 0


def test_quality_counts_when_hashes_collide(docs, rows, monkeypatch):
    from rowloom.llm import quality

    expected = {r["doc_id"]: r["n_repeat_words"] for r in quality.text_statistics(docs.where("doc_id < 100")).collect()}
    monkeypatch.setattr(quality, "PLACE_BITS", (60, 60))  # four bits of hash are left
    found = {r["doc_id"]: r["n_repeat_words"] for r in quality.text_statistics(docs.where("doc_id < 100")).collect()}
    assert found == expected and max(found.values()) > 50


def test_syncmers(docs, none, rows, monkeypatch):
    from rowloom.llm import syncmers

    monkeypatch.setattr(syncmers, "BUCKET_BYTES", 3000)
    found = {r["doc_id"]: r for r in edited_fingerprints(docs).collect()}
    order = sorted((r[0], r[1] or "") for r in rows)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        q = len(text) // 4
        if i != 5:
            digest = hashlib.sha256((text[: len(text) - q] + following[:q]).encode()).hexdigest()
            assert found[i]["edited_sha256"] == digest and found[i]["n_chars"] == len(text)
    assert found[0]["fingerprint"] == found[60]["fingerprint"] and found[63]["fingerprint"] == ""
    long = [found[i] for i in range(60) if i != 5]
    assert all(r["near_edited"] > 0.15 > r["near_next"] for r in long)
    assert np.mean([r["near_edited"] for r in long]) > 0.45
    assert edited_fingerprints(none).count() == 0


def test_languages(docs, none, spark):
    more = docs.select("doc_id", "text", "lang").unionByName(docs.where("doc_id < 60").select(F.col("doc_id") + 1000, "text", "lang").toDF("doc_id", "text", "lang"))
    found = {r["doc_id"]: r for r in held_out_languages(more).collect()}
    assert all(found[i]["lang_pred"] == ["en", "de", "es"][i % 3] for i in range(60) if found[i]["held_out"])
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (63, 64, 65, 66))
    assert found[68]["lang_pred"] != "und" and all(0 <= r["score"] <= 1 for r in found.values())
    assert held_out_languages(none).count() == 0
    scores = np.random.default_rng(0).normal(size=(13, 3)).astype(np.float32) * 3
    labels = viterbi(scores, np.array([0, 6]), np.array([6, 7]), 2.0)

    def value(path, at):
        return sum(scores[at + i, x] for i, x in enumerate(path)) - 2.0 * sum(a != b for a, b in itertools.pairwise(path))

    for at, n in ((0, 6), (6, 7)):
        best = max(itertools.product(range(3), repeat=n), key=lambda p: value(p, at))
        assert labels[at : at + n].tolist() == list(best)


def test_languages_of_long_texts_are_those_of_one_run():
    rng = np.random.default_rng(1)
    for n, langs, block in ((1, 2, 4), (9, 3, 4), (400, 4, 16), (401, 5, 16), (640, 2, 1), (100_000, 4, 4096)):
        # A language for some time, then another, so that paths have reason to keep a weak language over borders.
        true = np.repeat(rng.integers(0, langs, n // 7 + 1), 7)[:n]
        scores = (rng.normal(size=(n, langs)) * 2 + 1.2 * (np.arange(langs) == true[:, None])).astype(np.float32)
        whole = viterbi(scores, np.array([0]), np.array([n]), 4.0)
        parts = viterbi_in_blocks(scores, 4.0, block)
        value = lambda x: scores.astype(float)[np.arange(n), x].sum() - 4.0 * (np.diff(x.astype(int)) != 0).sum()
        assert value(parts) == pytest.approx(value(whole), rel=1e-4) and (parts == whole).mean() > 0.99


def test_toxicity(docs, none, spark):
    machine, words = _machine(), fixed_words()
    count = lambda text: clause_matches(text, words, machine)
    assert count("You are an idiot. Fine day.")[:4] == [0, 0, 0, 1]
    assert count("The idiot sleeps")[:4] == [0, 0, 1, 0]
    assert count("She is not an idiot")[:4] == [0, 1, 0, 0]
    assert count("He said idiot, twice")[:4] == [1, 0, 0, 0]
    assert count("I will kill time")[:4] == count("they kill")[:4] == [0, 0, 0, 0]
    for fine in ("Sie liest die Zeitung", "She beat the eggs", "Er schlägt die Eier", "Tu vas tuer le temps", "Ella va a matar el tiempo"):
        assert count(fine)[:4] == [0, 0, 0, 0], fine
    for meant in ("I will kill you", "They beat him", "Ich werde dich töten", "Je vais te tuer", "Te voy a matar"):
        assert count(meant)[:4] == [0, 0, 0, 1], meant
    assert count("He said he will kill you")[:4] == [1, 0, 0, 0] and count("I will not kill you")[:4] == [0, 1, 0, 0]
    assert count(None)[:4] == count("")[:4] == [0, 0, 0, 0]
    # The composed machine does what the machines do in turn.
    nexts, outs = composed([_reports(), _denials(), _targets()])
    for symbols in itertools.product(range(9), repeat=4):
        state, states = 0, [0, 0, 0]
        for x in symbols:
            out = x
            for k, m in enumerate((_reports(), _denials(), _targets())):
                states[k], out = m.step(states[k], out)
            assert outs[state, x] == out
            state = nexts[state, x]
    # Labels that turn the grammar round do not turn the weights round.
    counts = np.array([[0, 0, 1, 0, 3], [0, 0, 0, 1, 3], [1, 0, 0, 0, 3], [0, 0, 0, 0, 3]] * 20, float)
    weights = fitted(counts, np.array([1, 0, 1, 0] * 20, float))
    assert 0 <= weights[1] <= weights[2] <= weights[3] <= weights[4] and weights[5] >= 0
    texts = [(i, f"word{i} grumblefrump you {i}" if i % 3 == 0 else f"word{i} lovely {i}") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i, _ in texts], "doc_id bigint, toxic int, quality int")
    found = held_out_toxicity(spark.createDataFrame([*texts, (900, None), (901, "")], "doc_id bigint, text string"), labels).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in found if r["doc_id"] < 900)
    assert all(0 <= r["score"] < 0.5 for r in found if r["doc_id"] >= 900)
    assert held_out_toxicity(none, labels.limit(0)).count() == 0


def test_pieces(docs, none, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=Q.PIECES_32K)
    model = PieceModel(Q.PIECES_32K)
    odd = ["", " ", "\n\n x", "a  b   c ", "日本語 한국어", "<s> </s>", "== --- \t\t x", "é́ 𝔘𝔫𝔦", "word" * 500, "x" * 3000]
    for text in [*odd, *(r[1] or "" for r in rows[:70])]:
        ids = model.encode(text.encode())
        assert ids.tolist() == library.encode(text) and model.decode(ids) == text.encode()
    found = piece_digests(docs, Q.PIECES_32K, ["doc_id"]).collect()
    assert len(found) == len(rows) and all(r["round_trip"] for r in found)
    assert encoded(docs.limit(2), Q.PIECES_32K, out="piece").columns[-1] == "piece"
    assert piece_digests(none, Q.PIECES_32K, ["doc_id"]).count() == 0


def _repeats(bodies, length):
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(x for x, y in zip(b, gone) if not y)
        runs = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize(("limit", "least_hot"), [(16384, 1000), (16384, 1), (1, 1)])
def test_repeats(docs, none, rows, monkeypatch, limit, least_hot):
    from rowloom.llm import common, repeats

    monkeypatch.setattr(repeats, "MAX_SEGMENTS", limit)
    monkeypatch.setattr(common, "LEAST_HOT", least_hot)  # 1: every repeated key is dealt over parts
    small = docs.where("octet_length(text) < 8000 or text is null")
    mine = [r for r in rows if len((r[1] or "").encode()) < 8000]
    expected = {r[0]: x for r, x in zip(mine, _repeats([(r[1] or "").encode() for r in mine], 400))}
    found = without_repeats(small).collect()
    assert len(found) == len(mine)
    for r in found:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == expected[r["doc_id"]]
    assert sum(x[1] for x in expected.values()) > 2000
    assert without_repeats(none).count() == 0


@pytest.mark.parametrize("size", [330, 399, 400, 520])
def test_repeated_passages_go_by_their_bytes(spark, size):
    from rowloom.llm.repeats import BLOCK

    rng = np.random.default_rng(size)

    def prose(n):
        letters = rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n)
        letters[5::6] = " "
        return "".join(letters)

    passage, gone = prose(size), size if size >= 400 else 0
    assert len(passage.split()) > 50
    # The last starts at the last byte of a block of ``anchors``. Digits beside the copies end what is common.
    texts = [prose(n) + f"{i}{passage}{i}" + prose(300) for i, n in enumerate([200, 0, 700, BLOCK - 2])] + [prose(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in without_repeats(docs).collect()}
    for i, text in enumerate(texts):
        left = text.replace(passage, "") if gone else text
        assert found[i] == (len(text), len(text) - len(left), int(left != text), hashlib.sha256(left.encode()).hexdigest())
    assert [found[i][1] for i in range(5)] == [gone] * 4 + [0]


def _base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(d))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_personal_data(docs, none, rows, spark):
    odd = ["a@b.c_d@e.f.g", "x+1 (555) 123-4567 a@b.c@d.e", "1.2.3.4.5.6.7.8 999.1.1.1.2", "é@ü.de é+49 30 1234567", "+1+12345678901", "a" * 3000 + "@"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string")
    found = personal_spans(docs.select("doc_id", "text").unionByName(more)).select("doc_id", span_text(F.col("base")).alias("b")).collect()
    texts = {r[0]: r[1] or "" for r in rows} | {1000 + i: t for i, t in enumerate(odd)}
    assert len(found) == len(rows) + len(odd) and all(r["b"] == _base(texts[r["doc_id"]]) for r in found)
    told = [(i, f"Zorblax number {i} mailed to boss@corp.example today") for i in range(5)] + [(9 + i, f"today number {i} mailed to all") for i in range(60)]
    out = personal_spans(spark.createDataFrame(told, "doc_id bigint, text string"), Disclosure(), keep_text=True)
    clean = {r["doc_id"]: r["c"] for r in out.select("doc_id", sanitised(F.col("text"), F.col("spans")).alias("c")).collect()}
    assert clean[0] == " number 0 mailed to [EMAIL] today" and clean[20] == told[16][1]
    assert personal_spans(none).count() == 0


def test_pipeline(docs, none, spark):
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5
    now, empty = docs, none
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now, empty = corpus_pipeline.stored(stage(spark, now, "")), stage(spark, empty, "")
        assert now.columns == docs.columns and dict(now.dtypes) == dict(docs.dtypes)
    assert empty.count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, now, "").collect()
    ids = {r["doc_id"] for r in last}
    assert ids == {r["doc_id"] for r in now.collect()} and 0 in ids and 60 not in ids and 63 not in ids


def test_new_stretches_share_the_lattice_of_their_front(monkeypatch):
    model, front, places = PieceModel(Q.PIECES_32K), "unverifiabilitiesundone", []
    extend = PieceModel._extend

    def seen(self, text, end, upto, done, last):
        places.append(upto - end)
        return extend(self, text, end, upto, done, last)

    monkeypatch.setattr(PieceModel, "_extend", seen)
    words = [front + a + b for a in "stuvwxyzabc" for b in "étaoin"]
    texts = [" ".join(words).encode(), b"", ("ab " + "x" * 700 + " \n  é▁\U0001F600 ").encode(), b"  ", words[5].encode(), b"a b " * 400_000]
    got = list(model.texts(texts))
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=Q.PIECES_32K)
    assert [x.tolist() for x in got] == [library.encode(t.decode()) for t in texts]
    assert sum(n for n in places if n < 100) < 0.3 * sum(map(len, words))


@pytest.mark.parametrize("lines", [True, False])
def test_new_words_go_to_the_tokenizer_in_lines(monkeypatch, lines):
    from rowloom.llm.tokens import WordTokens

    words = WordTokens(Q.WORDS_49K)
    assert words.lines
    alone, single = [], WordTokens._single
    monkeypatch.setattr(WordTokens, "_single", lambda self, some: alone.extend(some) or single(self, some))
    words.lines = lines
    made = [f"W{chr(97 + i // 26)}{chr(97 + i % 26)}é" for i in range(600)]
    texts = [" ".join(f"{w}, {w.lower()}. {w} don't" for w in made), "", "10 İx ½ <|endoftext|> a.. ., Ǆ ΑΣ Σ é 한국 ㎏", "́a   ab.c\n x y"]
    got = [ids.tolist() for _, ids in words.texts([t.encode() for t in texts])]
    assert got == [[*x.ids, 0] for x in words.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert (len(alone) < 20) is lines
