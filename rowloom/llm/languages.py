"""Language identification: script ranges, per-word scores, Viterbi with a switching penalty.

A word's script, told by the ranges of its characters, leaves only languages
that use the script. Each word then has a score per language, the sum of the
log probabilities of its byte trigrams with borders. Viterbi over the words,
with a penalty for each change of language, labels the spans of mixed texts; the
language with most bytes in its spans is the text's, its share the score.

Trigram counts and scripts come from a sample of about ``SAMPLE`` documents a
language at most. Texts are read whole. Texts of over ``BLOCK`` words are worked
out in blocks of ``PART`` at the same time, once for each language that the word before a
block may have, and the blocks are chained: the best path is that of one run
over the whole text.

* a null text or one without a letter is ``und`` with score 0;
* a script that no language uses leaves all languages open;
* documents without a language are not learnt from; if there are none to learn
  from, every text is ``und``;
* null keys, repeated rows and further columns change nothing; empty in, empty out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.sampling import bounded_sample, held_out

SAMPLE = 4000
CELLS = 1 << 16
BLOCK = 4096
#: Words in a block of a longer text.
PART = 64
CHUNK = 4 << 20
SWITCH = 8.0
LETTER = re.compile(r"[^\W\d_]")

#: First bytes of UTF-8 characters by script: Latin, Greek, Cyrillic, Armenian and Hebrew, Arabic,
#: South Asian and Thai, further Asian, kana, Han, Hangul. 0: no letter, or inside a character.
RANGES = [
    (0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xC3, 0xCA, 1), (0xCD, 0xCF, 2), (0xD0, 0xD3, 3), (0xD4, 0xD7, 4),
    (0xD8, 0xDD, 5), (0xE0, 0xE0, 6), (0xE1, 0xE1, 7), (0xE3, 0xE3, 8), (0xE4, 0xE9, 9), (0xEA, 0xED, 10),
]
SCRIPTS = 11
SCRIPT = np.zeros(256, np.uint8)
for _low, _high, _script in RANGES:
    SCRIPT[_low : _high + 1] = _script


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    table: np.ndarray  # log probability of each trigram cell by language
    uses: np.ndarray  # script by language


def _words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def _cells(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram cells of all words in a row, each word's first cell, and each word's script."""
    data = np.frombuffer(b" " + b" ".join(words) + b"  ", np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    wide = data.astype(np.uint32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    cells = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    script = np.maximum.reduceat(SCRIPT[data[1:-1]], starts)
    return cells, starts, script


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, cell) and, beyond CELLS, of (language, script)."""
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = _words(text)
            for at in range(0, len(words), 100_000):
                cells, _, script = _cells(words[at : at + 100_000])
                counts = seen.setdefault(lang, np.zeros(CELLS + SCRIPTS, np.int64))
                counts[:CELLS] += np.bincount(cells, minlength=CELLS)
                counts[CELLS:] += np.bincount(script, minlength=SCRIPTS)
    for lang, counts in seen.items():
        at = np.nonzero(counts)[0]
        columns = [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "cell", "n"])


def learn_languages(rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """The model; at most ``CELLS`` counts a language come to the driver."""
    known = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(key, F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    some = bounded_sample(known, key, sample, by="lang")
    counts = some.select("lang", "text").mapInArrow(_counted, "lang string, cell int, n bigint")
    found = counts.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(found["lang"].unique())
    at = found["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(dtype=np.int64)
    full = np.zeros((CELLS + SCRIPTS, len(names)))
    full[found["cell"].to_numpy(dtype=np.int64), at] = found["n"].to_numpy()
    cells, scripts = full[:CELLS], full[CELLS:]
    table = np.log((cells + 0.1) / (cells.sum(axis=0) + 0.1 * CELLS)) if names else cells
    table = table - table.mean(axis=1, keepdims=True) if names else table
    uses = scripts >= 0.01 * scripts[1:].sum(axis=0)
    return LanguageModel(names, table.astype(np.float32), uses)


def viterbi(
    scores: np.ndarray,
    starts: np.ndarray,
    sizes: np.ndarray,
    penalty: float,
    entry: np.ndarray | None = None,
    ends: np.ndarray | None = None,
    values: bool = False,
) -> np.ndarray:
    """The best language of every word; rows of words begin at ``starts`` and go on for ``sizes``.

    ``entry``: what each row's languages are worth before its first word; ``ends``: the languages that the rows
    end in. With ``values``, what the best paths to each last language are worth instead of the labels.
    """
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    state = np.zeros((len(order), scores.shape[1]), np.float32) if entry is None else entry[order].astype(np.float32)
    label = np.zeros(len(scores), np.uint8 if scores.shape[1] < 256 else np.int32)
    back, steps = [], int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    for t in range(steps):
        now = state[: active[t]]
        best = now.argmax(axis=1)
        other = now[np.arange(len(now)), best][:, None] - penalty
        switch = other > now
        if not values:
            back.append((switch, best))
        state[: active[t]] = np.where(switch, other, now) + scores[starts[: active[t]] + t]
    if values:
        out = np.empty_like(state)
        out[order] = state
        return out
    last = state.argmax(axis=1) if ends is None else ends[order]
    for t in reversed(range(steps)):
        k = active[t]
        at = last[:k]
        label[starts[:k] + t] = at
        switch, best = back[t]
        last[:k] = np.where(switch[np.arange(k), at], best, at)
    return label


def viterbi_in_blocks(scores: np.ndarray, penalty: float, block: int) -> np.ndarray:
    """The best languages of one text's words, worked out for blocks of words that are then chained."""
    n, langs = scores.shape
    starts = np.arange(0, n, block)
    sizes = np.minimum(block, n - starts)
    only = np.where(np.eye(langs, dtype=bool), 0, -1e30).astype(np.float32)
    each = np.repeat(starts, langs), np.repeat(sizes, langs)
    worth = viterbi(scores, *each, penalty, np.tile(only, (len(starts), 1)), values=True).reshape(-1, langs, langs)
    total, before = np.zeros(langs), []
    for step in worth.astype(np.float64):
        through = total[:, None] + step
        before.append(through.argmax(axis=0))
        total = through.max(axis=0)
    ends = np.empty(len(starts) + 1, np.int64)
    ends[-1] = total.argmax()
    for k in reversed(range(len(starts))):
        ends[k] = before[k][ends[k + 1]]
    return viterbi(scores, starts, sizes, penalty, only[ends[:-1]], ends[1:])


def label_words(words: list[bytes], rows: np.ndarray, model: LanguageModel, penalty: float = SWITCH) -> np.ndarray:
    """Languages of words; ``rows``: the number of words in each text."""
    cells, starts, script = _cells(words)
    scores = np.empty((len(words), len(model.names)), np.float32)
    for at in range(0, len(words), 200_000):
        to = min(at + 200_000, len(words))
        end = starts[to] if to < len(words) else len(cells)
        scores[at:to] = np.add.reduceat(model.table[cells[starts[at] : end]], starts[at:to] - starts[at])
    allowed = model.uses[script]
    open_to_all = (script == 0) | ~allowed.any(axis=1)
    scores[script == 0] = 0
    scores[~(allowed | open_to_all[:, None])] -= 20.0
    first = np.cumsum(rows) - rows
    short = rows <= BLOCK
    labels = viterbi(scores, first[short], rows[short], penalty)
    for at, n in zip(first[~short], rows[~short]):
        labels[at : at + n] = viterbi_in_blocks(scores[at : at + n], penalty, PART)
    return labels


def _labelled(texts: list[str], model: LanguageModel) -> tuple[list[str], list[float]]:
    names, scores = ["und"] * len(texts), [0.0] * len(texts)

    def flush(owner, words, sizes):
        labels = label_words(words, np.array(sizes), model)
        weight = np.fromiter(map(len, words), np.int64, len(words))
        at = np.repeat(np.arange(len(owner)), sizes)
        share = np.bincount(at * len(model.names) + labels, weight, len(owner) * len(model.names)).reshape(len(owner), -1)
        best = share.argmax(axis=1)
        for k, i in enumerate(owner):
            names[i] = model.names[best[k]]
            scores[i] = float(share[k, best[k]] / share[k].sum())

    owner, words, sizes, held = [], [], [], 0
    for i, text in enumerate(texts):
        if not text or not model.names or not LETTER.search(text):
            continue
        some = _words(text)
        owner.append(i), sizes.append(len(some))
        words += some
        held += len(text)
        if held > CHUNK:
            flush(owner, words, sizes)
            owner, words, sizes, held = [], [], [], 0
    if owner:
        flush(owner, words, sizes)
    return names, scores


def predict_languages(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep``, ``lang_pred`` and ``score`` of every row."""

    def predicted(batches):
        for batch in batches:
            names, scores = _labelled(batch.column(len(keep)).to_pylist(), model)
            columns = [*batch.columns[: len(keep)], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f"k{i}" for i in range(len(keep))), "lang_pred", "score"])

    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    read = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").alias("t"))
    out = read.mapInArrow(predicted, f"{kinds}lang_pred string, score double")
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "lang_pred", "score")


def held_out_languages(docs: DataFrame) -> DataFrame:
    """Predictions for all documents by a model of those that are not held out."""
    marked = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = learn_languages(marked.where("not held_out"))
    return predict_languages(marked, model, ["doc_id", "held_out"])
