"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: insult, threat, target, negation, reporting, other and the
clause's end. Four transducers rewrite the symbols of a clause one after
another: reported speech, negation and target mark the insults and threats they
govern, and the last one gives each marked match a weight. They are composed
into one machine, which runs over each clause; a clause counts by its strongest
match, so an insult denied or quoted weighs less than one aimed at somebody.

The insults are a small fixed list and words learnt from labels: those in at least
``MIN_TOXIC`` toxic texts whose share of toxic texts is beyond chance, the
``MAX_WORDS`` furthest beyond it. The weights of the matches are fitted by
logistic regression, in the order reported, denied, plain, aimed. Both rest on a
sample of about ``SAMPLE`` labelled rows at most.

* null, empty and blank texts have no clause and get the score of a text without matches;
* unlabelled rows and rows that are held out are not learnt from; without labels of both
  kinds the fixed weights hold;
* repeated rows have equal results; further columns change nothing; empty in, empty out.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import small
from rowloom.llm.sampling import bounded_sample, held_out

SAMPLE, MAX_WORDS, MIN_TOXIC, CHANCE = 20_000, 5_000, 4, 6.0
TOKEN = re.compile(r"[^\W_]+|[.,;:!?\n]")
STOPS = frozenset(".,;:!?\n")

#: Words of the grammar in English, German, French and Spanish. Verbs of violence are apart by
#: where their object stands: behind them, or before them as in "dich töten", "te matar".
INSULTS = "idiot idiots moron morons stupid scum loser losers trash clown worthless pathetic disgusting imbecile dumb"
STRIKES = "kill hurt destroy beat töte schlage tue frappe mataré golpearé"
THREATS = "töten umbringen schlagen tuer frapper matar golpear"
TARGETS = "your yours he she they du dein ihr sie tu ton votre tú usted ustedes ellos"
OBJECTS = "you him her them dich euch ihn te toi vous os"
NEGATIONS = "not no never nobody nicht kein keine nie niemals pas jamais aucun aucune nunca jamás ningún ninguna"
REPORTS = "said says wrote writes quoted quotes called sagte schrieb zitierte dit écrit cité dijo escribió citó"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END, STRIKE, OBJECT = range(9)
VIOLENT = (INSULT, THREAT, STRIKE)
#: Marked matches, from the weakest: reported, denied, plain, aimed at somebody; the same for threats.
REPORTED, DENIED, PLAIN, AIMED = 10, 20, 30, 40
MATCHES = [REPORTED, DENIED, PLAIN, AIMED]


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine: (state, symbol) gives (state, symbol); others keep both."""

    arcs: dict[tuple[int, int], tuple[int, int]]

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        return self.arcs.get((state, symbol), (state, symbol))


def _reports() -> Transducer:
    """After a reporting word, insults and threats of the clause are reported."""
    return Transducer({(0, REPORT): (1, OTHER), (1, END): (0, END)} | {(1, x): (1, REPORTED) for x in VIOLENT})


def _denials(reach: int = 3) -> Transducer:
    """A negation governs the next ``reach`` words."""
    arcs = {(s, NEGATION): (reach, OTHER) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        arcs |= {(s, x): (s - 1, x) for x in (OTHER, TARGET, OBJECT, REPORTED)}
        arcs |= {(s, x): (0, DENIED) for x in VIOLENT} | {(s, END): (0, END)}
    return Transducer(arcs)


def _targets(before: int = 4, behind: int = 2) -> Transducer:
    """Insults near a target in the clause are aimed, others plain; violence counts with somebody as its object only.

    A state holds what was seen (nothing, a target, an insult without one), for
    how many words an object still stands before a verb, and for how many a
    verb still waits for its object.
    """
    arcs = {}
    for seen, held, waits in itertools.product(range(3), range(before + 1), range(behind + 1)):
        state = (seen * (before + 1) + held) * (behind + 1) + waits
        for symbol in (*range(9), REPORTED, DENIED):
            now, out, near, open_for = seen, symbol, max(held - 1, 0), max(waits - 1, 0)
            if symbol == END:
                now = near = open_for = 0
            elif symbol in (TARGET, OBJECT):
                out = AIMED if seen == 2 or (symbol == OBJECT and waits) else OTHER
                now = 1
                near, open_for = (before, 0) if symbol == OBJECT else (near, open_for)
            elif symbol == INSULT:
                out, now = (AIMED, 1) if seen == 1 else (PLAIN, 2)
            elif symbol == THREAT:
                out = AIMED if held else OTHER
            elif symbol == STRIKE:
                out, open_for = OTHER, behind
            arcs[state, symbol] = (now * (before + 1) + near) * (behind + 1) + open_for, out
    return Transducer(arcs)


def composed(machines: list[Transducer], symbols: range = range(9)) -> tuple[np.ndarray, np.ndarray]:
    """One machine that does what the machines do one after another: tables of next state and output."""
    start = tuple(0 for _ in machines)
    number, todo, rows = {start: 0}, [start], []
    while todo:
        state, row = todo.pop(0), []
        for symbol in symbols:
            after, out = [], symbol
            for machine, s in zip(machines, state):
                s, out = machine.step(s, out)
                after.append(s)
            key = tuple(after)
            if key not in number:
                number[key] = len(number)
                todo.append(key)
            row.append((number[key], out))
        rows.append(row)
    table = np.array(rows)
    return table[:, :, 0], table[:, :, 1]


@dataclass(frozen=True)
class ToxicityModel:
    words: dict[str, int]
    weights: tuple[float, ...]


def fixed_words() -> dict[str, int]:
    out = {}
    for some, symbol in (
        (TARGETS, TARGET), (OBJECTS, OBJECT), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT), (STRIKES, STRIKE), (INSULTS, INSULT),
    ):
        out |= dict.fromkeys(some.split(), symbol)
    return out


def clause_matches(text: str | None, words: dict[str, int], machine) -> list[int]:
    """Of a text: clauses whose strongest match is reported, denied, plain, aimed; and all clauses."""
    counts = [0, 0, 0, 0, 0]
    tokens = TOKEN.findall((text or "").lower())
    get = words.get
    symbols = [END if t in STOPS else get(t, OTHER) for t in tokens]
    if not any(x in symbols for x in VIOLENT):
        counts[4] = symbols.count(END) + 1
        return counts
    nexts, outs = machine
    state, strongest = 0, 0
    symbols.append(END)
    for symbol in symbols:
        state, out = nexts[state][symbol], outs[state][symbol]
        if symbol == END:
            counts[4] += 1
            if strongest:
                counts[strongest // 10 - 1] += 1
            strongest = 0
        elif out > strongest and out >= REPORTED:
            strongest = out
    return counts


def _machine():
    nexts, outs = composed([_reports(), _denials(), _targets()])
    return nexts.tolist(), outs.tolist()


def _features(counts: np.ndarray) -> np.ndarray:
    """One, then for each kind of match the logarithm of its clauses, then the densest share of clauses with matches."""
    hits = counts[:, :4]
    share = hits[:, 2:].sum(axis=1) / np.maximum(counts[:, 4], 1)
    return np.column_stack([np.ones(len(counts)), np.log1p(hits), np.sqrt(share)])


def _scores(counts: np.ndarray, weights) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_features(counts) @ np.array(weights), -30, 30)))


FIXED_WEIGHTS = (-3.0, 0.5, 0.5, 3.5, 4.0, 2.0)


def fitted(counts: np.ndarray, toxic: np.ndarray, ridge: float = 0.1, sweeps: int = 300) -> tuple[float, ...]:
    """Logistic regression with weights that rise from reported over denied and plain to aimed, none below zero.

    Each kind's weight is the last one's and a step that is not negative, so
    steps are what is fitted, one after another by Newton's method; the ridge
    draws them to those of the fixed weights.
    """
    x = _features(counts)
    x[:, 1:5] = x[:, 4:0:-1].cumsum(axis=1)[:, ::-1]
    prior = np.array(FIXED_WEIGHTS)
    prior[1:5] = np.diff(prior[1:5], prepend=0)
    step, at = prior.copy(), x @ prior
    for _ in range(sweeps):
        largest = 0.0
        for k in range(len(step)):
            p = 1 / (1 + np.exp(-np.clip(at, -30, 30)))
            slope = x[:, k] @ (p - toxic) + ridge * (step[k] - prior[k])
            bend = (x[:, k] ** 2) @ (p * (1 - p)) + ridge
            new = step[k] - np.clip(slope / bend, -2, 2)
            new = new if k == 0 else max(new, 0.0)
            at += x[:, k] * (new - step[k])
            largest, step[k] = max(largest, abs(new - step[k])), new
        if largest < 1e-7:
            break
    return (float(step[0]), *step[1:5].cumsum().tolist(), float(step[5]))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, every = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = {t for t in TOKEN.findall((text or "").lower()) if t not in STOPS}
            every.update(words)
            if label:
                toxic.update(words)
    # Words that are toxic nowhere in this task count in others, so all go on.
    words = list(every)
    columns = [pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()), pa.array([every[w] for w in words], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["word", "toxic", "n"])


def learn_toxicity(rows: DataFrame) -> ToxicityModel:
    """The model of ``rows`` (text, toxic 0/1), at most about ``SAMPLE`` rows."""
    words = fixed_words()
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    n, t = totals["n"], totals["t"] or 0
    if not 0 < t < n:
        return ToxicityModel(words, FIXED_WEIGHTS)
    p = t / n
    seen = rows.select("text", "toxic").mapInArrow(_word_counts, "word string, toxic bigint, n bigint")
    seen = seen.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    beyond = (F.col("toxic") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))
    found = seen.where((F.col("toxic") >= MIN_TOXIC) & (beyond >= CHANCE) & (F.col("toxic") >= 0.8 * F.col("n")))
    learnt = [r["word"] for r in found.orderBy(beyond.desc(), "word").limit(MAX_WORDS).collect()]
    words |= {w: INSULT for w in learnt if words.get(w, INSULT) == INSULT}
    counted = _counted(rows.select("toxic", "text"), words, ["toxic"]).collect()
    counts = np.array([[r["c0"], r["c1"], r["c2"], r["c3"], r["c4"]] for r in counted], float)
    return ToxicityModel(words, fitted(counts, np.array([r["toxic"] for r in counted], float)))


def _counted(rows: DataFrame, words: dict[str, int], keep: list[str]) -> DataFrame:
    def work(batches):
        machine = _machine()
        for batch in batches:
            found = [clause_matches(x, words, machine) for x in batch.column(len(keep)).to_pylist()]
            columns = [pa.array([r[i] for r in found], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], names=[*keep, "c0", "c1", "c2", "c3", "c4"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "text").mapInArrow(work, kinds + "".join(f", c{i} bigint" for i in range(5)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the ``score`` of every text."""

    def work(batches):
        machine = _machine()
        for batch in batches:
            found = np.array([clause_matches(x, model.words, machine) for x in batch.column(len(keep)).to_pylist()], float)
            scores = _scores(found.reshape(-1, 5), model.weights)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(scores)], names=[*(f"k{i}" for i in range(len(keep))), "score"])

    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    read = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").alias("t"))
    out = read.mapInArrow(work, f"{kinds}score double")
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "score")


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """``text`` and ``toxic`` of about ``bound`` labelled rows at most, none of them held out."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    some = bounded_sample(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", bound)
    return docs.select("doc_id", "text").join(small(some), "doc_id").select("text", "toxic")


def held_out_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model of labelled rows that are not held out."""
    model = learn_toxicity(labelled_sample(docs, labels))
    marked = docs.withColumn("held_out", held_out(F.col("doc_id")))
    scored = score_toxicity(marked, model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
