"""Fill-in-middle texts with cuts found by a learned rank index.

A text's tokens are runs of white space with the run of other characters behind
them. Two token numbers drawn from the document's key cut it into prefix, middle
and suffix, and the parts are put out with marks, suffix first (spm) or prefix
first (psm). Where a token ends is looked up in an index over all token ends of
the texts at hand: straight lines with a bounded error guess the place from the
rank, and a residual of one byte for every rank corrects the guess exactly. Lines
are fitted to stretches of ``SPAN`` ranks, and a stretch in which some rank is
further off than the bound is halved until none is.

* null and empty texts are empty and plain; a text that holds a mark is plain;
* a null key draws as an empty one; repeated rows have equal results;
* long texts take memory in proportion to the longest one, and some texts are
  handled at a time; other columns of any name pass through; empty in, empty out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of text that share an index, and ranks that a line is first tried on.
BLOCK = 1 << 20
SPAN = 4096
#: Greatest residual; it fits a byte.
ERROR = 127
MARKS = ("<P>", "<S>", "<M>")


class RankIndex:
    """The places of ascending boundaries by rank: lines with a bounded error, and a residual a rank."""

    def __init__(self, places: np.ndarray, span: int = SPAN, error: int = ERROR):
        self.residual = np.zeros(len(places), np.int8)
        first = np.arange(0, len(places), span)
        last = np.minimum(first + span, len(places)) - 1
        lines = []
        while len(first):
            slope = (places[last] - places[first]) / np.maximum(last - first, 1)
            size = last - first + 1
            at = np.cumsum(size) - size
            inside = np.arange(size.sum()) - np.repeat(at, size)
            off = places[np.repeat(first, size) + inside] - self._line(np.repeat(places[first], size), np.repeat(slope, size), inside)
            good = np.maximum.reduceat(np.abs(off), at) <= error
            kept = np.repeat(good, size)
            self.residual[(np.repeat(first, size) + inside)[kept]] = off[kept]
            lines.append((first[good], places[first[good]], slope[good]))
            first, last = first[~good], last[~good]
            middle = (first + last) // 2
            first, last = np.concatenate([first, middle + 1]), np.concatenate([middle, last])
        parts = [np.concatenate(x) for x in zip(*lines)] if lines else [np.zeros(0, np.int64)] * 3
        order = np.argsort(parts[0])
        self.first, self.place, self.slope = (x[order] for x in parts)

    @staticmethod
    def _line(place: np.ndarray, slope: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return place + np.floor(slope * inside).astype(np.int64)

    def __getitem__(self, rank: np.ndarray) -> np.ndarray:
        line = np.searchsorted(self.first, rank, side="right") - 1
        return self._line(self.place[line], self.slope[line], rank - self.first[line]) + self.residual[rank]


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token boundaries of the texts laid end to end, each text's start first, and how many tokens each has."""
    size = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    ends = np.zeros(len(points), bool)
    ends[:-1] = ~blank[:-1] & blank[1:]
    stop = np.cumsum(size)
    ends[stop[size > 0] - 1] = True
    place = np.flatnonzero(ends) + 1
    upto = np.searchsorted(place, stop, side="right")
    tokens = np.diff(upto, prepend=0)
    out = np.empty(len(place) + len(texts), np.int64)
    starts = upto - tokens + np.arange(len(texts))
    is_start = np.zeros(len(out), bool)
    is_start[starts] = True
    out[starts], out[~is_start] = stop - size, place
    return out, tokens


def draws(key: str) -> list[int]:
    digest = hashlib.sha256(key.encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def rearranged(keys: list[str], texts: list[str], share: int, suffix_first: int, marks: tuple[str, str, str]):
    """(tokens, form, characters of the prefix, of the middle, output) of every text."""
    places, tokens = boundaries(texts)
    index = RankIndex(places)
    start = np.cumsum(tokens + 1) - tokens - 1
    drawn = [draws(k) for k in keys]
    cuts = np.sort(np.array([d[:2] for d in drawn]).reshape(-1, 2) % (tokens + 1)[:, None], axis=1)
    at = index[start[:, None] + cuts] - places[start][:, None]
    p, s, m = marks
    for n, text, (_, _, h3, h4), (a, b) in zip(tokens.tolist(), texts, drawn, at.tolist()):
        if not text or h3 % 100 >= share or any(x in text for x in marks):
            yield n, "plain", None, None, text
        elif h4 % 100 < suffix_first:
            yield n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
        else:
            yield n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def _blocks(keys: list[str], texts: Iterator[str], size: int) -> Iterator[tuple[list[str], list[str]]]:
    some, held, first = [], 0, 0
    for i, text in enumerate(texts):
        some.append(text)
        held += len(text)
        if held >= size:
            yield keys[first : i + 1], some
            some, held, first = [], 0, i + 1
    if some:
        yield keys[first:], some


def _work(batches: Iterator[pa.RecordBatch], share: int, suffix_first: int, marks) -> Iterator[pa.RecordBatch]:
    kinds = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()
    for batch in batches:
        keys = batch.column(batch.num_columns - 2).to_pylist()
        bodies = ((x.as_py() or b"").decode("utf-8", "replace") for x in batch.columns[-1].cast(pa.binary()))
        parts, done = batch.columns[:-2], 0
        for some, texts in _blocks(keys, bodies, BLOCK):
            rows = list(zip(*rearranged(some, texts, share, suffix_first, marks)))
            own = [c.slice(done, len(some)) for c in parts]
            columns = [*own, *(pa.array(v, k) for v, k in zip(rows, kinds))]
            names = [*batch.schema.names[:-2], "n", "form", "prefix_chars", "middle_chars", "output"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            done += len(some)


def _checked(marks) -> tuple[str, str, str]:
    if len(set(marks)) != 3 or len({m[:1] for m in marks}) != 1 or any(m[:1] in m[1:] or not m for m in marks):
        raise ValueError("three different marks that share a first character, which stands nowhere else in them")
    return tuple(marks)


def fill_in_middle(
    docs: DataFrame,
    key: str,
    keep: list[str],
    text: str = "text",
    seed: int = 42,
    share: int = 50,
    suffix_first: int = 80,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """``keep``, n (tokens), form (plain, spm or psm), prefix_chars, middle_chars and output of every text.

    ``share`` percent of the texts are rearranged, ``suffix_first`` percent of
    those as spm. The draws depend on ``seed`` and the key as text alone.
    ``marks`` stand before prefix, suffix and middle.
    """
    marks = _checked(marks)
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    read = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), drawn.alias("h"), F.col(f"`{text}`").cast("string").alias("t"))
    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    kinds += "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    out = read.mapInArrow(lambda it: _work(it, share, suffix_first, marks), kinds)
    new = ["n", "form", "prefix_chars", "middle_chars", "output"]
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), *new)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that became ``output``."""
    parts = F.split(output, "|".join(map(re.escape, _checked(marks))), -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
