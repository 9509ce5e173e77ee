"""Benchmark decontamination by suffix arrays over the training documents.

Texts become words; a word of the benchmark has a number, any other is 0. The
documents of a task are laid out in shards of about ``SHARD_WORDS`` words, and
each shard gets a suffix array: its places with a known word, in the order of
the words that follow (packed keys first, then prefix doubling among places
still equal). Every suffix of the benchmark is looked up in every shard by binary
search, which gives its longest verbatim match and all places of it. Documents
with a match of a whole window are affected: they are marked, or removed.

The benchmark is read in blocks of about ``BLOCK_BYTES``; a block is all that the
driver holds and broadcasts, and there are as many passes over the documents as
blocks. Long items are cut into overlapping stretches, so that a block stays
small; long documents are cut likewise, so that a shard stays small.

* null texts, and texts without words, have no words and no matches; an item
  without words never occurs; an item of fewer words than a window is one window;
* repeated documents each have their row; an item id that repeats counts once;
  null item ids are one item, printed as an empty text;
* columns of any name pass through; empty tables give empty results, an empty
  benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import stored

SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 << 20
CHUNK = 1 << 20
#: A-Z to lower case; bytes that are no part of a word, all of them ASCII, to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def chunks(body: bytes, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The words of a text, in lists from about ``size`` bytes each."""
    folded, at = body.translate(FOLD), 0
    while at < len(folded):
        to = folded.find(b" ", at + size)
        to = len(folded) if to < 0 else to
        yield folded[at:to].split()
        at = to


@dataclass
class Block:
    """A block of the benchmark: its vocabulary, its items' words end to end, and where the windows start."""

    vocabulary: dict[bytes, int]
    ids: np.ndarray
    #: Of every place of ``ids``: its item, its place in the item, how many words of the item are left; 0 left after each item.
    item: np.ndarray
    at: np.ndarray
    left: np.ndarray
    names: list[str]
    #: Starts of the windows by their length.
    windows: dict[int, np.ndarray]

    @property
    def end(self) -> int:
        """The number that stands behind every item; no document has it."""
        return len(self.vocabulary) + 1


def block_of(rows: list[tuple[str, int, bytes]], window: int) -> Block:
    """A block from (item, place of its first word, words with spaces)."""
    vocabulary: dict[bytes, int] = {}
    names = sorted({name for name, _, _ in rows})
    number, ids, item, at, left, starts, base = {n: i for i, n in enumerate(names)}, [], [], [], [], {}, 0
    for name, first, body in rows:
        words = body.split()
        if not words:
            continue
        n, w = len(words), min(len(words), window)
        ids += [vocabulary.setdefault(x, len(vocabulary) + 1) for x in words] + [-1]
        item.append(np.full(n + 1, number[name]))
        at.append(np.arange(first, first + n + 1))
        left.append(np.arange(n, -1, -1))
        starts.setdefault(w, []).append(np.arange(base, base + n - w + 1))
        base += n + 1
    placed = np.array(ids, np.int64)
    placed[placed < 0] = len(vocabulary) + 1
    whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (item, at, left)]
    return Block(vocabulary, placed, *whole, names, {w: np.concatenate(x) for w, x in starts.items()})


class SuffixArray:
    """The places of known words in the order of the words that follow, compared up to ``depth`` words."""

    def __init__(self, ids: np.ndarray, end: int, depth: int):
        self.bits = end.bit_length()
        self.per = max(1, min(depth, 63 // self.bits))
        self.ids, self.depth = np.concatenate([ids, np.zeros(depth + self.per, np.int64)]), depth
        self.key = self.packed(self.ids)
        sa = np.flatnonzero(ids)
        sa = sa[np.argsort(self.key[sa])]
        self.sa = self._doubled(sa) if len(sa) else sa
        self.sorted = self.key[self.sa]

    def packed(self, ids: np.ndarray) -> np.ndarray:
        """At every place the next ``per`` words in one number."""
        ids, key = np.concatenate([ids, np.zeros(self.per, np.int64)]), 0
        for k in range(self.per):
            key = key << self.bits | ids[k : len(ids) - self.per + k]
        return key

    def _doubled(self, sa: np.ndarray) -> np.ndarray:
        """Prefix doubling; a place's rank is where its group starts, and groups of one are settled."""
        rank, known = np.zeros(len(self.ids) + self.depth, np.int64), self.per
        open_, keys = np.arange(len(sa)), self.key[sa]
        while True:
            starts = np.concatenate([[True], keys[1:] != keys[:-1]])
            rank[sa[open_]] = open_[starts][np.cumsum(starts) - 1] + 1
            many = ~(starts & np.append(starts[1:], True))
            open_ = open_[many]
            if known >= self.depth or not len(open_):
                return sa
            some = sa[open_]
            keys = rank[some] << 32 | rank[some + known]
            order = np.argsort(keys)
            sa[open_], keys = some[order], keys[order]
            known *= 2

    def _bound(self, lo: np.ndarray, hi: np.ndarray, off: int, target: np.ndarray, after: bool) -> np.ndarray:
        """Binary search in each [lo, hi) for the first key, ``off`` words on, not below (or above) the target."""
        lo, hi = lo.copy(), hi.copy()
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) >> 1
            found = self.key[self.sa[mid] + off]
            below = found <= target[live] if after else found < target[live]
            lo[live[below]] = mid[below] + 1
            hi[live[~below]] = mid[~below]
        return lo

    def _narrow(self, lo, hi, off: int, key: np.ndarray, words: int):
        """The part of each [lo, hi) whose next ``words`` words are those of the key."""
        loose = (1 << self.bits * (self.per - words)) - 1
        first, last = key & ~loose, key | loose
        if off == 0:
            return np.searchsorted(self.sorted, first), np.searchsorted(self.sorted, last, side="right")
        below = self._bound(lo, hi, off, first, False)
        return below, self._bound(below, hi, off, last, True)

    def windows(self, tests: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the starts whose next ``words`` words occur, and their parts of the array."""
        lo = hi = np.zeros(len(starts), np.int64)
        for off in range(0, words, self.per):
            lo, hi = self._narrow(lo, hi, off, tests[starts + off], min(self.per, words - off))
            live = lo < hi
            starts, lo, hi = starts[live], lo[live], hi[live]
        return starts, lo, hi

    def longest(self, tests: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Length of the longest match of every suffix, at most ``depth``, and its part of the array."""
        length = np.zeros(len(starts), np.int64)
        best_lo, best_hi = np.zeros((2, len(starts)), np.int64)
        live = np.arange(len(starts))
        for off in range(0, self.depth, self.per):
            key, most = tests[starts[live] + off], min(self.per, self.depth - off)
            going = np.ones(len(live), bool)
            for words in range(most, 0, -1):
                open_ = going.nonzero()[0] if words == most else missed
                lo, hi = self._narrow(best_lo[live[open_]], best_hi[live[open_]], off, key[open_], words)
                hit = lo < hi
                at = live[open_[hit]]
                best_lo[at], best_hi[at], length[at] = lo[hit], hi[hit], off + words
                missed = open_[~hit]
                going[missed] = False
            live = live[going]
            if not len(live):
                break
        return length, best_lo, best_hi


class Shard:
    """Documents' word numbers end to end, a 0 behind each."""

    def __init__(self, parts: list[tuple[int, int, np.ndarray]]):
        size = np.array([len(ids) + 1 for _, _, ids in parts])
        self.first = np.cumsum(size) - size
        self.row, self.at = (np.array([p[k] for p in parts]) for k in (0, 1))
        gap = np.zeros(1, np.int64)
        self.ids = np.concatenate([x for _, _, ids in parts for x in (ids, gap)])

    def part(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1

    def hits(self, block: Block, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, first, end) of the hit stretches of words, and the different (row, item)."""
        array = SuffixArray(self.ids, block.end, window)
        tests = array.packed(np.concatenate([block.ids, np.zeros(window, np.int64)]))
        edge, owned = np.zeros(len(self.ids) + 1, np.int64), []
        for words, starts in block.windows.items():
            starts, lo, hi = array.windows(tests, starts, words)
            if not len(starts):
                continue
            # Equal windows have the same part of the array.
            part, which = np.unique(lo, return_index=True)
            many = hi[which] - part
            at = array.sa[np.repeat(part - np.cumsum(many) + many, many) + np.arange(many.sum())]
            edge += np.bincount(at, minlength=len(edge)) - np.bincount(at + words, minlength=len(edge))
            # Documents of each different window, then the items of the window.
            seen = np.unique(np.repeat(np.arange(len(part)), many) << 32 | self.row[self.part(at)])
            items = np.unique(np.searchsorted(part, lo) << 32 | block.item[starts])
            first = np.searchsorted(items >> 32, np.arange(len(part) + 1))
            times = np.diff(first)[seen >> 32]
            pick = np.repeat(first[seen >> 32] - np.cumsum(times) + times, times) + np.arange(times.sum())
            owned.append(np.repeat(seen & 0xFFFFFFFF, times) << 32 | items[pick] & 0xFFFFFFFF)
        inside = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
        start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        part = self.part(start)
        shift = self.at[part] - self.first[part]
        pairs = np.unique(np.concatenate(owned)) if owned else np.zeros(0, np.int64)
        return self.row[part], start + shift, end + shift, pairs >> 32, pairs & 0xFFFFFFFF

    def longest(self, block: Block, least: int, order: np.ndarray):
        """Place in the block, length, row and word of the longest match of every suffix; the first row by ``order`` of equals."""
        depth = int(block.left.max(initial=1))
        array = SuffixArray(self.ids, block.end, depth)
        tests = array.packed(np.concatenate([block.ids, np.zeros(depth, np.int64)]))
        starts = np.flatnonzero(block.left >= least)
        length, lo, hi = array.longest(tests, starts)
        good = length >= least
        starts, length, lo, hi = starts[good], length[good], lo[good], hi[good]
        if not len(starts):
            return (np.zeros(0, np.int64),) * 4
        place = array.sa
        part = self.part(place)
        word = place - self.first[part] + self.at[part]
        by = order[self.row[part]] << 40 | word
        ranges = np.stack([lo, hi], 1).ravel()
        least_by = np.minimum.reduceat(np.append(by, 0), ranges)[::2]
        rows = np.argsort(order)[least_by >> 40]
        return starts, length, rows, least_by & (1 << 40) - 1


def _shards(bodies: Iterator[bytes], block: Block, overlap: int, counts: list[int], shard_words: int) -> Iterator[Shard]:
    """The rows' words in shards; a long row's parts share ``overlap`` words with the next."""
    get, parts, held = block.vocabulary.get, [], 0
    for row, body in enumerate(bodies):
        ids = [np.array([get(w, 0) for w in words], np.int64) for words in chunks(body)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        counts.append(len(ids))
        at = 0
        while at < len(ids):
            part = ids[at : at + shard_words + overlap]
            parts.append((row, at, part))
            held += len(part)
            if held >= shard_words:
                yield Shard(parts)
                parts, held = [], 0
            at += shard_words
    if parts:
        yield Shard(parts)


def _united(starts: list[int], ends: list[int]) -> list[dict[str, int]]:
    """Stretches that overlap or touch made one."""
    out: list[dict[str, int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def _bodies(column: pa.Array) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


SPANS = "array<struct<start: bigint, end: bigint>>"


def _marked(batches: Iterator[pa.RecordBatch], block: Block, window: int, shard_words: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows with the hits of a block added; the last columns are the text (not given back in the last pass), its words, hit stretches and items."""
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())
    for batch in batches:
        text, _, spans, items = batch.columns[-4:]
        counts, found, named = [], {}, {}
        for shard in _shards(_bodies(text), block, window - 1, counts, shard_words):
            row, start, end, owner, item = shard.hits(block, window)
            for r, a, b in zip(row.tolist(), start.tolist(), end.tolist()):
                ours = found.setdefault(r, ([], []))
                ours[0].append(a), ours[1].append(b)
            for r, i in zip(owner.tolist(), item.tolist()):
                named.setdefault(r, set()).add(block.names[i])
        new_spans, new_items = [], []
        for r, (old, had) in enumerate(zip(spans.to_pylist(), items.to_pylist())):
            a, b = found.get(r, ([], []))
            new_spans.append(_united([s["start"] for s in old] + a, [s["end"] for s in old] + b))
            new_items.append(sorted(named.get(r, set()).union(had)))
        kept, names = batch.num_columns - 3 - last, batch.schema.names
        columns = [*batch.columns[:kept], pa.array(counts, pa.int64()), *(pa.array(v, k) for v, k in zip((new_spans, new_items), kinds))]
        yield pa.RecordBatch.from_arrays(columns, names=[*names[:kept], *names[-3:]])


def _stretches(batches: Iterator[pa.RecordBatch], size: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Items as (item, place of the first word, words); long ones in overlapping stretches."""
    for batch in batches:
        rows = []
        for name, body in zip(batch.column(0).to_pylist(), _bodies(batch.column(1))):
            words, at, given = [], 0, False
            for some in chunks(body, size):
                words += some
                if len(words) > overlap and some:
                    rows.append((name, at, b" ".join(words)))
                    at, words, given = at + len(words) - overlap, words[len(words) - overlap :], True
            if words and not given:
                rows.append((name, 0, b" ".join(words)))
        columns = [pa.array(v, k) for v, k in zip(zip(*rows) if rows else [()] * 3, (pa.string(), pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "at", "body"])


def blocks(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes``, one at a time on the driver."""
    name = F.coalesce(F.col(f"`{item}`").cast("string"), F.lit(""))
    read = benchmark.select(name.alias("item"), F.col(f"`{text}`").cast("string").alias("text")).distinct()
    size = max(block_bytes // 16, 1 << 10)
    parts = read.mapInArrow(lambda it: _stretches(it, size, window - 1), "item string, at bigint, body binary")
    bulk = parts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    many = -(-bulk // block_bytes)
    if many > 1:
        parts = stored(parts)
    for i in range(many):
        some = parts.where(F.pmod(F.xxhash64("item", "at", "body"), F.lit(many)) == i)
        yield block_of([(r["item"], r["at"], bytes(r["body"])) for r in some.collect()], window)


def _affected(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The columns of ``keep`` as k0, k1 and so on, then n_words, spans and items."""
    rows = docs.select(
        *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)),
        F.col(f"`{text}`").cast("string").alias("t"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    spark, whole = docs.sparkSession, rows.schema
    short = T.StructType([f for f in whole if f.name != "t"])
    given = blocks(benchmark, item, item_text, window, block_bytes)
    block = next(given, block_of([], window))
    while True:
        following = next(given, None)
        last = following is None
        rows = _pass(spark, rows, short if last else whole, block, window, shard_words, last)
        if last:
            return rows
        rows, block = stored(rows), following


def _pass(spark, rows: DataFrame, schema: T.StructType, block: Block, window: int, shard_words: int, last: bool) -> DataFrame:
    sent = spark.sparkContext.broadcast(block)
    return rows.mapInArrow(lambda it: _marked(it, sent.value, window, shard_words, last), schema)


def affected(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", **options) -> DataFrame:
    """``keep``, n_words, spans (hit stretches of words, ends exclusive) and items (sorted) of every document.

    ``options`` are ``item`` and ``item_text`` (columns of the benchmark),
    ``window`` (words), ``block_bytes`` and ``shard_words``.
    """
    rows = _affected(docs, benchmark, keep, text, **options)
    return rows.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "n_words", "spans", "items")


def n_hit(spans: Column) -> Column:
    """How many words the stretches cover."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without a window of the benchmark, with all their columns."""
    clean = _affected(docs, benchmark, docs.columns, text, **options).where(F.size("spans") == 0)
    return clean.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)))


def _longest(batches: Iterator[pa.RecordBatch], block: Block, least: int, keys: int, shard_words: int) -> Iterator[pa.RecordBatch]:
    names = [*(f"k{i}" for i in range(keys)), "item", "item_at", "n_words", "doc_at"]
    for batch in batches:
        own = pa.Table.from_batches([batch.select(range(keys))])
        order = np.empty(batch.num_rows, np.int64)
        sort_keys = [(n, "ascending") for n in own.column_names]
        order[pc.sort_indices(own, sort_keys=sort_keys, null_placement="at_start").to_numpy()] = np.arange(batch.num_rows)
        overlap = int(block.left.max(initial=1)) - 1
        for shard in _shards(_bodies(batch.column(keys)), block, overlap, [], shard_words):
            starts, length, rows, word = shard.longest(block, least, order)
            item = pa.array([block.names[i] for i in block.item[starts].tolist()], pa.string())
            found = [item, *(pa.array(x) for x in (block.at[starts], length, word))]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows)) for c in batch.columns[:keys]), *found], names=names)


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    key: list[str],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    least: int = 10,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """item, item_at, n_words, ``key`` and doc_at: where in the corpus each suffix of an item has its longest match.

    Suffixes without a match of ``least`` words have no row. Of equally long
    matches the one with the least key, nulls first, and then the least place is
    given. A match ends at the end of the item, or of the stretch into which a
    long item was cut. ``key`` holds columns that can be sorted.
    """
    read = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(key)), F.col(f"`{text}`").cast("string").alias("t"))
    own = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(key))
    schema = own + "item string, item_at bigint, n_words bigint, doc_at bigint"
    spark, found = docs.sparkSession, None
    for block in blocks(benchmark, item, item_text, least, block_bytes):
        sent = spark.sparkContext.broadcast(block)
        some = read.mapInArrow(lambda it, sent=sent: _longest(it, sent.value, least, len(key), shard_words), schema)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], schema)
    first = F.struct((-F.col("n_words")).alias("n"), *(f"k{i}" for i in range(len(key))), "doc_at")
    best = found.groupBy("item", "item_at").agg(F.min(first).alias("m"))
    names = [F.col(f"m.k{i}").alias(c) for i, c in enumerate(key)]
    return best.select("item", "item_at", (-F.col("m.n")).alias("n_words"), *names, F.col("m.doc_at").alias("doc_at"))
