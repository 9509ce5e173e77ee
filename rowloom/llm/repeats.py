"""Repeated byte strings: column-wise construction over many documents, then removal.

A byte goes if it lies in a string of ``length`` (400) bytes that starts
anywhere else too. Every window of that length has one anchor: of its 32-byte
grams the one with the least hash, the leftmost of equals. Equal windows have
equal anchors at equal offsets, so each window is judged among the
*segments* of its anchor only: the windows of one stretch of text that share an
anchor occurrence, together under ``2 * length`` bytes.

* Anchors that occur once drop out. Equal segments (128-bit hashes) are repeats
  as a whole and are counted, not compared.
* The different segments of an anchor go through the column-wise construction,
  lined up at the anchor. Columns are written to an external file and read back
  one after another from the last to the first. Every round puts one symbol
  before each segment's suffix, re-sorts the suffixes by it (the next column of
  the collection's Burrows-Wheeler transform) and updates the common prefixes of
  neighbours from those of the round before. A common prefix of ``length`` or
  more marks a repeated window. As windows of other columns or anchors cannot be
  equal, only the current column's suffixes are held: order, common prefixes and
  one column.
* An anchor with more than ``MAX_SEGMENTS`` different segments is judged window
  by window, by counted 128-bit hashes, so no group ends up in one task.
* Occurrences of a hot anchor, segment or window are dealt over many tasks in
  every join (``spread_join``); of equal texts one a task is sent on for its bytes.

Texts are told apart by 128 bits of their SHA-256 digest; rows with equal texts are counted
as occurrences and have equal results. Null texts are empty; texts under
``length`` bytes keep everything; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import spread_join, stored

GRAM = 32
MAX_SEGMENTS = 16384
BLOCK = 1 << 17
#: Odd multipliers of the gram hash; any would do.
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the gram at each place."""
    n = len(data) - GRAM + 1
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.empty(len(data) - 7 + 8, np.uint64)
    for r in range(8):
        part = padded[r : r + (len(padded) - r) // 8 * 8].view("<u8")
        size = len(eight[r::8])
        eight[r::8] = part[:size]
    h = eight[:n] * MIX[0]
    for k in range(1, 4):
        h ^= h >> np.uint64(29)
        h += eight[8 * k : 8 * k + n]
        h *= MIX[k]
    h ^= h >> np.uint64(32)
    return h


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    out, have = x, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor its hash, its place, and the first and last start of the windows it stands for."""
    hashes, places, firsts, lasts = [], [], [], []
    total = len(text) - length + 1
    low = np.uint64((1 << 20) - 1)
    for at in range(0, max(total, 0), BLOCK):
        data = np.frombuffer(text, np.uint8, min(BLOCK + length - 1, len(text) - at), at)
        h = _gram_hashes(data)
        keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        least = _sliding_least(keys, length - GRAM + 1) & low
        starts = np.concatenate([[0], np.nonzero(np.diff(least))[0] + 1])
        ends = np.concatenate([starts[1:], [len(least)]]) - 1
        place = least[starts].astype(np.int64)
        hashes.append(h[place])
        places.append(place + at)
        firsts.append(starts + at)
        lasts.append(ends + at)
    if not hashes:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    h, p, a, b = (np.concatenate(x) for x in (hashes, places, firsts, lasts))
    # A block's border may cut the windows of one anchor in two.
    new = np.concatenate([[True], p[1:] != p[:-1]])
    return h[new], p[new], a[new], b[np.concatenate([np.nonzero(new)[0][1:], [len(p)]]) - 1]


def _occurrences(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "seg", "doc", "first", "last"]
    for batch in batches:
        found, segs, docs = [], [], []
        for doc, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
            body = text.as_py()
            if body is None or len(body) < length:
                continue
            h, p, a, b = anchors(body, length)
            view, digest = memoryview(body), xxhash.xxh3_128_digest
            # The anchor's offset belongs to the segment, so that equal segments line up.
            segs += [digest(view[x : y + length]) + int(q - x).to_bytes(2, "big") for q, x, y in zip(p.tolist(), a.tolist(), b.tolist())]
            docs += [doc.as_py()] * len(h)
            found.append((h.view(np.int64), a, b))
            if len(segs) > 50_000:
                yield pa.RecordBatch.from_arrays(_columns(found, segs, docs), names=names)
                found, segs, docs = [], [], []
        if segs:
            yield pa.RecordBatch.from_arrays(_columns(found, segs, docs), names=names)


def _columns(found, segs, docs):
    h, a, b = (np.concatenate(x) for x in zip(*found))
    return [pa.array(h), pa.array(segs, pa.binary()), pa.array(docs, pa.binary()), pa.array(a), pa.array(b)]


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of ``values[low:high]`` of each pair; low < high."""
    pairs = np.empty(2 * len(low), np.int64)
    pairs[::2], pairs[1::2] = low, high
    padded = np.append(values, np.iinfo(values.dtype).max)
    return np.minimum.reduceat(padded, pairs)[::2] if len(low) else values[:0]


def repeated_columns(group: np.ndarray, segments: list[bytes], offset: np.ndarray, length: int) -> list[np.ndarray]:
    """The starts of repeated windows in each segment, by the column-wise construction.

    ``group``: number of each segment's anchor; ``offset``: the anchor's place in it.
    """
    order = np.argsort(group, kind="stable")
    m, before = len(segments), int(offset.max())
    sizes = np.fromiter(map(len, segments), np.int64, m)
    after = int((sizes - offset).max())
    width = before + after
    marked: list[list[int]] = [[] for _ in range(m)]
    with tempfile.TemporaryFile() as columns:
        step = max(1, (1 << 22) // max(m, 1))
        flat = np.frombuffer(b"".join(segments), np.uint8)
        base = np.concatenate([[0], np.cumsum(sizes)[:-1]]) - before + offset
        for left in range(0, width, step):
            places = np.arange(left, min(left + step, width))[:, None]
            inside = (places >= (before - offset)[None, :]) & (places < (before - offset + sizes)[None, :])
            at = np.where(inside, base[None, :] + places, 0)
            symbols = np.where(inside, flat[at].astype(np.int16), -1)
            symbols.tofile(columns)
        groups = group[order]
        common = np.zeros(m, np.int16)
        for column in reversed(range(width)):
            columns.seek(2 * m * column)
            symbol = np.fromfile(columns, np.int16, m)[order]
            # Order within each anchor by the new symbol; equal symbols keep the order of the suffixes behind it.
            move = np.argsort(groups * 512 + (symbol + 1), kind="stable")
            order, symbol = order[move], symbol[move]
            same = np.zeros(m, bool)
            same[1:] = (groups[1:] == groups[:-1]) & (symbol[1:] == symbol[:-1]) & (symbol[1:] >= 0)
            pairs = np.nonzero(same)[0]
            grown = np.zeros(m, np.int16)
            if len(pairs):
                grown[pairs] = _range_least(common, move[pairs - 1] + 1, move[pairs] + 1) + 1
            common = grown
            long = common >= length
            if long.any():
                hit = long.copy()
                hit[:-1] |= long[1:]
                for i in order[hit]:
                    marked[i].append(column)
    return [np.array(x[::-1], np.int64) - before + offset[i] for i, x in enumerate(marked)]


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Sorted window starts as covered stretches."""
    if not len(starts):
        return []
    cut = np.nonzero(np.diff(starts) > length)[0]
    a = starts[np.concatenate([[0], cut + 1])]
    b = starts[np.concatenate([cut, [len(starts) - 1]])] + length
    return list(zip(a.tolist(), b.tolist()))


def _compared(batches: Iterator[pa.RecordBatch], length: int, limit: int = 8192) -> Iterator[pa.RecordBatch]:
    """Segments sorted by anchor, in batches of whole anchors."""
    anchor, seg, body = [], [], []

    def flush(k):
        numbers = np.unique(np.array(anchor[:k], np.int64), return_inverse=True)[1]
        offset = np.fromiter((int.from_bytes(s[16:], "big") for s in seg[:k]), np.int64, k)
        found = repeated_columns(numbers, body[:k], offset, length)
        rows = [(a, s, _runs(f, length)) for a, s, f in zip(anchor[:k], seg[:k], found) if len(f)]
        kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        spans = [[{"s": x, "e": y} for x, y in r[2]] for r in rows]
        out = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array(spans, kind)]
        del anchor[:k], seg[:k], body[:k]
        return pa.RecordBatch.from_arrays(out, names=["anchor", "seg", "spans"])

    for batch in batches:
        anchor += batch.column(0).to_pylist()
        seg += batch.column(1).to_pylist()
        body += batch.column(2).to_pylist()
        while len(anchor) > limit and anchor[0] != anchor[-1]:
            k = min(limit, len(anchor) - 1)
            while k < len(anchor) and anchor[k] == anchor[k - 1]:
                k += 1
            if k == len(anchor):
                k = next(i for i in range(len(anchor) - 1, 0, -1) if anchor[i] != anchor[i - 1])
            yield flush(k)
    if anchor:
        yield flush(len(anchor))


def _cut_out(batches: Iterator[pa.RecordBatch], length: int, per_window: bool) -> Iterator[pa.RecordBatch]:
    """The asked segments of each text, or the hashes of all windows in them."""
    for batch in batches:
        texts, wanted = batch.column(0).cast(pa.binary()), batch.column(1)
        rows = []
        for text, asked in zip(texts, wanted):
            body = memoryview(text.as_py())
            for w in asked.as_py():
                if per_window:
                    rows += [(w["doc"], i, xxhash.xxh3_128_digest(body[i : i + length])) for i in range(w["first"], w["last"] + 1)]
                else:
                    rows.append((w["anchor"], w["seg"], bytes(body[w["first"] : w["last"] + length])))
        kinds = [pa.binary(), pa.int64(), pa.binary()] if per_window else [pa.int64(), pa.binary(), pa.binary()]
        names = ["doc", "at", "hash"] if per_window else ["anchor", "seg", "body"]
        for at in range(0, len(rows), 20_000):
            part = list(zip(*rows[at : at + 20_000]))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(part, kinds)], names=names)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each text in a task, so that copies do not gather where texts are shuffled."""
    seen: set[bytes] = set()
    for batch in batches:
        take = []
        for i, doc in enumerate(batch.column(0).to_pylist()):
            if doc not in seen:
                seen.add(doc)
                take.append(i)
        yield batch.take(pa.array(take, pa.int64()))


def repeat_spans(texts: DataFrame, length: int = 400) -> DataFrame:
    """``doc`` (a text's digest) and its repeated stretches ``spans`` [s, e), unmerged; one row a text with any.

    ``texts`` has ``doc`` and ``text``, a row for every occurrence of a text.
    """
    kinds = "anchor bigint, seg binary, doc binary, first bigint, last bigint"
    found = stored(texts.mapInArrow(lambda it: _occurrences(it, length), kinds))
    again = stored(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    # Rows of a stored table keep their numbers when a task runs anew.
    found = stored(spread_join(found, again.select("anchor"), ["anchor"], "left_semi", again, F.monotonically_increasing_id()))
    segments = stored(
        found.groupBy("anchor", "seg").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "first", "last")).alias("one")
        )
    )
    variety = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("n"))
    compare = stored(variety.where((F.col("k") > 1) & (F.col("k") <= MAX_SEGMENTS)).select("anchor"))
    hot = stored(variety.where(F.col("k") > MAX_SEGMENTS).select("anchor"))

    whole = segments.where("n > 1").select("anchor", "seg")
    asked = segments.join(compare, "anchor").select("anchor", "seg", "n", "one.*")
    wanted = asked.groupBy("doc").agg(F.collect_list(F.struct("anchor", "seg", "first", "last")).alias("asked"))
    once = texts.where(F.octet_length("text") >= length).select("doc", "text").mapInArrow(_once, "doc binary, text string")
    one = once.join(wanted, "doc").dropDuplicates(["doc"]).select("text", "asked")
    bodies = one.mapInArrow(lambda it: _cut_out(it, length, False), "anchor bigint, seg binary, body binary")
    bodies = bodies.repartition("anchor").sortWithinPartitions("anchor")
    kinds = "anchor bigint, seg binary, spans array<struct<s: bigint, e: bigint>>"
    # Stored, so that the texts it shuffled are off the disks before texts move again.
    part = stored(bodies.mapInArrow(lambda it: _compared(it, length), kinds))
    relative = part.join(whole, ["anchor", "seg"], "left_anti").unionByName(
        whole.withColumn("spans", F.lit(None).cast("array<struct<s: bigint, e: bigint>>"))
    )
    counts = segments.select("anchor", "seg", "n")
    placed = spread_join(found, relative, ["anchor", "seg"], "inner", counts, F.monotonically_increasing_id()).select(
        "doc",
        F.when(F.col("spans").isNull(), F.array(F.struct(F.col("first").alias("s"), (F.col("last") + length).alias("e"))))
        .otherwise(F.transform("spans", lambda x: F.struct((x["s"] + F.col("first")).alias("s"), (x["e"] + F.col("first")).alias("e"))))
        .alias("spans"),
    )
    if not hot.isEmpty():
        here = spread_join(found, hot, ["anchor"], "left_semi", again, F.monotonically_increasing_id())
        here = here.select("doc", "first", "last").distinct()
        counts = texts.where(F.octet_length("text") >= length).groupBy("doc").agg(F.count(F.lit(1)).alias("copies"))
        asked = here.groupBy("doc").agg(F.collect_list(F.struct("doc", "first", "last")).alias("asked"))
        one = once.join(asked, "doc").dropDuplicates(["doc"]).select("text", "asked")
        windows = stored(one.mapInArrow(lambda it: _cut_out(it, length, True), "doc binary, at bigint, hash binary"))
        windows = windows.join(counts, "doc")
        twice = stored(windows.groupBy("hash").agg(F.sum("copies").alias("n")).where("n > 1"))
        single = spread_join(windows, twice.select("hash"), ["hash"], "left_semi", twice, F.xxhash64("doc", "at"))
        placed = placed.unionByName(
            single.select("doc", F.array(F.struct(F.col("at").alias("s"), (F.col("at") + length).alias("e"))).alias("spans"))
        )
    gathered = placed.distinct().groupBy("doc").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return stored(gathered)


def _removed(batches: Iterator[pa.RecordBatch], keep: list[int], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        texts, spans = batch.column(names.index("__text")).cast(pa.binary()), batch.column(names.index("spans"))
        out: list[tuple] = []
        for text, asked in zip(texts, spans):
            body, asked = text.as_py() or b"", asked.as_py() or []
            gone, runs, pieces = 0, 0, []
            upto = -1
            for s, e in sorted((x["s"], x["e"]) for x in asked):
                if s > upto:
                    pieces.append(body[max(upto, 0) : s])
                    runs += 1
                    gone += e - s
                    upto = e
                elif e > upto:
                    gone += e - upto
                    upto = e
            pieces.append(body[max(upto, 0) :])
            left = b"".join(pieces)
            out.append((len(body), gone, runs, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if with_text and gone else None))
        n, gone, runs, digest, left = map(list, zip(*out)) if out else ([], [], [], [], [])
        arrays = [batch.column(i) for i in keep]
        fields = [names[i] for i in keep] + ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
        arrays += [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())]
        if with_text:
            arrays.append(pa.array(left, pa.string()))
            fields.append("__left")
        yield pa.RecordBatch.from_arrays(arrays, names=fields)


def without_repeats(docs: DataFrame, length: int = 400, text: str = "text", with_text: bool = False) -> DataFrame:
    """The columns of ``docs`` without the text, and n_bytes, n_removed, n_spans, kept_sha256.

    With ``with_text`` also the text as it is left (``__left``; null where
    nothing went). A character of which only a part is left goes as a whole.
    """
    if not 2 * GRAM <= length < 10_000:
        raise ValueError("length must be from 64 to 9,999 bytes")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.unhex(F.substring(F.sha2(body, 256), 1, 32))
    spans = repeat_spans(docs.select(digest.alias("doc"), body.alias("text")), length)
    rest = [c for c in docs.columns if c != text]
    sources = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)), body.alias("__text"), digest.alias("doc"))
    joined = sources.join(spans, "doc", "left").select(*(f"c{i}" for i in range(len(rest))), "__text", "spans")
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest))
    kinds += ", n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    kinds += ", __left string" if with_text else ""
    keep = list(range(len(rest)))
    out = joined.mapInArrow(lambda it: _removed(it, keep, with_text), kinds)
    new = [c for c in out.columns if c not in {f"c{i}" for i in range(len(rest))}]
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(rest)), *new)
