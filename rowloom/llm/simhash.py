"""SimHash near copies: fingerprints, a byte-position inverted index, count filtering, components.

Two fingerprints at most ``max_bits`` = 3 bits apart differ in at most 3 of
their 8 bytes, so at least 5 positional bytes are shared. The inverted index
has posting lists for 14 sets of four byte positions. The sets are the blocks
of the Steiner system S(3, 4, 8): any three positions lie in one block, whose
complement is a block too, so whichever three bytes differ, some block is free
of them and every pair to be found meets in a posting list. In a list the
shared positional bytes of pairs are tallied, pairs with fewer than five are
dropped and the rest is verified by bit distance. A list gives the edges of a
spanning forest, not all pairs, which keeps every component.

Lists longer than ``MAX_LIST`` are cut up without loss: a pair with five
shared bytes shares one of the four bytes outside the block as well, so the
list splits by each of these, and lists that are still long split by the bits
of the remaining three bytes, of which three can differ.

* null and blank texts have fingerprint zero and are linked like any other;
* rows with equal fingerprints are one class, whatever their number;
* a null ``doc_id`` is never a component's name unless all its members are null;
* an empty table gives an empty result, further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.components import connected_components
from rowloom.llm.common import stored

SEED = 42
MAX_LIST = 2048

#: The 14 blocks of the Steiner system S(3, 4, 8) over byte positions.
BLOCKS = [
    (0, 1, 2, 3), (4, 5, 6, 7), (0, 1, 4, 5), (2, 3, 6, 7), (0, 1, 6, 7), (2, 3, 4, 5), (0, 2, 4, 6),
    (1, 3, 5, 7), (0, 2, 5, 7), (1, 3, 4, 6), (0, 3, 4, 7), (1, 2, 5, 6), (0, 3, 5, 6), (1, 2, 4, 7),
]


def simhash(text: bytes | None, size: int = 3) -> int:
    """The 64-bit SimHash of the ``size``-word shingles of a lower-cased text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > size:
        starts, ends = starts[: 1 - size], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    n, over = len(starts), np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        some = zip(starts[at : at + 65536].tolist(), ends[at : at + 65536].tolist())
        h = np.array([digest(view[a:b], SEED) for a, b in some], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64)
        over += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.nonzero(2 * over > n)[0]
    return sum(1 << int(b) for b in set_bits)


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        found = np.fromiter((simhash(x.as_py(), size) for x in texts), np.uint64, len(texts)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, size: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a signed number) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        lambda it: _fingerprints(it, size), f"doc_id {kind}, fp bigint"
    )


def _postings(classes: DataFrame) -> DataFrame:
    """(block, the block's four bytes, fp) of every different fingerprint."""

    def of(block):
        key = F.lit(0).cast("bigint")
        for p in block:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)))
        return key

    lists = F.array(*(F.struct(F.lit(i).alias("block"), of(b).alias("key")) for i, b in enumerate(BLOCKS)))
    return classes.select(F.explode(lists).alias("p"), "fp").select("p.block", "p.key", F.lit(0).cast("bigint").alias("sub"), "fp")


def _finer(lists: DataFrame, level: int) -> DataFrame:
    """Long lists split by the bytes outside the block, then by groups of the bits that are left.

    Level 0: by each of the four other bytes. Level 1: the other 24 bits in
    four groups of six, of which one at least has no differing bit.
    """
    rest = [[p for p in range(8) if p not in b] for b in BLOCKS]

    def byte(p):
        return F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))

    def joined(places):
        out = F.lit(0).cast("bigint")
        for p in places:
            out = F.shiftleft(out, 8).bitwiseOR(byte(p))
        return out

    per_block = []
    for others in rest:
        if level == 0:
            keys = [joined([p]).bitwiseOR(F.lit((q + 1) << 32)) for q, p in enumerate(others)]
        else:
            keys = []
            for q, p in enumerate(others):
                bits = joined([x for x in others if x != p])
                for g in range(4):
                    part = F.shiftrightunsigned(bits, 6 * g).bitwiseAND(F.lit(63))
                    mark = F.lit((q + 1) << 32 | (g + 1) << 40)
                    whole = F.shiftleft(part, 8).bitwiseOR(byte(p)).bitwiseOR(mark)
                    keys.append(F.when(F.shiftrightunsigned("sub", 32) == q + 1, whole))
        per_block.append(F.array_compact(F.array(*keys)))
    chosen = per_block[-1]
    for i in reversed(range(len(BLOCKS) - 1)):
        chosen = F.when(F.col("block") == i, per_block[i]).otherwise(chosen)
    return lists.select("block", "key", F.explode(chosen).alias("sub"), "fp")


def forest(fps: np.ndarray, max_bits: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all of a posting list that the links of ``max_bits`` join."""
    left = np.unique(fps)
    parts = left.view(np.uint8).reshape(-1, 8)
    a, b = [], []
    while len(left):
        frontier, rows = [left[0]], [parts[0]]
        left, parts = left[1:], parts[1:]
        while frontier and len(left):
            x, row = frontier.pop(), rows.pop()
            shared = (parts == row).sum(axis=1)
            near = shared >= 8 - max_bits
            near[near] = np.bitwise_count(left[near] ^ x) <= max_bits
            if near.any():
                found = left[near]
                a.append(np.full(len(found), x))
                b.append(found)
                frontier.extend(found)
                rows.extend(parts[near])
                left, parts = left[~near], parts[~near]
        if not len(left):
            break
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _linked(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
        sizes = np.diff(cuts)
        two = cuts[:-1][sizes == 2]
        x, y = values[two], values[two + 1]
        near = np.bitwise_count(x ^ y) <= max_bits
        edges = [(x[near], y[near])]
        for i in np.nonzero(sizes > 2)[0]:
            edges.append(forest(values[cuts[i] : cuts[i + 1]], max_bits))
        a, b = (np.concatenate(side).view(np.int64) for side in zip(*edges))
        keep = a != b
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def fingerprint_links(classes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (a, b) between different fingerprints ``fp``, enough for all components."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index guarantees shared bytes for 0 to 3 differing bits")
    lists, parts, keys = _postings(classes), [], ["block", "key", "sub"]
    for level in range(3):
        sizes = lists.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        if level < 2:
            long = stored(sizes.where(F.col("n") > MAX_LIST).select(*keys))
            if long.isEmpty():
                parts.append(lists)
                break
            parts.append(lists.join(long, keys, "left_anti"))
            lists = stored(_finer(lists.join(long, keys), level))
        else:
            parts.append(lists)
    out = None
    for part in parts:
        gathered = part.groupBy(*keys).agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")
        found = gathered.mapInArrow(lambda it: _linked(it, max_bits), "a bigint, b bigint")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def simhash_components(
    docs: DataFrame, size: int = 3, max_bits: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``fp``, ``root`` (a fingerprint of the component) and ``component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` that can be reached by links.
    """
    prints = stored(fingerprints(docs, size, key, text))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    classes = stored(classes)
    roots = connected_components(fingerprint_links(classes.select("fp"), max_bits))
    named = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = stored(named)
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    members = named.join(least, "root").select("fp", "root", "component_id")
    return prints.join(members, "fp").select("doc_id", "fp", "root", "component_id")


def first_of_components(docs: DataFrame, size: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the one with the smallest ``doc_id``.

    Of repeated rows with that ``doc_id``, and of components without any, one row stays.
    """
    found = stored(simhash_components(docs, size, max_bits))
    ids = found.groupBy("doc_id").agg(
        F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays"), F.count(F.lit(1)).alias("n")
    )
    ids = ids.where("stays").select(F.col("doc_id").alias("__id"), F.col("n").alias("__n"))
    staying = docs.join(ids, docs["doc_id"].eqNullSafe(ids["__id"]))
    once = staying.where((F.col("__n") == 1) & F.col("doc_id").isNotNull()).drop("__id", "__n")
    more = staying.where((F.col("__n") > 1) | F.col("doc_id").isNull())
    if ids.where((F.col("__n") > 1) | F.col("__id").isNull()).isEmpty():
        return once
    one = more.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("__text"))
    again = more.join(
        one.select(F.col("doc_id").alias("__one"), "__text"),
        F.col("doc_id").eqNullSafe(F.col("__one")) & (F.coalesce("text", F.lit("")) == F.col("__text")),
    )
    return once.unionByName(again.drop("__id", "__n", "__one", "__text").dropDuplicates(["doc_id"]))
