"""Alignment of two tokenizers' tokens of the same texts by pointer jumping.

A text with a space before it is encoded by a byte-level BPE (A) and by a
sentence-piece model (B, which adds that space itself). Every token is a byte
range. Each token points to the farthest-right token that overlaps it, of either
tokenizer; doubling all pointers at once (``next = next[next]``) ends after a few
rounds with every token at the terminal token of its component, the A token that
ends where a B token ends. The terminal labels the group.

The last A and B token of a group end together and are linked. How many links of
the corpus hold a pair of ids is counted from the distinct pairs of each *stretch*
(documents of one task with about ``STRETCH_LINKS`` links), so a frequent pair is
one row a stretch and no key is hot. The counts travel back by stretch, where
they are looked up for the links, which the documents keep, each
different one once, as places in their stretch's table of pairs.

Long texts are encoded in chunks, cut only before a space between two ASCII
letters or digits: there both tokenizers end a token (checked when they are
loaded). Memory grows with the chunk and, for a run without such a place, with
that run.

* null and empty texts, and texts whose joined tokens of A or B differ from
  space + text (invalid UTF-8, U+2581 in the text), have no tokens: counts are 0
  and the digest is '';
* repeated rows each have their row, and their links count each time; null keys
  are kept; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import stored

CHUNK = 1 << 20
#: Links of a stretch; a stretch ends with the document that reaches it.
STRETCH_LINKS = 1 << 22
#: Longest run of white space, or without it, in bytes that the faster encoder of A is given: its time is quadratic in a run.
LONG_RUN = 4096
CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
#: Fixed value: the pattern of byte-level pre-tokenization.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevelTokens:
    """Ids and token bytes of a byte-level BPE."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path) as f:
            kept = json.load(f)
        level, model = kept["pre_tokenizer"], kept["model"]
        if kept["normalizer"] or level["type"] != "ByteLevel" or level["add_prefix_space"] or not level["use_regex"]:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        special = {x["content"]: x["id"] for x in kept["added_tokens"]}
        symbols = byte_symbols()
        ranks = {bytes(map(symbols.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
        self.raw = [b""] * (1 + max([*ranks.values(), *special.values()]))
        for token, i in ranks.items():
            self.raw[i] = token
        for token, i in special.items():
            self.raw[i] = token.encode()
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        # Merging by id gives the same as merging by the list if each merge's id grows with its place.
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        self.fast = None
        if made == sorted(set(made)) and all(len(t) == 1 or i >= made[0] for t, i in ranks.items()):
            self.fast = tiktoken.Encoding("own", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str], long_run: list[bool]) -> list[np.ndarray]:
        fast = self.fast
        return [
            np.array(self.slow.encode(t, add_special_tokens=False).ids, np.int64)
            if run or fast is None
            else fast.encode_to_numpy(t).astype(np.int64)
            for t, run in zip(texts, long_run)
        ]


class PieceTokens:
    """Ids and token bytes of a sentence-piece model that adds a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.raw = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        if any(re.search("[^▁]▁", p) for p in names) or m.encode("a b1 c") != m.encode("a") + m.encode("b1") + m.encode("c"):
            raise ValueError(f"pieces of {path} run over the start of a word")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For the tokens of A, then of B, the A token that ends their component, by successor doubling."""
    n = len(ends_a)
    starts_a, starts_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    last_b = np.searchsorted(starts_b, ends_a) - 1
    last_a = np.searchsorted(starts_a, ends_b) - 1
    # Of tokens that end together the A token is the farther one, so that a component has one terminal.
    follow = np.concatenate([np.where(ends_b[last_b] > ends_a, n + last_b, np.arange(n)), last_a])
    while True:
        further = follow[follow]
        if np.array_equal(further, follow):
            return follow
        follow = further


class Aligned:
    """Groups and links of texts laid end to end; each text's last tokens end together."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray):
        self.a, self.b = np.concatenate(a), np.concatenate(b)
        self.a_of, self.b_of = ([0, *np.cumsum([len(x) for x in some]).tolist()] for some in (a, b))
        ends_a, ends_b = np.cumsum(size_a[self.a]), np.cumsum(size_b[self.b])
        n, end = len(self.a), terminals(ends_a, ends_b)
        self.is_last = end[:n] == np.arange(n)
        label = np.cumsum(self.is_last) - 1
        self.group_a, self.group_b = label[end[:n]], label[end[n:]]
        last_a = np.flatnonzero(self.is_last)
        self.last_b = np.flatnonzero(np.diff(self.group_b, append=len(last_a)))
        self.pairs = self.a[last_a] << 32 | self.b[self.last_b]
        self.links_of = [0, *(np.searchsorted(last_a, self.a_of[1:])).tolist()]

    def codes(self, tokens: int) -> tuple[np.ndarray, list[int]]:
        """All tokens in the order of print, as id + ``tokens`` * (0 inside a part, 1 after A's part, 2 after B's), and each text's first."""
        n, m = len(self.a), len(self.b)
        many_a, many_b = np.bincount(self.group_a), np.bincount(self.group_b)
        out = np.empty(n + m, np.int64)
        out[np.arange(n) + (np.cumsum(many_b) - many_b)[self.group_a]] = self.a + tokens * self.is_last
        ends = np.zeros(m, np.int64)
        ends[self.last_b] = 2
        out[np.arange(m) + np.cumsum(many_a)[self.group_b]] = self.b + tokens * ends
        return out, [x + y for x, y in zip(self.a_of, self.b_of)]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.one, self.two = ByteLevelTokens(path_a), PieceTokens(path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in t.raw]) for t in (self.one, self.two))
        self.tokens = max(len(self.size_a), len(self.size_b))
        self.printed = [f"{i}{end}".encode() for end in ",|;" for i in range(self.tokens)]

    def chunks(self, body: bytes) -> list[str]:
        """A text in chunks that both tokenizers encode on their own, each without the space before it; none of invalid bytes."""
        try:
            text = body.decode()
        except UnicodeDecodeError:
            return []
        out, at = [], 0
        while len(text) - at > CHUNK and (cut := CUT.search(text, at + CHUNK)):
            out.append(text[at : cut.start()])
            at = cut.end()
        return [*out, text[at:]]

    def blocks(self, bodies: Iterator[bytes]) -> Iterator[tuple[list[tuple[int, str]], int]]:
        """Lists of (document, chunk) of about ``CHUNK`` bytes, and how many documents are complete with each."""
        block, held, done = [], 0, 0
        for i, body in enumerate(bodies):
            for chunk in self.chunks(body) if body else ():
                if held >= CHUNK:
                    yield block, i
                    block, held = [], 0
                block.append((i, chunk))
                held += len(chunk)
            done = i + 1
        yield block, done

    def whole(self, ids: np.ndarray, raw: list[bytes], text: bytes) -> bool:
        return b"".join(map(raw.__getitem__, ids.tolist())) == text

    def align(self, block: list[tuple[int, str]]) -> tuple[list[int], Aligned | None, list[int]]:
        """Documents of the chunks that both tokenizers give back whole, their alignment, and the documents that are not."""
        spaced = [" " + chunk for _, chunk in block]
        raw = [s.encode() for s in spaced]
        a = self.one.encode(spaced, [has_long_run(s) for s in raw])
        b = self.two.encode([chunk for _, chunk in block])
        good = [self.whole(x, self.one.raw, s) and self.whole(y, self.two.raw, s) for x, y, s in zip(a, b, raw)]
        bad = [i for (i, _), g in zip(block, good) if not g]
        if not any(good):
            return [], None, bad
        keep = [k for k, g in enumerate(good) if g]
        found = Aligned([a[k] for k in keep], [b[k] for k in keep], self.size_a, self.size_b)
        return [block[k][0] for k in keep], found, bad


def has_long_run(body: bytes) -> bool:
    """Whether white space, or what is between it, runs on for more than ``LONG_RUN`` bytes."""
    if len(body) <= LONG_RUN:
        return False
    blank = np.frombuffer(body, np.uint8) <= 32
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return bool(np.diff(edges, prepend=-1, append=len(body)).max() > LONG_RUN)


_kept: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _kept:
        _kept[path_a, path_b] = Aligner(path_a, path_b)
    return _kept[path_a, path_b]


class Document:
    """What the chunks of a text come to."""

    def __init__(self):
        self.n_a = self.n_b = 0
        self.digest, self.printed, self.links, self.whole = None, [], [], True

    def add(self, n_a: int, n_b: int, printed: bytes, links: np.ndarray, keep: bool) -> None:
        self.n_a, self.n_b = self.n_a + n_a, self.n_b + n_b
        if self.digest is None:
            self.digest = hashlib.sha256(printed)
        else:
            self.digest.update(b";" + printed)
        self.links.append(links)
        if keep:
            self.printed.append(printed.decode())

    def row(self) -> tuple[int, int, str, np.ndarray, str]:
        if not self.whole or self.digest is None:
            return 0, 0, "", np.zeros(0, np.int64), ""
        return self.n_a, self.n_b, self.digest.hexdigest(), np.concatenate(self.links), ";".join(self.printed)


def _documents(found: Aligner, bodies: Iterator[bytes], keep: bool) -> Iterator[tuple[int, int, str, np.ndarray, str]]:
    """A tokens, B tokens, digest of the groups, pairs of the links and, if kept, the groups of every text in order."""
    docs, given = defaultdict(Document), 0
    for block, done in found.blocks(bodies):
        owners, aligned, bad = found.align(block) if block else ([], None, [])
        for i in bad:
            docs[i].whole = False
        if aligned is not None:
            codes, at = aligned.codes(found.tokens)
            codes, a, b, l = codes.tolist(), aligned.a_of, aligned.b_of, aligned.links_of
            for k, i in enumerate(owners):
                printed = b"".join(map(found.printed.__getitem__, codes[at[k] : at[k + 1]]))[:-1]
                docs[i].add(a[k + 1] - a[k], b[k + 1] - b[k], printed, aligned.pairs[l[k] : l[k + 1]], keep)
        for i in range(given, done):
            yield docs.pop(i, Document()).row()
        given = done


def _bodies(column: pa.Array) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


STORED = (
    "stretch bigint, n_a bigint, n_b bigint, groups_sha256 string, n_links bigint, n_pairs bigint, places binary, repeats binary, "
    "pairs array<bigint>, times array<bigint>"
)


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the greatest needs."""
    most = int(values.max(initial=0))
    return values.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def widened(packed: bytes, count: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // count}" if count else "u1").astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], keys: int, stretch_links: int) -> Iterator[pa.RecordBatch]:
    """A row for each document; the last one of a stretch has the stretch's pairs and how often each is linked."""
    found, task = aligner(*paths), TaskContext.get().partitionId() << 32
    names = [*(f"k{i}" for i in range(keys)), *(x.split()[0] for x in STORED.split(", "))]

    def stretch(parts, rows, number):
        n, size = len(rows), np.array([len(r[3]) for r in rows])
        coded = pa.array(np.concatenate([r[3] for r in rows])).dictionary_encode()
        place = coded.indices.to_numpy().astype(np.int64)
        times = np.bincount(place, minlength=len(coded.dictionary))
        own, repeats = np.unique(np.repeat(np.arange(n), size) << 32 | place, return_counts=True)
        first = np.searchsorted(own, np.arange(n + 1) << 32)
        parted = [np.split(x, first[1:-1]) for x in (own & 0xFFFFFFFF, repeats)]
        body = [
            pa.array([task | number] * n, pa.int64()),
            *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))),
            pa.array(size),
            pa.array(np.diff(first)),
            *(pa.array([narrow(x) for x in some], pa.binary()) for some in parted),
            *(pa.array([None] * (n - 1) + [x], pa.list_(pa.int64())) for x in (coded.dictionary.to_pylist(), times.tolist())),
        ]
        head = pa.Table.from_batches(parts).combine_chunks().columns
        return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in head), *body], names=names)

    parts, rows, held, number = [], [], 0, 0
    for batch in batches:
        keyed, start = batch.select(range(keys)), 0
        for i, row in enumerate(_documents(found, _bodies(batch.column(keys)), False)):
            rows.append(row)
            held += len(row[3])
            if held >= stretch_links:
                yield stretch([*parts, keyed.slice(start, i + 1 - start)], rows, number)
                parts, rows, held, start, number = [], [], 0, i + 1, number + 1
        parts.append(keyed.slice(start))
    if rows:
        yield stretch(parts, rows, number)


def _counted(docs: pa.Table, counts: pa.Table, keys: int) -> pa.Table:
    """Documents of a stretch with the counts of its pairs looked up for their links."""
    total, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    place = counts["place"].to_numpy()
    total[place], best[place] = counts["total"].to_numpy(), counts["best"].to_numpy()
    sums = []
    for places, repeats, n in zip(docs["places"].to_pylist(), docs["repeats"].to_pylist(), docs["n_pairs"].to_pylist()):
        at, times = widened(places, n), widened(repeats, n)
        sums.append((int(best[at] @ times), int(total[at] @ times)))
    out = docs.select([*(f"k{i}" for i in range(keys)), "n_a", "n_b", "n_links", "groups_sha256"])
    for name, values in zip(("n_best", "count_sum"), zip(*sums)):
        out = out.append_column(name, pa.array(values, pa.int64()))
    return out


def _read(docs: DataFrame, key: list[str], text: str) -> tuple[DataFrame, str]:
    names = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(key)]
    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(key))
    return docs.select(*names, F.col(f"`{text}`").cast("string").alias("t")), kinds


def _stored_rows(docs: DataFrame, paths: tuple[str, str], key: list[str], text: str, stretch_links: int) -> tuple[DataFrame, str]:
    read, kinds = _read(docs, key, text)
    return stored(read.mapInArrow(lambda it: _rows(it, paths, len(key), stretch_links), kinds + STORED)), kinds


def _pairs(rows: DataFrame) -> DataFrame:
    """stretch, place, pair and times, a row for each different pair of a stretch."""
    tables = rows.where(F.col("pairs").isNotNull()).select("stretch", F.arrays_zip("pairs", "times").alias("z"))
    each = tables.select("stretch", F.posexplode("z").alias("place", "z"))
    return each.select("stretch", "place", F.col("z.pairs").alias("pair"), F.col("z.times").alias("times"))


def _totals(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("pair").agg(F.sum("times").alias("total"))


def pair_counts(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """a_id, b_id and total: how many links of the corpus hold each pair of ids."""
    rows, _ = _stored_rows(docs, (path_a, path_b), [], text, STRETCH_LINKS)
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(0xFFFFFFFF)
    return _totals(_pairs(rows)).select(a.alias("a_id"), b.alias("b_id"), "total")


def token_groups(docs: DataFrame, path_a: str, path_b: str, key: list[str], text: str = "text") -> DataFrame:
    """``key`` and the groups of every text as ``a1,a2|b1;a3|b2,b3``."""
    read, kinds = _read(docs, key, text)

    def work(batches):
        found = aligner(path_a, path_b)
        for batch in batches:
            groups = [r[4] for r in _documents(found, _bodies(batch.column(len(key))), True)]
            names = [*(f"k{i}" for i in range(len(key))), "groups"]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], pa.array(groups, pa.string())], names=names)

    out = read.mapInArrow(work, kinds + "groups string")
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(key)), "groups")


def alignment_counts(
    docs: DataFrame, path_a: str, path_b: str, key: list[str], text: str = "text", stretch_links: int = STRETCH_LINKS
) -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every text.

    n_best counts the links whose pair is the most frequent one of its B id in
    the corpus, ties included; count_sum adds up the frequencies of the links.
    """
    rows, kinds = _stored_rows(docs, (path_a, path_b), key, text, stretch_links)
    pairs = _pairs(rows)
    # A B id has no more pairs than A has ids, which bounds the window's groups.
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    totals = _totals(pairs).withColumn("best", (F.col("total") == F.max("total").over(same_b)).cast("bigint"))
    counts = pairs.select("stretch", "place", "pair").join(totals, "pair").drop("pair")
    kept = rows.drop("pairs", "times").withColumnRenamed("stretch", "of")
    out = kept.groupBy("of").cogroup(counts.groupBy("stretch"))
    found = out.applyInArrow(
        lambda a, b: _counted(a, b, len(key)),
        f"{kinds}n_a bigint, n_b bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint",
    )
    names = [F.col(f"k{i}").alias(c) for i, c in enumerate(key)]
    return found.select(*names, "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")
