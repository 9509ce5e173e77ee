"""SentencePiece encoding by a streaming Viterbi lattice, and decoding.

For every place in a text the lattice holds the one last piece that the model's
merge order gives for the text up to there: among the pieces that end at the
place, the one that agrees with the last piece before it. Two neighbours agree
if their characters, merged on their own, give just these two. Back pointers
reach back no further than the longest piece, so only that window survives;
whenever the paths of all survivors meet in one boundary, the ids before it are
committed and dropped. No piece runs over the start of a run of spaces or over a
line break (checked when the model is loaded), so paths always meet there, and
the stretches between are kept in a bounded cache of each worker.

Results equal the library's for models whose pieces come from merges in order
of score, with byte fallback and without normalisation; others are refused.

* null and empty texts have no ids; white space and unknown characters survive
  the round trip; the mark U+2581 in a text decodes to a space, as in the library;
* long texts are read in chunks; repeated rows have equal results; empty in, empty out.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.id_cache import IdCache

MARK = "▁"
STRETCH = re.compile(rb" *[^ \n]+|\n| +")
CHUNK = 1 << 20
COMMIT_EVERY = 256
AGREED = 1_000_000
#: In the lattice, the id of a character without a piece; models that give it to a piece are refused.
NO_PIECE = 0
ONE = (1,)


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.bytes, self.ids, self.rank, self.raw = {}, {}, {}, [b""] * size
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece], self.rank[piece] = i, sp.get_score(i)
                self.raw[i] = piece.replace(MARK, " ").encode()
        self.longest = max(map(len, self.ids))
        two: dict[str, set[int]] = {}
        three: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 1:
                two.setdefault(piece[-2:], {1}).add(len(piece))
            if len(piece) > 2:
                three.setdefault(piece[-3:], {1}).add(len(piece))
        for end, lengths in three.items():
            lengths |= {2} & two[end[-2:]]
        #: Lengths of the pieces that end in three characters, and of those up to two that end in two, the longest first.
        self.three = {k: sorted(v, reverse=True) for k, v in three.items()}
        self.two = {k: sorted(v & {1, 2}, reverse=True) for k, v in two.items()}
        #: Length and text of the piece of an id; the length of ``NO_PIECE`` is one.
        self.length, self.piece = [1] * size, [""] * size
        for piece, i in self.ids.items():
            self.length[i], self.piece[i] = len(piece), piece
        self.agreed: dict[int, bool] = {}
        self.cache = IdCache(self._learn)
        odd = [p for p, i in self.ids.items() if i == NO_PIECE or "\n" in p or re.search(f"[^{MARK}]{MARK}", p)]
        if odd or len(self.bytes) < 256 or sp.encode("a  b½ﬁ") != self.encode("a  b½ﬁ".encode()).tolist():
            raise ValueError("the model's pieces cross spaces or lines, or it has no byte fallback, or it normalises")

    def agree(self, first: int, second: int) -> bool:
        """Whether two pieces' text, merged on its own (best score first, leftmost of equals), gives just these two.

        A merge over the border settles it early.
        """
        if len(self.agreed) > AGREED:
            self.agreed.clear()
        a, b = self.piece[first], self.piece[second]
        rank, parts, border, known = self.rank, list(a + b), len(a), False
        scores = [rank.get(x + y, -np.inf) for x, y in zip(parts, parts[1:])]
        while (best := max(scores, default=-np.inf)) > -np.inf:
            k = scores.index(best)
            if k == border - 1:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            border -= k < border
            if k:
                scores[k - 1] = rank.get(parts[k - 1] + parts[k], -np.inf)
            if k < len(scores):
                scores[k] = rank.get(parts[k] + parts[k + 1], -np.inf)
        else:
            known = parts == [a, b]
        self.agreed[first << 32 | second] = known
        return known

    def _learn(self, stretches: list[bytes]) -> list[list[int]]:
        """The ids of different stretches, in their order.

        A place's last piece depends on the text up to there alone, so of
        stretches in sorted order each goes on from the lattice of the front that it
        shares with the one before.
        """
        texts = [s.decode().replace(" ", MARK) for s in stretches]
        found: list[list[int]] = [[]] * len(texts)
        held, last = "", [NO_PIECE]
        for i in sorted(range(len(texts)), key=texts.__getitem__):
            text = texts[i]
            if len(text) > COMMIT_EVERY:
                found[i] = self.stretch(text)
                continue
            front = 0
            for x, y in zip(held, text):
                if x != y:
                    break
                front += 1
            del last[front + 1 :]
            self._extend(text, front, len(text), 0, last)
            found[i], held = self._path(0, len(text), text, last), text
        return found

    def stretch(self, text: str) -> list[int]:
        """The ids of a text whose spaces are marks, by the streaming lattice.

        ``last`` holds the id of the last piece for the places from ``done`` on; what is before is committed.
        """
        window, last, done, end, out, n = COMMIT_EVERY + self.longest, [NO_PIECE], 0, 0, [], len(text)
        while end < n:
            upto = min(n, max(end + 1, done + window))
            self._extend(text, end, upto, done, last)
            end, done = upto, self._commit(done, upto, text, last, out)
        return out

    def _extend(self, text: str, end: int, upto: int, done: int, last: list[int]) -> None:
        """Adds the last pieces of the places after ``end``, up to ``upto``.

        A place's back pointer is the start of its last piece. A character without a piece becomes bytes and
        never merges, so it agrees with all.
        """
        find, agreed, two, three = self.ids.get, self.agreed, self.two, self.three
        for end in range(end + 1, upto + 1):
            sizes = three.get(text[end - 3 : end]) if end > 2 else None
            if sizes is None:
                sizes = two.get(text[end - 2 : end], ONE) if end > 1 else ONE
            for size in sizes:
                start = end - size
                if start < done:
                    continue
                piece = find(text[start:end])
                if piece is not None:
                    before = last[start - done]
                    if before != NO_PIECE:
                        fits = agreed.get(before << 32 | piece)
                        if not (self.agree(before, piece) if fits is None else fits):
                            continue
                elif size == 1:
                    piece = NO_PIECE
                else:
                    continue
                last.append(piece)
                break

    def _commit(self, done: int, end: int, text: str, last: list[int], out: list[int]) -> int:
        """Appends the ids up to the boundary in which all surviving paths meet; returns the boundary."""
        at, length = end, self.length
        if end < len(text):
            alive = set(range(max(done, end - self.longest + 1), end + 1))
            while len(alive) > 1:
                furthest = max(alive)
                alive.remove(furthest)
                alive.add(furthest - length[last[furthest - done]])
            at = alive.pop()
        out += self._path(done, at, text, last)
        del last[: at - done]
        return at

    def _path(self, done: int, at: int, text: str, last: list[int]) -> list[int]:
        """The ids from ``done`` to ``at``, along the back pointers."""
        path, k, length = [], at, self.length
        while k > done:
            piece = last[k - done]
            if piece == NO_PIECE:
                path.extend(self.bytes[x] for x in reversed(text[k - 1].encode()))
            else:
                path.append(piece)
            k -= length[piece]
        path.reverse()
        return path

    def encode(self, body: bytes) -> np.ndarray:
        """The ids of a whole text."""
        if not body:
            return np.zeros(0, "<u4")
        out, at, body = [], 0, b" " + body.replace(MARK.encode(), b" ")
        while at < len(body):
            to = min(at + CHUNK, len(body))
            if to < len(body):
                # Cut before a line break, which is a stretch of its own, or before the spaces of a word.
                while to < len(body) and not (body[to : to + 1] == b"\n" or body[to : to + 1] == b" " != body[to - 1 : to]):
                    to += 1
            out.append(self.cache.ids(STRETCH.findall(body, at, to))[0])
            at = to
        return np.concatenate(out)

    def texts(self, bodies: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The ids of every text, in order; stretches of short texts are looked up together."""
        some: list[bytes] = []
        part: list[int] = []
        held = 0

        def flush():
            ids, ends = self.cache.ids(some)
            done = np.split(ids, np.concatenate([[0], ends])[np.cumsum(part)][:-1]) if part else []
            some.clear(), part.clear()
            return done

        for body in bodies:
            if len(body) > CHUNK:
                yield from flush()
                held = 0
                yield self.encode(body)
                continue
            found = STRETCH.findall(b" " + body.replace(MARK.encode(), b" ")) if body else []
            some += found
            part.append(len(found))
            held += len(body)
            if held > CHUNK:
                yield from flush()
                held = 0
        yield from flush()

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids.tolist()))[1:] if len(ids) else b""


_kept: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    if path not in _kept:
        _kept[path] = PieceModel(path)
    return _kept[path]


def _digests(batches: Iterator[pa.RecordBatch], path: str, keys: int) -> Iterator[pa.RecordBatch]:
    model = piece_model(path)
    for batch in batches:
        rows, bodies = [], [x.as_py() or b"" for x in batch.column(keys).cast(pa.binary())]
        for body, ids in zip(bodies, model.texts(bodies)):
            back = model.decode(ids)
            rows.append((len(ids), zlib.crc32(ids.tobytes()), back == body, hashlib.sha256(back).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        columns = [pa.array(v, k) for v, k in zip(zip(*rows) if rows else [()] * 4, kinds)]
        names = [*(f"k{i}" for i in range(keys)), "n_ids", "ids_crc32", "round_trip", "decoded_sha256"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:keys], *columns], names=names)


def piece_digests(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_ids, ids_crc32, round_trip and decoded_sha256 of every text, encoded and decoded."""
    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    read = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").cast("string").alias("t"))
    kinds += "n_ids bigint, ids_crc32 bigint, round_trip boolean, decoded_sha256 string"
    out = read.mapInArrow(lambda it: _digests(it, path, len(keep)), kinds)
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "n_ids", "ids_crc32", "round_trip", "decoded_sha256")


def encoded(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of a text column."""
    names = [c for c in docs.columns if c != out]

    def work(batches):
        model = piece_model(path)
        for batch in batches:
            at = batch.schema.names.index("__t")
            ids = [x.tolist() for x in model.texts(x.as_py() or b"" for x in batch.column(at).cast(pa.binary()))]
            columns = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f"k{i}" for i in range(len(names))), "ids"])

    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(names)) + "ids array<int>"
    read = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)), F.col(f"`{text}`").cast("string").alias("__t"))
    return read.mapInArrow(work, kinds).select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(names)), F.col("ids").alias(out))
