"""Token ids of whole texts, word by word with a bounded cache in each worker."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

from rowloom.llm.id_cache import IdCache

CHUNK = 1 << 20
#: A key with a space is no word; it stands for the end of a text.
END = b" "
#: So many new words go to the tokenizer as one line.
LINE = 500
#: Lines are used with a tokenizer that gives this one as it gives its words.
PROBE = "Of words, aBc and I. Endings DEF. tóo, x, É. y".encode().split()


def _own(word: str) -> int:
    """Into how many words of its own a tokenizer with lines parts a word: letters, a stop or comma; 0 for other words."""
    return 1 if word.isalpha() else 2 if word[:-1].isalpha() and word[-1] in ".," else 0


class WordTokens:
    """Ids by a tokenizer that never joins across ASCII white space.

    Texts are cut at ASCII white space; each different word is encoded once
    while the cache holds it.
    """

    def __init__(self, path: str, end_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        #: The same without its normalizer, for lines that are normalized already.
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.cache = IdCache(self._learn)
        size, suffix = self.tokenizer.get_vocab_size(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: The ids that end one of the tokenizer's own words, if its model marks them.
        self.ending = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)], bool)
        known = self._in_lines([w.decode() for w in PROBE])
        self.lines = list(map(known.get, (w.decode() for w in PROBE))) == self._single(PROBE)

    def _single(self, words: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]

    def _in_lines(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of words of letters, many a call: a call for each costs more than its merges. Words of odd lines are left out."""
        line, normal = " ".join(words), self.tokenizer.normalizer
        same = line if normal is None else normal.normalize_str(line)
        if len(same := same.split(" ")) != len(words):
            return {}
        todo = [w for w in dict.fromkeys(same) if _own(w)]
        lines = [todo[k : k + LINE] for k in range(0, len(todo), LINE)]
        found: dict[str, list[int]] = {}
        for some, x in zip(lines, self.bare.encode_batch_fast([" ".join(some) for some in lines], add_special_tokens=False)):
            ids, counts = x.ids, np.cumsum(list(map(_own, some)))
            last = np.flatnonzero(self.ending[ids]) + 1
            if len(last) == counts[-1] and last[-1] == len(ids):
                ends = last[counts - 1].tolist()
                found.update((w, ids[a:b]) for w, a, b in zip(some, [0, *ends], ends))
        return {w: found[x] for w, x in zip(words, same) if x in found}

    def _learn(self, words: list[bytes]) -> list[list[int]]:
        texts = [w.decode() for w in words]
        known = self._in_lines([w for w in texts if _own(w)]) if self.lines else {}
        known[END.decode()] = [self.end_id]
        other = [w for w in texts if w not in known]
        known.update(zip(other, self._single([w.encode() for w in other])))
        return [known[w] for w in texts]

    def encode(self, words: list[bytes], part: list[int]) -> list[np.ndarray]:
        """Ids of consecutive runs of ``part[i]`` words."""
        ids, ends = self.cache.ids(words)
        return np.split(ids, np.concatenate([[0], ends])[np.cumsum(part)][:-1])

    def texts(self, bodies: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """(index, ids with the end id) of every text, in order; long texts are read in chunks."""
        words, part, owner = [], [], []

        def flush():
            done = self.encode(words, part) if part else []
            out = list(zip(owner, done))
            words.clear(), part.clear(), owner.clear()
            return out

        held = 0
        for i, body in enumerate(bodies):
            if len(body) <= CHUNK:
                some = body.split()
                some.append(END)
                words += some
                part.append(len(some))
                owner.append(i)
                held += len(body)
                if held > CHUNK:
                    yield from flush()
                    held = 0
                continue
            yield from flush()
            held, at, pieces = 0, 0, []
            while at < len(body):
                to = min(at + CHUNK, len(body))
                while to < len(body) and not body[to : to + 1].isspace():
                    to += 1
                some = body[at:to].split()
                pieces += self.encode(some, [len(some)])
                at = to
            yield i, np.concatenate([*pieces, np.array([self.end_id], "<u4")])
        yield from flush()


_kept: dict[tuple[str, int], WordTokens] = {}


def word_tokens(path: str, end_id: int = 0) -> WordTokens:
    """The worker's own tokenizer and cache, which live as long as the worker."""
    if (path, end_id) not in _kept:
        _kept[path, end_id] = WordTokens(path, end_id)
    return _kept[path, end_id]
