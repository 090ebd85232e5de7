"""Token ids of whole texts by a public word-level BPE vocabulary.

The vocabulary cuts a lower-cased text into pre-tokens (English clitics, runs of
letters, single digits, runs of other signs) and merges inside each of them, so
the ids of a text are the ids of its pre-tokens, in order.  Each Python worker
keeps a bounded cache pre-token -> ids, whose size changes time and memory only.  The pre-tokens of about ``SLICE``
characters of texts that are not cached are merged together, as arrays, by the
vocabulary's own merge list; very long ones go through the tokenizer.  Texts with
characters for which Python's and the tokenizer's case, white-space or composition
rules could differ go through the tokenizer whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np

from finlake.llm.common import release

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE = 400_000   # pre-tokens per generation and worker (about 100 bytes each)
SLICE = 1 << 21   # characters cut and looked up at a time, at most
LONGEST = 32      # bytes of a pre-token that is merged here
_LAST = 0x17F     # letters up to here (Latin, whose small letters stay below) are cut by Python itself
_UNUSUAL = re.compile("[^\x00-\x1b\x20-\x84\x86-įı-ſ]")
_U = np.uint64
_SLOTS = 19


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_LAST + 1) if unicodedata.category(chr(c))[0] == kind)


# the vocabulary's own pre-token pattern, on characters up to _LAST
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^\s{_class('L')}{_class('N')}]+")


def byte_alphabet() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable Latin-1 signs stand
    for themselves, the other bytes are numbered from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Merges:
    """The vocabulary's merge list, applied to many words of one length at once."""

    NONE = np.int32(2 ** 31 - 1)

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        signs = byte_alphabet()
        self.inner = np.array([ids[s] for s in signs], np.int32)
        self.last = np.array([ids[s + end] for s in signs], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.uint64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.tables = []  # hash tables (multiplier, keys, ranks): a pair whose slot is taken is in a later one
        left = np.arange(len(keys))
        mult = 0x9E3779B97F4A7C15
        while len(left):
            at = (keys[left] * _U(mult)) >> _U(64 - _SLOTS)
            _, first = np.unique(at, return_index=True)
            key, rank = np.full(1 << _SLOTS, 2 ** 64 - 1, np.uint64), np.full(1 << _SLOTS, self.NONE, np.int32)
            key[at[first]], rank[at[first]] = keys[left[first]], left[first]
            self.tables.append((_U(mult), key, rank))
            left = np.delete(left, first)
            mult = (mult * 0xD6E8FEB86659FD93 + 2) % 2 ** 64 | 1
        del model, ids, pairs  # the file as Python objects is several times its arrays
        release()

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbours in the merge list; NONE for no merge."""
        pair = a.astype(np.uint64) << _U(32) | b.astype(np.uint64)
        out = np.full(pair.shape, self.NONE, np.int32)
        for mult, key, rank in self.tables:
            at = (pair * mult) >> _U(64 - _SLOTS)
            out = np.where(key[at] == pair, rank[at], out)
        return out

    def words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of one length: in every step each word merges its pair of lowest rank (the
        leftmost of them), so words that are not finished stay equally long."""
        x = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        ids = self.inner[x]
        ids[:, -1] = self.last[x[:, -1]]
        out: list[np.ndarray] = [ids[0]] * len(words)
        place = np.arange(len(words))
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while len(place):
            n = ids.shape[1]
            rows = np.arange(len(place))
            at = rank.argmin(1) if n > 1 else np.zeros(len(place), np.int64)
            best = rank[rows, at] if n > 1 else np.full(len(place), self.NONE)
            ready = best == self.NONE
            if ready.any():
                for p, done in zip(place[ready].tolist(), ids[ready]):
                    out[p] = done
                ids, rank, at, best, place = ids[~ready], rank[~ready], at[~ready], best[~ready], place[~ready]
                rows = np.arange(len(place))
            if not len(place):
                break
            cols = np.arange(n - 1)
            ids = ids[rows[:, None], cols + (cols > at[:, None])]
            ids[rows, at] = self.merged[best]
            cols = np.arange(n - 2)
            rank = rank[rows[:, None], cols + (cols >= at[:, None])]
            for side in (at - 1, at):  # the pairs that the new sign makes
                on = np.flatnonzero((side >= 0) & (side < n - 2))
                rank[on, side[on]] = self.ranks(ids[on, side[on]], ids[on, side[on] + 1])
        return out


class Known:
    """Pre-tokens with their ids: a number per pre-token, and all ids end to end."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 15, np.int64)
        self.used = 0

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add pre-tokens that are not known yet; ``ids`` holds theirs one after another."""
        n = len(self.number)
        self.number.update(zip(pieces, range(n, n + len(pieces))))
        ends = self.used + np.cumsum(sizes)
        self.ids = _room(self.ids, int(ends[-1]) + 1)
        self.start = _room(self.start, n + len(pieces) + 1)
        self.ids[self.used:ends[-1]] = ids
        self.start[n + 1:n + 1 + len(pieces)] = ends  # an entry ends where the next one starts
        self.used = int(ends[-1])

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered pre-tokens, end to end, and how many each of them has."""
        first = self.start[at]
        size = self.start[at + 1] - first
        before = np.cumsum(size) - size
        return self.ids[np.repeat(first - before, size) + np.arange(int(size.sum()))], size


def _room(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


class CachedTokenizer:
    def __init__(self, path: str, cache: int | None = None):
        self.path = path
        self.cache = cache or CACHE
        self.slice = min(SLICE, 8 * self.cache)
        self.merges = Merges(path)
        self.warm, self.cold = Known(), Known()

    @functools.cached_property
    def full(self):
        """The tokenizer itself, made when a text needs it (it is large)."""
        from tokenizers import Tokenizer
        full = Tokenizer.from_file(self.path)
        full.encode_special_tokens = True
        return full

    def _raw(self, text: str) -> np.ndarray:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian uint32 ids of every text (null: none)."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if _UNUSUAL.search(text):
                out[i].append(self._raw(text).astype("<u4").tobytes())
                continue
            for part in _slices(text, self.slice):
                waiting.append((i, _PIECE.findall(part.lower())))
                size += len(part)
                if size >= self.slice:
                    self._look_up(waiting, out)
                    waiting, size = [], 0
        self._look_up(waiting, out)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _look_up(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if len(self.warm.number) > self.cache:  # the warm half becomes the cold one, whose unused entries go
            self.cold, self.warm = self.warm, Known()
        if not waiting:
            return
        count = np.array([len(pieces) for _, pieces in waiting])
        pieces = list(chain.from_iterable(p for _, p in waiting))
        at = np.fromiter(map(self.warm.number.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._learn({pieces[i] for i in new})
            at[new] = [self.warm.number[pieces[i]] for i in new]
        ids, size = self.warm.gather(at)
        data = ids.astype("<u4").tobytes()
        ends = 4 * np.r_[0, np.cumsum(size)][np.cumsum(count)]
        lo = 0
        for (i, _), hi in zip(waiting, ends.tolist()):
            out[i].append(data[lo:hi])
            lo = hi

    def _learn(self, missing: set[str]) -> None:
        """Entries come back from the cold half or from the merge list."""
        old = [p for p in missing if p in self.cold.number]
        if old:
            self.warm.add(old, *self.cold.gather(np.array([self.cold.number[p] for p in old])))
        by_size: dict[int, list[str]] = {}
        for p in missing:
            if p not in self.cold.number:
                by_size.setdefault(len(p) if p.isascii() else len(p.encode()), []).append(p)
        for size, pieces in by_size.items():
            ids = [self._raw(p) for p in pieces] if size > LONGEST else self.merges.words([p.encode() for p in pieces])
            self.warm.add(pieces, np.concatenate(ids), np.array([len(x) for x in ids]))


def _slices(text: str, size: int) -> Iterator[str]:
    """The text, cut after spaces into parts of about ``size`` characters."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + size)
        end = len(text) if end < 0 else end + 1
        yield text[at:end] if at or end < len(text) else text
        at = end


@functools.lru_cache(maxsize=2)
def tokenizer(path: str, cache: int | None = None) -> CachedTokenizer:
    return CachedTokenizer(path, cache)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
