"""Operator 4: subword-lattice language model.

A text's probability is the sum over all ways to cut its words into pieces of a
public subword vocabulary, computed in log space by a forward recursion over
each word's bytes.  A word starts with one word-initial piece and goes on with
inner pieces; every piece has one probability to go on and one to end the word, so
the probabilities of all words sum to one.

The vocabulary and its scores exist already (``piece_bpe_32k.model``).  A score
is minus a rank, and rank r weighs 1 / (r + 3), the usual law of ranks.  These
weights are the prior, and ``EM_STEPS`` expectation-maximisation steps (forward-
backward over every distinct training word) fit them to the training documents.
Every training word is also an arc of its own from the word's start to its end: it
takes its count less ``DISCOUNT``, and the discounts together, one per distinct
word, are the weight of the subword lattice; so each distinct word counts once there.

A document repeats its own words: it draws them from an urn that starts with
``alpha`` parts of the word probabilities and gets one part more of every word
drawn, so a word's n-th use is likelier than its first.  The probability of the
draws depends on the words' counts alone and is closed (gamma functions).  A
document's probability is the mean over the ``ALPHAS``; the last ones hardly adapt.

Counts are gathered from all training documents: pre-aggregated per task, summed
by a shuffle on the word.  To score, the ``FREQUENT`` most frequent words (a
bounded list) go to every task, which settles most of a text there; only the
rarer words of each document meet the word table in a shuffled join.

Defined results: null text is empty and has the end only; null ids fold like the
empty text; repeated rows are counted and scored each; without training rows the
lattice prior alone scores, end and words at equal odds; extra columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import fold, id_text, stage

PRIOR = 2000.0  # tokens that the existing scores count for
EM_STEPS = 3
DISCOUNT = 0.7
FREQUENT = 100_000
ALPHAS = tuple(10.0 ** e for e in (1.5, 2, 2.5, 3, 3.5, 4, 5, 6))
END = b"\n"  # cannot be a word
_FLUSH = 300_000  # distinct words that a task holds before it writes them
_U = np.uint64
_BASE = _U(0x100000001B3)
_SLOTS = 20


class Pieces:
    """The vocabulary: piece bytes, prior weights, lookup by polynomial hash.

    Index 0.. of the inner pieces, then of the word-initial ones.  Probabilities
    have twice that length: going on, then ending the word.
    """

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        inner: dict[bytes, float] = {}
        first: dict[bytes, float] = {}
        size = model.get_piece_size()
        for i in range(size):
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            name, rank = model.id_to_piece(i), -model.get_score(i)
            if model.is_byte(i):
                inner.setdefault(bytes([int(name[3:5], 16)]), 1 / (size + 3))
                continue
            to, name = (first, name[1:]) if name.startswith("▁") else (inner, name)
            data = name.replace("▁", " ").encode().lower()
            if b" " not in data and rank <= size:
                to[data] = to.get(data, 0.0) + 1 / (rank + 3)
        first.setdefault(b"", 1 / (size + 3))
        inner.pop(b"", None)
        for byte in range(256):
            inner.setdefault(bytes([byte]), 1 / (size + 3))
        self.names = [*inner, *first]
        self.inner, self.first = len(inner), len(first)
        self.size = self.inner + self.first
        w = np.array([*inner.values(), *first.values()])
        self.prior = np.r_[w * 0.7, w * 0.3]  # a word has about three pieces
        self.empty = self.names.index(b"", self.inner)
        self.tables = [self._table(0, self.inner), self._table(self.inner, self.inner + self.first)]
        self.prior[self.size + self.empty] = 0  # no word is empty
        self.longest = [max(map(len, inner)), max(map(len, first))]

    def _table(self, low: int, high: int):
        """Two open tables: a piece whose slot is taken in one is in the other."""
        keys = np.zeros(high - low, np.uint64)
        for i, name in enumerate(self.names[low:high]):
            h = 0
            for byte in name:
                h = (h * int(_BASE) + byte + 1) & (2 ** 64 - 1)
            keys[i] = h
        tables, left = [], np.arange(high - low)
        mult = 0x9E3779B97F4A7C15
        while len(left):
            slot = np.full(1 << _SLOTS, -1, np.int32)
            m = _U(mult)
            at = (keys[left] * m) >> _U(64 - _SLOTS)
            _, where = np.unique(at, return_index=True)
            slot[at[where]] = left[where]
            tables.append((m, slot))
            left = np.delete(left, where)
            mult = (mult * 0xD6E8FEB86659FD93 + 2) & (2 ** 64 - 1) | 1
        return low, keys, tables

    def lookup(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """Piece index of each hashed substring, -1 for none."""
        low, own, tables = self.tables[kind]
        flat = keys.ravel()
        out = np.full(len(flat), -1, np.int64)
        left = np.arange(len(flat))
        for m, slot in tables:
            got = slot[(flat[left] * m) >> _U(64 - _SLOTS)]
            taken = np.flatnonzero(got >= 0)
            left, got = left[taken], got[taken]
            same = own[got] == flat[left]
            out[left[same]] = got[same] + low
            left = left[~same]  # its slot holds another piece: the next table may have it
        return out.reshape(keys.shape)

    def fit(self, expected: np.ndarray) -> np.ndarray:
        """Probabilities from expected counts plus the prior: inner pieces sum to
        one over going on and ending, so do the word-initial ones."""
        out = (expected + PRIOR * self.prior / self.prior.sum()).reshape(2, self.size)
        out[:, :self.inner] /= out[:, :self.inner].sum()
        out[:, self.inner:] /= out[:, self.inner:].sum()
        return out.ravel()


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _lse(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=1, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(terms - top).sum(axis=1)) + top[:, 0]


def _block(vocab: Pieces, log_p: np.ndarray, words: list[bytes]):
    """Forward pass over words of one length: alpha, inner arcs by length (index
    into the probabilities and log probability), initial arcs, log marginal."""
    n, size = len(words), len(words[0])
    x = np.frombuffer(b"".join(words), np.uint8).reshape(n, size).astype(np.uint64)
    padded = np.r_[log_p, -np.inf]  # index -1: no piece
    ends = lambda a: np.where(a >= 0, a + vocab.size, -1)  # noqa: E731  an arc to the word's end
    alpha = np.full((n, size + 1), -np.inf)
    alpha[:, 0] = log_p[vocab.empty]
    arcs, key = {}, np.zeros((n, size), np.uint64)
    first = np.full((n, size + 1), -1, np.int64)
    for m in range(1, min(size, max(vocab.longest)) + 1):
        key = key[:, :size - m + 1] * _BASE + x[:, m - 1:] + _U(1)
        arcs[m] = vocab.lookup(key, 0)
        arcs[m][:, -1] = ends(arcs[m][:, -1])
        first[:, m] = vocab.lookup(key[:, 0], 1)
    first[:, size] = ends(first[:, size])
    start = padded[first]
    logs = {m: padded[a] for m, a in arcs.items()}
    for j in range(1, size + 1):
        terms = [start[:, j]] + [alpha[:, j - m] + logs[m][:, j - m] for m in arcs if m <= j]
        alpha[:, j] = _lse(np.stack(terms, 1))
    return alpha, arcs, logs, first, start, alpha[:, size]


def _by_length(words: list[bytes]):
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    i = 0
    while i < len(order):
        size = len(words[order[i]])
        most = max(1, 200_000 // (size * min(size, 16)))
        j = i
        while j < len(order) and j - i < most and len(words[order[j]]) == size:
            j += 1
        yield order[i:j]
        i = j


def log_marginals(vocab: Pieces, p: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural log of each word's probability, summed over all segmentations."""
    with np.errstate(divide="ignore"):
        log_p, out = np.log(p), np.empty(len(words))
    for at in _by_length(words):
        out[at] = _block(vocab, log_p, [words[i] for i in at])[-1]
    return out


def expected_counts(vocab: Pieces, p: np.ndarray, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Expected uses of every piece, going on and ending, by forward-backward."""
    with np.errstate(divide="ignore"):
        log_p, out = np.log(p), np.zeros(len(p))
    for at in _by_length(words):
        c = counts[at].astype(np.float64)
        alpha, arcs, logs, first, start, total = _block(vocab, log_p, [words[i] for i in at])
        n, size = alpha.shape[0], alpha.shape[1] - 1
        beta = np.full((n, size + 1), -np.inf)
        beta[:, size] = 0
        for i in range(size - 1, -1, -1):
            beta[:, i] = _lse(np.stack([logs[m][:, i] + beta[:, i + m] for m in arcs if i + m <= size], 1))
        for m, a in arcs.items():
            share = np.exp(alpha[:, :size - m + 1] + logs[m] + beta[:, m:] - total[:, None]) * c[:, None]
            hit = a >= 0
            out += np.bincount(a[hit], weights=share[hit], minlength=len(p))
        share = np.exp(start + beta - total[:, None]) * c[:, None]
        hit = first >= 0
        out += np.bincount(first[hit], weights=share[hit], minlength=len(p))
        out[vocab.empty] += (np.exp(log_p[vocab.empty] + beta[:, 0] - total) * c).sum()
    return out


def _count_words(batches):
    train: Counter = Counter()
    other: Counter = Counter()

    def emit():
        words = [*train, *(w for w in other if w not in train)]
        got = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([train.get(w, 0) for w in words], pa.int64()),
             pa.array([other.get(w, 0) for w in words], pa.int64())], names=["word", "c", "other"])
        train.clear()
        other.clear()
        return got

    for b in batches:
        for held_out, text in zip(b.column("held_out").to_pylist(), b.column("text").to_pylist()):
            ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
            ws.append(END)
            (other if held_out else train).update(ws)
            if len(train) + len(other) > _FLUSH:
                yield emit()
    yield emit()


def _gathered(batches, rows: int = 50_000, size: int = 8 << 20):
    """Join small batches: the recursion runs over many words of one length at once."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= rows or sum(x.nbytes for x in held) >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _expect(path: str, p: np.ndarray):
    def run(batches):
        vocab, total = pieces(path), np.zeros(len(p))
        for b in _gathered(batches):
            total += expected_counts(vocab, p, b.column("word").to_pylist(), np.ones(len(b)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["piece", "uses"])
    return run


class Model:
    """log10 probabilities of tokens; small enough to go to every task."""

    def __init__(self, path: str, p: np.ndarray, total: int, types: int, end_count: int, words: int):
        self.path, self.p = path, p
        self.total, self.types, self.end_count, self.words = total, types, end_count, words

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.types + 1)))

    def tokens(self, words: list[bytes], c: np.ndarray) -> np.ndarray:
        """log10 P of each word (``c``: its training count)."""
        log_lat = log_marginals(pieces(self.path), self.p, words) if words else np.zeros(0)
        if not self.words:  # no training words: the lattice alone, words and end at odds
            room = 0.5 if not self.end_count else 1 / (self.end_count + 2)
            return (log_lat + math.log(room)) / math.log(10)
        own = np.maximum(c - DISCOUNT, 0) / self.total
        spare = DISCOUNT * self.words / self.total
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(own), log_lat + math.log(spare)) / math.log(10)

    def end(self) -> float:
        return math.log10(self.end_count / self.total) if self.words else math.log10(
            0.5 if not self.end_count else 1 - 1 / (self.end_count + 2))

    def stay(self) -> float:
        """log10 P of another word, whichever."""
        return math.log10(1 - 10 ** self.end())


def _word_scores(model: Model):
    def run(batches):
        for b in _gathered(batches):
            words, c = b.column("word").to_pylist(), b.column("c").to_numpy()
            if len(words):
                yield pa.RecordBatch.from_arrays(
                    [b.column("word"), b.column("c"), pa.array(model.base(c)), pa.array(model.tokens(words, c))],
                    names=["word", "c", "base", "score"])
    return run


def log_gamma(y, log=np.log):
    """ln Gamma(y) for y >= 1, of arrays or (with ``F.log``) of columns: Stirling's
    series eight steps further up; the error is below 1e-9."""
    steps = y
    for i in range(1, 8):
        steps = steps * (y + i)
    z = y + 8
    s = 1 / (z * z)
    return (z - 0.5) * log(z) - z + 0.5 * math.log(2 * math.pi) + (1 / 12 - s * (1 / 360 - s / 1260)) / z - log(steps)


_PART = ("doc_id long, row long, held_out boolean, n_tokens long, n_known long, base double, "
         "parts array<double>, word binary, times long")


def _score_task(model: Model, known: dict[bytes, tuple[bool, float, float]]):
    """Per document one row with all that its frequent words settle, and one row per rare word."""
    def run(batches):
        row = TaskContext.get().partitionId() << 33
        end_base, end_score, stay = float(model.base(np.array([model.end_count]))[0]), model.end(), model.stay()
        end_known = int(model.end_count > 0)
        alpha = np.array(ALPHAS)[:, None]
        names = [x.split()[0] for x in _PART.split(", ")]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(),
                 pa.list_(pa.float64()), pa.binary(), pa.int64()]
        out: list[tuple] = []
        docs: list[tuple[int, int, float]] = []  # words, distinct settled words, sum of their log10 shares
        again: list[tuple[int, float, int]] = []  # document, log10 share, times: words that come again

        def emit():
            n, types_of, logs = (np.array(c, np.float64) for c in zip(*docs))
            parts = end_score + n * stay + logs + types_of * np.log10(alpha) - (
                log_gamma(alpha + n) - log_gamma(alpha)) / math.log(10)
            for i in range(0, len(again), 20_000):
                doc, share, times = zip(*again[i:i + 20_000])
                x = alpha * 10 ** np.array(share)
                more = (log_gamma(x + np.array(times)) - log_gamma(x + 1)) / math.log(10)
                for a, weights in enumerate(more):
                    parts[a] += np.bincount(doc, weights=weights, minlength=len(docs))
            settled = iter(parts.T.tolist())
            columns = [list(c) for c in zip(*out)]
            columns[6] = [next(settled) if first else None for first in columns[6]]
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            for held in (out, docs, again):
                held.clear()
            return got

        for b in batches:
            for doc_id, held_out, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
                ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
                seen, base, logs, settled, rare = end_known, end_base, 0.0, 0, []
                for w, k in Counter(ws).items():
                    got = known.get(w)
                    if got is None:
                        rare.append((w, k))
                    else:
                        seen += k * got[0]
                        base += k * got[1]
                        logs += got[2]
                        settled += 1
                        if k > 1:
                            again.append((len(docs), got[2], k))
                docs.append((len(ws), settled, logs))
                # what is settled travels with the first rare word, or with a key of no word
                w, k = rare[0] if rare else (b" %d" % (row % 4096), 0)
                out.append((doc_id, row, held_out, len(ws) + 1, seen, base, True, w, k))
                out.extend((doc_id, row, held_out, 0, 0, 0.0, False, w, k) for w, k in rare[1:])
                row += 1
                if len(out) > 50_000 or len(again) > 200_000:
                    yield emit()
        if out:
            yield emit()
    return run


def learn(docs: DataFrame, path: str | None = None, em_steps: int = EM_STEPS) -> tuple[Model, DataFrame]:
    """Model and word table (word, c: training count, other: further count) from
    rows (text, held_out)."""
    path = path or default_vocabulary()
    words = stage(docs.select("text", "held_out").mapInArrow(
        _count_words, "word binary, c long, other long")
        .groupBy("word").agg(F.sum("c").alias("c"), F.sum("other").alias("other")), "words")
    end = F.col("word") == F.lit(END)
    s = words.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v"),
                  F.sum(F.when(end, F.col("c"))).alias("e"),
                  F.sum(F.when(~end, F.col("c").cast("boolean").cast("long"))).alias("w")).first()
    vocab = pieces(path)
    p = vocab.fit(np.zeros(len(vocab.prior)))
    train = words.filter(~end & (F.col("c") > 0)).select("word")
    for _ in range(em_steps if s["w"] else 0):
        uses = np.zeros(len(p))
        for r in train.mapInArrow(_expect(path, p), "piece int, uses double").groupBy("piece").agg(
                F.sum("uses").alias("uses")).collect():  # at most one row per piece
            uses[r["piece"]] = r["uses"]
        p = vocab.fit(uses)
    return Model(path, p, s["n"] or 0, s["v"] or 0, s["e"] or 0, s["w"] or 0), words.filter(~end)


def _frequent_from(words: DataFrame, frequent: int) -> int:
    """The smallest count from which on at most ``frequent`` words are counted, by
    a histogram of counts in eighths of a power of two."""
    step = F.floor(F.log2(F.col("c") + F.col("other")) * 8)
    seen, least = 0, 1 << 62
    for r in words.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min(
            F.col("c") + F.col("other")).alias("low")).orderBy(F.col("s").desc()).collect():  # 512 rows at most
        seen += r["n"]
        if seen > frequent:
            break
        least = r["low"]
    return least


def score(docs: DataFrame, model: Model, words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Score rows (doc_id, text, held_out): one row each."""
    least = _frequent_from(words, frequent)
    total = F.col("c") + F.col("other")
    top = words.filter(total >= least).select("word", "c").toArrow()  # at most ``frequent`` rows
    names, c = top.column("word").to_pylist(), top.column("c").to_numpy()
    known = {w: (bool(k), float(x), float(y)) for w, k, x, y in
             zip(names, c, model.base(c), model.tokens(names, c) - model.stay())}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model, known))  # bounded by ``frequent``

    def task(batches):
        return _score_task(*shared.value)(batches)

    parts = docs.select("doc_id", "text", "held_out").mapInArrow(task, _PART)
    table = words.filter(total < least).select("word", "c").mapInArrow(
        _word_scores(model), "word binary, c long, base double, score double")
    table = table.select("word", (F.col("c") > 0).cast("long").alias("_k"), F.col("base").alias("_b"),
                         (F.col("score") - model.stay()).alias("_s"))
    joined = parts.join(table, "word", "left")
    add = lambda own, part: F.sum(F.col(own) + F.coalesce(F.col("times") * F.col(part), F.lit(0)))
    urns = [F.sum(F.coalesce(F.element_at("parts", i + 1), F.lit(0.0)) + F.coalesce(_urn(a), F.lit(0.0))).alias(f"_u{i}")
            for i, a in enumerate(ALPHAS)]
    out = joined.groupBy("doc_id", "row", "held_out").agg(
        F.sum("n_tokens").alias("n_tokens"), add("n_known", "_k").alias("n_known"),
        add("base", "_b").alias("base_score"), *urns)
    each = [F.col(f"_u{i}") for i in range(len(ALPHAS))]
    top = F.greatest(*each)
    total = functools.reduce(lambda a, b: a + b, [F.pow(F.lit(10.0), u - top) for u in each])
    return out.select("doc_id", "held_out", "n_tokens", "n_known",
                      F.lit(model.total).cast("long").alias("train_tokens"), "base_score",
                      (top + F.log10(total / len(each))).alias("score"))


def _urn(alpha: float):
    """log10 of a rare word's part in a document: its share ``_s``, drawn ``times`` times."""
    x = alpha * F.pow(F.lit(10.0), F.col("_s"))
    more = (log_gamma(x + F.col("times"), F.log) - log_gamma(x + 1, F.log)) / math.log(10)
    return math.log10(alpha) + F.col("_s") + F.when(F.col("times") > 1, more).otherwise(0.0)


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from nine tenths of the documents (by id), score all of them."""
    rows = id_text(docs).withColumn("held_out", fold(F.col("doc_id"), 10) == 0)
    model, words = learn(rows)
    return score(rows, model, words)
