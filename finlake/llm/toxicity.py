"""Operator 3: toxicity as cumulative-link ordinal regression.

P(grade > k) = sigmoid(w . x - cut_k) with one weight vector shared by all
ordered cuts.  x are sparse word features: words and their beginnings of
``STEMS`` letters (inflected forms share them), hashed to ``2**BITS`` columns and
valued by their share of the text (times 100, square root, so rare strong words
count without long texts being blurred).  The output is the expected severity
sum_k P(grade > k) and the most likely grade.

Labels only say toxic or not, so the grades above 0 are read off the labelled
sample itself: the words that toxic texts use far more often than others form a
word list, and toxic texts are graded 1..``GRADES`` by how much of the text that
list makes up (equal-sized classes).  Grade 0: not toxic.

Only columns are used that occur in at least ``MIN_DOCS`` of the sampled texts and
whose presence in toxic and other texts differs by ``MIN_Z`` standard errors.

Training uses a bounded sample: at most ``max_docs`` labelled documents per
class, in the order of a hash of the id, fitted by Adam in numpy on the driver.
Scoring covers every whole text.

Defined results: null or empty text has no features (grade by the cuts alone);
labels without a document and null labels are not learned from; of several
labels of one id the highest counts; no labelled rows: severity 0; extra columns
are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import fold, id_text
from finlake.llm.words import hash_words, words

BITS = 18
STEMS = (4, 5, 6)
MIN_DOCS, MIN_Z = 3, 4.0
GRADES = 3
_WORDS = 300_000
_STRIP = b".,;:!?\"'()[]|"


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Column numbers (ascending) and values of a text."""
    ws = words(text)
    counts: Counter = Counter()
    for w, k in Counter(ws).items():
        for name in _names(w):
            counts[name] += k
    if not counts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    share = np.bincount(_columns(list(counts)), weights=np.fromiter(counts.values(), np.float64, len(counts)))
    at = np.flatnonzero(share)
    return at.astype(np.int32), np.sqrt(100 * share[at] / len(ws)).astype(np.float32)


def _names(word: bytes) -> list[bytes]:
    """Feature names of a word: the word itself and its beginnings."""
    word = word.strip(_STRIP)
    if not word:
        return []
    letters = word.decode("utf-8", "surrogatepass")
    return [b"w" + word, *(b"s" + letters[:n].encode("utf-8", "surrogatepass") for n in STEMS if len(letters) >= n)]


def _columns(names: list[bytes]) -> np.ndarray:
    return (hash_words(names) >> np.uint64(64 - BITS)).astype(np.int32)


class OrdinalModel:
    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, one row per score."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.cuts[None], -40, 40)))

    def severity(self, score: np.ndarray) -> np.ndarray:
        return self.above(score).sum(1)


def fit(cols: list[np.ndarray], vals: list[np.ndarray], grade: np.ndarray, epochs: int = 60,
        rate: float = 0.05, decay: float = 2e-5) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model; Adam on all rows at once.
    The cuts are a first cut plus positive steps, so they stay in order."""
    used = telling(cols, grade > 0)
    vals = [v[used[c]] for c, v in zip(cols, vals)]
    cols = [c[used[c]] for c in cols]
    row = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    col = np.concatenate(cols) if cols else np.zeros(0, int)
    val = np.concatenate(vals).astype(np.float64) if vals else np.zeros(0)
    n, top = len(cols), int(grade.max(initial=0))
    steps = max(top, 1)
    w = np.zeros(1 << BITS)
    free = np.r_[2.0, np.zeros(steps - 1)]  # first cut, logs of the steps
    size = np.bincount(grade, minlength=top + 1)
    weight = (n / (2.0 * np.where(grade > 0, size[1:].sum(), size[0])))  # both sides count alike
    m = [np.zeros_like(w), np.zeros_like(free)]
    s = [np.zeros_like(w), np.zeros_like(free)]
    for t in range(1, epochs + 1):
        cuts = np.cumsum(np.r_[free[0], np.exp(free[1:])])
        z = np.bincount(row, weights=val * w[col], minlength=n)
        up = 1 / (1 + np.exp(-np.clip(z[:, None] - cuts, -40, 40)))  # P(grade > k)
        p = np.c_[np.ones(n), up]
        q = np.c_[up, np.zeros(n)]
        mass = np.maximum(p[np.arange(n), grade] - q[np.arange(n), grade], 1e-9)
        slope = np.c_[np.zeros(n), up * (1 - up), np.zeros(n)]
        low, high = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        dz = -weight * (low - high) / mass / n
        dcut = np.zeros((n, steps + 2))
        dcut[np.arange(n), grade] += weight * low / mass / n
        dcut[np.arange(n), grade + 1] -= weight * high / mass / n
        g_cut = dcut[:, 1:-1].sum(0)
        tail = np.cumsum(g_cut[::-1])[::-1]
        g = [np.bincount(col, weights=val * dz[row], minlength=1 << BITS) + decay * w,
             np.r_[tail[0], tail[1:] * np.exp(free[1:])]]
        for i, x in enumerate((w, free)):
            m[i] = 0.9 * m[i] + 0.1 * g[i]
            s[i] = 0.999 * s[i] + 0.001 * g[i] ** 2
            x -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(s[i] / (1 - 0.999 ** t)) + 1e-10)
    return OrdinalModel(w.astype(np.float32), np.cumsum(np.r_[free[0], np.exp(free[1:])]))


def telling(cols: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Which columns' document frequencies differ between the two sides beyond chance."""
    df = np.zeros((2, 1 << BITS))
    for c, t in zip(cols, toxic):
        df[int(t), c] += 1
    n = np.maximum(np.array([[(~toxic).sum()], [toxic.sum()]]), 1)
    both = (df.sum(0) + 1) / (n.sum() + 2)
    z = (df[1] / n[1] - df[0] / n[0]) / np.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]))
    return (df.sum(0) >= MIN_DOCS) & (np.abs(z) >= MIN_Z)


def grades(cols: list[np.ndarray], vals: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """0 for other texts, 1..GRADES for toxic ones by the share of listed words."""
    df = np.zeros((2, 1 << BITS))
    for c, t in zip(cols, toxic):
        df[int(t), c] += 1
    n = np.array([[(toxic == 0).sum()], [(toxic == 1).sum()]]) + 1.0
    rate = (df + 0.5) / n
    listed = (df[1] >= 5) & (rate[1] > 4 * rate[0])
    share = np.array([(v[listed[c]] ** 2).sum() for c, v in zip(cols, vals)])
    bad = np.sort(share[toxic == 1])
    if not len(bad):
        return np.zeros(len(cols), int)
    cut = [bad[len(bad) * i // GRADES] for i in range(1, GRADES)]
    return np.where(toxic == 1, 1 + np.searchsorted(cut, share, side="right"), 0).astype(int)


def _sparse(batches):
    for b in batches:
        got = [features(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("_h"), b.column("toxic"), pa.array([c.tobytes() for c, _ in got], pa.binary()),
             pa.array([v.tobytes() for _, v in got], pa.binary())], names=["_h", "toxic", "cols", "vals"])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 4000) -> OrdinalModel | None:
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("_h", F.xxhash64("doc_id"))
    picked = None
    for t in (0, 1):  # at most max_docs ids of each class
        part = known.filter(F.col("toxic") == t).orderBy("_h", "doc_id").limit(max_docs)
        picked = part if picked is None else picked.unionByName(part)
    rows = id_text(docs).join(F.broadcast(picked), "doc_id").select("_h", "toxic", "text").mapInArrow(
        _sparse, "_h long, toxic int, cols binary, vals binary")
    # the sample: one row per sampled id, however many rows repeat it
    rows = rows.groupBy("_h").agg(F.min(F.struct("toxic", "cols", "vals")).alias("r")).select("_h", "r.*").collect()
    rows.sort(key=lambda r: (r["_h"], bytes(r["cols"]), bytes(r["vals"])))
    if not any(r["toxic"] for r in rows):
        return None
    cols = [np.frombuffer(r["cols"], np.int32) for r in rows]
    vals = [np.frombuffer(r["vals"], np.float32) for r in rows]
    toxic = np.array([r["toxic"] for r in rows])
    return fit(cols, vals, grades(cols, vals, toxic))


class Scorer:
    """w . x of whole texts.  Of a word only the columns with a weight are looked at;
    they are remembered for up to ``_WORDS`` words, then looked up anew."""

    def __init__(self, model: OrdinalModel):
        self.weights = model.weights.tolist()
        self.known: dict[bytes, tuple[int, ...]] = {}

    def _learn(self, new: list[bytes]) -> None:
        names = [_names(w) for w in new]
        flat = [name for of_word in names for name in of_word]
        cols = iter(_columns(flat).tolist() if flat else ())
        for w, of_word in zip(new, names):
            self.known[w] = tuple(c for c in islice(cols, len(of_word)) if self.weights[c])

    def score(self, text: str | None) -> float:
        ws = words(text)
        counts = Counter(ws)
        if len(self.known) > _WORDS:
            self.known.clear()
        self._learn([w for w in counts if w not in self.known])
        uses: dict[int, int] = {}
        for w, k in counts.items():
            for c in self.known[w]:
                uses[c] = uses.get(c, 0) + k
        return sum(self.weights[c] * math.sqrt(100 * uses[c] / len(ws)) for c in sorted(uses))


def _score(model: OrdinalModel | None, flag: float):
    def run(batches):
        scorer = Scorer(model) if model is not None else None
        for b in batches:
            texts = b.column("text").to_pylist()
            z = np.zeros(len(texts))
            if model is not None:
                z[:] = [scorer.score(t) for t in texts]
                up = model.above(z)
            else:
                up = np.zeros((len(texts), 1))
            p = np.c_[np.ones(len(z)), up] - np.c_[up, np.zeros(len(z))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(up.sum(1)), pa.array(p.argmax(1).astype(np.int32)),
                 pa.array(up[:, 0]), pa.array(up[:, 0] >= flag)],
                names=["doc_id", "severity", "grade", "p_toxic", "toxic"])
    return run


def score(docs: DataFrame, model: OrdinalModel | None, flag: float = 0.7) -> DataFrame:
    """doc_id, severity (expected grade), grade (most likely), p_toxic, toxic (p_toxic at least ``flag``)."""
    return id_text(docs).mapInArrow(
        _score(model, flag), "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def held_in(labels: DataFrame) -> DataFrame:
    """Nine tenths of the labels; the rest stays for measuring."""
    return labels.filter(fold(F.col("doc_id"), 10) != 0)
