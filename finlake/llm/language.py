"""Operator 10: language identification by a byte convolutional network.

Whole texts are cut into windows of ``WINDOW`` bytes.  Every window goes through
byte embeddings, convolution filters of several widths, max pooling over the
window and softmax; a document's score is the geometric mean of its windows'
probabilities (weighted by bytes), normalised over the languages.

The network is trained in numpy on the driver from a bounded sample of labelled
texts: at most ``max_docs`` documents (languages drawn evenly, in the order of
a hash of the id) with two windows each; rows that repeat an id and language
count as one document there (the smallest window is taken).  All known languages
are counted over all labelled rows.  Prediction covers every window of every text.

Defined results: null text or text without letters: ``und``, score 0; very short
texts are padded; rows with a null ``lang`` are not learned from; a table without
labelled rows predicts ``und``, and ``keep_identified`` then has no ground to reject a
text with letters and keeps it; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import fold, id_text, tidy

WINDOW = 256
WIDTHS = (2, 3, 4)
UNKNOWN = "und"


class ByteConvNet:
    def __init__(self, classes: list[str], filters: int = 16, dim: int = 8, seed: int = 7):
        r = np.random.default_rng(seed)
        self.classes = classes
        p = {"emb": r.normal(0, 0.5, (256, dim)), "out": r.normal(0, 0.1, (filters * len(WIDTHS), len(classes))),
             "bias": np.zeros(len(classes))}
        for w in WIDTHS:
            p[f"w{w}"] = r.normal(0, (w * dim) ** -0.5, (w * dim, filters))
            p[f"b{w}"] = np.zeros(filters)
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    def _features(self, x: np.ndarray, keep: bool = False):
        """Max-pooled filter outputs of windows x (n, WINDOW) and, for training, where the maxima lie."""
        emb = self.p["emb"][x]
        n, length, dim = emb.shape
        pooled, places = [], []
        for w in WIDTHS:
            m = length - w + 1
            cols = np.lib.stride_tricks.as_strided(
                emb, (n, m, w * dim), (emb.strides[0], emb.strides[1], emb.strides[2]))
            act = np.ascontiguousarray(cols).reshape(n * m, w * dim) @ self.p[f"w{w}"]
            act = act.reshape(n, m, -1)
            if keep:
                at = act.argmax(axis=1)
                places.append(at)
                top = np.take_along_axis(act, at[:, None, :], 1)[:, 0]
            else:
                top = act.max(axis=1)
            pooled.append(np.maximum(top + self.p[f"b{w}"], 0))
        return emb, np.concatenate(pooled, 1), places

    def log_probs(self, x: np.ndarray, block: int = 64) -> np.ndarray:
        out = np.empty((len(x), len(self.classes)), np.float32)
        for i in range(0, len(x), block):
            _, f, _ = self._features(x[i:i + block])
            z = f @ self.p["out"] + self.p["bias"]
            z -= z.max(1, keepdims=True)
            out[i:i + block] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64,
              rate: float = 0.004, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        weight = 1.0 / np.maximum(np.bincount(y, minlength=len(self.classes)), 1)
        weight *= len(self.classes) / max((weight[y]).sum(), 1e-9) * len(y) / len(self.classes)
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(order), batch):
                rows = order[i:i + batch]
                g = self._gradients(x[rows], y[rows], weight[y[rows]].astype(np.float32))
                t += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)

    def _gradients(self, x, y, weight):
        emb, f, places = self._features(x, keep=True)
        n, dim = len(x), emb.shape[2]
        z = f @ self.p["out"] + self.p["bias"]
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        z[np.arange(n), y] -= 1
        z *= weight[:, None] / n
        g = {"out": f.T @ z, "bias": z.sum(0), "emb": np.zeros_like(self.p["emb"])}
        df = (z @ self.p["out"].T) * (f > 0)
        k = f.shape[1] // len(WIDTHS)
        for j, w in enumerate(WIDTHS):
            d = df[:, j * k:(j + 1) * k]
            at = places[j][:, :, None] + np.arange(w)  # bytes under each filter's maximum
            under = emb[np.arange(n)[:, None, None], at].reshape(n, k, w * dim)
            g[f"w{w}"] = np.einsum("nkd,nk->dk", under, d)
            g[f"b{w}"] = d.sum(0)
            back = (d[:, :, None] * self.p[f"w{w}"].T[None]).reshape(n, k, w, dim)
            np.add.at(g["emb"], x[np.arange(n)[:, None, None], at], back)
        return g


def windows(data: bytes) -> np.ndarray:
    """All windows of a text, the last one padded with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def _sample_windows(batches):
    for b in batches:
        out = []
        for lang, h, text in zip(*(b.column(c).to_pylist() for c in ("lang", "_h", "text"))):
            data = text.encode("utf-8", "surrogatepass")
            for turn in range(2):
                r = xxhash.xxh3_64_intdigest(h.to_bytes(8, "big", signed=True), seed=turn)
                n = WINDOW if turn == 0 else 16 + r % (WINDOW - 15)  # some short ones
                at = (r >> 20) % max(1, len(data) - n + 1)
                out.append((lang, h, turn, data[at:at + n]))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                names=["lang", "_h", "turn", "window"])


def train(labelled: DataFrame, max_docs: int = 6000, epochs: int = 6) -> ByteConvNet | None:
    """Fit the network on rows (doc_id, text, lang)."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL AND length(text) > 0").select(
        "lang", "text", F.xxhash64("doc_id", "lang").alias("_h"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    unit = F.pmod(F.col("_h"), F.lit(1 << 30)) * F.col("_n")  # every language equally likely
    chosen = (rows.select("lang", "_h").join(counts, "lang")
              .orderBy(unit, "_h").limit(max_docs).select("_h").distinct())
    got = rows.join(F.broadcast(chosen), "_h").select("lang", "_h", "text").mapInArrow(  # max_docs rows
        _sample_windows, "lang string, _h long, turn long, window binary") \
        .groupBy("_h", "turn").agg(F.min(F.struct("lang", "window")).alias("w")) \
        .select("w.lang", "_h", "turn", "w.window").orderBy("_h", "turn").collect()  # two per chosen document
    if not got:
        return None
    classes = sorted(r["lang"] for r in counts.select("lang").collect())  # one row per language
    at = {c: i for i, c in enumerate(classes)}
    net = ByteConvNet(classes)
    net.train(np.concatenate([windows(bytes(r["window"]))[:1] for r in got]),
              np.array([at[r["lang"]] for r in got]), epochs=epochs)
    return net


def _predict(net: ByteConvNet | None):
    def run(batches):
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            todo = [i for i, t in enumerate(texts) if t and net and any(map(str.isalpha, t))]
            for i in todo:
                data = texts[i].encode("utf-8", "surrogatepass")
                lp = net.log_probs(windows(data))
                size = np.full(len(lp), WINDOW, np.float64)
                size[-1] = len(data) - WINDOW * (len(lp) - 1)
                z = (lp * size[:, None]).sum(0) / size.sum()
                z = np.exp(z - z.max())
                best = int(z.argmax())
                pred[i], score[i] = net.classes[best], float(z[best] / z.sum())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """doc_id, lang_pred, score for every row; only the text is looked at."""
    return id_text(docs).mapInArrow(tidy(_predict(net)), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, max_docs: int = 6000) -> DataFrame:
    """Train on two thirds of the labelled documents, predict all."""
    learn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang")).filter(fold(F.col("doc_id"), 3) != 1)
    out = predict(docs, train(learn, max_docs))
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, net: ByteConvNet | None, min_score: float = 0.5) -> DataFrame:
    """Rows whose language is recognised with at least ``min_score``; columns as they are.
    Without a network (nothing was labelled) rows whose text has a letter."""
    names = docs.columns

    def run(batches):
        judge = _predict(net)
        for b in batches:
            if net is None:
                yield b.filter(pa.array([bool(t) and any(map(str.isalpha, t)) for t in b.column("text").to_pylist()],
                                        pa.bool_()))
                continue
            view = pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text")], names=["doc_id", "text"])
            got = next(judge(iter([view])))
            keep = [p != UNKNOWN and s >= min_score for p, s in
                    zip(got.column("lang_pred").to_pylist(), got.column("score").to_pylist())]
            yield b.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(tidy(run), docs.schema).select(*names)
