"""Operator 13: target-distribution importance resampling with segment de-duplication.

Features of a text are its runs of one to three neighbouring words, hashed into
buckets.  A bucket's gain compares its share in the target texts with its share
in all documents; a document's weight is the sum of gains over its features, and
the highest Gumbel-perturbed weights are drawn.

Newlines separate words, so a text's features are those inside its lines plus
those that cross a line's end:

1. Tasks cut their texts into lines (a line is its sequence of words) in chunks
   of about ``CHUNK`` characters and list each distinct line of a chunk with its
   number of occurrences.  Lines are added up over all chunks, and each distinct
   line's buckets are computed once.
2. A second pass over the texts keeps of every document references to its chunk's
   lines, known by a 128-bit key, and the buckets of its cross-line runs.  Bucket
   totals are each line's buckets times its occurrences, plus the cross-line ones.
3. With the gains, each distinct line is weighed once.  Its weight goes back to
   the chunks that list it (a line that a third of all documents repeat is one
   row per chunk), and every document adds the weights of its lines, as often as
   they occur, and the gains of its cross-line runs.
4. Only scores in the buckets of a score histogram that can hold the drawn ones
   are sorted and numbered.

Memory per task: one chunk (or one text, if larger), and the table of
``N_BUCKETS`` gains.

Defined results: a null or empty text has no features, weight 0; a null doc_id is
perturbed as the empty text and the last among equal scores; rows that repeat an
id are documents of their own; with an empty target every gain follows from
t = 0; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import id_text, stage
from finlake.operators.keys import sequence_key

N_BUCKETS = 10_000
CHUNK = 8 << 20
# Word bytes stay (A-Z lower-cased), the newline stays, every other ASCII byte separates.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b == 10 or chr(b).isalnum() else 32
               for b in range(256))
_PARTS = "part long, doc_id long, n_words long, refs binary, cross binary, idx int, key binary"
_ARROW = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("refs", pa.binary()),
                    ("cross", pa.binary()), ("idx", pa.int32()), ("key", pa.binary())])


def bucket(run: bytes) -> int:
    return zlib.crc32(run) % N_BUCKETS


def lines_of(text: str | None) -> list[bytes]:
    """The lines of a text that hold words, as words joined by one space."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    return [b" ".join(w) for w in map(bytes.split, data.split(b"\n")) if w]


def inner_buckets(line: bytes) -> np.ndarray:
    """Buckets of all runs of one to three words inside a line."""
    space = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
    start, stop = [0] + [i + 1 for i in space], space + [len(line)]
    return np.array([bucket(line[a:z]) for k in range(3) for a, z in zip(start, stop[k:])], "<u2")


class Line:
    """A distinct line of a chunk: its place, size and the words at its ends."""
    __slots__ = ("idx", "size", "head", "tail")

    def __init__(self, idx: int, line: bytes):
        w = line.split(b" ")
        self.idx, self.size, self.head, self.tail = idx, len(w), w[:2], w[-2:]


def cross_buckets(lines: list[Line]) -> list[int]:
    """Buckets of the runs that cross a line's end, each run once: at its last
    crossing when its last word starts a line, else at its only one."""
    out: list[int] = []
    before: list[bytes] = []
    for x in lines:
        if before:
            near, first = before[-1], x.head[0]
            pair = near + b" " + first
            out.append(bucket(pair))
            if len(before) == 2:
                out.append(bucket(before[0] + b" " + pair))
            if x.size > 1:
                out.append(bucket(pair + b" " + x.head[1]))
        before = (before + x.tail)[-2:]
    return out


def n_features(words: int) -> int:
    return words + max(words - 1, 0) + max(words - 2, 0)


def _distinct_lines(batches):
    """The distinct lines of every chunk with their occurrences."""
    seen: Counter = Counter()
    held = 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(seen, pa.binary()), pa.array(seen.values(), pa.int64())],
                                          names=["line", "times"])

    for b in batches:
        for text in b.column("text").to_pylist():
            seen.update(lines_of(text))
            held += len(text or "")
            if held > CHUNK:
                yield flush()
                seen.clear()
                held = 0
    yield flush()


def _cut(batches):
    """Documents as references to their chunk's lines, and the keys of these lines."""
    part = TaskContext.get().partitionId() << 32
    docs: list[tuple] = []
    seen: dict[bytes, Line] = {}
    held = 0

    def flush():
        n, k = len(docs), len(seen)
        ids, words, refs, cross = list(zip(*docs)) or [()] * 4
        rows = [[part] * (n + k), list(ids) + [None] * k, list(words) + [None] * k, list(refs) + [None] * k,
                list(cross) + [None] * k, [None] * n + [x.idx for x in seen.values()],
                [None] * n + [line_key(x) for x in seen]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _ARROW.types)], schema=_ARROW)

    for b in batches:
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            lines = []
            for x in lines_of(text):
                at = seen.get(x)
                if at is None:
                    at = seen[x] = Line(len(seen), x)
                lines.append(at)
            docs.append((doc_id, sum(x.size for x in lines), np.array([x.idx for x in lines], "<u4").tobytes(),
                         packed(cross_buckets(lines))))
            held += len(text or "") + 64
            if held > CHUNK:
                yield flush()
                part, held = part + 1, 0
                docs.clear()
                seen.clear()
    if docs:
        yield flush()


def line_key(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(line)


def packed(buckets) -> bytes:
    """Buckets in ascending order as steps, which compress well."""
    return np.diff(np.sort(np.array(buckets, "<u2")), prepend=np.uint16(0)).astype("<u2").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u2"), dtype=np.int64)


def _line_buckets(batches):
    for b in batches:
        lines = b.column("line").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([line_key(x) for x in lines], pa.binary()), b.column("times"),
             pa.array([packed(inner_buckets(x)) for x in lines], pa.binary())], names=["key", "times", "buckets"])


def _totals(batches):
    """Per task: how often every bucket occurs (``buckets`` counted ``times`` times)."""
    total = np.zeros(N_BUCKETS, np.int64)
    for b in batches:
        runs = [unpacked(x) for x in b.column("buckets").to_pylist()]
        if runs:
            np.add.at(total, np.concatenate(runs), np.repeat(b.column("times").to_numpy(), list(map(len, runs))))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())],
                                     names=["bucket", "n"])


def _add_up(counted: DataFrame) -> np.ndarray:
    """Totals of all buckets: at most N_BUCKETS rows reach the driver."""
    out = np.zeros(N_BUCKETS, np.int64)
    rows = counted.select("buckets", "times").mapInArrow(_totals, "bucket long, n long")
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the source)."""
    t, s = float(target.sum()), float(source.sum())
    return np.array([math.floor(1000 * math.log((a + 1.0) * (s + N_BUCKETS) / ((b + 1.0) * (t + N_BUCKETS))))
                     for a, b in zip(target.tolist(), source.tolist())], np.int64)


class Segments:
    """The cut texts of a table, with each distinct line once."""

    def __init__(self, rows: DataFrame, name: str):
        parts = stage(rows.mapInArrow(_cut, _PARTS), f"{name}-parts", "zstd")
        self.docs = parts.filter("refs IS NOT NULL").select("part", "doc_id", "n_words", "refs", "cross")
        self.listed = parts.filter("key IS NOT NULL").select("part", "idx", "key")
        distinct = rows.select("text").mapInArrow(_distinct_lines, "line binary, times long").groupBy("line").agg(
            F.sum("times").alias("times"))
        self.lines = stage(distinct.mapInArrow(_line_buckets, "key binary, times long, buckets binary"),
                           f"{name}-lines", "zstd")

    def totals(self) -> np.ndarray:
        cross = self.docs.select(F.col("cross").alias("buckets"), F.lit(1).cast("long").alias("times"))
        return _add_up(self.lines) + _add_up(cross)


def gumbel(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh_lines(gain):
    def run(batches):
        for b in batches:
            got = [int(gain.value[unpacked(x)].sum()) for x in b.column("buckets").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(got, pa.int64())], names=["key", "gain"])
    return run


def _weigh_documents(gain, seed: int):
    def run(docs: pa.Table, lines: pa.Table) -> pa.Table:
        of = np.zeros(lines.num_rows, np.int64)
        of[lines.column("idx").to_numpy()] = lines.column("gain").to_numpy()
        ids, words = docs.column("doc_id").to_pylist(), docs.column("n_words").to_pylist()
        weight = [int(of[np.frombuffer(r, "<u4")].sum() + gain.value[unpacked(c)].sum())
                  for r, c in zip(docs.column("refs").to_pylist(), docs.column("cross").to_pylist())]
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(words, pa.int64()),
            "n_features": pa.array([n_features(n) for n in words], pa.int64()),
            "weight": pa.array(weight, pa.int64()),
            "score": pa.array([w + gumbel(d, seed) for d, w in zip(ids, weight)], pa.int64())})
    return run


def weigh(docs: DataFrame, target: DataFrame, seed: int = 42) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row (staged)."""
    spark = docs.sparkSession
    texts = target.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    segments = Segments(id_text(docs), "resampling")
    gain = spark.sparkContext.broadcast(gains(Segments(texts, "target").totals(), segments.totals()))
    line_gain = segments.lines.mapInArrow(_weigh_lines(gain), "key binary, gain long")
    told = segments.listed.join(line_gain, "key").select(F.col("part").alias("_part"), "idx", "gain")
    return stage(segments.docs.groupBy("part").cogroup(told.groupBy("_part")).applyInArrow(
        _weigh_documents(gain, seed), "doc_id long, n_words long, n_features long, weight long, score long"), "weights")


def draw(weighed: DataFrame, percent: int = 5, min_words: int = 20) -> DataFrame:
    """``weighed`` with ``rank`` 1, 2, ... for the floor(percent * N / 100) highest scores among the N
    documents of at least ``min_words`` words, equal scores by ascending doc_id; null for all others."""
    none = F.lit(None).cast("long")
    fit = F.col("n_words") >= min_words
    # logarithmic steps in the order of the scores: some 8,000 at most for 64-bit scores
    step = (F.signum("score") * F.floor(F.log2(F.abs("score") + 1.0) * 64)).cast("long")
    counts = sorted(((r["step"], r["n"]) for r in weighed.filter(fit).groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in counts) // 100
    if wanted == 0:
        return weighed.withColumn("rank", none)
    total = 0
    for low, n in counts:
        total += n
        if total >= wanted:
            break
    high = fit & (step >= low)
    ranked = sequence_key(weighed.filter(high), [F.desc("score"), F.asc_nulls_last("doc_id")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return ranked.unionByName(weighed.filter(~high).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank."""
    return draw(weigh(docs, target, seed), percent, min_words)


def digest(resampled: DataFrame) -> DataFrame:
    return resampled.drop("n_words")
