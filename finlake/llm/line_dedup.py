"""Operator 8: line de-duplication by a sharded minimal perfect hash.

A line's key is the line without surrounding ASCII white space, A-Z
lower-cased.  Keys of at least ``min_chars`` code points that occur in at least
two documents lose all their lines except in the smallest document holding them.

1. Rows are dealt by id and text, so rows that share an id (or have none) are
   spread.  Each such part lists its distinct line hashes once, with the smallest
   and largest document that has the line, cut by hash into shards.  A line that a third of all documents repeat is thus one entry
   per part, never one per document.
2. Each shard merges its lists and builds a minimal perfect hash over its
   distinct line hashes.  It addresses three arrays: a fingerprint, the number
   of documents (up to "two or more") and the owner, the smallest document.  The
   parts' lists probe these arrays, and every part gets back the hashes that are
   repeated, with their owners.
3. Each part indexes the answers in the same way, with whole hashes as
   fingerprints; its documents probe these arrays with all their lines and drop
   those that another document owns.  Documents never join lines.

Memory per task: one shard's distinct hashes, or one part's lines; both shrink
with ``spark.sql.shuffle.partitions``.

Defined results: null or empty text is one empty line; rows with one doc_id are
one document; a null doc_id counts as larger than any other (all null ids are
one document); an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import id_text, partitions, release, tidy

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
SPACE = " \t\n\x0b\x0c\r"
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_U = np.uint64
# smallest and largest id of the documents with the line (low > high: none has an id), and
# whether a row without an id has it
_ENTRY = np.dtype([("h", "<u8"), ("low", "<i8"), ("high", "<i8"), ("none", "?")])
_REPLY = np.dtype([("h", "<u8"), ("owner", "<i8")])


def line_key(line: str) -> str:
    line = line.strip(SPACE)
    return line.lower() if line.isascii() else line.translate(_LOWER)


def key_hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys by hash, displace and rank.

    Keys fall into buckets of about four; buckets, largest first, get the
    smallest seed that sends all their keys to free places.  Places number as
    many as keys, so the function is minimal.  A bucket without a seed after
    ``TRIES`` starts the build again with another salt.
    """

    LOAD, TRIES, SEEDS = 4, 60, 4096

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        self.buckets = max(1, -(-self.n // self.LOAD))
        # A few spare places make the last buckets cheap; rank() closes the gaps.
        self.places = int(self.n * 1.1) + 8
        for salt in range(self.TRIES):
            self.salt = _U((0x9E3779B97F4A7C15 * (2 * salt + 1)) & (2 ** 64 - 1))
            if self._build(keys):
                break
        else:
            raise ValueError("keys are not distinct")
        self.rank = np.cumsum(self.taken) - 1

    def _mixed(self, keys, seed):
        x = (keys ^ self.salt) + np.asarray(seed).reshape(-1) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(31))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(29))

    def _bucket(self, keys):
        return ((self._mixed(keys, _U(0)) >> _U(33)) % _U(self.buckets)).astype(np.int64)

    def _place(self, keys, seed):
        return (self._mixed(keys, seed) % _U(self.places)).astype(np.int64)

    def _build(self, keys) -> bool:
        bucket = self._bucket(keys)
        size = np.bincount(bucket, minlength=self.buckets)
        self.seed = np.zeros(self.buckets, dtype=np.uint64)
        self.taken = np.zeros(self.places, dtype=bool)
        for level in np.unique(size[size > 0])[::-1]:  # buckets of one size together
            members = np.flatnonzero(size[bucket] == level)
            members = members[np.argsort(bucket[members], kind="stable")].reshape(-1, level)
            for seed in range(1, self.SEEDS):
                if not len(members):
                    break
                at = self._place(keys[members], _U(seed))
                fits = ~self.taken[at].any(axis=1)
                if level > 1:
                    s = np.sort(at, axis=1)
                    fits &= (s[:, 1:] != s[:, :-1]).all(axis=1)
                # of buckets that want one place in this round the first takes it
                rows = np.flatnonzero(fits)
                want = at[rows]
                first = np.full(self.places, len(rows), dtype=np.int64)
                order = np.repeat(np.arange(len(rows)), level)
                np.minimum.at(first, want.ravel(), order)
                won = (first[want] == np.arange(len(rows))[:, None]).all(axis=1)
                rows = rows[won]
                self.taken[at[rows].ravel()] = True
                self.seed[bucket[members[rows, 0]]] = _U(seed)
                members = np.delete(members, rows, axis=0)
            if len(members):
                return False
        return True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Index 0..n-1; any index (or -1) for a key that is not in the set."""
        place = self._place(keys, self.seed[self._bucket(keys)])
        return np.where(self.taken[place], self.rank[place], -1)


class LineIndex:
    """The arrays of one shard."""

    def __init__(self, entries: np.ndarray):
        e = entries[np.argsort(entries["h"], kind="stable")]
        start = np.flatnonzero(np.r_[True, e["h"][1:] != e["h"][:-1]]) if len(e) else np.zeros(0, int)
        keys = e["h"][start]
        low = np.minimum.reduceat(e["low"], start) if len(e) else e["low"]
        high = np.maximum.reduceat(e["high"], start) if len(e) else e["high"]
        none = np.logical_or.reduceat(e["none"], start) if len(e) else e["none"]
        self.perfect = PerfectHash(keys)
        at = self.perfect(keys)
        self.fingerprint = np.empty(len(keys), np.uint32)
        self.count = np.empty(len(keys), np.uint8)
        self.owner = np.empty(len(keys), np.int64)
        self.fingerprint[at] = (keys & _U(0xFFFFFFFF)).astype(np.uint32)
        self.count[at] = 1 + ((low < high) | (low == high) & none)
        self.owner[at] = low

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are lines of two or more documents, and their owners."""
        if not len(self.owner):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = self.perfect(keys)
        known = (at >= 0) & (self.fingerprint[at] == (keys & _U(0xFFFFFFFF)).astype(np.uint32))
        return known & (self.count[at] > 1), self.owner[at]


def _list_lines(min_chars: int, shards: int):
    """Per part: distinct long lines with their smallest and largest document."""
    def run(batches):
        seen: dict[int, dict[int, list[int]]] = {}
        for b in batches:
            for part, doc, text in zip(b.column("_part").to_pylist(), b.column("_id").to_pylist(),
                                       b.column("text").to_pylist()):
                own = seen.setdefault(part, {})
                none = doc is None
                for line in (text or "").split("\n"):
                    if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
                        h = key_hash(key)
                        got = own.get(h)
                        if got is None:
                            got = own[h] = [_HIGH, _LOW, False]
                        if none:
                            got[2] = True
                            continue
                        if doc < got[0]:
                            got[0] = doc
                        if doc > got[1]:
                            got[1] = doc
        for part, own in seen.items():
            e = np.empty(len(own), _ENTRY)
            e["h"] = np.fromiter(own.keys(), np.uint64, len(own))
            e["low"] = np.fromiter((v[0] for v in own.values()), np.int64, len(own))
            e["high"] = np.fromiter((v[1] for v in own.values()), np.int64, len(own))
            e["none"] = np.fromiter((v[2] for v in own.values()), bool, len(own))
            shard = (e["h"] % _U(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            e, shard = e[order], shard[order]
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(e) else []
            ends = [*cuts[1:], len(e)] if len(e) else []
            if len(e):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[cuts]), pa.array([part] * len(cuts), pa.int64()),
                     pa.array([e[a:z].tobytes() for a, z in zip(cuts, ends)], pa.binary())],
                    names=["shard", "_part", "entries"])
    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard: build the arrays, let every part probe them."""
    lists = [np.frombuffer(x, _ENTRY) for x in pdf["entries"]]
    index = LineIndex(np.concatenate(lists))
    out = []
    for part, e in zip(pdf["_part"], lists):
        repeated, owner = index.probe(e["h"])
        # a part whose documents with the line are all the owner keeps it whole
        told = repeated & (e["none"] | (e["low"] < e["high"]) | (e["low"] == e["high"]) & (e["low"] != owner))
        r = np.empty(int(told.sum()), _REPLY)
        r["h"], r["owner"] = e["h"][told], owner[told]
        if len(r):
            out.append((part, r.tobytes()))
    return pd.DataFrame(out, columns=["_part", "reply"])


class PartIndex:
    """The repeated lines of one part: a perfect hash addresses their hashes and owners."""

    def __init__(self, replies: list[bytes]):
        r = np.concatenate([np.frombuffer(x, _REPLY) for x in replies]) if replies else np.empty(0, _REPLY)
        self.perfect = PerfectHash(r["h"])
        at = self.perfect(r["h"])
        self.known, self.owner = np.empty(len(r), np.uint64), np.empty(len(r), np.int64)
        self.known[at], self.owner[at] = r["h"], r["owner"]

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which lines are repeated ones, and the documents that keep them."""
        if not len(self.known):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = self.perfect(keys)
        return (at >= 0) & (self.known[at] == keys), self.owner[at]


def _drop(min_chars: int, keep: list[str]):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        index = PartIndex(replies.column("reply").to_pylist())
        ids, texts = docs.column("_id").to_pylist(), docs.column("text").to_pylist()
        before, row, place, keys = [], [], [], []
        for r, text in enumerate(texts):
            lines = (text or "").split("\n")
            before.append(len(lines))
            for i, x in enumerate(lines):
                if len(x) >= min_chars and len(k := line_key(x)) >= min_chars:
                    row.append(r)
                    place.append(i)
                    keys.append(key_hash(k))
        repeated, owner = index.probe(np.array(keys, np.uint64))
        gone: dict[int, set[int]] = {}
        for j in np.flatnonzero(repeated).tolist():
            if ids[row[j]] is None or ids[row[j]] != owner[j]:
                gone.setdefault(row[j], set()).add(place[j])
        kept = ["\n".join([x for i, x in enumerate((t or "").split("\n")) if i not in gone[r]]) if r in gone else t or ""
                for r, t in enumerate(texts)]
        dropped = [len(gone.get(r, ())) for r in range(len(texts))]
        release()
        return pa.table({"_id": docs.column("_id"), "text": pa.array(kept, pa.string()),
                         "n_lines": pa.array(before, pa.int64()),
                         "n_dropped": pa.array(dropped, pa.int64()),
                         **{c: docs.column(c) for c in keep}})
    return run


def dedup_lines(docs: DataFrame, min_chars: int = 10, keep: list[str] | None = None) -> DataFrame:
    """doc_id, text (repeated lines dropped), n_lines, n_dropped, and the columns
    ``keep`` of the input as they are.  One row per input row."""
    spark = docs.sparkSession
    n = partitions(spark)
    keep = [c for c in keep or [] if c not in ("doc_id", "text")]
    base = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    base = base.select(F.pmod(F.xxhash64("_id", "text"), F.lit(n)).alias("_part"), "*")
    lines = base.select("_part", "_id", "text").repartition(n, "_part").mapInArrow(
        tidy(_list_lines(min_chars, n)), "shard long, _part long, entries binary")
    replies = lines.groupBy("shard").applyInPandas(_answer, "_part long, reply binary")
    carried = [f"_k{i}" for i in range(len(keep))]
    kinds = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    out = base.groupBy("_part").cogroup(replies.groupBy("_part")).applyInArrow(
        _drop(min_chars, carried), ", ".join(
            ["_id long, text string, n_lines long, n_dropped long",
             *[f"{c} {kinds[c]}" for c in carried]]))
    return out.select(F.col("_id").alias("doc_id"), "text",
                      "n_lines", "n_dropped", *[F.col(k).alias(c) for k, c in zip(carried, keep)])


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT doc_id, rid, i, ls[i] AS line,
         translate(trim(ls[i], E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, rid, string_split(t, E'\n') AS ls FROM docs),
       LATERAL (SELECT unnest(generate_series(1, len(ls))) AS i)),
shared AS (SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10
           GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.*, s.k IS NOT NULL AND l.doc_id <> s.owner AS gone
           FROM lines l LEFT JOIN shared s ON l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, E'\n' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, rid
"""
