"""Operator 11: ranked lexical search with bag de-duplication.

Every document is scored for every benchmark item by an integer BM25-like sum
over the item's terms; the ``k`` best documents of each item are returned.

1. Documents are restricted to the vocabulary of the items: each keeps its
   length ``n`` and the term frequencies of item terms (its bag).  N and L are
   summed over all documents.
2. Documents with the same term-frequency vector and the same length norm
   ``m`` form a class.  Classes are found by a 64-bit hash of the two and
   verified by the vector itself (both are grouping keys, so a collision makes
   two classes).  Document frequencies are summed over classes.
3. A class is scored once.  Every task scores its classes against all items by
   integer arrays and keeps the ``k`` best classes of each item, by score and
   smallest doc_id: each of them has at least one member that precedes all
   members of a later class, so no document of the answer is lost.
4. The chosen classes are expanded to members, the smallest ids first (at most
   ``k`` of a class can be in an answer), and ranked.

Items are taken in blocks of about ``block_terms`` (item, term) pairs; a larger
item table costs one pass over the documents per block.  Only a block's pairs
reach the driver and the tasks.

Defined results: a null text has no terms; a null doc_id is a document of its
own and the last among equal scores; rows that repeat an id are documents of
their own; rows of one item_id are one item with the terms of all of them (a
null item_id likewise); items without terms, or whose terms no document holds,
have no rows; empty tables give none; extra columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import id_text, stage

# Term bytes stay (A-Z lower-cased), every other ASCII byte separates.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SLICE = 1 << 20      # bytes of a text split at a time
CELLS = 1 << 21      # class x item scores held at a time
BLOCK_TERMS = 500_000


def terms(text: str | None):
    """Lists of the terms of a text, slice by slice."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _item_terms(batches):
    for b in batches:
        got = {(i, t) for i, x in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist())
               for part in terms(x) for t in part}
        ids, ts = zip(*got) if got else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ts, pa.binary())],
                                         names=["item_id", "term"])


class ItemBlock:
    """The items of one block: their ids, the vocabulary and, per term, the items that hold it."""

    def __init__(self, pairs: list[tuple[int | None, bytes]]):
        self.items = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i or 0))
        place = {i: j for j, i in enumerate(self.items)}
        self.vocabulary = {t: j for j, t in enumerate(sorted({t for _, t in pairs}))}
        at = np.array([(self.vocabulary[t], place[i]) for i, t in pairs], np.int64).reshape(-1, 2)
        at = at[np.lexsort((at[:, 1], at[:, 0]))]
        self.held_by = at[:, 1]
        self.degree = np.bincount(at[:, 0], minlength=len(self.vocabulary))
        self.first = np.cumsum(self.degree) - self.degree


def _bags(block):
    def run(batches):
        get = block.value.vocabulary.get
        for b in batches:
            n, bags = [], []
            for text in b.column("text").to_pylist():
                size, held = 0, Counter()
                for part in terms(text):
                    size += len(part)
                    held.update(map(get, part))
                held.pop(None, None)
                n.append(size)
                bags.append(np.array(sorted(held.items()), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(bags, pa.binary())],
                names=["doc_id", "n", "bag"])
    return run


def _document_counts(size: int):
    """Per task: how many documents hold each term (class sizes added up)."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for bag, members in zip(b.column("bag").to_pylist(), b.column("members").to_pylist()):
                total[np.frombuffer(bag, "<u4")[::2]] += members
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())],
                                         names=["term", "df"])
    return run


class TopClasses:
    """The best ``k`` (score, smallest doc_id) of every item seen so far."""

    def __init__(self, k: int, items: int):
        self.k, self.pool, self.size = k, [], 0
        self.least = np.ones(items, np.int64)  # scores below cannot enter
        self.room = max(1 << 16, 4 * k * items)

    def add(self, scores: np.ndarray, first: np.ndarray, none: np.ndarray, cid: np.ndarray) -> None:
        c, i = np.nonzero(scores >= self.least)
        self.pool.append(np.stack([i, -scores[c, i], none[c], first[c], cid[c]]))
        self.size += len(c)
        if self.size > self.room:
            self.prune()

    def prune(self) -> np.ndarray:
        p = np.concatenate(self.pool, 1) if self.pool else np.zeros((5, 0), np.int64)
        p = p[:, np.lexsort(p[::-1])]  # by item, score, null id, smallest id, class
        start = np.flatnonzero(np.r_[True, p[0, 1:] != p[0, :-1]]) if p.shape[1] else np.zeros(0, np.int64)
        place = np.arange(p.shape[1]) - np.repeat(start, np.diff(np.r_[start, p.shape[1]]))
        last = place == self.k - 1
        self.least[p[0, last]] = -p[1, last]
        p = p[:, place < self.k]
        self.pool, self.size = [p], p.shape[1]
        return p


def class_scores(block: ItemBlock, weight: np.ndarray, bags: list[bytes], m: np.ndarray) -> np.ndarray:
    """(classes, items) integer scores."""
    bag = [np.frombuffer(x, "<u4").astype(np.int64) for x in bags]
    size = np.array([len(x) // 2 for x in bag], np.int64)
    flat = np.concatenate(bag) if bag else np.zeros(0, np.int64)
    t, tf = flat[::2], flat[1::2]
    cls = np.repeat(np.arange(len(bags)), size)
    part = weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[cls]))
    out = np.zeros(len(bags) * len(block.items), np.int64)
    deg = block.degree[t]
    ends = np.cumsum(deg)
    lo = 0
    while lo < len(t):  # terms spread over their items, a bounded number at a time
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CELLS, "right")))
        d = deg[lo:hi]
        inside = np.arange(d.sum()) - np.repeat(np.cumsum(d) - d, d)
        item = block.held_by[np.repeat(block.first[t[lo:hi]], d) + inside]
        np.add.at(out, np.repeat(cls[lo:hi], d) * len(block.items) + item, np.repeat(part[lo:hi], d))
        lo = hi
    return out.reshape(len(bags), len(block.items))


def _best(block, weight, k: int):
    def run(batches):
        held = block.value
        top = TopClasses(k, len(held.items))
        step = max(1, CELLS // len(held.items))
        for b in batches:
            first = b.column("first").to_pylist()
            none = np.array([x is None for x in first], np.int64)
            first = np.array([x or 0 for x in first], np.int64)
            m, cid = np.array(b.column("m")), np.array(b.column("cid"))
            bags = b.column("bag").to_pylist()
            for i in range(0, len(bags), step):
                z = slice(i, i + step)
                top.add(class_scores(held, weight.value, bags[z], m[z]), first[z], none[z], cid[z])
        p = top.prune()
        ids = [held.items[i] for i in p[0]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(p[0], pa.int64()), pa.array(ids, pa.int64()), pa.array(-p[1], pa.int64()),
             pa.array([None if z else f for z, f in zip(p[2].tolist(), p[3].tolist())], pa.int64()),
             pa.array(p[4], pa.int64())], names=["item", "item_id", "score", "first", "cid"])
    return run


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _search_block(docs: DataFrame, block: ItemBlock, k: int) -> DataFrame:
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(block)
    bags = stage(id_text(docs).mapInArrow(_bags(held), "doc_id long, n long, bag binary"), "bags")
    n_docs, n_terms = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    keyed = bags.filter("length(bag) > 0").withColumn(
        "m", F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L")).withColumn("h", F.xxhash64("bag", "m"))
    classes = stage(keyed.groupBy("h", "m", "bag").agg(
        F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("first"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    weight = np.zeros(len(block.vocabulary), np.int64)
    counts = classes.select("bag", "members").mapInArrow(
        _document_counts(len(weight)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counts.collect():  # one row per item term at most
        weight[r["term"]] = term_weight(n_docs, r["df"])
    best = classes.select("bag", "m", "first", "cid").mapInArrow(
        _best(held, spark.sparkContext.broadcast(weight), k),
        "item long, item_id long, score long, first long, cid long")
    by_class = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first"), "cid")
    top = stage(best.withColumn("_at", F.row_number().over(by_class)).filter(F.col("_at") <= k).drop("_at"), "top")
    chosen = classes.join(top.select("cid").distinct(), "cid").select("h", "m", "bag", "cid")
    low_first = Window.partitionBy("cid").orderBy(F.asc_nulls_last("doc_id"))
    members = (keyed.join(chosen, ["h", "m", "bag"]).select("cid", "doc_id")
               .withColumn("_at", F.row_number().over(low_first)).filter(F.col("_at") <= k).drop("_at"))
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (members.join(top.select("item", "item_id", "score", "cid"), "cid")
            .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (score above 0) of every item."""
    pairs = stage(items.select(F.col("item_id").cast("long").alias("item_id"),
                               F.col("text").cast("string").alias("text"))
                  .mapInArrow(_item_terms, "item_id long, term binary").distinct(), "item-terms")
    blocks = max(1, -(-pairs.count() // block_terms))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = []
    for i in range(blocks):
        got = [(r["item_id"], bytes(r["term"])) for r in pairs.filter(block == i).collect()]
        if got:
            out.append(_search_block(docs, ItemBlock(got), k))
    if not out:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionByName, out)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
u AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM d) GROUP BY rid, t),
g AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d),
q AS (SELECT DISTINCT item_id, t FROM (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)),
w AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM u, g WHERE t IN (SELECT t FROM q) GROUP BY t),
s AS (
  SELECT q.item_id, u.rid, any_value(d.doc_id) AS doc_id,
         sum(w.w * ((1000000000 * u.tf) // (1000 * u.tf + 20 * (50 + (50 * len(d.ts) * g.n_docs) // g.n_terms))))::BIGINT
           AS score
  FROM u JOIN w USING (t) JOIN q USING (t) JOIN d ON d.rid = u.rid, g
  GROUP BY q.item_id, u.rid)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank
  FROM s WHERE score > 0) WHERE rank <= 50
"""
