"""Operator 7: Merkle tree over sentences, paragraphs and sections.

A text is a tree: the root has sections, a section has paragraphs (lines), a
paragraph has sentences.  A section ends at an empty paragraph or after a
paragraph whose hash falls into one of eight classes, so borders depend on the
content near them and an edit moves no border elsewhere.  A sentence longer
than ``LEAF_CHARS`` is cut after words the same way.  Every node's hash covers
its children's hashes, so equal roots mean equal texts (up to collisions of a
128-bit root), and a walk down the branches that differ locates edits.

The fingerprint is text: ``root;section;section...`` with ``section`` =
``hash:leaf.length,leaf.length,...``.  Two fingerprints are compared without
the texts: sections with equal hashes are taken whole, in the others the leaves
are matched.  Likeness = code points in common / code points of the longer text
(1 for two empty texts).

Defined results: null text is empty; the empty text has one root hash and no
section; equal texts (repeated rows as well) have equal fingerprints; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import id_text, partitions
from finlake.operators.ranges import range_of, split_points

LEAF_CHARS = 160
SECTION_CLASSES = 8
_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+[ \t]*|\n|$)")
_WORD = re.compile(r"\S*\s*")
_LINE = re.compile(r"[^\n]*\n|[^\n]+")
_hash = xxhash.xxh3_64_intdigest


def _bytes(s: str) -> bytes:
    return s.encode("utf-8", "surrogatepass")


def _leaves(paragraph: str) -> list[str]:
    out = []
    for s in _SENTENCE.findall(paragraph):
        if len(s) <= LEAF_CHARS:
            if s:
                out.append(s)
            continue
        start = at = 0  # cut a long sentence after words chosen by content
        for m in _WORD.finditer(s):
            at = m.end()
            if at - start >= LEAF_CHARS // 4 and (_hash(_bytes(m.group())) % 8 == 0
                                                 or at - start >= LEAF_CHARS):
                out.append(s[start:at])
                start = at
        if start < len(s):
            out.append(s[start:])
    return out


class Tree:
    """root (hex), sections: list of (hash, [(leaf hash, code points), ...])."""

    __slots__ = ("root", "sections", "n_chars")

    def __init__(self, root: str, sections: list):
        self.root, self.sections = root, sections
        self.n_chars = sum(n for _, leaves in sections for _, n in leaves)

    @classmethod
    def of(cls, text: str) -> Tree:
        sections, leaves, hashes = [], [], []
        for line in _LINE.findall(text):
            own = [(_hash(_bytes(x)), len(x)) for x in _leaves(line)]
            leaves += own
            h = _hash(b"p" + b"".join(x.to_bytes(8, "big") for x, _ in own))
            hashes.append(h)
            if line == "\n" or h % SECTION_CLASSES == 0:
                sections.append((cls._node(hashes), leaves))
                leaves, hashes = [], []
        if leaves:
            sections.append((cls._node(hashes), leaves))
        return cls(cls._root([h for h, _ in sections]), sections)

    @staticmethod
    def _node(children: list[int]) -> int:
        return _hash(b"s" + b"".join(x.to_bytes(8, "big") for x in children))

    @staticmethod
    def _root(children: list[int]) -> str:
        return hashlib.blake2b(b"".join(x.to_bytes(8, "big") for x in children), digest_size=16).hexdigest()

    def __str__(self) -> str:
        return ";".join([self.root, *(
            f"{h:016x}:" + ",".join(f"{x:016x}.{n:x}" for x, n in leaves)
            for h, leaves in self.sections)])

    @classmethod
    def parse(cls, fingerprint: str) -> Tree:
        root, *parts = fingerprint.split(";")
        sections = []
        for p in parts:
            h, _, leaves = p.partition(":")
            sections.append((int(h, 16), [(int(x[:16], 16), int(x[17:], 16)) for x in leaves.split(",")]))
        return cls(root, sections)


def likeness(a: Tree, b: Tree) -> float:
    """Share of the longer text's code points that lie in equal sections or leaves."""
    longer = max(a.n_chars, b.n_chars)
    if a.root == b.root or longer == 0:
        return 1.0
    same_a, same_b, common = _unmatched(a, b)
    rest = Counter(x for leaves in same_b for x in leaves)
    for leaves in same_a:
        for x in leaves:
            if rest.get(x, 0):
                rest[x] -= 1
                common += x[1]
    return common / longer


def _unmatched(a: Tree, b: Tree) -> tuple[list, list, int]:
    """The leaf lists of the sections that only one tree has; code points in common sections."""
    have, common, only_a, only_b = Counter(h for h, _ in b.sections), 0, [], []
    taken: Counter = Counter()
    for h, leaves in a.sections:
        if have[h] > taken[h]:
            taken[h] += 1
            common += sum(n for _, n in leaves)
        else:
            only_a.append(leaves)
    for h, leaves in b.sections:
        if taken[h]:
            taken[h] -= 1
        else:
            only_b.append(leaves)
    return only_a, only_b, common


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Code-point spans (start, end) of ``b`` whose leaves ``a`` does not have,
    found by walking only the sections whose hashes differ."""
    ta, tb = Tree.parse(a), Tree.parse(b)
    if ta.root == tb.root:
        return []
    have = Counter(h for h, _ in ta.sections)
    rest = Counter(x for leaves in _unmatched(ta, tb)[0] for x in leaves)
    out, at = [], 0
    for h, leaves in tb.sections:
        if have[h]:
            have[h] -= 1
            at += sum(n for _, n in leaves)
            continue
        for x in leaves:
            if rest[x]:
                rest[x] -= 1
            elif out and out[-1][1] == at:
                out[-1] = (out[-1][0], at + x[1])
            else:
                out.append((at, at + x[1]))
            at += x[1]
    return out


def _fingerprint_batches(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([str(Tree.of(t or "")) for t in b.column("text").to_pylist()])],
            names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every whole text."""
    return id_text(docs).mapInArrow(_fingerprint_batches, "doc_id long, fingerprint string")


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")


def _walk(batches):
    """Rows of one run of ids, descending; the run's last row (``_tail``) is the
    next run's first document and only serves as a neighbour."""
    names = [x.split()[0] for x in _RESULT.split(", ")]
    held, part = None, None
    for b in batches:
        out = []
        for run, doc_id, text, tail in zip(*(b.column(c).to_pylist() for c in ("_run", "doc_id", "text", "_tail"))):
            now = (doc_id, text or "", Tree.of(text or ""), tail)
            if held is not None and run == part and not held[3]:
                out.append(_compare(held, now))
            held, part = now, run
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)))), schema=pa.schema(
                [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                 ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                 ("near_edited", pa.float64()), ("near_next", pa.float64())]))


def _compare(doc, nxt):
    doc_id, text, tree, _ = doc
    half = len(text) // 2
    edited = text[:len(text) - half] + nxt[1][:half]
    tree_e = Tree.of(edited)
    return (doc_id, len(text), hashlib.sha256(_bytes(edited)).hexdigest(), str(tree), str(tree_e),
            likeness(tree, tree_e), likeness(tree, nxt[2]))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and the text edited with its neighbour in
    descending id order (ties: by text; null ids come last).

    Ids, and where they repeat or are null the first letters of the texts, decide
    the runs: split points from a sample, then one shuffle moves each text once to
    its run, plus one text per run that the run before needs as neighbour.  A run is
    streamed, so only rows with one id and one text beginning stay together, and
    these cost time, not memory.
    """
    spark = docs.sparkSession
    runs, order = partitions(spark), ["-doc_id", "_head"]
    base = id_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    keyed = base.withColumn("_head", F.substring("text", 1, 32))
    # run 0 holds the largest ids
    placed = range_of(keyed, order, split_points(keyed, order, runs, base.count()), "_run")
    first = {r["_run"]: r["m"] for r in placed.groupBy("_run").agg(  # one row per run; null: no ids in it
        F.max("doc_id").alias("m")).collect()}
    filled = sorted(first)
    tails = [(r, first[r], filled[i - 1]) for i, r in enumerate(filled)]  # wraps: the first serves the last
    extra = spark.createDataFrame(tails, "_of int, _first long, _before int")
    # null-safe, though no run is null: a plain equality has the planner push "_run is not null" through
    # every step of the search for the run, whose expression grows many times over at each
    tail_rows = placed.join(F.broadcast(extra), F.col("_run").eqNullSafe(F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_first"))) \
        .groupBy("_before", "doc_id").agg(F.min("text").alias("text"))
    rows = placed.select("_run", F.lit(False).alias("_tail"), "doc_id", "text").unionByName(
        tail_rows.select(F.col("_before").alias("_run"), F.lit(True).alias("_tail"), "doc_id", "text"))
    return rows.repartitionById(runs, F.col("_run").cast("int")).sortWithinPartitions(
        "_run", "_tail", F.col("doc_id").desc_nulls_last(), "text").mapInArrow(_walk, _RESULT)
