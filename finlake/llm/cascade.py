"""Operator 12: quality rules as a short-circuit cascade.

Base counts are taken of every whole text.  Documents that pass the base check
go through the rules of ``RULES``, each of which sees only what the earlier ones
have left; a document is kept when no rule rejects it.

The order is fitted on a sample of about ``sample_docs`` documents: every rule
runs on all of them, which gives its cost per document and, as one bit per rule,
which documents it rejects.  The greedy order takes next the rule that rejects
most of what is left per second.  A rule is a fixed test of one text, so the
order (and with it the sample) changes the time only, never a verdict.

Rules that need the same intermediate value (words, lines) share it: a
``Document`` computes each once, when the first rule asks for it.

Defined results: a null or empty text has no words and fails the base check;
every row is judged by itself (ties, repeated rows and null ids need no rule);
an empty table gives no rows (and keeps the listed order); extra columns are not
read.  Memory per task is one Arrow batch and the words of one text.
"""

from __future__ import annotations

import functools
import re
import time
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import id_text

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LOWER = bytes(b for b in range(256) if not 97 <= b <= 122)


class Document:
    """One text and the values that several rules use, each computed at most once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.data = self.text.encode("utf-8", "surrogatepass")

    @functools.cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @functools.cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.data.split(b"\n") if not x.isspace() and x]

    @functools.cached_property
    def word_ids(self) -> np.ndarray:
        seen: dict[bytes, int] = {}
        return np.array([seen.setdefault(w, len(seen)) for w in self.words], np.int64)

    @functools.cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @functools.cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @functools.cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @functools.cached_property
    def pair_ids(self) -> np.ndarray:
        """One number per two neighbouring words."""
        x = self.word_ids
        return np.unique(x[:-1] * (x.max() + 1) + x[1:], return_inverse=True)[1] if len(x) > 1 else x[:0]

    @functools.cached_property
    def n_repeat_words(self) -> int:
        p = self.pair_ids
        if len(p) < 3:  # fewer than two windows of three words
            return 0
        triple = p[:-1] * (self.word_ids.max() + 1) + self.word_ids[2:]
        _, at, n = np.unique(triple, return_inverse=True, return_counts=True)
        again = n[at] > 1
        held = np.zeros(len(p) + 1, bool)
        for shift in range(3):
            held[shift:shift + len(again)] |= again
        return int(held.sum())


def base_failed(d: Document) -> bool:
    return len(d.words) < 50 or 100 * d.n_repeat_words > 50 * len(d.words)


def word_length(d: Document) -> bool:
    """Mean word length outside 3 to 10 code points."""
    return not 3 * len(d.words) <= d.word_chars <= 10 * len(d.words)


def symbols(d: Document) -> bool:
    """More than one symbol in ten words."""
    return 10 * d.n_symbols > len(d.words)


def letters(d: Document) -> bool:
    """Fewer than 80 % of the words hold a letter (A-Z, a-z or beyond ASCII)."""
    return 100 * sum(map(bool, map(_LETTER.search, d.words))) < 80 * len(d.words)


def capitals(d: Document) -> bool:
    """More A-Z than a-z."""
    return len(d.data.translate(None, _NOT_UPPER)) > len(d.data.translate(None, _NOT_LOWER))


def repeated_lines(d: Document) -> bool:
    """More than half of the lines with a word repeat an earlier one."""
    return 2 * d.n_dup_lines > len(d.lines)


def bullets(d: Document) -> bool:
    """More than 90 % of the lines with a word start with a bullet."""
    n = sum(x.lstrip().startswith((b"- ", b"* ", b"\xe2\x80\xa2")) for x in d.lines)
    return 10 * n > 9 * len(d.lines)


def ellipses(d: Document) -> bool:
    """More than 30 % of the lines with a word end with an ellipsis."""
    n = sum(x.rstrip().endswith((b"...", b"\xe2\x80\xa6")) for x in d.lines)
    return 10 * n > 3 * len(d.lines)


def frequent_pair(d: Document) -> bool:
    """One pair of neighbouring words occurs more than once in five words."""
    return len(d.pair_ids) > 0 and 5 * int(np.bincount(d.pair_ids).max()) > len(d.words)


Rule = Callable[[Document], bool]
RULES: tuple[Rule, ...] = (word_length, symbols, letters, capitals, repeated_lines, bullets, ellipses,
                           frequent_pair)


def _trial(rules: Sequence[Rule], base: Rule):
    """Every rule on every sampled document: patterns of rejections and seconds per rule.

    Each rule gets a fresh document, so its cost holds what it has to compute
    itself, beyond the values that the base check leaves behind."""
    def run(batches):
        patterns: Counter = Counter()
        cost = [0.0] * len(rules)
        for b in batches:
            for text in b.column("text").to_pylist():
                first = Document(text)
                if base(first):
                    continue
                bits = 0
                for i, rule in enumerate(rules):
                    d = Document(text)
                    d.__dict__.update(first.__dict__)
                    start = time.perf_counter()
                    bits |= bool(rule(d)) << i
                    cost[i] += time.perf_counter() - start
                patterns[bits] += 1
        rows = [(None, k, n) for k, n in patterns.items()] + [(i, None, c) for i, c in enumerate(cost)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows), (pa.int64(), pa.int64(), pa.float64()))], names=["rule", "pattern", "amount"])
    return run


def greedy_order(patterns: dict[int, float], cost: Sequence[float]) -> list[int]:
    """Next comes the rule that rejects most of the documents left per second;
    rules that reject nothing of them follow, cheapest first."""
    left, order, rest = dict(patterns), [], list(range(len(cost)))
    while rest:
        gain = {i: sum(n for k, n in left.items() if k >> i & 1) for i in rest}
        best = max(rest, key=lambda i: (gain[i] / max(cost[i], 1e-9), -cost[i], -i))
        order.append(best)
        rest.remove(best)
        left = {k: n for k, n in left.items() if not k >> best & 1}
    return order


def fit_order(docs: DataFrame, rules: Sequence[Rule] = RULES, base: Rule = base_failed,
              sample_docs: int = 2000, seed: int = 12) -> list[int]:
    """Order of ``rules``, fitted on about ``sample_docs`` rows (all rows when there are fewer).

    At most 2 ** len(rules) patterns and one cost per rule reach the driver."""
    rows = id_text(docs)
    n = rows.select("doc_id").count()
    some = rows.sample(sample_docs / n, seed) if n > sample_docs else rows
    got = some.mapInArrow(_trial(rules, base), "rule long, pattern long, amount double").groupBy(
        "rule", "pattern").agg(F.sum("amount").alias("amount")).collect()
    cost = {r["rule"]: r["amount"] for r in got if r["rule"] is not None}
    return greedy_order({r["pattern"]: r["amount"] for r in got if r["pattern"] is not None},
                        [cost.get(i, 0.0) for i in range(len(rules))])


def _judge(rules: Sequence[Rule], base: Rule):
    def run(batches):
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                d = Document(text)
                failed = base(d)
                by = None if failed else next((r.__name__ for r in rules if r(d)), None)
                rows.append((len(d.words), d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words,
                             failed, not failed and by is None, by))
            cols = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(c, t) for c, t in zip(
                    cols, [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()])],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "rejected_by"])
    return run


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, base: Rule = base_failed,
          order: Sequence[int] | None = None, sample_docs: int = 2000) -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``kept`` and ``rejected_by``, the first
    rule of the fitted order that rejected it."""
    order = fit_order(docs, rules, base, sample_docs) if order is None else order
    return id_text(docs).mapInArrow(
        _judge([rules[i] for i in order], base),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, rejected_by string")


def digest(judged: DataFrame) -> DataFrame:
    return judged.drop("rejected_by")


_SPACE = r"[\x20\x09-\x0D]"
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), E'\n'),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
w AS (SELECT rid, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c, i, len(ws) AS n
      FROM (SELECT rid, ws, unnest(generate_series(1, len(ws))) AS i FROM d)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM w WHERE i <= n - 2)
          WHERE k > 1),
covered AS (SELECT rid, count(DISTINCT j) AS n_repeat_words
            FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY rid),
pairs AS (SELECT rid, max(k) AS top FROM (SELECT rid, count(*) AS k FROM w WHERE i < n GROUP BY rid, a, b) GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, len(ws) AS n_words,
         length(regexp_replace(t, '{_SPACE}', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(top, 0) AS top_pair,
         len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z\x{{80}}-\x{{10FFFF}}]'))) AS lettered,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower,
         len(list_filter(ls, lambda l: regexp_matches(l, '^{_SPACE}*([-*] |•)'))) AS bulleted,
         len(list_filter(ls, lambda l: regexp_matches(l, '(\.\.\.|…){_SPACE}*$'))) AS dotted
  FROM d LEFT JOIN covered USING (rid) LEFT JOIN pairs USING (rid)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 3 * n_words AND 10 * n_words AND 10 * n_symbols <= n_words
       AND 100 * lettered >= 80 * n_words AND upper <= lower AND 2 * n_dup_lines <= n_lines
       AND 10 * bulleted <= 9 * n_lines AND 10 * dotted <= 3 * n_lines AND 5 * top_pair <= n_words AS kept
FROM g
"""
