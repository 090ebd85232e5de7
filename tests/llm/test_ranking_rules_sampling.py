"""Operators 11 to 13 against plain Python, on odd rows, empty tables and the smallest driver tables."""
import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import pytest

from finlake.llm import cascade, lexical, queries, resampling

from .conftest import rows

SF = "/root/testdata/sf0.001"
TEXTS = [(r[0], r[1]) for r in rows()]
LONG = " ".join(f"w{i % 997} the" for i in range(60_000)) + "\n" + "again and again\n" * 3000
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
big = lambda d: math.inf if d is None else d
drivers = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def long_odd(spark, odd):
    return odd.select("doc_id", "text", "_part").unionByName(
        spark.createDataFrame([(90, LONG, 1), (91, LONG, 2)], "doc_id long, text string, _part long"))


ALL = TEXTS + [(90, LONG), (91, LONG)]


def brute_search(docs, items, k):
    bags = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    of: dict = {}
    for i, t in items:
        of.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for i, ts in of.items():
        found = []
        for d, b in bags:
            m = 50 + 50 * sum(b.values()) * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * b[t]) // (1000 * b[t] + 20 * m)) for t in ts if b[t])
            if score > 0:
                found.append((-score, big(d), d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1)]
    return Counter(out)


ITEMS = [(1, "the small unique TEXT number 12 nobody"), (2, "word5x9 word60x4 other60x4"), (2, "w5 w6 again"), (3, None), (4, ""),
         (5, "nothing-matches zzzz"), (None, "a row without an id"), (6, "Σίσυφος çA naïve"), (7, "the " * 50)]


@pytest.mark.parametrize("k,block_terms", [(50, 500_000), (3, 500_000), (7, 6)])
def test_search_equals_brute_force(spark, long_odd, k, block_terms):
    items = spark.createDataFrame([(*x, 5) for x in ITEMS], "item_id long, text string, doc_id long")
    got = lexical.search(long_odd, items, k, block_terms).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == brute_search(ALL, ITEMS, k)


def test_search_on_empty_tables(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(empty, items).count() == 0
    got = lexical.search(odd, items.filter("false"))
    assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_equal_bags_are_scored_once(spark):
    """A hot class: 300 copies (other words differ), one better and one worse document."""
    docs = [(1000 - i, f"needle hay private{i}") for i in range(300)] + [(5000, "needle needle hay x"), (1, "hay x y")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    items = [(1, "needle hay"), (2, "hay")]
    got = lexical.search(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()) == brute_search(docs, items, 50)


def test_long_texts_are_cut_at_separators(monkeypatch):
    monkeypatch.setattr(lexical, "SLICE", 7)
    text = "Alpha beta-GAMMA  delta " * 9 + "x" * 40
    assert [t.decode() for p in lexical.terms(text) for t in p] == TERM.findall(text.translate(LOWER))


def brute_rules(t):
    t = t or ""
    ws = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(ws)
    windows = Counter(zip(ws, ws[1:], ws[2:]))
    covered = {j for i in range(n - 2) if windows[tuple(ws[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    chars = sum(map(len, ws))
    symbols = sum(c in "#*$%&|<>" for c in t)
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    pair = max(Counter(zip(ws, ws[1:])).values(), default=0)
    ok = (3 * n <= chars <= 10 * n and 10 * symbols <= n
          and 100 * sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in w) for w in ws) >= 80 * n
          and sum("A" <= c <= "Z" for c in t) <= sum("a" <= c <= "z" for c in t) and 2 * dup <= len(lines)
          and 10 * sum(bool(re.match(r"[ \t-\r]*([-*] |•)", x)) for x in lines) <= 9 * len(lines)
          and 10 * sum(bool(re.search(r"(\.\.\.|…)[ \t-\r]*\Z", x)) for x in lines) <= 3 * len(lines) and 5 * pair <= n)
    return n, chars, symbols, dup, len(covered), failed, not failed and ok


def prose(n, seed=0, sep=" "):
    return sep.join(f"wo{chr(97 + (i * 7 + seed) % 26)}d{'abcdefghij'[i % 10]}{'klmnop'[(i // 10) % 6]}" for i in range(n))


RULED = [prose(60), prose(60).upper(), prose(60).replace(" ", "# "), " ".join(["12", "34", "ab"] + [f"{i}" for i in range(60)]),
         "\n".join(f"- {prose(8, i)}" for i in range(9)), "\n".join(f"{prose(8, i)}..." for i in range(9)),
         "\n".join(f"{prose(8, i)}… " for i in range(2)) + "\n" + "\n".join(prose(8, i) for i in range(9, 18)),
         " ".join(f"the end {prose(1, i)}{i}" for i in range(30)), " ".join("x" for _ in range(70)), prose(60).replace("o", "o" * 20),
         "same line here\n" * 30 + prose(200), " a b " * 30, "\n \n\t\n" + prose(55, sep="\n"), "a b a b a b " + prose(70)]


def test_rules_equal_brute_force(spark, long_odd):
    extra = spark.createDataFrame([(200 + i, t, 1) for i, t in enumerate(RULED)], "doc_id long, text string, _part long")
    docs = [*ALL, *((200 + i, t) for i, t in enumerate(RULED))]
    want = Counter((d, *brute_rules(t)) for d, t in docs)
    for order in (None, list(range(len(cascade.RULES))), list(range(len(cascade.RULES)))[::-1]):
        judged = cascade.judge(long_odd.unionByName(extra), order=order)
        got = judged.collect()
        assert Counter(tuple(r)[:8] for r in got) == want
        for r in got:
            assert (r.rejected_by is None) == (r.base_failed or r.kept)
    assert len({r.rejected_by for r in got}) >= 6  # most rules reject something here


def test_cascade_order():
    # bit 0 rejects 90 at cost 9, bit 1 rejects 50 at cost 1, bit 2 only what bit 1 rejects too
    patterns = {0b001: 50, 0b011: 20, 0b111: 20, 0b010: 10, 0: 900}
    assert cascade.greedy_order(patterns, [9.0, 1.0, 0.9]) == [1, 0, 2]
    assert cascade.greedy_order({}, [3.0, 1.0, 2.0]) == [1, 2, 0]


def test_cascade_sample_and_empty(spark, empty):
    assert cascade.judge(empty).count() == 0
    docs = spark.createDataFrame([(i, prose(60, i) + (" #" * 20 if i % 2 else "")) for i in range(400)], "doc_id long, text string")
    order = cascade.fit_order(docs, sample_docs=100)
    assert sorted(order) == list(range(len(cascade.RULES))) and cascade.RULES[order[0]] is cascade.symbols


def brute_resample(docs, target, percent=5, min_words=20):
    def features(t):
        w = TERM.findall((t or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    cut = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, _, f in cut for b in f), Counter(b for x in target for b in features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    out = []
    for d, n, f in cut:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append((d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], big(r[0])))
    rank = [(r, i + 1) for i, r in enumerate(fit[:percent * len(fit) // 100])]
    left = Counter(out) - Counter(r for r, _ in rank)
    return Counter((*r, i) for r, i in rank) + Counter({(*r, None): n for r, n in left.items()})


TARGET = ["the small unique text", "word3x8 word4x2\nword5x9 and\n\n\nagain", None, ""]


@pytest.mark.parametrize("percent,chunk", [(5, 8 << 20), (40, 8 << 20), (100, 300)])
def test_resampling_equals_brute_force(spark, long_odd, monkeypatch, percent, chunk):
    monkeypatch.setattr(resampling, "CHUNK", chunk)
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, doc_id long")
    got = resampling.resample(long_odd, target, percent).collect()
    assert Counter(map(tuple, got)) == brute_resample(ALL, TARGET, percent)


def test_cross_line_runs_are_counted_once():
    for text in ("a\nb\nc\nd", "a b\nc\nd e f\ng", "a b c\nd e", "a\n\n\nb c\nd", "one", "", "x y\nz\n"):
        lines = resampling.lines_of(text)
        w = [x for y in lines for x in y.split(b" ")]
        want = Counter(resampling.bucket(b" ".join(w[i:i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        got = Counter(b for x in lines for b in resampling.inner_buckets(x).tolist())
        got += Counter(resampling.cross_buckets([resampling.Line(0, x) for x in lines]))
        assert got == want


def test_resampling_empty(spark, odd, empty):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert resampling.resample(empty, target).count() == 0
    assert Counter(map(tuple, resampling.resample(odd, target.filter("false")).collect())) == brute_resample(TEXTS, [])


@drivers
def test_resampling_query_on_driver_tables(spark):
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet')").fetchall()
    target = [r[0] for r in con.execute(f"SELECT text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()]
    got = queries.QUERIES["op13_resampling"](spark, SF).select("doc_id", "n_features", "weight", "score", "rank").collect()
    want = brute_resample(docs, target)
    assert Counter(map(tuple, got)) == Counter({(r[0], *r[2:]): n for r, n in want.items()})
