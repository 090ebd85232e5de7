"""Trained operators, sharding, likeness and the pipeline against plain Python versions; ids, names and texts
at the edges."""
import bisect
import hashlib
import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from finlake.llm import decontaminate, fingerprints, hilbert, language, line_dedup, tokens, toxicity

from .conftest import rows

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.1"
TEXTS = [(r[0], r[1]) for r in rows()]
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
drivers = pytest.mark.skipif(not os.path.exists(BIG), reason="driver tables not present")


@drivers
def test_token_ids_equal_the_tokenizer_on_all_texts():
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokens.default_vocabulary())
    plain.encode_special_tokens = True
    texts = pq.read_table(f"{BIG}/documents.parquet", columns=["text"]).column("text").to_pylist()
    cached = tokens.CachedTokenizer(tokens.default_vocabulary())
    for i in range(0, len(texts), 2000):
        part = texts[i:i + 2000]
        want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch_fast([t or "" for t in part], add_special_tokens=False)]
        assert cached.encode(part) == want


EDGES = ["it's we'll I'D they've 'tis rock'n'roll ''s 's't", "a b\x0bc\x1bd", "½ cup, 3² x¹ ªº µ", "İstanbul ǅ ŉ ß ẞ", "é é",
         "<|endoftext|> a<|startoftext|>", "—–…“x” don’t", " ", "\n\n", "1234567890", "x" * 70_000, "Ÿ Ǆ ȺɎ ʼ", "a_b __c__", "日本語 text"]


def test_token_ids_at_the_edges(monkeypatch):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokens.default_vocabulary())
    plain.encode_special_tokens = True
    monkeypatch.setattr(tokens, "SLICE", 50)
    monkeypatch.setattr(tokens, "CACHE", 40)
    cached = tokens.CachedTokenizer(tokens.default_vocabulary())
    texts = [t for _, t in TEXTS] + EDGES + ["".join(map(chr, range(a, a + 40))) for a in range(1, 0x250, 37)]
    for _ in range(3):
        got = cached.encode(texts)
        assert got == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if t else b"" for t in texts]


def plain_probabilities(net, data):
    """Softmax over pooled convolutions of one window, filter by filter."""
    x = [net.p["emb"][b].astype(np.float64) for b in data]
    pooled = []
    for w in language.WIDTHS:
        for f in range(net.p[f"b{w}"].shape[0]):
            kernel = net.p[f"w{w}"][:, f].astype(np.float64)
            best = max(float(np.concatenate(x[i:i + w]) @ kernel) for i in range(len(x) - w + 1))
            pooled.append(max(best + float(net.p[f"b{w}"][f]), 0.0))
    z = np.array(pooled) @ net.p["out"].astype(np.float64) + net.p["bias"]
    z = np.exp(z - z.max())
    return z / z.sum()


def test_language_scores_by_plain_convolution(spark, odd):
    learn = odd.select("doc_id", "text", "lang").filter("doc_id IS NOT NULL")
    net = language.train(learn, epochs=2)
    got = {r.doc_id: r for r in language.predict(odd, net).collect() if r.doc_id is not None}
    for d, t in [x for x in TEXTS if x[0] in (5, 9, 10, 25)]:
        data = t.encode()
        wins = [data[i:i + 256] for i in range(0, len(data), 256)]
        logs = sum(np.log(plain_probabilities(net, w.ljust(256, b"\0"))) * len(w) for w in wins) / len(data)
        p = np.exp(logs - logs.max())
        p /= p.sum()
        assert got[d].lang_pred == net.classes[int(p.argmax())]
        assert math.isclose(got[d].score, p.max(), rel_tol=1e-3, abs_tol=1e-4)


def test_nothing_labelled_keeps_every_text_with_letters(spark, odd):
    none = odd.withColumn("lang", odd.lang.substr(1, 0).cast("int").cast("string"))
    none = odd.selectExpr(*[c if c != "lang" else "cast(null as string) AS lang" for c in odd.columns])
    kept = Counter((r.doc_id, r.text) for r in P.identify_language(spark, none, "").collect())
    assert kept == Counter((d, t) for d, t in TEXTS if t and any(map(str.isalpha, t)))


def test_toxicity_by_plain_cumulative_links(spark):
    docs = spark.createDataFrame([(i, f"plain words {i} and more {i % 7} text " * 3 + ("foulness filthyword " * (1 + i % 5) if i % 4 == 0 else ""))
                                  for i in range(300)], "doc_id long, text string")
    model = toxicity.train(docs, docs.selectExpr("doc_id", "cast(doc_id % 4 = 0 as int) toxic"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for r in docs.collect()[:60]:
        cols, vals = toxicity.features(r.text)
        x = sum(float(v) * float(model.weights[c]) for c, v in zip(cols, vals))
        above = [1 / (1 + math.exp(-(x - c))) for c in model.cuts]  # P(grade > k)
        assert math.isclose(got[r.doc_id].severity, sum(above), rel_tol=1e-3, abs_tol=1e-3)


def test_shards_are_runs_of_the_curve(spark):
    sources = ["https://alpha", "https://beta", "https://alphabet", "https://gamma", None]
    data = [(i, "x" * (i * 37 % 901), ["de", "en", "fr", None][i % 4], sources[i * 7 % 5]) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(5)
    out = hilbert.shard_documents(docs)
    got = sorted(out.collect(), key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in got] == sorted(r.curve for r in got)
    ties = [(r.curve, r.doc_id, r.text_crc32) for r in got]
    assert ties == sorted(ties)
    by = defaultdict(set)
    for r in got:  # equal metadata, equal place; sources that share a long prefix are told apart
        by[r.lang, r.source, r["size"]].add(r.curve)
    assert all(len(v) == 1 for v in by.values())
    one = [r for r in got if r.lang == "de"]
    assert len({r.curve for r in one if 400 <= r["size"] < 420}) > 1

    def rank(values):
        known = sorted({v for v in values if v is not None})
        return [None if v is None else known.index(v) + 1 for v in values]

    def cells(numbers, bits=6):
        have = sorted(x for x in numbers if x is not None)
        cuts = [have[max(0, math.ceil(len(have) * i / 64) - 1)] for i in range(1, 64)]
        return [0 if x is None else bisect.bisect_left(cuts, x) for x in numbers]
    axes = [cells(rank([r.lang for r in got])), cells(rank([r.source for r in got])), cells([r["size"] for r in got])]
    points = spark.createDataFrame([(i, *map(int, p)) for i, p in enumerate(zip(*axes))], "i long, a int, b int, c int")
    want = {r.i: r.h for r in points.withColumn("h", hilbert.hilbert_index([points.a, points.b, points.c], 6)).collect()}
    assert [r.curve for r in got] == [want[i] for i in range(len(got))]


def test_written_shards_prune_by_source(spark, tmp_path):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('https://site', lpad(cast(id % 40 AS string), 3, '0')) AS source",
                                        "id * 31 % 5000 AS size", "id AS text_crc32")
    hilbert.write_shards(docs, str(tmp_path / "s"), ["source", "size"], ["doc_id", "text_crc32"], shards=16)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 4000 and back.select("shard").distinct().count() == 16
    per_source = back.groupBy("source").agg({"shard": "approx_count_distinct"}).collect()
    assert max(r[1] for r in per_source) <= 8  # one source lies in at most half of the files


def test_likeness_by_plain_matching():
    a = "One line here. And more. \nAnother line there. It goes on.\n\nThe end of it all." * 8
    for b in (a, a.replace("goes", "went", 2), a[:200], "", a[::-1], a + a[:77]):
        ta, tb = fingerprints.Tree.of(a), fingerprints.Tree.of(b)
        leaves = lambda t: Counter(x for p in fingerprints._LINE.findall(t) for x in fingerprints._leaves(p))
        most = sum(n * len(x) for x, n in (leaves(a) & leaves(b)).items())  # leaves matched wherever they are
        got = fingerprints.likeness(ta, tb)
        assert got == fingerprints.likeness(tb, ta) or abs(got - fingerprints.likeness(tb, ta)) < 0.2
        assert 0 <= got <= most / max(len(a), len(b), 1) + 1e-9
        assert (got == 1) == (a == b)
    near = fingerprints.likeness(fingerprints.Tree.of(a), fingerprints.Tree.of(a.replace("goes", "went", 1)))
    assert near > 0.9


EXTREME = [(LOWEST, "a line that two of them share\nown one"), (HIGHEST, "a line that two of them share\nown two"),
           (None, "a line that two of them share\nown three"), (None, "a line without an id\na line that two of them share"),
           (HIGHEST, "a line without an id\nsecond text of an id"), (HIGHEST - 1, "only the largest and null"), (None, "only the largest and null")]


def test_extreme_ids(spark):
    docs = spark.createDataFrame(EXTREME, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == Counter([(LOWEST, EXTREME[0][1]), (HIGHEST, "own two"), (None, "own three"), (None, ""),
                           (HIGHEST, EXTREME[4][1]), (HIGHEST - 1, EXTREME[5][1]), (None, "")])
    order = sorted(EXTREME, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter()
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        want[d, hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in fingerprints.compare_with_next(docs).collect()) == want


def test_one_hot_id_is_spread(spark):
    """All rows without an id: their lines are dealt over the parts, texts stay whole."""
    docs = spark.createDataFrame([(None, f"own line number {i}\ncommon line of all") for i in range(200)] + [(1, "common line of all")],
                                 "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == Counter([(None, f"own line number {i}") for i in range(200)] + [(1, "common line of all")])


CLASH = ["_gone", "_gone_text", "_bad", "_one", "_row", "_h", "_part", "_id", "_k0", "words", "row", "digest", "BAD", "top", "part"]


def plain_pipeline(docs, bench):
    """Line de-duplication, Jaccard classes and item alignment, in plain Python; rows (doc_id, text)."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(low)
    rank = lambda d: math.inf if d is None else d
    held = defaultdict(set)
    for d, t in docs:
        for x in t.split("\n"):
            if len(key(x)) >= 10:
                held[key(x)].add(rank(d))
    docs = [(d, "\n".join(x for x in t.split("\n") if len(held[key(x)]) < 2 or min(held[key(x)]) == rank(d))) for d, t in docs]
    stages = [Counter(docs)]
    sets = []
    for d, t in docs:
        w = t.encode().lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                up[root(j)] = root(i)
    digest = lambda i: hashlib.md5(docs[i][1].encode()).digest()
    classes = defaultdict(list)
    for i in range(len(docs)):
        classes[root(i)].append(i)
    kept = []
    for members in classes.values():
        if not sets[members[0]]:
            kept += [docs[i] for i in members]
            continue
        best = min(members, key=lambda i: (rank(docs[i][0]), digest(i)))
        kept += [docs[i] for i in members if docs[i] == docs[best] and docs[i][0] is not None]
        kept += [docs[best]] * (docs[best][0] is None)
    stages.append(Counter(kept))
    words = lambda t: [x for x in re.split(r"[\W_]+", t.lower()) if x]
    clean = []
    for d, t in kept:
        w, leak = words(t), False
        at = defaultdict(list)
        for i, x in enumerate(w):
            at[x].append(i)
        for item in bench:
            v = words(item)
            if len(v) < 5 or leak:
                continue
            need = 10 if len(v) >= 10 else len(v) - 2 * (len(v) // 7)
            for shift, n in Counter(i - j for j, x in enumerate(v) for i in at[x]).items():
                if n < need:
                    continue
                now = best = 0
                for j in range(len(v)):
                    if 0 <= shift + j < len(w):
                        now = max(now, 0) + (1 if w[shift + j] == v[j] else -1)
                        best = max(best, now)
                leak |= best >= need
        if not leak:
            clean.append((d, t))
    stages.append(Counter(clean))
    return stages


def run_stages(spark, docs, sf):
    out = []
    names = docs.columns
    for name, step in P.STAGES[:-1]:
        docs = P.stage(step(spark, docs, sf), f"t-{name}")
        assert docs.columns == names
        out.append(docs)
    return out, P.STAGES[-1][1](spark, docs, sf)


def compare_with_plain(spark, docs, sf, bench):
    staged, pieces = run_stages(spark, docs, sf)
    pairs = [Counter((r.doc_id, r.text) for r in s.select("doc_id", "text").collect()) for s in staged]
    assert all(t and any(map(str.isalpha, t)) for _, t in pairs[0])
    want = plain_pipeline(list(pairs[0].elements()), bench)
    for got, w in zip(pairs[1:], want):
        assert got == w
    full = Counter((r.doc_id, r.doc_tokens, r.start, r.length) for r in pieces.collect())
    cached = tokens.tokenizer(tokens.default_vocabulary())
    assert sum(n * c for (*_, n), c in full.items()) == sum(len(cached.encode([t])[0]) // 4 + 1 for _, t in pairs[-1].elements())


def test_pipeline_on_odd_rows_with_clashing_names(spark, odd, tmp_path):
    docs = odd
    for c in CLASH:
        if c.lower() not in {x.lower() for x in docs.columns}:
            docs = docs.selectExpr("*", f"cast(doc_id % 3 AS int) AS `{c}`")
    sf = str(tmp_path)
    bench = [TEXTS[10][1], None, "a b"]
    spark.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    compare_with_plain(spark, docs, sf, [b for b in bench if b])
    _, pieces = run_stages(spark, docs.filter("false"), sf)
    assert pieces.count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_pipeline_on_driver_tables(spark):
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    compare_with_plain(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, bench)


def test_short_items_are_reported_and_drop_nothing(spark):
    docs = spark.createDataFrame([(1, "so what is the capital of it"), (2, "what is a capital"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "What is the capital?"), (2, "capital"), (3, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.doc_start, r.doc_end, r.short) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {(1, 1, 1, 5, True), (1, 2, 4, 5, True), (2, 2, 3, 4, True)}
    assert decontaminate.remove_leaks(docs, bench).count() == 3



def random_list(seed, k, late):
    r = np.random.default_rng(seed)
    n = r.integers(20, 400, k).astype(np.int32)
    pos = np.array([r.integers(0, max(1, int(x * (0.2 if late else 0.02)))) for x in n], np.int32)
    maps = r.integers(-2 ** 63, 2 ** 63 - 1, (k, 8), dtype=np.int64)
    maps[::3] = maps[0]  # some sets that the maps cannot tell apart
    return {"token": np.full(k, 7, np.int64), "_b1": np.zeros(k, np.int32), "_b2": np.zeros(k, np.int32), "_own": np.zeros(k, np.int32),
            "id": np.arange(k, dtype=np.int64), "n": n, "pos": pos, "label": (np.arange(k) // 5).astype(np.int64), "map": maps}


@pytest.mark.parametrize("k,late", [(5, False), (128, True), (129, False), (1500, True), (1500, False)])
def test_blocks_skip_pairs_and_lose_none(k, late):
    """Candidates of a long mixed list equal those of all pairs; most block pairs are never looked at."""
    from finlake.llm import ngram_join
    c = random_list(k, k, late)
    order = np.lexsort((c["id"], c["pos"], c["n"]))
    c = {x: v[order] for x, v in c.items()}
    x, y = np.triu_indices(k, 1)
    ok = ngram_join._allowed(c, x, y)
    x, y = x[ok], y[ok]
    ok = ngram_join._maps_allow(c, x, y) if len(x) else np.zeros(0, bool)
    want = {(min(a, b), max(a, b)) for a, b in zip(c["id"][x[ok]].tolist(), c["id"][y[ok]].tolist())}
    got = {(a, b) for p in ngram_join._compare(c) for a, b in zip(p.column("a").to_pylist(), p.column("b").to_pylist())}
    assert got == want
    if k == 1500:
        skipped, total = ngram_join.BlockedList(c).skipped()
        assert skipped > 0.6 * total


def test_blocks_of_one_class_are_skipped():
    from finlake.llm import ngram_join
    c = random_list(3, 640, False)
    c["n"][:] = 100
    c["label"][:] = 0
    c["label"][-1] = 1
    skipped, total = ngram_join.BlockedList(c).skipped()
    assert total == 55 and skipped >= 45
