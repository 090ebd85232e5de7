"""Operators against brute force, on odd rows, empty tables and the smallest driver tables."""
import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from finlake.llm import (decontaminate, fingerprints, hilbert, language, lattice, line_dedup, ngram_join,
                         packing, queries, token_counts, toxicity)
from finlake.llm.components import components

from .conftest import rows

SF = "/root/testdata/sf0.001"
TEXTS = [(r[0], r[1]) for r in rows()]


def whole_ids():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return [(d, np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4")) for d, x in TEXTS]


def test_packing_covers_every_id_once(odd, empty):
    got = packing.digest(packing.pack(odd, capacity=256, open_windows=4)).collect()
    ids = defaultdict(list)
    for d, x in whole_ids():
        ids[d].append(x)
    for r in got:
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   for x in ids[r.doc_id])
    assert sum(r.length for r in got) == sum(len(x) for v in ids.values() for x in v)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for off, n in sorted(pieces):
            assert off == at
            at += n
        assert at <= 256
    assert packing.pack(empty).count() == 0


def test_token_histogram(odd, empty):
    lengths = [len(x) for _, x in whole_ids()]
    hist = token_counts.histogram(token_counts.token_lengths(odd))
    for r in token_counts.limits_report(hist).collect():
        assert r.n_docs == lengths.count(r.length) and r.docs_at_least == sum(n >= r.length for n in lengths)
        assert r.tokens_kept == sum(min(n, r.length) for n in lengths) and r.total_tokens == sum(lengths)
    for r in token_counts.totals_at(hist, [0, 7, 10 ** 6]).collect():
        assert r.tokens_kept == sum(min(n, r.context_limit) for n in lengths)
    assert token_counts.limits_report(token_counts.histogram(token_counts.token_lengths(empty))).count() == 0


def brute_sets():
    out = []
    for d, t in TEXTS:
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        out.append((d, {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()))
    return out


def test_ngram_join(odd, empty):
    sets = brute_sets()
    up = {d: d for d, _ in sets}
    big = lambda d: math.inf if d is None else d
    for _ in sets:
        for a, x in sets:
            for b, y in sets:
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    up[b] = min(up[a], up[b], key=big)
    got = ngram_join.digest(ngram_join.join_components(odd)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        (d, len(s), up[d]) for d, s in sets)
    assert ngram_join.join_components(empty).count() == 0


def test_rows_without_an_id_or_with_a_shared_one(spark):
    import corpus_pipeline as P
    text = lambda x: " ".join(f"{x}{i}" for i in range(80))
    near = lambda x: text(x).replace(f"{x}0 ", "other ")
    rows_ = [(5, text("a")), (9, text("b")), (None, text("a")), (None, near("b")), (None, text("c")), (None, near("c")),
             (None, text("c")), (None, text("d")), (None, ""), (None, None), (7, near("a")), (7, text("e")), (8, near("e"))]
    docs = spark.createDataFrame([(*r, "en") for r in rows_], "doc_id long, text string, lang string").repartition(3)
    got = ngram_join.join_components(docs).collect()
    by_sql = {"a": 5, "b": 9, "e": 5}  # the SQL takes an id as one node, so 7 ties a and e; a missing id ties nothing
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter(
        (d, by_sql.get((t or "-").split()[-1][:1] if t else "")) for d, t in rows_)
    kept = Counter((r.doc_id, r.text) for r in P.deduplicate_documents(spark, docs, "").collect())
    copies = [kept.pop((None, x), 0) for x in (text("c"), near("c"))]
    assert sum(copies) == 1
    assert kept == Counter([(5, text("a")), (9, text("b")), (None, text("d")), (None, ""), (None, None), (7, text("e"))])
    bench = spark.createDataFrame([(1, text("d")), (2, text("e"))], "item_id long, text string")
    left = decontaminate.remove_leaks(docs, bench)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(
        (d, t) for d, t in rows_ if t not in (text("d"), text("e"), near("e")))


def test_components(spark):
    edges = spark.createDataFrame([(9, 8), (8, 7), (7, 6), (6, 5), (20, 21), (21, 22), (30, 30)], "a long, b long")
    got = {r.id: r.label for r in components(edges).collect()}
    assert got == {5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 20: 20, 21: 20, 22: 20}


def test_line_dedup(odd, empty):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(line_dedup._LOWER)
    docs = [(math.inf if d is None else d, t or "") for d, t in TEXTS]
    held = defaultdict(set)
    for d, t in docs:
        for x in t.split("\n"):
            if len(key(x)) >= 10:
                held[key(x)].add(d)
    want = Counter()
    for d, t in docs:
        keep = [x for x in t.split("\n") if len(held[key(x)]) < 2 or min(held[key(x)]) == d]
        want[(None if d == math.inf else d, t.count("\n") + 1, t.count("\n") + 1 - len(keep),
              hashlib.sha256("\n".join(keep).encode()).hexdigest())] += 1
    assert Counter(map(tuple, line_dedup.digest(line_dedup.dedup_lines(odd)).collect())) == want
    assert line_dedup.dedup_lines(empty).count() == 0
    kept = line_dedup.dedup_lines(odd, keep=odd.columns)
    assert {"lang", "n_chars", "component_id", "_part"} <= set(kept.columns) and kept.count() == len(docs)


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2 ** 63, n).astype(np.uint64))
    at = line_dedup.PerfectHash(keys)(keys)
    assert sorted(at.tolist()) == list(range(len(keys)))


def test_decontamination(spark, odd, empty):
    items = [(1, " ".join(f"bench{i}" for i in range(40))), (2, "six short words stand right here"), (3, None), (4, "a b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    w = items[0][1].split()
    for i in (5, 13, 22, 31):
        w[i] = "changed"
    docs = spark.createDataFrame([(1, "before " + items[0][1] + " after"), (2, "intro " * 9 + " ".join(w)),
                                  (3, "Well, SIX short words; stand right here!"), (4, "six short words stood right there"),
                                  (5, " ".join(w[:6])), (6, None), (7, "a b"), (None, items[0][1])], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 2), (None, 1), (7, 4)}
    assert [k for k, r in got.items() if r.short] == [(7, 4)] and got[7, 4].score == 2
    assert (got[1, 1].doc_start, got[1, 1].doc_end, got[1, 1].n_equal) == (1, 41, 40)
    assert got[2, 1].n_substituted == 4 and got[2, 1].n_equal == 36
    assert {r.doc_id for r in decontaminate.remove_leaks(docs, bench).collect()} == {4, 5, 6, 7}
    assert decontaminate.find_leaks(odd, bench).count() == 0
    assert decontaminate.find_leaks(empty, bench).count() == 0 == decontaminate.find_leaks(docs, bench.filter("false")).count()


def avoiding_score(masks, need):
    """Best run score of a row of equal (1) and other (0) words, of any length, that holds none of the masks."""
    width = max(map(len, masks)) - 1
    best = {0: 0}  # last bits -> best score of a run that ends there; before its start there is no equal word
    while max(best.values()) < need:
        new = dict(best)
        for bits, x in best.items():
            for bit in (0, 1):
                row = bits << 1 | bit
                if not any(row & int(m, 2) == int(m, 2) for m in masks):
                    to = row & ((1 << width) - 1)
                    new[to] = max(new.get(to, 0), x + 2 * bit - 1)
        if new == best:
            break
        best = new
    return max(best.values())


def test_masks_are_complete():
    assert avoiding_score(decontaminate.MASKS, decontaminate.MIN_SCORE) < decontaminate.MIN_SCORE
    assert all("1" == m[0] == m[-1] and len(m) <= decontaminate.MIN_SCORE for m in decontaminate.MASKS)
    assert avoiding_score(("110100110101", "111001011", "1011000111"), 10) == 10
    for n in range(decontaminate.MIN_WORDS, decontaminate.MIN_SCORE):  # items too short for MIN_SCORE
        need = n - 2 * (n // 7)
        for row in range(1 << n):
            bits = f"{row:0{n}b}"
            if 2 * bits.count("1") - n >= need:
                assert any(all(bits[i + j] == "1" for j, b in enumerate(m) if b == "1")
                           for m in decontaminate.MASKS for i in range(n - len(m) + 1)), bits


def brute_leaks(docs, items):
    """Every item laid at every shift of every document."""
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out, short = {}, set()
    for d, t in docs:
        for i, x in items:
            w, v = words(t), words(x)
            if not v:
                continue
            if len(v) < decontaminate.MIN_WORDS:
                at = next((a for a in range(len(w) - len(v) + 1) if w[a:a + len(v)] == v), None)
                if at is not None:
                    short.add((d, i, at, at + len(v), 0, len(v), 0, len(v), True))
                continue
            need = decontaminate.MIN_SCORE if len(v) >= decontaminate.MIN_SCORE else len(v) - 2 * (len(v) // 7)
            for shift in range(1 - len(v), len(w)):
                low, now, since = max(shift, 0), 0, 0
                top = (0, 0, 0)
                for at in range(low, min(len(w), shift + len(v))):
                    if now <= 0:
                        now, since = 0, at
                    now += 1 if w[at] == v[at - shift] else -1
                    if now > top[0]:
                        top = (now, since, at + 1)
                score, a, b = top
                if score >= need:
                    r = (score, -a, b, a - shift, (b - a + score) // 2, (b - a - score) // 2)
                    out[d, i] = max(out.get((d, i), r), r)
    return short | {(d, i, -r[1], r[2], r[3], r[4], r[5], r[0], False) for (d, i), r in out.items()}


def test_leaks_against_every_shift(spark):
    rng = np.random.default_rng(6)
    lengths = [4, 5, 6, 9, 7, 8, 10, 11, 12, 16, 20, 20, 59, 59, 200]
    items = [(i, " ".join(f"i{i}w{rng.integers(40)}" for _ in range(n))) for i, n in enumerate(lengths)]
    items += [(None, "a benchmark passage that has no id of its own but still counts"), (3, items[9][1]), (3, items[10][1]), (90, "i0w1"), (91, "")]
    docs = [(None, items[15][1])]

    def plant(item, gone):
        w = items[item][1].split()
        docs.append((len(docs), " ".join(["before"] * int(rng.integers(4)) + [f"sub{i}" if i in gone else x for i, x in enumerate(w)])))
    plant(9, (2, 6, 8))
    for item, n in enumerate(lengths):
        for every in (2, 3, 4):
            for first in range(every):
                plant(item, range(first, n, every))
        for share in (0.1, 0.2, 0.25, 0.3, 0.4, 0.45):
            for _ in range(4):
                plant(item, {i for i in range(n) if rng.random() < share})
        plant(item, {0})
        plant(item, {n - 1})
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute_leaks(docs, items)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    found = {(d, i) for d, i, *_ in want}
    assert {(1, 9), (None, None), (1, 3)} <= found and len(found) > 200
    assert any(d for d, i, *r in want if i == 4 and r[4] == 1)  # one of seven words substituted


def test_fingerprints(odd, empty):
    order = sorted(TEXTS, key=lambda r: (-(r[0] if r[0] is not None else -math.inf), r[1] or ""))
    want = Counter()
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), str(fingerprints.Tree.of(t)),
              str(fingerprints.Tree.of(edited)))] += 1
    got = fingerprints.compare_with_next(odd).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.compare_with_next(empty).count() == 0
    a = "One line here.\nAnother line there. It goes on.\nThe end." * 5
    b = a.replace("goes", "went", 1)
    fa, fb = str(fingerprints.Tree.of(a)), str(fingerprints.Tree.of(b))
    assert fingerprints.edits(fa, fa) == []
    assert any(s <= b.index("went") < e for s, e in fingerprints.edits(fa, fb))
    assert "".join(x for p in fingerprints._LINE.findall(a) for x in fingerprints._leaves(p)) == a


def test_hilbert_curve_steps_to_neighbours(spark):
    points = spark.range(512).selectExpr("cast(id % 8 as int) x", "cast(id div 8 % 8 as int) y", "cast(id div 64 as int) z")
    got = points.withColumn("h", hilbert.hilbert_index([points.x, points.y, points.z], 3)).orderBy("h").collect()
    assert [r.h for r in got] == list(range(512))
    assert all(sum(abs(p[i] - q[i]) for i in range(3)) == 1 for p, q in zip(got, got[1:]))


def test_sharding_rows_law(odd, empty):
    got = hilbert.digest(hilbert.shard_documents(odd)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in TEXTS)
    assert hilbert.shard_documents(empty).count() == 0


def test_language(odd, empty):
    got = {r.doc_id: r for r in language.identify(odd).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 4))
    assert got[20].lang_pred in ("en", "de", "fr") and 0 <= got[20].score <= 1
    assert got[20].held_out == (zlib.crc32(b"20") % 3 == 1)
    assert language.identify(empty).count() == 0


def segmentations(word, vocab, p):
    """Sum over all segmentations by plain recursion."""
    inner = {n: i for i, n in enumerate(vocab.names[:vocab.inner])}
    first = {n: i + vocab.inner for i, n in enumerate(vocab.names[vocab.inner:])}

    def rest(at):
        return sum(p[inner[word[at:j]] + (vocab.size if j == len(word) else 0)] * (1.0 if j == len(word) else rest(j))
                   for j in range(at + 1, min(len(word), at + max(vocab.longest)) + 1) if word[at:j] in inner)
    total = p[first[b""]] * rest(0)
    for j in range(1, len(word) + 1):
        if word[:j] in first:
            total += p[first[word[:j]] + (vocab.size if j == len(word) else 0)] * (1.0 if j == len(word) else rest(j))
    return total


def test_lattice_sums_all_segmentations():
    vocab = lattice.pieces(lattice.default_vocabulary())
    words = [b"the", b"thering", "été".encode(), b"q", b"zzxq.", "населения".encode()]
    assert max(vocab.longest) == 24 and "населения".encode() in vocab.names  # no piece is left out for its length
    p = vocab.fit(np.zeros(len(vocab.prior)))
    for _ in range(2):
        for w, got in zip(words, lattice.log_marginals(vocab, p, words)):
            assert math.isclose(math.exp(got), segmentations(w, vocab, p), rel_tol=1e-9)
        uses = lattice.expected_counts(vocab, p, words, np.ones(len(words)))
        assert math.isclose(uses[vocab.size:].sum(), len(words), rel_tol=1e-9)  # every word ends once
        p = vocab.fit(uses)


def test_lm_scores(odd, empty):
    got = lattice.score_documents(odd).collect()
    train, n = Counter(), 0
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    for d, t in TEXTS:
        if not held(d):
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    want = Counter((d, held(d), len(tokens(t)), sum(train[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for d, t in TEXTS)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    few = lattice.score_documents(odd.filter("doc_id < 30")).collect()
    rows_ = odd.filter("doc_id < 30").select("doc_id", "text").withColumn("held_out", lattice.fold(odd.doc_id, 10) == 0)
    model, words = lattice.learn(rows_)
    alone = lattice.score(rows_, model, words, frequent=0).collect()  # every word by the shuffled join
    assert sorted((r.doc_id, round(r.score, 6)) for r in few) == sorted((r.doc_id, round(r.score, 6)) for r in alone)
    assert lattice.score_documents(empty).count() == 0
    known = Counter(w for d, t in TEXTS if d is not None and d < 30 and not held(d) for w in tokens(t)[:-1])
    names = sorted({w for _, t in TEXTS for w in tokens(t)[:-1]})
    share = dict(zip(names, model.tokens(names, np.array([known[w] for w in names])) - model.stay()))
    want = sorted((d, drawn(tokens(t)[:-1], model, share)) for d, t in TEXTS if d is not None and d < 30)
    for (d, x), (e, y) in zip(want, sorted((r.doc_id, r.score) for r in alone)):
        assert d == e and math.isclose(x, y, rel_tol=1e-7)


def drawn(ws, model, share):
    """A document's score by drawing its words one after another, for every urn."""
    scores = []
    for a in lattice.ALPHAS:
        seen, x = Counter(), model.end()
        for i, w in enumerate(ws):
            x += model.stay() - math.log10(a + i)
            x += math.log10(a * 10 ** share[w] + seen[w]) if seen[w] else math.log10(a) + share[w]
            seen[w] += 1
        scores.append(x)
    top = max(scores)
    return top + math.log10(sum(10 ** (x - top) for x in scores) / len(scores))


def test_log_gamma():
    for y in (1.0, 1.5, 2.0, 30.0, 1e4, 1e9):
        assert math.isclose(float(lattice.log_gamma(np.array(y))), math.lgamma(y), rel_tol=1e-9, abs_tol=1e-9)


def test_remembered_words_score_like_whole_features():
    model = toxicity.OrdinalModel(np.where(np.arange(1 << toxicity.BITS) % 3 == 0, 0.5, 0).astype(np.float32), np.array([1.0]))
    scorer = toxicity.Scorer(model)
    for _, t in TEXTS * 2:
        cols, vals = toxicity.features(t)
        assert math.isclose(scorer.score(t), float(vals @ model.weights[cols]), rel_tol=1e-4, abs_tol=1e-4)


def test_toxicity(spark, odd, empty):
    docs = spark.createDataFrame([(i, f"plain words {i} and more {i % 7} text " * 5 + ("foulness filthyword " * (1 + i % 5) if i % 4 == 0 else ""))
                                  for i in range(400)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 4 = 0 as int) toxic")
    got = toxicity.score(docs, toxicity.train(docs, toxicity.held_in(labels))).collect()
    assert sum(r.toxic == (r.doc_id % 4 == 0) for r in got) >= 396
    model = toxicity.train(docs, labels)
    assert list(model.cuts) == sorted(model.cuts)
    assert toxicity.score(odd, model).count() == len(TEXTS) and toxicity.score(empty, model).count() == 0
    assert toxicity.train(docs, labels.filter("false")) is None and toxicity.score(docs, None).filter("toxic").count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.execute(queries.ORACLE_SQL[name]).df()[list(got.columns)]
    cols = list(got.columns)
    assert got.sort_values(cols).values.tolist() == want.sort_values(cols).values.tolist()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_pipeline(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, left = docs.columns, docs.count()
    for _, step in P.STAGES[:-1]:
        docs = P.stage(step(spark, docs, SF), "t")
        assert docs.columns == names and 0 < docs.count() <= left
        left = docs.count()
    pieces = P.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_the_plan_of_many_runs_fits_the_driver(spark):
    """A filter pushed through the search for a run multiplies at each step: it filled the driver at 211 runs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        fingerprints.compare_with_next(docs)._jdf.queryExecution().optimizedPlan()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
