"""Operator 6: benchmark decontamination by spaced-seed hashing (DataFrame functions only).

Texts are words (runs of letters and digits, lower-cased).  Each fixed mask
selects some positions of a window and ignores the others, so a substituted word
under an ignored position does not change the window's hash.  The hashes of all
benchmark windows are joined with those of all document windows; every hit
gives an alignment (document start - item start), and around it the whole item
is laid against the document: the best run of aligned words, +1 for an equal
word and -1 for a substituted one, is verified.  A document is contaminated when
the run reaches ``needed_score`` of the item: ``MIN_SCORE``, for items of fewer
words all of them, from seven words on with one substituted.

The masks are complete: every row of equal and substituted words, of whatever
length, that reaches its needed score holds one of them inside its best run (the
test walks all rows that avoid them), so no alignment that the rule accepts goes
without a hit.

Items of fewer than ``MIN_WORDS`` words are a class of their own (``short``): they
are found where all their words stand side by side, and reported, but they are
common phrases and no ground to drop a document.

Only the benchmark's distinct texts are broadcast, after their windows have been
counted (``WINDOWS_BOUND``); a larger benchmark is joined by shuffling.  Ids join last.

Defined results: null or empty texts have no windows; items without words never
match; repeated rows give one row per (doc_id, item_id); null ids of both sides are
kept; empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import free_name, stage, text_digest

# The masks (1 selects a position).
MASKS = ("1111", "11101", "11011", "111001", "101011")
MIN_SCORE = 10
MIN_WORDS = 5
WINDOWS_BOUND = 1_000_000  # benchmark windows that may be broadcast (48 bytes each)
IDS_BOUND = 1_000_000


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hash(words: Column, pos: Column, mask: str) -> Column:
    """Hash of the selected words; null where the window leaves the text."""
    picked = [F.get(words, pos + i) for i, bit in enumerate(mask) if bit == "1"]
    return F.when(pos + len(mask) <= F.size(words), F.xxhash64(*picked))


def _windows(rows: DataFrame, masks: list[str]) -> DataFrame:
    """One row per position and mask: the rows' columns, pos, mask, h."""
    rows = rows.withColumn("pos", F.explode(F.sequence(F.lit(0), F.size("words") - 1)))
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), _hash(F.col("words"), F.col("pos"), m).alias("h"))
                     for i, m in enumerate(masks)])
    return rows.select("*", F.inline(keys))


def needed_score(words: Column) -> Column:
    """The score an item of so many words has to reach."""
    return F.when(words >= MIN_SCORE, F.lit(MIN_SCORE)).otherwise(words - 2 * F.floor(words / 7)).cast("int")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated (doc_id, item_id): doc_start, doc_end (words),
    item_start, n_equal, n_substituted, score of the best run, short."""
    docs, benchmark = _words_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), _items(benchmark)
    out = _leaks(docs, benchmark.filter(F.size("words") >= MIN_WORDS))
    few = benchmark.filter(F.size("words") < MIN_WORDS)
    return out if few.isEmpty() else out.unionByName(_short_items(docs, few))


def _words_of(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", word_list(F.col("text").cast("string")).alias("words"))


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            word_list(F.col("text").cast("string")).alias("words")) \
        .filter(F.size("words") > 0).withColumn("item", F.md5(F.concat_ws(" ", "words"))).distinct()


def _short_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Items under MIN_WORDS words where they stand in full: the first place in each document.
    A document's phrases are made distinct before the join."""
    phrase = lambda n: F.transform(
        F.sequence(F.lit(0), F.size("words") - n), lambda i: F.array_join(F.slice("words", i + 1, n), " "))
    phrases = F.flatten(F.array(*[F.when(F.size("words") >= n, phrase(n)).otherwise(F.array().cast("array<string>"))
                                  for n in range(1, MIN_WORDS)]))
    said = docs.withColumn("phrase", F.explode(F.array_distinct(phrases)))
    asked = items.select("item_id", F.array_join("words", " ").alias("phrase"), F.size("words").alias("n"))
    start = F.array_position(phrase(F.col("n")), F.col("phrase")).cast("int") - 1
    return said.join(asked, "phrase").select(
        "doc_id", "item_id", start.alias("doc_start"), (start + F.col("n")).alias("doc_end"), F.lit(0).alias("item_start"),
        F.col("n").alias("n_equal"), F.lit(0).alias("n_substituted"), F.col("n").alias("score"),
        F.lit(True).alias("short")).dropDuplicates(["doc_id", "item_id"])


def _leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Leaks of items of MIN_WORDS words or more; ``docs``: doc_id and words."""
    size = F.size("words")
    texts = items.select("item", "words").dropDuplicates(["item"])
    keys = _windows(texts, list(MASKS)).filter("h IS NOT NULL").select(
        "h", "mask", "item", F.col("pos").alias("item_pos"), size.alias("item_words"))
    few = keys.count() <= WINDOWS_BOUND
    small = F.broadcast if few else (lambda x: x)
    own = docs.filter(size >= MIN_WORDS)
    hits = _windows(own, list(MASKS)).join(small(keys), ["mask", "h"])
    shift = F.col("pos") - F.col("item_pos")
    low = F.greatest(shift, F.lit(0))
    high = F.least(F.size("words"), shift + F.col("item_words"))
    aligned = hits.select("doc_id", "item", shift.alias("shift"), low.alias("doc_low"),
                          F.slice("words", low + 1, high - low).alias("part")) \
        .dropDuplicates(["doc_id", "item", "shift", "part"])
    lines = aligned.join(small(texts), "item")
    equal = F.zip_with("part", F.slice("words", F.col("doc_low") - F.col("shift") + 1, F.size("part")),
                       lambda a, b: a == b)
    best = _best_run(equal)
    found = lines.withColumn("run", best).filter(F.col("run.score") >= needed_score(size))
    start = F.col("doc_low") + F.col("run.start")
    length = F.col("run.end") - F.col("run.start")
    rows = found.select(
        "doc_id", "item", F.struct(
            F.col("run.score").alias("score"), (-start).alias("_near"), (start + length).alias("doc_end"),
            (start - F.col("shift")).alias("item_start"), ((length + F.col("run.score")) / 2).cast("int").alias("n_equal"),
            ((length - F.col("run.score")) / 2).cast("int").alias("n_substituted")).alias("r"))
    out = rows.groupBy("doc_id", "item").agg(F.max("r").alias("r")).join(items.select("item", "item_id"), "item")
    return out.select("doc_id", "item_id", (-F.col("r._near")).alias("doc_start"), "r.doc_end", "r.item_start",
                      "r.n_equal", "r.n_substituted", "r.score", F.lit(False).alias("short"))


def _best_run(equal: Column) -> Column:
    """Best-scoring run of aligned words: score, start, end (positions in the alignment)."""
    zero = F.struct(*[F.lit(0).alias(c) for c in ("at", "now", "since", "score", "start", "end")])

    def step(acc: Column, hit: Column) -> Column:
        fresh = acc["now"] <= 0
        now = F.when(hit, F.lit(1)).otherwise(F.lit(-1)) + F.when(fresh, F.lit(0)).otherwise(acc["now"])
        since = F.when(fresh, acc["at"]).otherwise(acc["since"])
        better = now > acc["score"]
        return F.struct((acc["at"] + 1).alias("at"), now.alias("now"), since.alias("since"),
                        F.when(better, now).otherwise(acc["score"]).alias("score"),
                        F.when(better, since).otherwise(acc["start"]).alias("start"),
                        F.when(better, acc["at"] + 1).otherwise(acc["end"]).alias("end"))

    return F.aggregate(equal, zero, step)


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any verified benchmark passage (short items do not count);
    columns as they are.

    Texts are told apart by their digest, not by doc_id: a leak under a null or
    repeated id takes no other text of that id with it."""
    digest, bad = text_digest(F.col("text")), free_name(docs, "bad")
    leaks = _leaks(_words_of(docs.select(digest.alias("doc_id"), "text")),
                   _items(benchmark).filter(F.size("words") >= MIN_WORDS))
    found = stage(leaks.select(F.col("doc_id").alias(bad)).distinct(), "leaks")
    few = found.count() <= IDS_BOUND
    return docs.join(F.broadcast(found) if few else found, digest == F.col(bad), "left_anti")
