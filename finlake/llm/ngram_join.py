"""Operator 2: exact n-gram Jaccard join with set-relation skipping.

Texts become sets of distinct five-word shingles; two link when
|x & y| / |x | y| >= 4/5.  The result is one class id per document.

1. *Frequent shingles.*  All shingles of all texts are counted (by their upper
   32 bits, in buckets of that number range, so counting memory is bounded).
   The most frequent ones, a bounded list, come last in the global order; it
   only affects speed, any order gives the same links.
2. *Equal sets* collapse to their smallest row, before any index is built.  Sets
   are linked by their staged number in the order of these rows, never by doc_id.
3. *Index.*  Every set lists the shingles of its prefix (sets that link share at
   least one prefix shingle) with its size and the position.  Lists of one entry go.
4. *Hub rounds: answers of a highly similar set.*  In each list the smallest
   set is checked against the others.  A set that links with its hub takes over
   the hub's class, so pairs inside a class are never compared: a group of a
   thousand near copies costs about a thousand comparisons.
5. *Exact round: block skips.*  Lists that still hold several classes are cut into
   blocks of ``ENTRIES`` entries by size class and position.  Two blocks are skipped
   whole when their sizes are too far apart, when the best room that a position in
   them leaves cannot reach the overlap that their smallest sizes need, or when both
   hold the same single class.  In blocks that are not skipped pairs are tested alike one by
   one, and a 512-bit parity map bounds the overlap from above.  (Lists of a few
   entries are walked by size, many at a time.)  Very long lists are dealt by a hash of
   the set over tasks that pair up the parts.  What remains is compared exactly on
   whole texts.

Every link between different texts is either compared exactly or lies inside one
class.  Nothing is capped.  Hubs with many partners are salted.

Defined results: text without words (or null): no shingles, class of its own;
fewer than five words: the whole sequence is the one shingle; every row without
an id is a document of its own, larger than all that have one (a class of such
rows alone has the null class id); an empty table gives no rows; extra columns
are not read.  Different texts under one proper id: ``join_components`` follows
the SQL, where an id is one node; ``surplus`` (the pipeline) links each text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from finlake.llm.common import id_text, partitions, stage, text_digest, tidy
from finlake.llm.components import components
from finlake.llm.words import shingles

WORDS = 5
NUM, DEN = 4, 5  # similarity at least NUM / DEN
HEAVY_MIN, HEAVY_MAX = 8, 200_000  # listed frequent shingles: at least so often, at most so many
MAP_LONGS = 8  # 512-bit parity map
BLOCK = 4096  # entries of one list in one task's part
ENTRIES = 64  # entries of one (size class, position) block
SALT = 1000  # partners of a hub compared in one group
IDS_BOUND = 1_000_000  # ids that may be broadcast (16 MB); beyond, a shuffled join
HUB_ROUNDS = 2
_U = np.uint64


def prefix_length(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def links(common: int, n: int, m: int) -> bool:
    return common * (NUM + DEN) >= NUM * (n + m)


def _count_task(buckets: int):
    """(bucket, sorted 32-bit shingle numbers) in a few blobs per task."""
    def run(batches):
        held, size = [], 0

        def emit():
            x = np.sort(np.concatenate(held))
            edges = np.searchsorted(x, [(b << 32) // buckets for b in range(buckets)])
            ends = np.append(edges[1:], len(x))
            full = np.flatnonzero(ends > edges)
            return pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)),
                 pa.array([x[edges[b]:ends[b]].astype("<u4").tobytes() for b in full], pa.binary())],
                names=["bucket", "numbers"])

        for batch in batches:
            for t in batch.column("text").to_pylist():
                s = shingles(t, WORDS)
                if len(s):
                    held.append(s >> _U(32))
                    size += len(s)
            if size > 4_000_000:
                yield emit()
                held, size = [], 0
        if held:
            yield emit()
    return run


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    x = np.concatenate([p[0] for p in parts])
    c = np.concatenate([p[1] for p in parts])
    order = np.argsort(x, kind="stable")
    x, c = x[order], c[order]
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    return x[first], np.add.reduceat(c, first)


def _heavy_task(most: int):
    def run(batches):
        parts, size = [], 0
        for b in batches:
            for blob in b.column("numbers").to_pylist():
                x, c = np.unique(np.frombuffer(blob, "<u4"), return_counts=True)
                parts.append((x, c))
                size += len(x)
                if size > 4_000_000:
                    parts = [_merge(parts)]
                    size = 0
        if parts:
            x, c = _merge(parts)
            keep = np.flatnonzero(c >= HEAVY_MIN)
            keep = keep[np.lexsort((x[keep], -c[keep]))][:most]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep].astype(np.int64)), pa.array(c[keep].astype(np.int64))],
                names=["number", "n"])
    return run


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingle numbers (ascending) and their counts, over all texts."""
    n = partitions(docs.sparkSession)
    counted = docs.select("text").mapInArrow(tidy(_count_task(n)), "bucket int, numbers binary") \
        .repartitionById(n, "bucket").mapInArrow(tidy(_heavy_task(HEAVY_MAX // n + 1)), "number long, n long")
    got = counted.orderBy(F.col("n").desc(), "number").limit(HEAVY_MAX).collect()
    x = np.array([r["number"] for r in got], np.uint64)
    c = np.array([r["n"] for r in got], np.int64)
    order = np.argsort(x)
    return x[order], c[order]


_SETS = ("doc_id long, digest binary, n long, f1 long, f2 long, light int, prefix array<long>, map array<long>")


def _sets_task(heavy: np.ndarray, counts: np.ndarray):
    """Per text: set size, 128-bit set hash, prefix in the global order, parity map."""
    def run(batches):
        for b in batches:
            n, f1, f2, light, prefixes, maps = [], [], [], [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t, WORDS)
                n.append(len(s))
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
                f1.append(int(d[0]))
                f2.append(int(d[1]))
                if not len(s):
                    light.append(0)
                    prefixes.append(s.view(np.int64))
                    maps.append(np.zeros(MAP_LONGS, np.int64))
                    continue
                p = prefix_length(len(s))
                often = np.zeros(len(s), np.int64)
                if len(heavy):
                    number = s >> _U(32)
                    at = np.minimum(np.searchsorted(heavy, number), len(heavy) - 1)
                    often = np.where(heavy[at] == number, counts[at], 0)
                rare = np.flatnonzero(often == 0)
                if len(rare) >= p:  # s is sorted, so these are in order already
                    chosen = s[rare[:p]]
                else:
                    more = np.flatnonzero(often)
                    more = more[np.lexsort((s[more], often[more]))]
                    chosen = s[np.r_[rare, more[:p - len(rare)]]]
                light.append(min(len(rare), p))
                prefixes.append(chosen.view(np.int64))
                bits = np.bincount((s & _U(64 * MAP_LONGS - 1)).astype(np.int64), minlength=64 * MAP_LONGS) & 1
                maps.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
            ends = np.r_[0, np.cumsum([len(x) for x in prefixes])].astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            width = np.arange(0, MAP_LONGS * (len(n) + 1), MAP_LONGS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("digest"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(light, pa.int32()), pa.ListArray.from_arrays(ends, flat),
                 pa.ListArray.from_arrays(width, np.concatenate(maps) if maps else flat)],
                names=["doc_id", "digest", "n", "f1", "f2", "light", "prefix", "map"])
    return run


def _index(sets: DataFrame, reps: DataFrame) -> DataFrame:
    """(token, id, n, pos) of the representatives, lists of two entries or more."""
    own = sets.join(reps.select(F.col("first.row").alias("row"), F.col("node").alias("id")), "row")
    rows = own.select("id", F.col("n").cast("int").alias("n"), "light",
                      F.posexplode("prefix").alias("pos", "token"))
    rare = rows.filter("pos < light").drop("light")
    rare = rare.withColumn("_c", F.count(F.lit(1)).over(Window.partitionBy("token"))) \
        .filter("_c > 1").drop("_c")
    often = rows.filter("pos >= light").drop("light")  # listed tokens: may be hot, so counted first
    several = often.groupBy("token").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("token")
    often = often.join(several, "token")
    cols = ["token", "id", "n", "pos"]
    return stage(rare.select(*cols).unionByName(often.select(*cols)), "index")


def _fits(n1, p1, n2, p2):
    """Sizes and positions leave room for a link whose first common shingle this is."""
    need = (n1 + n2) * F.lit(NUM)
    room = F.least(n1 - p1, n2 - p2) * F.lit(NUM + DEN)
    return (F.least(n1, n2) * DEN >= F.greatest(n1, n2) * NUM) & (room >= need)


def _map_allows(m1, m2, n1, n2):
    """Upper bound of the overlap from the parity maps: (n1 + n2 - differing bits) / 2."""
    differ = F.aggregate(F.zip_with(m1, m2, lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda acc, x: acc + x)
    return (n1 + n2 - differ) * (NUM + DEN) >= (n1 + n2) * (2 * NUM)


def _hub_pairs(index: DataFrame, labels: DataFrame | None) -> DataFrame:
    """In every list: the smallest class's smallest set, with each other class's smallest."""
    entry = F.struct("id", "n", "pos")
    if labels is None:
        heads = index.select("token", F.col("id").alias("label"), entry.alias("x"))
    else:
        heads = _labelled(index, labels).groupBy("token", "label").agg(F.min(entry).alias("x"))
    hub = heads.groupBy("token").agg(F.min(F.struct("label", "x")).alias("h"),
                                     F.max("label").alias("_top")).filter("_top <> h.label")
    p = heads.join(hub, "token").filter("label <> h.label")
    p = p.filter(_fits(F.col("x.n"), F.col("x.pos"), F.col("h.x.n"), F.col("h.x.pos")))
    return p.select(F.col("h.x.id").alias("a"), F.col("x.id").alias("b")).distinct()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _filter_by_map(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    x = maps.select(F.col("id").alias("a"), F.col("n").alias("_n1"), F.col("map").alias("_m1"))
    y = maps.select(F.col("id").alias("b"), F.col("n").alias("_n2"), F.col("map").alias("_m2"))
    return pairs.join(x, "a").join(y, "b").filter(
        _map_allows(F.col("_m1"), F.col("_m2"), F.col("_n1"), F.col("_n2"))).select("a", "b").distinct()


def _cross_pairs(index: DataFrame, labels: DataFrame | None, maps: DataFrame) -> DataFrame:
    """All pairs of different classes that the lists, sizes, positions and maps allow."""
    rows = index.withColumn("label", F.col("id")) if labels is None else _labelled(index, labels)
    mixed = rows.groupBy("token").agg(F.min("label").alias("_low"), F.max("label").alias("_high"),
                                      F.count(F.lit(1)).alias("_c")).filter("_low < _high")
    rows = rows.join(mixed.select("token", "_c"), "token")
    rows = rows.join(maps.select("id", "n", "map").withColumnRenamed("n", "_mn"), "id") \
        .filter("_mn = n").drop("_mn")
    blocks = F.ceil(F.col("_c") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks.cast("long")).cast("int")
    rows = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("token", F.least("_own", "_other").alias("_b1"), F.greatest("_own", "_other").alias("_b2"),
                       "_own", "id", "n", "pos", "label", "map")
    n = partitions(index.sparkSession)
    return rows.repartition(n, "token", "_b1", "_b2").sortWithinPartitions(
        "token", "_b1", "_b2", "n", "pos", "id").mapInArrow(tidy(_walk_lists), "a long, b long").distinct()


_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _walk_lists(batches):
    """Rows sorted by list part, then size and position: whole lists at a time."""
    rest = None
    names = ["token", "_b1", "_b2", "_own", "id", "n", "pos", "label"]
    for b in batches:
        cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in names}
        flat = b.column("map").flatten().to_numpy(zero_copy_only=False)
        cols["map"] = flat.reshape(len(b), MAP_LONGS)
        if rest is not None:
            cols = {c: np.concatenate([rest[c], cols[c]]) for c in cols}
        k = len(cols["id"])
        if not k:
            continue
        same = np.ones(k, bool)
        for c in ("token", "_b1", "_b2"):
            same &= cols[c] == cols[c][-1]
        done = int(np.argmax(same))  # the last list may go on in the next batch
        rest = {c: v[done:] for c, v in cols.items()}
        yield from _compare({c: v[:done] for c, v in cols.items()})
    if rest is not None:
        yield from _compare(rest)


def _compare(c):
    """Candidate pairs of whole lists: long ones by blocks, short ones by a common walk."""
    k = len(c["id"])
    change = np.zeros(k, bool)
    for x in ("token", "_b1", "_b2"):
        change[1:] |= c[x][1:] != c[x][:-1]
    start = np.r_[0, np.flatnonzero(change)] if k else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, k])
    out: set[tuple[int, int]] = set()
    for lo, n in zip(start[size > 2 * ENTRIES].tolist(), size[size > 2 * ENTRIES].tolist()):
        for a, b in BlockedList({x: v[lo:lo + n] for x, v in c.items()}).candidates():
            out.update(zip(a.tolist(), b.tolist()))
            if len(out) > 200_000:
                yield _pairs_batch(out)
                out = set()
    if out:
        yield _pairs_batch(out)
    short = np.repeat(size <= 2 * ENTRIES, size)
    yield from _walk({x: v[short] for x, v in c.items()})


def _allowed(c, x, y):
    """Which entry pairs may link and are to be compared here."""
    n1, n2 = c["n"][x].astype(np.int64), c["n"][y].astype(np.int64)
    ok = (c["label"][x] != c["label"][y]) & (c["id"][x] != c["id"][y])
    # parts b1 < b2 pair up entries of the two; inside one part b1 = b2
    ok &= (c["_b1"][x] == c["_b2"][x]) | (c["_own"][x] != c["_own"][y])
    ok &= np.minimum(n1, n2) * DEN >= np.maximum(n1, n2) * NUM
    room = np.minimum(n1 - c["pos"][x], n2 - c["pos"][y])
    return ok & (room * (NUM + DEN) >= NUM * (n1 + n2))


def _maps_allow(c, x, y):
    differ = _POP[(c["map"][x] ^ c["map"][y]).view(np.uint8)].sum(1)
    total = c["n"][x].astype(np.int64) + c["n"][y]
    return (total - differ) * (NUM + DEN) >= 2 * NUM * total


class BlockedList:
    """One list in blocks by size class (a factor of DEN / NUM each) and position."""

    def __init__(self, c):
        level = np.floor(np.log(np.maximum(c["n"], 1)) / np.log(DEN / NUM)).astype(np.int64)
        order = np.lexsort((c["n"], c["pos"], level))
        self.c = c = {x: v[order] for x, v in c.items()}
        level = level[order]
        first = np.flatnonzero(np.r_[True, level[1:] != level[:-1]])
        place = np.arange(len(level)) - np.repeat(first, np.diff(np.r_[first, len(level)]))
        self.start = np.flatnonzero(place % ENTRIES == 0)
        self.stop = np.r_[self.start[1:], len(level)]
        n = c["n"].astype(np.int64)
        low, high = np.minimum.reduceat(n, self.start), np.maximum.reduceat(n, self.start)
        room = np.maximum.reduceat(n - c["pos"], self.start)
        one = np.minimum.reduceat(c["label"], self.start), np.maximum.reduceat(c["label"], self.start)
        single = np.where(one[0] == one[1], one[0], -1)
        pair = lambda f, v: f(v[:, None], v[None, :])
        keep = pair(np.minimum, room) * (NUM + DEN) >= NUM * (low[:, None] + low[None, :])
        keep &= (high[:, None] * DEN >= low[None, :] * NUM) & (high[None, :] * DEN >= low[:, None] * NUM)
        keep &= ~((single[:, None] == single[None, :]) & (single >= 0)[:, None])
        self.keep = np.triu(keep)

    def skipped(self) -> tuple[int, int]:
        """Block pairs skipped, and all."""
        total = len(self.start) * (len(self.start) + 1) // 2
        return total - int(self.keep.sum()), total

    def candidates(self):
        """Pairs (smaller id, larger id) block by block."""
        for i, j in zip(*np.nonzero(self.keep)):
            x, y = np.meshgrid(np.arange(self.start[i], self.stop[i]), np.arange(self.start[j], self.stop[j]), indexing="ij")
            x, y = x.ravel(), y.ravel()
            if i == j:
                x, y = x[x < y], y[x < y]
            ok = _allowed(self.c, x, y)
            x, y = x[ok], y[ok]
            ok = _maps_allow(self.c, x, y) if len(x) else np.zeros(0, bool)
            a, b = self.c["id"][x[ok]], self.c["id"][y[ok]]
            if len(a):
                yield np.minimum(a, b), np.maximum(a, b)


def _walk(c):
    """Short lists: step d compares every entry with the d-th after it."""
    k = len(c["id"])
    alive, d = np.arange(k), 0
    out: set[tuple[int, int]] = set()
    while len(alive):
        d += 1
        alive = alive[alive + d < k]
        if not len(alive):
            break
        j = alive + d
        on = (c["token"][alive] == c["token"][j]) & (c["_b1"][alive] == c["_b1"][j]) & (c["_b2"][alive] == c["_b2"][j])
        on &= c["n"][j].astype(np.int64) * NUM <= c["n"][alive].astype(np.int64) * DEN  # later ones are larger still
        alive = alive[on]
        j = alive + d
        at = np.flatnonzero(_allowed(c, alive, j))
        if len(at):
            at = at[_maps_allow(c, alive[at], j[at])]
            x, y = c["id"][alive[at]], c["id"][j[at]]
            out.update(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist()))
        if len(out) > 200_000:
            yield _pairs_batch(out)
            out = set()
    if out:
        yield _pairs_batch(out)


def _pairs_batch(pairs):
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _verify_task(batches):
    """Groups of one hub: its text first, then its partners'."""
    group, hub = None, []
    for b in batches:
        a_out, b_out = [], []
        for a, salt, partner, other, text in zip(*(b.column(c).to_pylist() for c in ("a", "_salt", "_role", "id", "text"))):
            if (a, salt) != group:
                group, hub = (a, salt), []
            s = shingles(text, WORDS)
            if not partner:
                hub.append(s)
                continue
            for h in hub:
                if len(s) and links(len(np.intersect1d(h, s, assume_unique=True)), len(h), len(s)):
                    a_out.append(a)
                    b_out.append(other)
                    break
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])


def verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole texts link."""
    spark = docs.sparkSession
    size = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_c"))
    salted = pairs.join(size, "a").select("a", "b", F.pmod(
        F.xxhash64("b"), F.ceil(F.col("_c") / F.lit(SALT))).alias("_salt"))
    need = salted.select("a", "_salt", F.lit(0).alias("_role"), F.col("a").alias("id")).distinct() \
        .unionByName(salted.select("a", "_salt", F.lit(1).alias("_role"), F.col("b").alias("id")))
    ids = reps.join(need.select(F.col("id").alias("node")).distinct(), "node", "left_semi").select(
        F.col("node").alias("id"), F.col("first.doc_id").alias("_doc"), F.col("first.digest").alias("_digest"))
    if ids.count() <= IDS_BOUND:
        ids = F.broadcast(ids)
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")))
    rows = need.join(texts.select("id", "text").distinct(), "id") \
        .select("a", "_salt", "_role", "id", "text")
    return rows.repartition(partitions(spark), "a", "_salt").sortWithinPartitions("a", "_salt", "_role", "id") \
        .mapInArrow(tidy(_verify_task), "a long, b long").distinct()


def _compose(labels: DataFrame | None, more: DataFrame | None) -> DataFrame | None:
    """labels: id -> class; more: class -> larger class."""
    if more is None or labels is None:
        return labels if more is None else more
    up = more.select(F.col("id").alias("label"), F.col("label").alias("_up"))
    moved = labels.join(up, "label", "left").select("id", F.coalesce("_up", "label").alias("label"))
    fresh = more.join(labels.select("id"), "id", "left_anti").select("id", "label")
    return stage(moved.unionByName(fresh), "labels")


def _merge_links(labels: DataFrame | None, found: DataFrame) -> DataFrame | None:
    if labels is not None:
        x = labels.select(F.col("id").alias("a"), F.col("label").alias("_la"))
        y = labels.select(F.col("id").alias("b"), F.col("label").alias("_lb"))
        found = found.join(x, "a", "left").join(y, "b", "left").select(
            F.coalesce("_la", "a").alias("a"), F.coalesce("_lb", "b").alias("b")).filter("a <> b")
    found = stage(found.distinct(), "links")
    if found.isEmpty():
        return labels
    return _compose(labels, components(found))


def _by_id(sets: DataFrame, reps: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes of the different sets under one proper id."""
    keys = ["n", "f1", "f2"]
    named = sets.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", *keys)
    several = named.groupBy("doc_id").agg(F.greatest(*[(F.min(k) != F.max(k)).cast("int") for k in keys]).alias("_c")) \
        .filter("_c > 0").select("doc_id")
    nodes = stage(named.join(several, "doc_id").join(reps, keys).select("doc_id", F.col("node").alias("b")).distinct(),
                  "several")
    return nodes.join(nodes.groupBy("doc_id").agg(F.min("b").alias("a")), "doc_id").filter("a <> b").select("a", "b")


def _classes(docs: DataFrame, by_id: bool) -> DataFrame:
    """One row per input row: doc_id, digest (of the text), n_shingles, ``first`` (smallest
    row with an equal set) and ``top`` (smallest row of the class); both null without shingles."""
    base = id_text(docs).withColumn("digest", text_digest(F.col("text")))
    heavy, counts = frequent_shingles(base)
    sets = stage(base.mapInArrow(tidy(_sets_task(heavy, counts)), _SETS).withColumn("row", F.monotonically_increasing_id()),
                 "sets")
    keys = ["n", "f1", "f2"]
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "row")
    firsts = stage(sets.filter("n > 0").groupBy(*keys).agg(F.min(order).alias("first")), "firsts")
    # numbered in the order of the ids: hubs are the smallest, and an original is older than its copies
    reps = stage(firsts.orderBy("first").withColumn("node", F.monotonically_increasing_id()), "reps")
    index = _index(sets, reps)
    maps = sets.join(reps.select(F.col("first.row").alias("row"), F.col("node").alias("id")), "row") \
        .select("id", "n", "map")
    labels = _merge_links(None, _by_id(sets, reps)) if by_id else None
    for _ in range(HUB_ROUNDS):
        labels = _merge_links(labels, verify(stage(_filter_by_map(_hub_pairs(index, labels), maps), "pairs"), base, reps))
    pairs = stage(_cross_pairs(index, labels, maps), "pairs")
    if not pairs.isEmpty():
        labels = _merge_links(labels, verify(pairs, base, reps))
    if labels is None:
        tops = reps.withColumn("top", F.col("first"))
    else:
        linked = reps.join(labels.select(F.col("id").alias("node"), "label"), "node")
        top = linked.groupBy("label").agg(F.min("first").alias("top"))
        tops = reps.join(linked.select("node", "label").join(top, "label").select("node", "top"), "node", "left") \
            .withColumn("top", F.coalesce("top", "first"))
    return sets.select("doc_id", "digest", *keys).join(tops.select(*keys, "first", "top"), keys, "left").select(
        "doc_id", "digest", F.col("n").alias("n_shingles"), "first", "top")


def join_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, rep_id (smallest document with an equal
    set; null without shingles): one row per input row."""
    return _classes(docs, by_id=True).select(
        "doc_id", "n_shingles", F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id"))
        .alias("component_id"), F.col("first.doc_id").alias("rep_id"))


def surplus(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, top): the texts with words and whether they are the smallest of
    their class; texts are linked one by one, whatever ids they share."""
    return _classes(docs, by_id=False).filter("n_shingles > 0").select(
        "doc_id", "digest", (F.col("doc_id").eqNullSafe(F.col("top.doc_id"))
                             & (F.col("digest") == F.col("top.digest"))).alias("top")).distinct()


ORACLE = r"""
WITH RECURSIVE low AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sh AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM low),
tok AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sh),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS i
           FROM tok a JOIN tok b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common WHERE 100 * i >= 80 * (nx + ny - i)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents
                     UNION SELECT b.y, reach.r FROM reach JOIN both_ways b ON b.x = reach.doc_id
                     )
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id
FROM sh s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


def digest(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_shingles", "component_id")
