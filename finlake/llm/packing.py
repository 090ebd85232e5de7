"""Operator 1: bounded-space online packing.

Every task packs the documents it reads while it keeps a fixed number of open
windows: a piece goes into the window that it fills best (least room left that
still takes it); if none takes it, the fullest window is emitted and a new one
opened.  A document longer than the window is cut, its full windows are emitted
at once.  What is still open at the end of each task is merged: the leftovers
of all tasks are laid end to end by a running sum of lengths (one number per
task, no data moves) and cut at window borders, so only the very last sequence
is short.

Defined results: null text has no ids but the end id; a repeated row is packed
again; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import id_text, stage, tidy
from finlake.llm.tokens import default_vocabulary, tokenizer

PIECE = ("doc_id long, start long, length long, doc_tokens long, ids binary, "
         "part long, win long, off long, closed boolean")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("part", pa.int64()),
                    ("win", pa.int64()), ("off", pa.int64()), ("closed", pa.bool_())])
_FLUSH_BYTES = 4 << 20
ROWS = 400  # texts with their ids held at a time


class OpenWindows:
    """At most ``limit`` open windows, ordered by the room they have left."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.room: list[tuple[int, int]] = []  # (room left, window), ascending
        self.held: dict[int, list] = {}
        self.opened = 0

    def place(self, length: int, piece) -> tuple[int, list] | None:
        """Put a piece away; returns the window that had to be emitted, if any."""
        out = None
        at = bisect.bisect_left(self.room, (length, -1))
        if at < len(self.room):
            room, win = self.room.pop(at)
        else:
            if len(self.room) >= self.limit:
                _, full = self.room.pop(0)
                out = (full, self.held.pop(full))
            room, win = self.capacity, self.new()
            self.held[win] = []
        self.held[win].append(piece)
        if room > length:
            bisect.insort(self.room, (room - length, win))
        else:  # filled to the brim (never a new window: pieces are shorter than one)
            out = (win, self.held.pop(win))
        return out

    def new(self) -> int:
        self.opened += 1
        return self.opened - 1


def _pack_task(vocabulary: str, end_id: int, capacity: int, limit: int, cache: int | None = None):
    def run(batches):
        tok = tokenizer(vocabulary, cache)
        part = TaskContext.get().partitionId()
        end = int(end_id).to_bytes(4, "little")
        windows = OpenWindows(capacity, limit)
        rows: list[tuple] = []
        held = 0

        def emit(win, pieces):
            off = 0
            for doc_id, start, n, total, ids in pieces:
                rows.append((doc_id, start, n, total, ids, part, win, off, True))
                off += n

        def flush():
            cols = list(zip(*rows)) if rows else [[] for _ in _ARROW]
            got = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, _ARROW.types)], schema=_ARROW)
            rows.clear()
            return got

        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, len(b), ROWS)):
            ids_of = tok.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of):
                ids += end
                total = len(ids) // 4
                held += len(ids)
                whole = total // capacity * capacity
                for s in range(0, whole, capacity):
                    emit(windows.new(), [(doc_id, s, capacity, total,
                                          ids[4 * s:4 * (s + capacity)])])
                if total > whole:
                    done = windows.place(total - whole, (doc_id, whole, total - whole, total,
                                                         ids[4 * whole:]))
                    if done:
                        emit(*done)
                if held > _FLUSH_BYTES:
                    yield flush()
                    held = 0
        yield flush()
        off = 0
        for win in sorted(windows.held):
            for doc_id, start, n, total, ids in windows.held[win]:
                rows.append((doc_id, start, n, total, ids, part, win, off, False))
                off += n
            if len(rows) > 10_000:
                yield flush()
        yield flush()
    return tidy(run)


def pack(docs: DataFrame, capacity: int = 4096, open_windows: int = 64,
         vocabulary: str | None = None, end_id: int = 2, cache: int | None = None) -> DataFrame:
    """Pieces with their ids: doc_id, start, length, doc_tokens, ids (binary,
    little-endian uint32), sequence_id, offset.  The first pass is staged, so
    texts are tokenized once and sequence numbers stay as they are.  ``cache``:
    pre-tokens that a worker remembers (time and memory only)."""
    pieces = stage(id_text(docs).mapInArrow(
        _pack_task(vocabulary or default_vocabulary(), end_id, capacity, open_windows, cache), PIECE),
        "pack")
    cols = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
    full = pieces.filter("closed").select(
        *cols[:5], (F.shiftleft(F.col("part") + 1, 33) + F.col("win")).alias("sequence_id"),
        F.col("off").alias("offset"))
    left = pieces.filter("NOT closed")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (left.groupBy("part").agg(F.sum("length").alias("_total"))  # one row per task
            .select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")))
    cap = F.lit(capacity).cast("long")
    pos = left.join(base, "part").withColumn("_pos", F.col("_base") + F.col("off"))
    cut = pos.withColumn("sequence_id", F.explode(F.sequence(
        F.floor(F.col("_pos") / cap), F.floor((F.col("_pos") + F.col("length") - 1) / cap))))
    low = F.greatest(F.col("_pos"), F.col("sequence_id") * cap) - F.col("_pos")
    high = F.least(F.col("_pos") + F.col("length"), (F.col("sequence_id") + 1) * cap) - F.col("_pos")
    cut = cut.withColumn("_low", low).withColumn("_n", high - low)
    merged = cut.select(
        "doc_id", (F.col("start") + F.col("_low")).alias("start"), F.col("_n").alias("length"),
        "doc_tokens",
        F.col("ids").substr((F.col("_low") * 4 + 1).cast("int"), (F.col("_n") * 4).cast("int")).alias("ids"),
        "sequence_id",
        (F.col("_pos") + F.col("_low") - F.col("sequence_id") * cap).alias("offset"))
    return full.select(*cols).unionByName(merged.select(*cols))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
