"""Commit ledger: every batch is written exactly once, to several tables at a time (STR8).

A batch is a (query, epoch) pair: a streaming query's identity and its
micro-batch number, or a load's identity and 0.  It is written in three steps:

1. every output is staged under the ledger's folder by an ordinary Spark write;
2. one small file, written whole or not at all, marks the batch ``prepared`` and
   names the staged folders and their targets: from here on it counts;
3. the staged files are moved into the targets and the batch is marked ``done``.

A batch that is replayed after a crash before 2 has left nothing in any table
and is staged again; after 2 it is not computed again, the remaining files are
moved (a moved file is no longer staged, so none is moved twice); after 3 it is
skipped.  Readers never see staged files: the folder's name starts with ``_``.

Query identities must not be reused for other epochs: for a stream take the id
in its checkpoint (``stream_id``), not the checkpoint's path.
"""

from __future__ import annotations

import json
import re
import time

from pyspark.sql import DataFrame, SparkSession

from finlake.sinks import check_log
from finlake.sinks.files import Files

KEEP = 1000  # done entries kept per query
ENTRY = ("query STRING, epoch BIGINT, "
         "outputs ARRAY<STRUCT<name: STRING, staged: STRING, target: STRING, rows: BIGINT>>, at DOUBLE")


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def _prepared(self, query: str, epoch: int) -> str:
        return f"{self.root}/prepared/{_name(query)}.{epoch}.json"

    def _done(self, query: str, epoch: int) -> str:
        return f"{self.root}/done/{_name(query)}/{epoch}.json"

    def staging(self, query: str, epoch: int, output: str) -> str:
        """The folder an output of a batch is staged in (emptied of a broken attempt)."""
        folder = f"{self.root}/staged/{_name(query)}.{epoch}/{output}"
        self.files.delete(folder)
        return folder

    def state(self, query: str, epoch: int) -> str | None:
        """``done``, ``prepared`` or, for a batch that has not counted yet, None."""
        if self.files.exists(self._done(query, epoch)):
            return "done"
        return "prepared" if self.files.exists(self._prepared(query, epoch)) else None

    def rows(self, query: str, epoch: int) -> dict[str, int]:
        """Rows per output of a batch that has counted."""
        text = self.files.read_text(self._done(query, epoch)) or self.files.read_text(self._prepared(query, epoch))
        return {o["name"]: o["rows"] for o in json.loads(text)["outputs"]} if text else {}

    def prepare(self, query: str, epoch: int, outputs: list[dict]) -> None:
        """Make the staged outputs (name, staged, target, rows) count, all or none."""
        self._write(self._prepared(query, epoch), query, epoch, outputs)

    def publish(self, query: str, epoch: int) -> None:
        """Move what is still staged of a prepared batch and mark it done.

        Several writers may do so at once: a file that one has moved is gone for the others."""
        text = self.files.read_text(self._prepared(query, epoch))
        if text is None:
            if self.state(query, epoch) != "done":
                raise ValueError(f"batch {epoch} of {query} is not prepared")
            return
        outputs = json.loads(text)["outputs"]
        for o in outputs:
            for name in list(self.files.data_files(o["staged"])):
                self.files.move(f"{o['staged']}/{name}", f"{o['target']}/{name}")
            if o.get("failures") is not None:  # the same name again after a crash
                check_log.add(self.spark, o["target"], f"{_name(query)}.{epoch}", o["rows"], o["failures"])
        self._write(self._done(query, epoch), query, epoch, outputs)
        self.files.delete(self._prepared(query, epoch))
        self.files.delete(f"{self.root}/staged/{_name(query)}.{epoch}")
        self.files.delete(self._done(query, epoch - KEEP))  # a stream replays its last batch only

    def recover(self) -> int:
        """Publish every batch that a crash left prepared; returns how many."""
        texts = [self.files.read_text(f"{self.root}/prepared/{n}")
                 for n in self.files.names(f"{self.root}/prepared") if n.endswith(".json")]
        entries = [json.loads(t) for t in texts if t]
        for e in entries:
            self.publish(e["query"], e["epoch"])
        return len(entries)

    def idle(self) -> bool:
        """Whether no batch is under way."""
        return not self.files.folders(f"{self.root}/staged")

    def _write(self, name: str, query: str, epoch: int, outputs: list[dict]) -> None:
        self.files.write_text(name, json.dumps({"query": query, "epoch": epoch, "outputs": outputs, "at": time.time()}))

    def table(self) -> DataFrame:
        """One row per batch that is done (the last ``KEEP`` of every query)."""
        if not self.files.folders(f"{self.root}/done"):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(f"{self.root}/done/*")


def _name(query: str) -> str:
    return re.sub(r"[^A-Za-z0-9-]", "-", query)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a streaming query keeps in its checkpoint."""
    text = Files(spark, checkpoint).read_text(f"{checkpoint.rstrip('/')}/metadata")
    if not text:
        raise ValueError(f"no streaming query has started with checkpoint {checkpoint}")
    return json.loads(text)["id"]
