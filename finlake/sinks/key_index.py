"""Key index of a table: which rows it holds already (SNK3, STR9).

Beside the table, in its hidden folder ``_keys``, lies a table of one column
``_key``, bucketed and sorted by it.  An idempotent append compares the batch
with this index only: the wide table is not read, and because the index is
bucketed by the join key only the batch is shuffled, never the index.

``_key`` is the JSON text of the key columns.  A row whose key has a null is
known by a digest of all its columns but the audit stamps, so that a replay of
such a row is found, too, while two different rows without a key both stay.

The index is written with the rows it describes, in one ledger batch.  Each
append adds at most one file per bucket; ``compact`` merges them into a new
version, with as many buckets as the keys have come to need; the description file
of the highest version counts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.operators.dedup import first_per_key
from finlake.sinks.files import Files

KEY = "_key"
AUDIT = ("_ingested_at",)
FILES_PER_BUCKET = 32
KEYS_PER_BUCKET = 500_000


def key_of(columns: Sequence[str], keys: Sequence[str]) -> Column:
    """The identity of a row among ``columns`` (see the module's text)."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    rest = F.to_json(F.struct(*[F.col(c) for c in sorted(columns) if c not in AUDIT]))
    return F.when(whole, F.concat(F.lit("k"), F.to_json(F.struct(*[F.col(k) for k in keys])))) \
        .otherwise(F.concat(F.lit("d"), F.sha2(rest, 256)))


def _buckets(keys: int) -> int:
    return max(1, -(-keys // KEYS_PER_BUCKET))


def _newest(files: Files, root: str) -> str | None:
    """The description of the index's current version."""
    names = sorted(n for n in files.names(f"{root}/_index") if n.endswith(".json"))
    return files.read_text(f"{root}/_index/{names[-1]}") if names else None


class KeyIndex:
    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], buckets: int | None = None):
        """The index of the table in ``folder``; ``buckets`` counts for a new one only (default: by
        the number of rows it is made for)."""
        self.spark, self.root, self.keys = spark, f"{folder.rstrip('/')}/_keys", list(keys)
        self.files = Files(spark, self.root)
        text = _newest(self.files, self.root)
        self.known = text is not None
        have = json.loads(text) if text else {"keys": self.keys, "version": 0, "buckets": buckets}
        if have["keys"] != self.keys:
            raise ValueError(f"the table is indexed by {have['keys']}, not by {self.keys}")
        self.version, self.buckets = have["version"], have["buckets"]

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> KeyIndex | None:
        """The index a table has, if any."""
        text = _newest(Files(spark, folder), f"{folder.rstrip('/')}/_keys")
        return cls(spark, folder, json.loads(text)["keys"]) if text else None

    @property
    def location(self) -> str:
        return f"{self.root}/v{self.version}"

    def create(self, rows: int, current: DataFrame | None = None) -> None:
        """Make the index of a table of so many rows; those that it has already are listed."""
        if not self.known:
            self.buckets = self.buckets or _buckets(rows)
            if current is not None:
                self.write(current.select(key_of(current.columns, self.keys).alias(KEY)).distinct(), self.location)
            self._point()
            self.known = True

    def _point(self) -> None:
        self.files.write_text(f"{self.root}/_index/{self.version:09d}.json", json.dumps(
            {"keys": self.keys, "version": self.version, "buckets": self.buckets}))

    def _table_name(self, location: str) -> str:
        return "finlake_keys_" + hashlib.md5(location.encode()).hexdigest()

    def write(self, keys: DataFrame, location: str) -> None:
        """Write keys as files of the index: one sorted file per bucket."""
        name = self._table_name(location)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        (keys.select(KEY).repartition(self.buckets, KEY).write.mode("overwrite").format("parquet")
         .option("path", location).option(f"parquet.bloom.filter.enabled#{KEY}", "true")
         .bucketBy(self.buckets, KEY).sortBy(KEY).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # external: the files stay

    def read(self) -> DataFrame | None:
        """The keys, as a bucketed table of this session's catalog."""
        if not self.known or next(self.files.data_files(self.location), None) is None:
            return None
        name = self._table_name(self.location)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({KEY} STRING) USING parquet "
                       f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.location}'")
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def new_rows(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` that the table does not hold, one per key (of several the smallest
        payload), with their ``_key``.  The batch combines before its shuffle."""
        keyed = first_per_key(df.withColumn(KEY, key_of(df.columns, self.keys)), [KEY], [], df.columns)
        seen = self.read()
        return keyed if seen is None else keyed.join(seen, KEY, "left_anti")

    def compact(self, files_per_bucket: int = FILES_PER_BUCKET) -> bool:
        """Merge the files into one per bucket when there are more than ``files_per_bucket``."""
        n = sum(1 for _ in self.files.data_files(self.location))
        if n <= files_per_bucket * self.buckets:
            return False
        old = self.location
        keys = self.spark.read.schema(f"{KEY} STRING").parquet(old)  # as plain files: the write deals them again
        name = self._table_name(old)
        self.version, self.buckets = self.version + 1, max(self.buckets, _buckets(keys.count()))
        self.write(keys, self.location)
        self._point()
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.files.delete(old)
        return True
