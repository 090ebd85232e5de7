"""Versioned folders: replaces that readers never see half done (SNK2, SNK8).

An overwrite deletes the old files before the new ones are there.  A versioned
folder keeps each write in a sub-folder of its own, hidden in ``_versions``, and
names the current one by the highest-numbered file in ``_current``.  Making that
file is the switch: it appears whole, and nothing it replaces is touched, so a
reader that resolved the folder before goes on reading the old version, and one
that resolves it later gets the new one.  Old versions are swept at the next
switch but the last ``keep``, which running readers may still use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from finlake.sinks.files import Files


class Versions:
    def __init__(self, spark: SparkSession, folder: str):
        self.root = folder.rstrip("/")
        self.files = Files(spark, self.root)

    def _numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self.files.names(f"{self.root}/_current") if n.endswith(".txt"))

    def _named(self, number: int) -> str | None:
        return self.files.read_text(f"{self.root}/_current/{number:019d}.txt")

    def current(self) -> str | None:
        """The folder of the current version; None for a folder that is not versioned."""
        numbers = self._numbers()
        return f"{self.root}/_versions/{self._named(numbers[-1])}" if numbers else None

    def fresh(self) -> str:
        """A folder for the next version, which no reader knows yet."""
        return f"{self.root}/_versions/{uuid.uuid4().hex}"

    def switch(self, folder: str, keep: int = 2) -> None:
        """Make ``folder`` (of ``fresh``) the current version; all but the last ``keep`` go."""
        numbers = self._numbers()
        self.files.write_text(f"{self.root}/_current/{(numbers[-1] + 1 if numbers else 0):019d}.txt",
                              folder.rsplit("/", 1)[1])
        numbers = self._numbers()
        used = {self._named(n) for n in numbers[-keep:]}
        for n in numbers[:-keep]:
            name = self._named(n)
            self.files.delete(f"{self.root}/_current/{n:019d}.txt")
            if name not in used:
                self.files.delete(f"{self.root}/_versions/{name}")


def resolve(spark: SparkSession, folder: str) -> str:
    """The folder to read: the current version, or the folder itself when it has none."""
    return Versions(spark, folder).current() or folder.rstrip("/")
