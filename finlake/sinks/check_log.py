"""Per-row check counts of a table, logged by the writes themselves (DQ2, DQ3).

A write that observes its rows leaves one small file in the table's hidden folder
``_checks``: the number of rows written and the failures per check.  Appends add
files, a replace starts anew (an overwrite clears the folder).  The counts stand
for the table only while they account for every row of it: an append that did not
observe, or a writer that died before logging, makes the sum of logged rows differ
from the table's row count (a footer count), and the checks are scanned for instead.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import SparkSession

from finlake.sinks.files import Files
from finlake.sources.tables import row_count


def add(spark: SparkSession, folder: str, write: str, rows: int, failures: Mapping[str, int]) -> None:
    """Log one write; the same ``write`` replaces its entry."""
    Files(spark, folder).write_text(f"{folder.rstrip('/')}/_checks/{write}.json",
                                    json.dumps({"rows": rows, "failures": dict(failures)}))


def failures(spark: SparkSession, folder: str) -> dict[str, int]:
    """Failures per check label that every logged write has counted; empty unless all rows are logged."""
    files = Files(spark, folder)
    at = f"{folder.rstrip('/')}/_checks"
    entries = [json.loads(files.read_text(f"{at}/{n}")) for n in files.names(at) if n.endswith(".json")]
    if not entries or sum(e["rows"] for e in entries) != row_count(spark, folder):
        return {}
    total: Counter = Counter()
    for e in entries:
        total.update(e["failures"])
    return {k: n for k, n in total.items() if all(k in e["failures"] for e in entries if e["rows"])}
