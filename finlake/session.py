"""Session defaults and the shared scratch location.

Defaults: timestamps are handled as zone-free ``TIMESTAMP_NTZ`` values and the
session zone is pinned to UTC; ANSI mode and adaptive execution (partition
coalescing, skew-join splitting) are on.  Nothing here starts a UI or server.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "finlake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults to an existing session (idempotent)."""
    for k, v in DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only in local mode without one (tests) a private temp folder is set; on a
    cluster the configured shared location is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
            root = None
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: configure a folder shared by "
                               "all executors (HDFS / object store) for staged and landed tables")
        root = tempfile.mkdtemp(prefix="finlake-ckpt-")  # local mode (tests) only
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # noqa: BLE001
            pass
    return root.rstrip("/")


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (classic or Connect session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.app.id", "session")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder name under the shared checkpoint root (writers create it)."""
    root = checkpoint_root(spark)
    return f"{root}/finlake/{name}-{uuid.uuid4().hex[:12]}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a staging folder that the library itself has written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
