"""Session settings the library is tuned for, and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Columnar files hold several times their size in rows. Spark broadcasts by estimates from the size of files, so these are
#: raised; and a task reads an eighth of what it would, since what it gathers for its rows grows with them.
SCANS = {"spark.sql.sources.fileCompressionFactor": "4.0", "spark.sql.files.maxPartitionBytes": "16m"}
#: Shuffled rows are compressed as well, and a task sorts them several times for joins and windows. Adaptive execution puts
#: partitions together up to this size, a quarter of what it would.
SHUFFLES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

#: Adaptive execution does three jobs here: it shrinks the shuffle to the data,
#: turns a join into a broadcast only once the measured side is small, and
#: splits the partitions of a hot key.
SETTINGS = SCANS | SHUFFLES | {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "opsmart", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or fetch) a session with :data:`SETTINGS`; ``extra`` overrides them.

    Leave ``spark.sql.shuffle.partitions`` to the cluster: set it generously
    (about 2-3x the cores) and let adaptive execution coalesce.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune_scans(spark: SparkSession) -> None:
    """:data:`SCANS` and :data:`SHUFFLES` in a session made elsewhere; what that session sets itself stays."""
    for key, value in (SCANS | SHUFFLES).items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="opsmart-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that all executors can reach.

    A machine-local folder is used only where the session names no checkpoint
    folder, which is the case in unit tests on ``local[n]``; it goes with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Compute ``df`` once, into a table in the shared folder, and read it back.

    For results that a plan uses many times over. Unlike a cache, the table
    survives the loss of executors.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, purpose: str, column: str) -> DataFrame:
    """:func:`materialise`, with the rows of a value of ``column`` in one bucket, so that what is grouped by it is not shuffled.

    For a column with about as many values as there are shuffle partitions; there are four buckets for each of those, so few hold several.
    The session's catalog names the table only while it is opened.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, purpose)
    name = f"{purpose}_{uuid.uuid4().hex}"
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(name, format="parquet")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files stay, the frame has them
