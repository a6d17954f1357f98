"""Session settings the library is designed around."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Everything here is a public Spark SQL setting.  Values that depend on the
# cluster (memory, shuffle partitions, checkpoint folder) are left to the
# deployment; AQE sizes the shuffles it is given.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE split a hot join key even when a later step wants the join's
    # partitioning and has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Shuffle files go when their query ends, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Stored files are weighed by what their rows take in memory before one is broadcast.
    "spark.sql.sources.fileCompressionFactor": "8.0",
    # Call-site capture on every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "touchline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


ROWS_A_PARTITION = 100_000
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Shuffled bytes are compressed; sorted rows take many times their room.
ADVISED_MB = 16
_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let shuffles of ``rows`` wide rows start with partitions that a task sorts in memory.

    Adaptive execution joins small ones again.  A number that the session sets higher stays.
    """
    have = int(spark.conf.get(_FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if (wanted := -(-rows // ROWS_A_PARTITION)) > have:
        spark.conf.set(_FIRST_PARTITIONS, str(wanted))
    # Joined by size, partitions keep to what a task sorts in memory.  A size that the session sets itself stays.
    if spark.conf.get(_ADVISED, None) is None:
        spark.conf.set(_ADVISED, f"{ADVISED_MB}m")


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A row of a few columns takes many times the room of its compressed file.
_UNPACKED, UNPACKED = "spark.sql.sources.fileCompressionFactor", "8.0"


def bound_queries(spark: SparkSession) -> None:
    """Bound what queries hold; what the session sets itself stays.

    Shuffle files go when their query ends, so that a chain of stored tables holds one query's at a time.
    Files are weighed by what their rows take, so that none is broadcast for being well compressed.
    """
    for key, value in ((_FREED, "true"), (_UNPACKED, UNPACKED)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder the cluster shares, as ``spark.checkpoint.dir`` names it.

    Only where the session names none and runs on this machine alone a folder of this process is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="touchline-")
        atexit.register(shutil.rmtree, _own_folders[app], True)
    return _own_folders[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later plans start at the files.

    A file outlives the executor that wrote it, which a cached copy does not.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
