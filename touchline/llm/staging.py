"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of this process only where it is unset and there is but one machine."""
    folder = spark.conf.get(KEY, "") or ""
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"name a folder that all executors share in {KEY}")
        folder = tempfile.mkdtemp(prefix="touchline-")
        atexit.register(shutil.rmtree, folder, True)
        spark.conf.set(KEY, folder)
    return folder


_shipped: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A Python worker holds a batch of texts three times over: as Arrow, as strings and as bytes.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Give this package's modules to the Python workers of the session, once, in batches bounded by bytes.

    By default only rows bound a batch, whatever the length of their texts.  A size that the session sets itself stays.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="touchline-")
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(target := f"{folder}/touchline_llm_modules.zip", "w") as z:
        for f in [package / "__init__.py", *sorted((package / "llm").glob("*.py"))]:
            z.writestr(str(f.relative_to(package.parent)), f.read_text() if f.parent != package else "")
    context.addPyFile(target)
    _shipped.add(context.applicationId)


class Staging:
    """Parquet tables of one operator run.  Written tables survive lost executors and cut the plan."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def put_bucketed(self, name: str, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """The same, as a table dealt out by a key, so that joins on it don't shuffle it again."""
        table = f"touchline_{name}_{uuid.uuid4().hex}"
        (df.write.mode("overwrite").option("path", f"{self.root}/{name}").option("compression", "zstd")
         .format("parquet").bucketBy(buckets, key).saveAsTable(table))
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Let the driver notice that finished shuffles are unused, and wait a moment for their files to go."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)
