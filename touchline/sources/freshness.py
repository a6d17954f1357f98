"""Age of source files against warning and error limits."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted age in days.
WARN_DAYS, ERROR_DAYS = 7, 14


def source_freshness(spark: SparkSession, paths: dict[str, str], now: datetime) -> DataFrame:
    """Newest file time, age and status per source; only file metadata is read."""
    parts = [
        spark.read.parquet(path).select(F.col("_metadata.file_modification_time").alias("t"))
        .agg(F.max("t").alias("last_modified")).select(F.lit(name).alias("table_name"), "last_modified")
        for name, path in paths.items()
    ]
    seconds = F.lit(now).cast("timestamp").cast("double") - F.col("last_modified").cast("double")
    return (
        reduce(DataFrame.unionByName, parts).withColumn("age_days", seconds / 86400)
        .withColumn("status", F.when(F.col("age_days") > ERROR_DAYS, "error")
                    .when(F.col("age_days") > WARN_DAYS, "warn").otherwise("pass"))
    )
