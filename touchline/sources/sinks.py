"""Table and artifact sinks on plain files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = "_year"


def overwrite(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    if order:
        # Sorted files give min/max skipping; no shuffle is added.
        df = df.sortWithinPartitions(*order)
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Append rows; columns new to the table are allowed."""
    df.write.mode("append").parquet(path)


def write_by_year(df: DataFrame, path: str, day: str, order: list[str], files_per_year: int | None = None) -> None:
    """Partition by the year of ``day``, clustered on ``order`` within files.

    Range partitioning on (year, order) spreads a big year over many tasks and
    keeps each file to a narrow key range.
    """
    keyed = df.withColumn(YEAR, F.year(day))
    keys = [YEAR, *order]
    spread = keyed.repartitionByRange(files_per_year, *keys) if files_per_year else keyed.repartitionByRange(*keys)
    spread.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(YEAR).parquet(path)


def read_table(spark: SparkSession, path: str, appended: bool = False) -> DataFrame:
    """A stored table; only one that was appended to needs the schemas of all its files."""
    df = spark.read.option("mergeSchema", str(appended).lower()).parquet(path)
    return df.drop(YEAR)


def read_years(spark: SparkSession, path: str, day: str, lo: date, hi: date) -> DataFrame:
    """Rows with ``day`` in [lo, hi]; the year predicate prunes folders."""
    df = spark.read.parquet(path)
    return df.where(
        F.col(YEAR).between(lo.year, hi.year) & F.col(day).between(F.lit(lo), F.lit(hi))
    ).drop(YEAR)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
