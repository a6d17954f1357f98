"""Append rows whose key is not in the table yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from touchline.sources import sinks


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return sinks.read_table(spark, path, appended=True)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_new_keys(rows: DataFrame, path: str, key: str) -> None:
    """Idempotent append: a key that was stored before is not stored again.

    Columns the stored table lacks are added; older rows read them as null.
    """
    stored = existing(rows.sparkSession, path)
    if stored is not None:
        rows = rows.join(stored.select(key), key, "left_anti")
    sinks.append(rows, path)
