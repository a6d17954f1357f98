"""Fan-out of rows to report segments, and summaries per segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fan_out(df: DataFrame, segments: dict[str, Column], type_name: str, value_name: str,
            keep_null: bool = True) -> DataFrame:
    """One output row per input row and segment, from a single scan.

    Project before calling: the kept columns are repeated.  Partial aggregation
    collapses the copies before the shuffle that follows.
    """
    pairs = F.array(*[
        F.struct(F.lit(kind).alias(type_name), value.cast("string").alias(value_name))
        for kind, value in segments.items()
    ])
    out = df.withColumn("_seg", F.explode(pairs)).select("*", "_seg.*").drop("_seg")
    return out if keep_null else out.where(F.col(value_name).isNotNull())


def unpivot(df: DataFrame, keep: list[str], label: str, rows: dict[object, dict[str, str]]) -> DataFrame:
    """Turn groups of columns into rows; null values are kept."""
    packed = F.array(*[
        F.struct(F.lit(tag).alias(label), *[F.col(src).alias(dst) for dst, src in cols.items()])
        for tag, cols in rows.items()
    ])
    return df.select(*keep, F.explode(packed).alias("_u")).select(*keep, "_u.*")
