"""Trailing row windows that stay exact when one key is huge."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 100_000


def trailing_rows(df: DataFrame, key: str, day: str, tiebreak: list[str], size: int,
                  measures: Callable[[WindowSpec], dict[str, Column]], *,
                  block_rows: int = BLOCK_ROWS, between: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add aggregates over the last ``size`` rows of each key.

    Rows are numbered through a per-day count grid and cut into blocks of ``block_rows`` rows of
    a key; each block gets the ``size - 1`` rows before it as context.  Every key takes this one
    way, so no task sees more of a key than a block or a day, and nothing is counted beforehand.
    ``between`` may store the numbered rows, so that the shuffles before and after the numbering
    are not held at once.
    """
    back = size - 1
    by_day = W.partitionBy(key).orderBy(day)
    # As one struct, key and day join with their nulls, and the numbers need no second shuffle.
    spot = F.struct(F.col(key).alias("k"), F.col(day).alias("d")).alias("_spot")
    grid = (
        df.groupBy(key, day).agg(F.count("*").alias("_n"))
        .select(
            spot, F.coalesce(F.sum("_n").over(by_day.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        )
    )
    numbered = between(
        df.select("*", spot).join(grid, "_spot")
        .withColumn("_seq", F.col("_before") + F.row_number().over(W.partitionBy("_spot").orderBy(*tiebreak)) - 1)
        .drop("_spot", "_before")
    )
    placed = numbered.withColumn("_home", F.floor(F.col("_seq") / block_rows))
    reach = F.when(F.col("_seq") % block_rows >= block_rows - back,
                   F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    spread = placed.withColumn("_block", F.explode(reach))
    w = W.partitionBy(key, "_block").orderBy("_seq").rowsBetween(-back, 0)
    return (
        spread.withColumns(measures(w)).where(F.col("_block") == F.col("_home"))
        .drop("_seq", "_home", "_block")
    )
