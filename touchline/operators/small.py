"""Fitted parameters: tables of a known, small size."""

from __future__ import annotations

from pyspark.sql import DataFrame


def pinned(df: DataFrame, bound: int) -> DataFrame:
    """Compute a table of at most ``bound`` rows once and keep it as values.

    Weights, widths and medians are parameters of a fitted model.  Pinning them
    keeps the plans that use them free of the plans that fitted them.  A larger
    table is an error, never cut.
    """
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"expected at most {bound} rows of parameters")
    return df.sparkSession.createDataFrame(rows, df.schema)
