"""Calibrated prediction intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.labels import VALUE_CUTS, value_band
from touchline.ml.contract import INTERVAL_QUANTILE
from touchline.operators.order_stats import Want, order_statistics
from touchline.operators.small import pinned


def calibrate(df: DataFrame, actual: str, predicted: str, q: float = INTERVAL_QUANTILE) -> DataFrame:
    """Upper ``q`` quantile of the absolute error per predicted band and overall.

    The overall row has a null band.
    """
    if not 0 < q < 1:
        raise ValueError("the interval quantile must lie strictly between 0 and 1")
    errors = df.select(value_band(predicted).alias("band"), F.abs(F.col(actual) - F.col(predicted)).alias("gap"))
    want = {"width": Want(q, "higher")}
    overall = order_statistics(errors, [], "gap", want).select(F.lit(None).cast("string").alias("band"), "width")
    both = overall.unionByName(order_statistics(errors, ["band"], "gap", want).select("band", "width"))
    return pinned(both, len(VALUE_CUTS) + 2)


def attach_widths(df: DataFrame, widths: DataFrame, predicted: str) -> DataFrame:
    """Band and width of each prediction; unseen bands take the overall width.

    ``widths`` has at most one row per band plus one, so it is sent to all tasks.
    """
    default = widths.where(F.col("band").isNull()).select(F.col("width").alias("_default"))
    named = widths.where(F.col("band").isNotNull()).select(
        F.col("band").alias("prediction_interval_band"), F.col("width").alias("_own"))
    return (
        df.withColumn("prediction_interval_band", value_band(predicted))
        .join(F.broadcast(named), "prediction_interval_band", "left").crossJoin(F.broadcast(default))
        .withColumn("prediction_width", F.coalesce("_own", "_default")).drop("_own", "_default")
    )


def finite_sample_radius(df: DataFrame, actual: str, predicted: str, alpha: float = 0.1) -> DataFrame:
    """Split-conformal radius: the error of rank ceil((n+1)(1-alpha)).

    Null when the calibration rows are too few for a finite interval.
    """
    if not 0 < alpha < 1:
        raise ValueError("alpha must lie strictly between 0 and 1")
    gaps = df.select(F.abs(F.col(actual) - F.col(predicted)).alias("gap"))
    return pinned(order_statistics(gaps, [], "gap", {"radius": Want(1 - alpha, "conformal")}), 1)
