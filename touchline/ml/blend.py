"""Prediction quality, baseline and blend weights."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.ml.contract import (HIGH_QUALITY_MINUTES, MIN_SEGMENT_ROWS, PREVIOUS, STATUSES, TARGET,
                                   WEIGHT_OVERRIDES, WEIGHT_STEPS)
from touchline.ml.scores import exact_sum
from touchline.operators.order_stats import Want, order_statistics
from touchline.operators.small import pinned

STATUS, ML, BASE = "prediction_quality_status", "ml_prediction", "baseline_prediction"


def quality_status() -> Column:
    valued = F.col(PREVIOUS).isNotNull() & F.col("age_at_target_date").isNotNull()
    minutes = F.col("minutes_before_target")
    return (
        F.when(valued & F.col("competition_id").isNotNull() & (minutes >= HIGH_QUALITY_MINUTES), "high")
        .when(valued & (minutes > 0), "medium").otherwise("limited"))


_MEDIANS: WeakKeyDictionary = WeakKeyDictionary()


def median_target(reference: DataFrame) -> DataFrame:
    """Exact median target of a frame as ``_fill``, found once for each frame."""
    if reference not in _MEDIANS:
        _MEDIANS[reference] = pinned(order_statistics(reference, [], TARGET, {"_fill": Want(0.5)}).drop("n"), 1)
    return _MEDIANS[reference]


def with_baseline(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Previous value, or the reference population's exact median target."""
    return df.crossJoin(F.broadcast(median_target(reference))).withColumn(
        BASE, F.coalesce(F.col(PREVIOUS).cast("double"), F.col("_fill"))).drop("_fill")


def _best_weight(target: str = TARGET) -> Column:
    """Weight with the least total error, the smallest one on ties.

    All candidates are sums over the same rows, so no row is repeated.
    """
    scored = []
    for i in range(WEIGHT_STEPS + 1):
        w = i / WEIGHT_STEPS
        gap = F.abs(F.col(target) - (F.lit(w) * F.col(ML) + F.lit(1 - w) * F.col(BASE)))
        scored.append(F.struct(F.sum(gap.cast("decimal(28,6)")).alias("error"), F.lit(w).alias("weight")))
    return F.array_min(F.array(*scored))["weight"]


def best_weight(df: DataFrame) -> DataFrame:
    return pinned(df.agg(_best_weight().alias("weight")), 1)


def blend_weights(df: DataFrame, min_rows: int = MIN_SEGMENT_ROWS) -> DataFrame:
    """Weight per status, with the overall weight as ``default`` row."""
    overall = df.agg(_best_weight().alias("default_weight"))
    own = df.groupBy(STATUS).agg(F.count("*").alias("n"), _best_weight().alias("own"))
    names = F.array(*[F.lit(s) for s in ["default", *STATUSES]])
    rows = overall.select("default_weight", F.explode(names).alias(STATUS)).join(own, STATUS, "left")
    weight = F.when(F.col("n") >= min_rows, F.col("own")).otherwise(F.col("default_weight"))
    for status, fixed in WEIGHT_OVERRIDES.items():
        weight = F.when(F.col(STATUS) == status, F.lit(fixed)).otherwise(weight)
    return pinned(rows.select(STATUS, weight.alias("weight")), len(STATUSES) + 1)


def apply_blend(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Convex blend of model and baseline; at most four weight rows are sent out."""
    w = weights.select(STATUS, F.col("weight").alias("selected_ml_blend_weight"))
    blended = F.col("selected_ml_blend_weight") * F.col(ML) + (1 - F.col("selected_ml_blend_weight")) * F.col(BASE)
    return df.join(F.broadcast(w), STATUS).withColumn("blended", blended)
