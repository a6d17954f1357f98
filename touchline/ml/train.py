"""Chronological training, hold-out predictions and current scoring."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import labels as L
from touchline.ml import blend, intervals, splits
from touchline.ml.contract import MODEL_NAME, PREVIOUS, TARGET
from touchline.session import stored

HOLD_OUT_COLUMNS = [
    "training_row_key", "player_id", "player_name", "season", "competition_id",
    "target_market_value_date", TARGET, PREVIOUS, "position", "sub_position",
    "age_at_target_date", "competition_country_name",
]


def _scored(model, rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Model value, baseline and quality status of each row."""
    return blend.with_baseline(model.predict(rows), reference).withColumn(blend.STATUS, blend.quality_status())


@dataclass
class Run:
    """One evaluated model.  Its scores are stored at their first use, so that every summary starts at files."""

    times: splits.Chronology
    model: object
    weights: DataFrame
    widths: DataFrame
    frame: DataFrame
    version: str
    generated_at: datetime
    fitted: DataFrame
    scores: DataFrame | None = None

    def hold_out_scores(self) -> DataFrame:
        if self.scores is None:
            scored = _scored(self.model, self.times.test_rows(self.frame), self.fitted)
            banded = intervals.attach_widths(blend.apply_blend(scored, self.weights), self.widths, "blended")
            self.scores = stored(banded, "hold_out_scores")
        return self.scores

    def hold_out(self) -> DataFrame:
        """Published hold-out predictions, amounts rounded half to even."""
        width, value = F.col("prediction_width"), F.col("blended")
        return self.hold_out_scores().select(
            *HOLD_OUT_COLUMNS,
            F.rint(blend.ML).alias("ml_only_prediction_eur"),
            F.rint(blend.BASE).alias("baseline_prediction_eur"),
            F.rint(value).alias("predicted_market_value_eur"),
            F.rint(F.abs(F.col(TARGET) - value)).alias("absolute_error_eur"),
            "prediction_interval_band", F.rint(width).alias("prediction_interval_eur"),
            F.rint(F.greatest(value - width, F.lit(0.0))).alias("prediction_lower_eur"),
            F.rint(value + width).alias("prediction_upper_eur"),
            blend.STATUS, "selected_ml_blend_weight",
            F.lit(self.version).alias("model_version"),
            F.lit(self.generated_at).cast("timestamp").alias("model_generated_at_utc"))

    def score_current(self, current: DataFrame, model) -> DataFrame:
        """Published current predictions from the model refitted on all rows."""
        scored = blend.apply_blend(_scored(model, current, self.frame), self.weights).withColumn(
            "predicted_market_value_eur", F.rint("blended"))
        banded = intervals.attach_widths(scored, self.widths, "predicted_market_value_eur")
        value, width, before = F.col("predicted_market_value_eur"), F.col("prediction_width"), F.col(PREVIOUS)
        last = self.frame.agg(F.max("season").alias("_last"))
        delta = F.rint(value - before)
        return banded.crossJoin(F.broadcast(last)).select(
            *current.columns,
            F.rint(blend.ML).alias("ml_only_prediction_eur"), F.rint(blend.BASE).alias("baseline_prediction_eur"),
            "predicted_market_value_eur", "prediction_interval_band",
            F.rint(width).alias("prediction_interval_eur"),
            F.rint(F.greatest(value - width, F.lit(0.0))).alias("prediction_lower_eur"),
            F.rint(value + width).alias("prediction_upper_eur"),
            delta.alias("prediction_delta_vs_previous_eur"),
            F.round(F.try_divide(delta, before.cast("double")) * 100, 2).alias("prediction_delta_vs_previous_pct"),
            blend.STATUS,
            L.lookup(L.QUALITY_TR, blend.STATUS, F.col(blend.STATUS)).alias("kalite_etiketi_tr"),
            L.lookup(L.POSITION_TR, "position", L.UNKNOWN_TR).alias("pozisyon_tr"),
            (F.col("season") > F.col("_last")).alias("prediction_is_out_of_time"),
            "selected_ml_blend_weight", F.lit(self.version).alias("model_version"),
            F.lit(self.generated_at).cast("timestamp").alias("model_generated_at_utc"))

    def run_metadata(self) -> DataFrame:
        """One row describing the run's seasons and row counts."""
        t, season = self.times, F.col("season")
        train, fit = season <= t.calibration, season <= t.tuning
        return self.frame.agg(
            F.count_if(train).alias("training_rows"), F.count_if(season.isin(t.test)).alias("test_rows"),
            F.min(F.when(train, season)).alias("train_season_min"),
            F.max(F.when(train, season)).alias("train_season_max"),
            F.count_if(fit).alias("evaluation_fit_rows"),
            F.max(F.when(fit, season)).alias("evaluation_fit_season_max"),
            F.count_if(season == t.calibration).alias("calibration_rows"),
            F.count("*").alias("production_training_rows"),
        ).select(
            F.lit(MODEL_NAME).alias("model_name"), F.lit(self.version).alias("model_version"),
            F.lit(self.generated_at).cast("timestamp").alias("model_generated_at_utc"), "*",
            F.lit(t.tuning).cast("long").alias("tuning_season"),
            F.lit(t.calibration).cast("long").alias("calibration_season"),
            F.array(*[F.lit(s).cast("long") for s in t.test]).alias("held_out_test_seasons"),
            F.lit(True).alias("calibration_and_test_share_fitted_predictor"))


def tuned_rows(forecaster, frame: DataFrame, times: splits.Chronology) -> DataFrame:
    development = times.development(frame)
    scored = _scored(forecaster.fit(development), times.tuning_rows(frame), development)
    return stored(scored.select(blend.STATUS, blend.ML, blend.BASE, TARGET), "tuned_rows")


def evaluate_model(frame: DataFrame, forecaster, version: str, generated_at: datetime, test_seasons: int = 2) -> Run:
    """Tune on one season, calibrate on the next, keep the last ones for test.

    The model fitted through the tuning season both calibrates the intervals
    and scores the hold-out, so their errors come from the same predictor.
    """
    times = splits.chronology(frame, test_seasons)
    fit = times.fit_rows(frame)
    # Two fits that do not depend on each other: their jobs share the executors.
    with ThreadPoolExecutor(1) as other:
        fitted = other.submit(inheritable_thread_target(frame.sparkSession)(forecaster.fit), fit)
        weights = blend.blend_weights(tuned_rows(forecaster, frame, times))
        model = fitted.result()
    calibrated = blend.apply_blend(_scored(model, times.calibration_rows(frame), fit), weights)
    widths = intervals.calibrate(stored(calibrated.select(TARGET, "blended"), "calibrated_rows"), TARGET, "blended")
    return Run(times, model, weights, widths, frame, version, generated_at, fit)


def registry_row(run: Run, status: DataFrame, metrics: DataFrame) -> DataFrame:
    """Append-only registry row: run facts, status, weights, widths, metrics."""
    def packed(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
        # A handful of rows: statuses or value bands.
        pairs = F.array_sort(F.collect_list(F.struct(key, value)))
        return df.where(F.col(key).isNotNull()).agg(F.to_json(F.map_from_entries(pairs)).alias(name))

    overall = run.widths.where(F.col("band").isNull()).select(F.col("width").alias("conformal_prediction_interval_eur_90"))
    default = run.weights.where(F.col(blend.STATUS) == "default").select(F.col("weight").alias("selected_ml_blend_weight"))
    named = metrics.select(*[F.col(c).alias("test_" + c) for c in metrics.columns if c != "row_count"])
    row = run.run_metadata().withColumn("held_out_test_seasons", F.concat_ws(",", F.transform("held_out_test_seasons", lambda s: s.cast("string"))))
    for part in (status.select("release_status", "warning_gates_failed",
                               (F.col("blocking_gates_failed") == 0).alias("blocking_quality_gates_passed")),
                 named, overall, default,
                 packed(run.weights, blend.STATUS, "weight", "selected_ml_blend_weights_by_quality_status"),
                 packed(run.widths, "band", "width", "conformal_prediction_interval_by_predicted_value_band_eur_90")):
        row = row.crossJoin(F.broadcast(part))
    return row
