"""Fail-closed input checks as counts of violating rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.ml.contract import CATEGORICAL, FORBIDDEN, NUMERIC, PREVIOUS, TARGET


def _rows(one: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("rule"), F.coalesce(F.col(c).cast("long"), F.lit(0)).alias("violations"))
                      for c in one.columns])
    return one.select(F.explode(pairs).alias("r")).select("r.*")


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")


def require(violations: DataFrame, what: str) -> None:
    """Raise when any rule has violations (the frame has one row per rule)."""
    broken = {r["rule"]: r["violations"] for r in violations.where(F.col("violations") > 0).collect()}
    if broken:
        raise ValueError(f"{what} is invalid: {broken}")


def _finite(c: str) -> Column:
    v = F.col(c).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def _infinite(c: str) -> Column:
    return F.abs(F.col(c).cast("double")) == float("inf")


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def _key_rules(df: DataFrame, key: str) -> DataFrame:
    """Empty frame, blank keys and repeated keys, from one grouped pass."""
    blank = F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        (F.count("*") == 0).cast("long").alias("empty_frame"),
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("blank_keys"),
        F.sum(F.when(~blank & (F.col("n") > 1), F.col("n") - 1).otherwise(0)).alias("repeated_keys"))


def _season_bad(c: str = "season") -> Column:
    v = F.col(c).cast("double")
    return ~_finite(c) | (v != F.floor(v)) | (v <= 0)


def input_violations(df: DataFrame, kind: str) -> DataFrame:
    """Contract of a training or scoring frame."""
    if kind not in ("training", "scoring"):
        raise ValueError(f"unknown frame kind: {kind}")
    key = f"{kind}_row_key"
    needed = [key, "player_id", *NUMERIC, *CATEGORICAL] + ([TARGET] if kind == "training" else [])
    require_columns(df, needed, f"{kind} frame")
    numeric = NUMERIC + ([TARGET] if kind == "training" else [])
    rules = {
        "missing_player": F.col("player_id").isNull(),
        "invalid_season": _season_bad(),
        "infinite_numeric": _any(_infinite(c) for c in numeric),
        "negative_prior_value": F.col(PREVIOUS) < 0,
    }
    if kind == "training":
        rules["invalid_target"] = ~_finite(TARGET) | (F.col(TARGET) <= 0)
    one = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return _rows(_key_rules(df, key).crossJoin(F.broadcast(one)))


def research_violations(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Contract of a walk-forward frame; leaking features are refused."""
    names = numeric + categorical
    if not numeric or len(set(names)) != len(names):
        raise ValueError("the feature contract needs distinct, non-empty numeric features")
    if FORBIDDEN & set(names):
        raise ValueError(f"features would leak the target: {sorted(FORBIDDEN & set(names))}")
    require_columns(df, ["season", "player_id", TARGET, PREVIOUS, "position", *names], "research frame")
    one = df.agg(
        (F.count("*") == 0).cast("long").alias("empty_frame"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in {
            "missing_player": F.col("player_id").isNull() | (F.trim(F.col("player_id").cast("string")) == ""),
            "invalid_prior_value": _infinite(PREVIOUS) | (F.col(PREVIOUS) < 0),
            "invalid_target": ~_finite(TARGET) | (F.col(TARGET) <= 0),
            "invalid_season": ~_finite("season") | (F.col("season") != F.floor(F.col("season"))),
            "infinite_numeric": _any(_infinite(c) for c in numeric),
        }.items()])
    if "training_row_key" in df.columns:
        keys = _key_rules(df, "training_row_key").select("blank_keys", "repeated_keys")
        one = one.crossJoin(F.broadcast(keys))
    return _rows(one)


INTERVAL_COLUMNS = ["prediction_interval_band", "prediction_interval_eur", "prediction_lower_eur", "prediction_upper_eur"]


def prediction_violations(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys, finite non-negative values, and intervals that hold the value."""
    present = [c for c in INTERVAL_COLUMNS if c in df.columns]
    if present and len(present) != len(INTERVAL_COLUMNS):
        raise ValueError("interval columns must be supplied together")
    rules = {"invalid_prediction": ~_finite(value) | (F.col(value) < 0)}
    if present:
        lower, upper = F.col("prediction_lower_eur"), F.col("prediction_upper_eur")
        rules["invalid_interval"] = _any([
            ~_finite("prediction_interval_eur"), ~_finite("prediction_lower_eur"), ~_finite("prediction_upper_eur"),
            F.col("prediction_interval_eur") <= 0, F.col("prediction_interval_band").isNull(),
            lower < 0, lower > F.col(value), upper < F.col(value)])
    one = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    keys = _key_rules(df, key).select("blank_keys", "repeated_keys")
    return _rows(keys.crossJoin(F.broadcast(one)))


EVALUATION_COLUMNS = [
    "training_row_key", "player_id", "season", "position", "prediction_quality_status",
    "model_version", TARGET, "predicted_market_value_eur", "baseline_prediction_eur",
    "prediction_lower_eur", "prediction_upper_eur",
]


def evaluation_violations(df: DataFrame) -> DataFrame:
    """Contract of a hold-out prediction export."""
    require_columns(df, EVALUATION_COLUMNS, "evaluation export")
    value, lower, upper = (F.col(c) for c in ("predicted_market_value_eur", "prediction_lower_eur", "prediction_upper_eur"))
    numbers = EVALUATION_COLUMNS[-5:]
    rules = {
        "missing_player_or_season": F.col("player_id").isNull() | F.col("season").isNull(),
        "missing_version": F.col("model_version").isNull() | (F.trim("model_version") == ""),
        "not_finite": _any(~_finite(c) for c in [*numbers, "season"]),
        "bad_sign": _any([F.col(TARGET) <= 0, *[F.col(c) < 0 for c in numbers[1:]]]),
        "outside_interval": (lower > value) | (value > upper),
        "fractional_season": F.col("season") != F.floor(F.col("season")),
    }
    one = df.agg(
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()],
        F.coalesce((F.min("model_version") != F.max("model_version")).cast("long"), F.lit(0)).alias("several_versions"))
    return _rows(_key_rules(df, "training_row_key").crossJoin(F.broadcast(one)))


def provenance_violations(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Chronology and row counts of an export against its one-row run metadata."""
    seen = df.agg(
        F.count("*").alias("rows"), F.min("season").alias("first"),
        F.max("model_version").alias("version"), F.array_sort(F.collect_set("season")).alias("seasons"))
    both = metadata.crossJoin(F.broadcast(seen))
    m = {c: F.col(c) for c in metadata.columns}
    held = F.array_sort(F.col("held_out_test_seasons"))
    order = (m["tuning_season"] < m["calibration_season"]) & (m["calibration_season"] == m["train_season_max"]) \
        & (m["train_season_max"] < F.array_min(held))
    checks = {
        "version_mismatch": ~m["model_version"].eqNullSafe(F.col("version")),
        "predictor_not_shared": ~F.coalesce(m["calibration_and_test_share_fitted_predictor"], F.lit(False)),
        "season_mismatch": ~held.eqNullSafe(F.col("seasons").cast("array<bigint>")),
        "repeated_season": F.size(held) != F.size(F.array_distinct(held)),
        "chronology": ~F.coalesce(order, F.lit(False)),
        "test_rows_mismatch": m["test_rows"] != F.col("rows"),
        "row_balance": (m["evaluation_fit_rows"] + m["calibration_rows"] != m["training_rows"])
        | (m["evaluation_fit_rows"] <= 0) | (m["calibration_rows"] <= 0) | (m["training_rows"] <= 0),
        "fit_end_mismatch": m["evaluation_fit_season_max"] != m["tuning_season"],
    }
    return _rows(both.select(*[F.coalesce(c, F.lit(True)).cast("long").alias(n) for n, c in checks.items()]))
