"""Feature contract, statuses and release thresholds."""

NUMERIC = [
    "season", "height_in_cm", "age_at_target_date", "matches_before_target",
    "competitions_played_before_target", "minutes_before_target", "goals_before_target",
    "assists_before_target", "yellow_cards_before_target", "red_cards_before_target",
    "goals_per_90_before_target", "assists_per_90_before_target", "previous_market_value_eur",
    "days_since_previous_market_value", "prior_valuation_count", "prior_highest_market_value_eur",
]
CATEGORICAL = [
    "position", "sub_position", "preferred_foot", "country_of_citizenship", "competition_id",
    "competition_type", "competition_country_name", "confederation",
]
FEATURES = NUMERIC + CATEGORICAL
TARGET = "target_market_value_eur"
PREVIOUS = "previous_market_value_eur"

# Columns that would leak the target or identify the row.
FORBIDDEN = {
    TARGET, "training_row_key", "player_id", "player_name", "target_market_value_date",
    "current_market_value_in_eur", "future_market_value_eur", "transfer_fee_eur",
}

STATUSES = ["high", "medium", "limited"]
WEIGHT_OVERRIDES = {"limited": 0.0}
WEIGHT_STEPS = 20
MIN_SEGMENT_ROWS = 100
MIN_SAMPLE = 30
HIGH_QUALITY_MINUTES = 450
INTERVAL_QUANTILE = 0.9

GATE_LIMITS = {
    "mae_improvement_vs_baseline_pct": 0.0, "wape_pct": 15.0, "r2": 0.95,
    "overall_interval_coverage_pct": 85.0, "elite_interval_coverage_pct": 80.0,
    "champion_mae_regression_pct": 2.0, "quality_segment_mae_improvement_vs_baseline_pct": 0.0,
    "current_limited_prediction_pct": 25.0,
}
DRIFT_MONITOR, DRIFT_SIGNIFICANT, PSI_FLOOR = 0.1, 0.25, 1e-6

MODEL_NAME = "player_market_value_gbt"
