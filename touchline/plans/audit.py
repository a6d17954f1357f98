"""One audit row per run: volumes, coverage and risk counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUDITED = {
    "source_game_rows": "stg_games", "source_appearance_rows": "stg_appearances",
    "source_transfer_rows": "stg_transfers", "source_valuation_rows": "stg_player_valuations",
    "match_rows": "fct_match", "player_match_rows": "fct_player_match_performance",
    "historical_transfer_rows": "fct_transfer_fixed_horizon_outcomes",
}


def audit_row(wh, run_key: str, generated_at: datetime, target: str = "spark") -> DataFrame:
    """Single-row frame; every part is a global aggregate."""
    overall = (F.col("segment_type") == "overall") & (F.col("segment_value") == "all")

    def at(c: str):
        return F.max(F.when(overall, F.col(c)))

    row = wh["fct_data_coverage_bias"].agg(
        at("known_fee_coverage_pct").alias("overall_known_fee_coverage_pct"),
        at("fee_value_comparison_coverage_pct").alias("overall_fee_value_comparison_coverage_pct"),
        at("outcome_365d_coverage_pct").alias("overall_365d_outcome_coverage_pct"),
        F.count_if(F.col("coverage_bias_risk") == "high_bias_risk").alias("high_bias_risk_segment_count"),
    ).crossJoin(F.broadcast(wh["fct_transfer_cohort_performance"].agg(
        F.count_if(~F.col("meets_minimum_sample_size")).alias("insufficient_sample_cohort_count"))))
    for name, table in AUDITED.items():
        row = row.crossJoin(F.broadcast(wh.unstored(table).agg(F.count("*").alias(name))))
    return row.select(
        F.lit(run_key).alias("audit_key"),
        F.lit(generated_at).cast("timestamp").alias("audit_generated_at_utc"),
        F.lit(target).alias("target_name"),
        *AUDITED,
        "overall_known_fee_coverage_pct", "overall_fee_value_comparison_coverage_pct",
        "overall_365d_outcome_coverage_pct", "high_bias_risk_segment_count",
        "insufficient_sample_cohort_count",
    )
