"""Analysis queries over the marts.  Each takes a warehouse."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.exprs import fixed_avg, least_known, pct, rounded_avg
from touchline.operators.segments import fan_out
from touchline.plans.features import target_days, unanimous
from touchline.plans.governance import MIN_SAMPLE
from touchline.plans.transfers import TOLERANCE_DAYS


def agent_portfolio_benchmark(wh) -> DataFrame:
    return wh["fct_agent_portfolio"].where(
        (F.col("player_count") >= 5) & (F.col("transfer_fee_coverage_pct") >= 50)
    ).orderBy(F.desc("total_current_market_value"))


def data_coverage_release_gate(wh) -> DataFrame:
    return wh["fct_data_coverage_bias"].where(
        F.col("coverage_bias_risk").isin("high_bias_risk", "insufficient_sample")
    ).orderBy(F.desc("maximum_material_missingness_pct"), F.desc("transfer_count"))


def manager_formation_benchmark(wh, min_matches: int = 10) -> DataFrame:
    # Read from the cleaned games: no competition attribute is needed.
    home, away = F.col("home_club_goals"), F.col("away_club_goals")
    return (
        wh["stg_games"].where(
            (F.col("game_date") <= F.lit(wh.as_of)) & F.col("home_club_manager_name").isNotNull()
            & F.col("home_club_formation").isNotNull())
        .groupBy("season", "competition_id", F.col("home_club_manager_name").alias("manager_name"),
                 F.col("home_club_formation").alias("formation"))
        .agg(
            F.count("*").alias("home_matches"),
            F.count_if(home > away).alias("n_won"),
            rounded_avg(home).alias("avg_home_goals"),
            rounded_avg(away).alias("avg_goals_conceded"),
            rounded_avg("attendance").alias("avg_attendance"),
        )
        .where(F.col("home_matches") >= min_matches)
        .select("season", "competition_id", "manager_name", "formation", "home_matches",
                pct("n_won", "home_matches").alias("home_win_rate_pct"), "avg_home_goals",
                "avg_goals_conceded", "avg_attendance")
        .orderBy(F.desc("season"), F.desc("home_win_rate_pct"))
    )


def transfer_cohort_decision_report(wh) -> DataFrame:
    return (
        wh["fct_transfer_cohort_performance"]
        .where(F.col("meets_minimum_sample_size") & (F.col("cohort_type") != "overall"))
        .select("horizon_days", "cohort_type", "cohort_value", "transfer_count",
                "observed_outcome_count", "outcome_coverage_pct", "median_market_value_change_pct",
                "avg_market_value_change_pct", "avg_change_ci95_lower_pct",
                "avg_change_ci95_upper_pct", "positive_outcome_rate_pct", "analytical_reliability")
        .orderBy("horizon_days", "cohort_type", F.desc("median_market_value_change_pct"))
    )


STRATUM = ["transfer_year", "position", "age_band_at_transfer", "fee_premium_band"]


def matched_comparison(outcomes: DataFrame, strata: list[str], treatment: str, first: str,
                       second: str, seen: str, change: str, min_rows: int = MIN_SAMPLE) -> DataFrame:
    """Difference of group means inside strata where both groups are large enough.

    Observational, not causal.  One aggregate with a conditional pivot; the
    eligibility test is a filter on the same row instead of a self-join.
    """
    def side(value: str) -> list[Column]:
        mine = (F.col(treatment) == value) & F.col(seen)
        return [F.count_if(mine).alias(f"{value}_observed_transfers"),
                fixed_avg(F.when(mine, F.col(change))).alias(f"_{value}")]

    rows = outcomes.where(F.col(treatment).isin(first, second)).groupBy(*strata).agg(*side(first), *side(second))
    kept = rows.where(
        (F.col(f"{first}_observed_transfers") >= min_rows) & (F.col(f"{second}_observed_transfers") >= min_rows)
    )
    # An equality self-join never matches null stratum values.
    for s in strata:
        kept = kept.where(F.col(s).isNotNull())
    return kept.select(
        *strata, f"{first}_observed_transfers", f"{second}_observed_transfers",
        F.round(f"_{first}", 2).alias(f"{first}_avg_change_365d_pct"),
        F.round(f"_{second}", 2).alias(f"{second}_avg_change_365d_pct"),
        F.round(F.col(f"_{second}") - F.col(f"_{first}"), 2).alias("observational_difference_pct"),
    ).orderBy(*strata)


def transfer_observational_matched_comparison(wh) -> DataFrame:
    return matched_comparison(
        wh["fct_transfer_fixed_horizon_outcomes"], STRATUM, "valuation_context_change",
        "same_competition", "country_change", "has_365d_outcome", "market_value_change_365d_pct")


def audit_ml_feature_lineage(wh) -> DataFrame:
    def population(name: str, df: DataFrame, key: str, day: str, targets: Column, strict: bool) -> DataFrame:
        def late(c: str) -> Column:
            return F.count_if(F.col(c) >= F.col(day) if strict else F.col(c) > F.col(day))

        return df.agg(
            F.count("*").alias("row_count"),
            F.count_distinct(key).alias("distinct_keys"),
            F.count_distinct("player_id").alias("distinct_players"),
            F.min("season").alias("earliest_season"), F.max("season").alias("latest_season"),
            F.min(day).alias("earliest_target_or_asof_date"), F.max(day).alias("latest_target_or_asof_date"),
            targets.alias("nonpositive_or_missing_targets"),
            late("feature_last_appearance_date").alias("invalid_appearance_timestamps"),
            late("previous_market_value_date").alias("invalid_prior_valuation_timestamps"),
            F.count_if(F.col("previous_market_value_eur") < 0).alias("negative_prior_values"),
            F.count_if(F.col("previous_market_value_eur").isNull()).alias("missing_prior_values"),
            F.count_if(F.col("prior_valuation_count") < 0).alias("negative_valuation_counts"),
        ).select(F.lit(name).alias("population"), "*")

    target = F.col("target_market_value_eur")
    return population(
        "historical_training", wh["ml_player_market_value_training"], "training_row_key",
        "target_market_value_date", F.count_if(target.isNull() | (target <= 0)), True,
    ).unionByName(population(
        "current_scoring", wh["ml_player_market_value_scoring"], "scoring_row_key",
        "prediction_as_of_date", F.max(F.lit(None).cast("long")), False))


def audit_ml_valuation_event_grain(wh) -> DataFrame:
    value, league = F.col("market_value_in_eur"), "player_club_domestic_competition_id"
    good = value > 0
    days = (
        wh["stg_player_valuations"].where(F.col("valuation_date").isNotNull())
        .groupBy("player_id", "valuation_date").agg(
            F.count("*").alias("n"), F.count_if(good).alias("n_good"),
            unanimous("market_value_in_eur", good).alias("one_value"),
            F.max(F.when(good, value)).alias("top_value"),
            unanimous(league, good).alias("one_league"),
            F.max(F.when(good, F.col(league))).alias("top_league"),
        )
    )
    single = F.col("one_value").isNotNull()
    several = F.col("top_value").isNotNull() & ~single
    totals = days.agg(
        F.count("*").alias("player_date_valuation_groups"),
        F.count_if(F.col("n") > 1).alias("multirow_player_dates"),
        F.count_if((F.col("n_good") > 1) & single).alias("duplicated_consistent_positive_days"),
        F.count_if(several).alias("conflicting_positive_value_days"),
        F.count_if(single & F.col("top_league").isNotNull() & F.col("one_league").isNull())
        .alias("conflicting_competition_only_days"),
    )
    matched = F.col("one_value") == F.col("target_market_value_eur")
    targets = (
        target_days(wh)
        .join(days.select("player_id", F.col("valuation_date").alias("target_market_value_date"), "one_value"),
              ["player_id", "target_market_value_date"], "left")
        .agg(
            F.count("*").alias("candidate_player_season_targets"),
            F.count_if(F.col("target_market_value_eur").isNull()).alias("conflicted_latest_player_season_targets"),
            F.count_if(matched).alias("matched_unambiguous_targets"),
            F.count_if(~F.coalesce(matched, F.lit(False))).alias("excluded_ambiguous_or_unmatched_targets"),
        )
    )
    raw = wh["stg_player_valuations"].agg(F.count("*").alias("raw_valuation_rows"))
    return raw.crossJoin(F.broadcast(totals)).crossJoin(F.broadcast(targets))


def _cutoff(wh, capture: date) -> DataFrame:
    """Capture date, newest source valuation and their minimum, as one row."""
    return wh["fct_transfer_fixed_horizon_outcomes"].agg(
        F.max("source_latest_valuation_date").alias("source_latest_valuation_date")
    ).select(
        F.lit(capture).alias("capture_date"), "source_latest_valuation_date",
        least_known(F.lit(capture), "source_latest_valuation_date").alias("effective_cutoff_date"))


def _matured() -> Column:
    due = F.date_add("target_365d_date", TOLERANCE_DAYS)
    return F.coalesce(due <= F.col("effective_cutoff_date"), F.lit(False))


def audit_transfer_365d_capture(wh, capture: date | None = None) -> DataFrame:
    labels = wh["fct_transfer_success_labels"].select("transfer_key").distinct().withColumn("in_labels", F.lit(True))
    rows = (
        wh["fct_transfer_fixed_horizon_outcomes"]
        .select("transfer_key", "position", "has_365d_outcome", "target_365d_date")
        .crossJoin(F.broadcast(_cutoff(wh, capture or wh.as_of)))
        .join(labels, "transfer_key", "left")
        .select("transfer_key", "position", "effective_cutoff_date", F.col("has_365d_outcome").alias("seen"),
                F.col("in_labels").isNotNull().alias("labelled"), _matured().alias("mature"))
    )
    spread = fan_out(rows, {
        "all": F.lit("overall"), "position": F.coalesce("position", F.lit("<NULL_POSITION>")),
    }, "cohort", "segment")
    seen, labelled, mature = F.col("seen"), F.col("labelled"), F.col("mature")

    def keys(cond: Column) -> Column:
        return F.count_distinct(F.when(cond, F.col("transfer_key")))

    out = spread.groupBy("cohort", "segment").agg(
        F.max("effective_cutoff_date").alias("effective_cutoff_date"),
        F.count("*").alias("fixed_horizon_rows"),
        F.count_distinct("transfer_key").alias("fixed_horizon_keys"),
        F.count_if(seen).alias("observed_anytime"),
        keys(labelled).alias("success_label_rows"),
        keys(mature).alias("dax_eligible_transfer_rows"),
        keys(mature & seen).alias("dax_observed_transfer_rows"),
        F.count_if(labelled & ~mature).alias("label_rows_excluded_by_dax_maturity"),
        F.count_if(mature & seen & ~labelled).alias("matured_observed_missing_success_label"),
        F.count_if(labelled & ~seen).alias("unexpected_label_without_outcome"),
    )
    return out.withColumns({
        "dax_observed_coverage_pct": pct("dax_observed_transfer_rows", "dax_eligible_transfer_rows"),
        "observed_vs_label_row_difference": F.col("success_label_rows") - F.col("dax_observed_transfer_rows"),
    }).orderBy("cohort", "segment")


def classify_discrepancies(outcomes: DataFrame, labels: DataFrame, cutoff: DataFrame) -> DataFrame:
    """Transfers whose matured observation and label disagree, with a reason."""
    seen = F.coalesce("has_365d_outcome", F.lit(False))
    horizon = (
        outcomes.select("transfer_key", "has_365d_outcome", "target_365d_date", "transfer_date")
        .crossJoin(F.broadcast(cutoff)).groupBy("transfer_key").agg(
            F.count("*").alias("h_rows"), F.count_if(seen).alias("h_seen"),
            F.count_if(_matured()).alias("h_mature"), F.count_if(seen & _matured()).alias("h_both"),
            F.min("transfer_date").alias("first_transfer_date"), F.max("transfer_date").alias("last_transfer_date"),
            F.min("target_365d_date").alias("first_target_365d_date"),
            F.max("target_365d_date").alias("last_target_365d_date"),
        )
    )
    per_label = labels.groupBy("transfer_key").agg(F.count("*").alias("l_rows"))
    zero = F.lit(0)
    both = horizon.join(per_label, "transfer_key", "full_outer").crossJoin(F.broadcast(cutoff)).select(
        "transfer_key", "capture_date", "source_latest_valuation_date", "effective_cutoff_date",
        F.coalesce("h_rows", zero).alias("horizon_rows"),
        F.coalesce("h_seen", zero).alias("observed_horizon_rows"),
        F.coalesce("h_mature", zero).alias("matured_horizon_rows"),
        (F.coalesce("h_both", zero) > 0).alias("dax_observed"),
        (F.coalesce("l_rows", zero) > 0).alias("in_success_labels"),
        F.coalesce("l_rows", zero).alias("label_rows"),
        "first_transfer_date", "last_transfer_date", "first_target_365d_date", "last_target_365d_date",
    )
    only_label = F.col("in_success_labels") & ~F.col("dax_observed")
    early = (F.col("observed_horizon_rows") > 0) & (F.col("matured_horizon_rows") == 0)
    # The order of the reasons decides when several apply.
    reason = (
        F.when(F.col("transfer_key").isNull(), "null_transfer_key")
        .when(F.col("horizon_rows") > 1, "duplicate_horizon_key")
        .when(F.col("label_rows") > 1, "duplicate_label_key")
        .when(F.col("horizon_rows") == 0, "label_without_horizon_key")
        .when(only_label & early, "label_before_maturity_cutoff")
        .when(only_label, "label_without_matured_observation")
        .when(F.col("dax_observed") & ~F.col("in_success_labels"), "matured_observation_without_label")
        .otherwise("unexpected_inconsistency")
    )
    wrong = (
        (F.col("dax_observed") != F.col("in_success_labels")) | (F.col("horizon_rows") != 1)
        | (F.col("label_rows") > 1) | F.col("transfer_key").isNull()
    )
    return both.where(wrong).withColumn("discrepancy_reason", reason)


def audit_transfer_365d_row_level(wh, capture: date | None = None) -> DataFrame:
    return classify_discrepancies(
        wh["fct_transfer_fixed_horizon_outcomes"], wh["fct_transfer_success_labels"],
        _cutoff(wh, capture or wh.as_of),
    ).orderBy("discrepancy_reason", "transfer_key")


ANALYSES = {f.__name__: f for f in (
    agent_portfolio_benchmark, data_coverage_release_gate, manager_formation_benchmark,
    transfer_cohort_decision_report, transfer_observational_matched_comparison,
    audit_ml_feature_lineage, audit_ml_valuation_event_grain, audit_transfer_365d_capture,
    audit_transfer_365d_row_level,
)}
