"""Named metrics: one aggregate expression each, over one fact.

``metric(wh, names, by, where)`` answers a metric question with a single
aggregate plan.  Filters go to the scan; ratios are taken after aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import labels as L
from touchline.functions.exprs import fixed_avg, least_known, money_avg
from touchline.operators.order_stats import Want, order_statistics
from touchline.plans.transfers import TOLERANCE_DAYS


@dataclass(frozen=True)
class Metric:
    fact: str
    value: Column


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _keys(key: str, cond: Column | None = None) -> Column:
    return F.count_distinct(F.col(key) if cond is None else F.when(cond, F.col(key)))


def _one_player(c: Column) -> Column:
    """Only when exactly one player is in scope."""
    return F.when(F.count_distinct("player_id") == 1, c)


def _transfer_metrics() -> dict[str, Column]:
    key = "transfer_key"
    n = _keys(key)
    known, comparable = F.col("has_known_transfer_fee"), F.col("has_fee_market_value_comparison")
    changed = F.col("has_post_transfer_value_change")
    fee, base = F.col("transfer_fee"), F.col("market_value_baseline")
    known_fee = F.when(known, fee)
    up = _keys(key, F.col("market_value_direction_after_transfer") == "increase")
    outcome = _keys(key, changed)
    change = _ratio(fixed_avg(F.when(changed, F.col("market_value_change_after_transfer_pct"))), F.lit(100))
    return {
        "transfer_count": n,
        "known_fee_transfer_count": _keys(key, known),
        "known_fee_coverage": _zero(_ratio(_keys(key, known), n)),
        "average_known_transfer_fee": money_avg(known_fee),
        "total_known_transfer_fee": F.sum(known_fee),
        "max_known_transfer_fee": F.max(known_fee),
        "comparable_transfer_count": _keys(key, comparable),
        "comparison_coverage": _ratio(_keys(key, comparable), n),
        "average_fee_premium": _ratio(fixed_avg(F.when(comparable, F.col("fee_market_value_difference_pct"))), F.lit(100)),
        "post_transfer_outcome_count": outcome,
        "post_transfer_outcome_coverage": _zero(_ratio(outcome, n)),
        "average_post_transfer_value_change": change,
        "value_increase_rate": _zero(_ratio(up, outcome)),
        "high_premium_transfer_count": _keys(key, F.col("fee_market_value_difference_pct") > 30),
        "transfer_value_index": _ratio(F.sum(known_fee), F.sum(base)),
        "selected_player_transfer_count": _one_player(n),
        "selected_player_known_fee": _one_player(F.sum(known_fee)),
        "selected_player_post_transfer_change": _one_player(change),
    }


def _prediction_metrics() -> dict[str, Column]:
    n = _keys("player_id")
    ready = F.col("prediction_quality_status").isin("high", "medium")
    delta = F.col("prediction_delta_vs_previous_pct")
    predicted = F.avg("predicted_market_value_eur")
    previous = F.avg("previous_market_value_eur")
    interval = F.avg("prediction_interval_eur")
    upside = _ratio(fixed_avg(delta), F.lit(100))
    return {
        "scored_player_count": n,
        "decision_ready_player_count": _keys("player_id", ready),
        "decision_ready_rate": _zero(_ratio(_keys("player_id", ready), n)),
        "average_predicted_market_value": predicted,
        "average_previous_market_value": previous,
        "average_prediction_upside": upside,
        "positive_upside_player_count": _keys("player_id", delta > 0),
        "positive_upside_rate": _zero(_ratio(_keys("player_id", delta > 0), n)),
        "high_upside_player_count": _keys("player_id", delta > 20),
        "high_upside_decision_ready_count": _keys("player_id", ready & (delta > 0)),
        "average_prediction_interval": interval,
        "average_relative_prediction_interval": _ratio(interval, predicted),
        "average_prediction_confidence": 1 - F.coalesce(_ratio(interval, predicted), F.lit(0.0)),
        "selected_player_previous_value": _one_player(previous),
        "selected_player_prediction_value": _one_player(predicted),
        "selected_player_prediction_change": _one_player(upside),
    }


def _performance_metrics() -> dict[str, Column]:
    goals, assists, minutes = F.sum("total_goals"), F.sum("total_assists"), F.sum("total_minutes_played")
    return {
        "total_goals": goals,
        "total_assists": assists,
        "total_minutes": minutes,
        "total_players": _keys("player_id"),
        # Ratio of sums against the mean of per-player ratios.
        "player_goals_assists_per_90": _ratio(goals + assists, minutes) * 90,
        # A blank counts as zero beside a number; two blanks are left out.
        "average_goals_assists_per_90": fixed_avg(F.when(
            F.coalesce("goals_per_90", "assists_per_90").isNotNull(),
            F.coalesce("goals_per_90", F.lit(0.0)) + F.coalesce("assists_per_90", F.lit(0.0)))),
        "average_minutes": fixed_avg("avg_minutes_per_match"),
    }


def _label_metrics() -> dict[str, Column]:
    mine = F.col("label_horizon_days") == 365
    return {
        "labelled_transfers_365d": _keys("transfer_key", mine),
        "average_transfer_fee_365d": money_avg(F.when(mine, F.col("transfer_fee"))),
        "transfer_success_rate_365d": F.avg(F.when(mine, F.col("is_successful_transfer"))),
    }


def _governed_metrics() -> dict[str, dict[str, Column]]:
    seen = F.sum(F.when(F.col("has_365d_outcome"), 1).otherwise(0))
    return {
        "fct_transfer_fixed_horizon_outcomes": {
            "transfers": F.count("transfer_key"),
            "observed_365d_transfers": seen,
            "transfer_365d_outcome_coverage": _ratio(seen, F.count("transfer_key")),
            "average_365d_market_value_change_pct": fixed_avg("market_value_change_365d_pct"),
            "average_transfer_fee_premium_pct": fixed_avg("fee_market_value_difference_pct"),
        },
        "fct_club_season_performance": {
            "club_matches": F.sum("matches_played"),
            "club_points": F.sum("points"),
        },
    }


def _reference_metrics() -> dict[str, dict[str, Column]]:
    enough = F.col("meets_minimum_sample_size")
    return {
        "fct_transfer_cohort_performance": {
            "observed_transfer_outcomes": F.sum("observed_outcome_count"),
            "cohort_outcome_coverage": _ratio(F.sum("observed_outcome_count"), F.sum("transfer_count")),
            "average_reliable_cohort_median_change": fixed_avg(F.when(enough, F.col("median_market_value_change_pct"))),
        },
        "fct_data_coverage_bias": {
            "segment_known_fee_coverage": _ratio(F.sum("known_fee_count"), F.sum("transfer_count")),
        },
        "fct_club_transfer_portfolio": {"net_transfer_spend": F.sum("net_transfer_spend")},
        "fct_club_risk_profile": {
            "reliable_club_success_rate": fixed_avg(F.when(enough, F.col("transfer_success_rate_pct"))),
        },
        "fct_player_rolling_form": {"rolling_5_goals_per_90": fixed_avg("rolling_5_goals_per_90", 4)},
    }


PREDICTIONS = "current_predictions"


def registry() -> dict[str, Metric]:
    facts: dict[str, dict[str, Column]] = {
        "fct_transfer_market_value_analysis": _transfer_metrics(),
        PREDICTIONS: _prediction_metrics(),
        "fct_player_performance": _performance_metrics(),
        "fct_transfer_success_labels": _label_metrics(),
    }
    for extra in (_governed_metrics(), _reference_metrics()):
        for fact, values in extra.items():
            facts.setdefault(fact, {}).update(values)
    return {name: Metric(fact, value) for fact, values in facts.items() for name, value in values.items()}


def evaluate(df: DataFrame, values: dict[str, Column], by: list[str] = (), where=None) -> DataFrame:
    if where is not None:
        df = df.where(where)
    named = [v.alias(n) for n, v in values.items()]
    return df.groupBy(*by).agg(*named) if by else df.agg(*named)


def metric(wh, names: list[str] | str, by: list[str] = (), where=None, fact_df: DataFrame | None = None) -> DataFrame:
    """Metrics of one fact, grouped and filtered as asked."""
    names = [names] if isinstance(names, str) else list(names)
    known = registry()
    facts = {known[n].fact for n in names}
    if len(facts) != 1:
        raise ValueError(f"metrics of several facts cannot share one query: {sorted(facts)}")
    df = fact_df if fact_df is not None else wh[facts.pop()]
    return evaluate(df, {n: known[n].value for n in names}, by, where)


def metrics_of(fact: str) -> list[str]:
    return [n for n, m in registry().items() if m.fact == fact]


def fee_year_over_year(wh) -> DataFrame:
    """Average known fee by year against the year before; gaps stay null."""
    yearly = metric(wh, "average_known_transfer_fee", ["transfer_year"])
    before = yearly.select((F.col("transfer_year") + 1).alias("transfer_year"),
                           F.col("average_known_transfer_fee").alias("previous_year_fee"))
    joined = yearly.join(before, "transfer_year", "left")
    change = F.col("average_known_transfer_fee") - F.col("previous_year_fee")
    return joined.withColumn("fee_change", _ratio(change, F.col("previous_year_fee")))


def matured_outcomes(wh, by: list[str], today: date | None = None) -> DataFrame:
    """Eligible and observed 365-day transfers under one maturity cut-off.

    The cut-off is the newest valuation of the source, at most today; every row carries it.
    """
    rows = wh["fct_transfer_fixed_horizon_outcomes"].select(
        *by, "transfer_key", "has_365d_outcome", "target_365d_date", "source_latest_valuation_date")
    cutoff = least_known(F.lit(today or wh.as_of), F.col("source_latest_valuation_date"))
    mature = F.date_add("target_365d_date", TOLERANCE_DAYS) <= cutoff
    out = rows.groupBy(*by).agg(
        _keys("transfer_key", mature).alias("eligible_transfers_365d"),
        _keys("transfer_key", mature & F.col("has_365d_outcome")).alias("observed_transfers_365d"),
    )
    eligible, observed = F.col("eligible_transfers_365d"), F.col("observed_transfers_365d")
    cover = _ratio(observed, eligible)
    notice = (
        F.when(eligible.isNull() | (eligible == 0), "NO MATURED COHORT")
        .when(observed.isNull() | (observed < 30), "SMALL OBSERVED SAMPLE")
        .when(cover.isNull() | (cover < 0.8), "LOW FOLLOW-UP COVERAGE")
        .otherwise("OBSERVATIONAL ONLY")
    )
    return out.withColumns({"outcome_coverage_365d": cover, "reliability_notice_365d": notice})


def transfers_by_status(wh) -> DataFrame:
    return wh["fct_transfer_fixed_horizon_outcomes"].groupBy(
        F.col("outcome_365d_status"), L.follow_up_label("outcome_365d_status").alias("follow_up_label"),
    ).agg(_keys("transfer_key").alias("transfers"))


def median_outcome_change(wh, by: list[str] = ()) -> DataFrame:
    """Exact interpolated median of the observed 365-day change."""
    seen = wh["fct_transfer_fixed_horizon_outcomes"].where(F.col("has_365d_outcome"))
    return order_statistics(
        seen, list(by), "market_value_change_365d_pct", {"median_change_365d_pct": Want(0.5)}
    ).drop("n")


def audit_age_label(audit: DataFrame, now: datetime) -> DataFrame:
    newest = F.max("audit_generated_at_utc")
    age = F.datediff(F.lit(now).cast("timestamp"), newest)
    text = F.concat(
        F.when(age > 90, "HISTORICAL / ").otherwise("QUALITY AUDIT / "),
        F.upper(F.date_format(newest, "dd MMM yyyy")))
    return audit.agg(F.when(newest.isNull(), "AUDIT / NOT AVAILABLE").otherwise(text).alias("audit_label"))


def report_columns_players(wh) -> DataFrame:
    return wh["dim_players"].groupBy(L.report_age_group("birth_date", wh.as_of).alias("age_group")).agg(
        _keys("player_id").alias("total_players"))


def report_columns_fees(wh) -> DataFrame:
    return wh["fct_transfer_market_value_analysis"].groupBy(
        L.fee_range("transfer_fee", "has_known_transfer_fee").alias("fee_range_category_tr")
    ).agg(_keys("transfer_key").alias("transfers"))


def report_columns_competitions(wh) -> DataFrame:
    return wh["fct_competition_performance"].select(
        "competition_id", L.competition_label("competition_id", "competition_name").alias("competition_short_label"),
        "matches_played")
