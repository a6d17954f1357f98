"""Cohort, coverage, risk and portfolio reports over the transfer facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import labels as L
from touchline.functions.exprs import MONEY, fixed_avg, money_avg, pct, rounded_avg
from touchline.operators.order_stats import Want, order_statistics
from touchline.operators.segments import fan_out, unpivot
from touchline.plans.transfers import HORIZONS, LABEL_HORIZON, SUCCESS_PCT, money_diff

# Sample sizes of the report layer.
MIN_SAMPLE = 30
STRONG_SAMPLE = 100
Z_95 = 1.96


def with_quantiles(grouped: DataFrame, rows: DataFrame, by: list[str], value: str, wants: dict[str, float]) -> DataFrame:
    """``grouped`` with exact discrete quantiles of ``value``; null for groups without values."""
    kind = rows.schema[value].dataType
    found = order_statistics(rows, by, value, {n: Want(p, "discrete") for n, p in wants.items()}).select(
        *[F.col(b).alias("_q_" + b) for b in by], *[F.col(n).cast(kind).alias(n) for n in wants])
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col("_q_" + b))
    return grouped.join(found, same, "left").drop(*["_q_" + b for b in by])


def cohort_rows(wh) -> DataFrame:
    """One row per transfer, horizon and cohort."""
    attributes = ["position", "age_band_at_transfer", "transfer_year", "fee_premium_band",
                  "valuation_context_change", "fee_market_value_difference_pct"]
    outcomes = unpivot(
        wh["fct_transfer_fixed_horizon_outcomes"], attributes, "horizon_days",
        {h: {"has_outcome": f"has_{h}d_outcome", "outcome_status": f"outcome_{h}d_status",
                 "change_pct": f"market_value_change_{h}d_pct"} for h in HORIZONS},
    )
    return fan_out(outcomes, {
        "overall": F.lit("all"),
        "transfer_year": F.col("transfer_year"),
        "position": F.coalesce("position", F.lit("unknown")),
        "age_band_at_transfer": F.col("age_band_at_transfer"),
        "fee_premium_band": F.col("fee_premium_band"),
        "valuation_context_change": F.col("valuation_context_change"),
    }, "cohort_type", "cohort_value")


def fct_transfer_cohort_performance(wh) -> DataFrame:
    seen = F.col("has_outcome")
    change = F.when(seen, F.col("change_pct"))

    def status(name: str) -> Column:
        return F.count_if(F.col("outcome_status") == name).alias(name + "_count")

    by = ["horizon_days", "cohort_type", "cohort_value"]
    rows = cohort_rows(wh)
    grouped = rows.groupBy(*by).agg(
        F.count("*").alias("transfer_count"),
        F.count_if(seen).alias("observed_outcome_count"),
        status("missing_baseline"), status("not_yet_observable"), status("missing_followup"),
        F.round(fixed_avg(change), 2).alias("avg_market_value_change_pct"),
        F.round(F.stddev_samp(change), 2).alias("stddev_market_value_change_pct"),
        F.count_if(change > 0).alias("n_positive"),
        F.round(fixed_avg("fee_market_value_difference_pct"), 2).alias("avg_fee_premium_pct"),
    )
    grouped = with_quantiles(grouped, rows.where(seen), by, "change_pct", {"p25": 0.25, "median": 0.5, "p75": 0.75})
    mean, n = F.col("avg_market_value_change_pct"), F.col("observed_outcome_count")
    # The interval uses the published, rounded mean and deviation.
    half = Z_95 * F.try_divide(F.col("stddev_market_value_change_pct"), F.sqrt(n))
    return grouped.select(
        "horizon_days", "cohort_type", "cohort_value", "transfer_count", "observed_outcome_count",
        "missing_baseline_count", "not_yet_observable_count", "missing_followup_count",
        pct("observed_outcome_count", "transfer_count").alias("outcome_coverage_pct"),
        mean,
        F.round("median", 2).alias("median_market_value_change_pct"),
        F.round("p25", 2).alias("p25_market_value_change_pct"),
        F.round("p75", 2).alias("p75_market_value_change_pct"),
        "stddev_market_value_change_pct",
        pct("n_positive", "observed_outcome_count").alias("positive_outcome_rate_pct"),
        "avg_fee_premium_pct",
        F.round(mean - half, 2).alias("avg_change_ci95_lower_pct"),
        F.round(mean + half, 2).alias("avg_change_ci95_upper_pct"),
        (n >= MIN_SAMPLE).alias("meets_minimum_sample_size"),
        F.when(n >= STRONG_SAMPLE, "strong").when(n >= MIN_SAMPLE, "directional")
        .otherwise("insufficient").alias("analytical_reliability"),
    )


def fct_data_coverage_bias(wh) -> DataFrame:
    base = wh["fct_transfer_fixed_horizon_outcomes"]
    # Coverage flags, projected before the fan-out: name -> (stem, flag).
    flags = {
        "known_fee": F.col("has_known_transfer_fee"),
        "market_value_baseline": F.col("market_value_baseline").isNotNull(),
        "fee_value_comparison": F.col("has_fee_market_value_comparison"),
        **{f"outcome_{h}d": F.col(f"has_{h}d_outcome") for h in HORIZONS},
        "pre_180d_performance": F.col("has_pre_180d_performance"),
        "post_180d_performance": F.col("has_post_180d_performance"),
    }
    narrow = base.select(
        "transfer_year", "position", "age_band_at_transfer", "valuation_context_change",
        L.value_band("market_value_baseline", "unavailable").alias("market_value_band"),
        *[c.alias("f_" + n) for n, c in flags.items()],
    )
    rows = fan_out(narrow, {
        "overall": F.lit("all"),
        "transfer_year": F.col("transfer_year"),
        "position": F.coalesce("position", F.lit("unknown")),
        "age_band_at_transfer": F.col("age_band_at_transfer"),
        "market_value_band": F.col("market_value_band"),
        "valuation_context_change": F.col("valuation_context_change"),
    }, "segment_type", "segment_value")
    counted = rows.groupBy("segment_type", "segment_value").agg(
        F.count("*").alias("transfer_count"),
        *[F.count_if(F.col("f_" + n)).alias(n + "_count") for n in flags],
    ).withColumns({n + "_coverage_pct": pct(n + "_count", "transfer_count") for n in flags})
    material = ("known_fee", "fee_value_comparison", "outcome_365d")
    exact = F.greatest(*[
        100 - 100 * F.try_divide(F.col(n + "_count").cast("double"), F.col("transfer_count").cast("double"))
        for n in material
    ])
    out = ["segment_type", "segment_value", "transfer_count"]
    for n in flags:
        out += [n + "_count", n + "_coverage_pct"]
    return counted.select(
        *out,
        F.greatest(*[100 - F.col(n + "_coverage_pct") for n in material]).alias("maximum_material_missingness_pct"),
        F.when(F.col("transfer_count") < MIN_SAMPLE, "insufficient_sample")
        .when(exact > 50, "high_bias_risk").when(exact > 25, "monitor")
        .otherwise("acceptable").alias("coverage_bias_risk"),
    )


def fct_club_risk_profile(wh) -> DataFrame:
    outcomes = wh["fct_transfer_fixed_horizon_outcomes"].where(F.col("to_club_id").isNotNull())
    # Labels are the observed 365-day rows of the same table, so both halves
    # come from one aggregate instead of two scans and a join.
    seen = F.col(f"has_{LABEL_HORIZON}d_outcome")
    hit = F.col(f"market_value_change_{LABEL_HORIZON}d_pct") >= SUCCESS_PCT
    success = F.when(seen, F.when(hit, 1).otherwise(0))
    grouped = outcomes.groupBy(F.col("to_club_id").alias("club_id")).agg(
        F.max_by("to_club_name", F.struct("transfer_date", "to_club_name")).alias("club_name"),
        F.count("*").alias("total_incoming_transfers"),
        F.count_if(F.col("has_known_transfer_fee")).alias("transfers_with_known_fee"),
        F.count_if(seen).alias("observed_365d_transfers"),
        F.round(fixed_avg("fee_market_value_difference_pct"), 2).alias("avg_overpay_pct"),
        F.count_if(success == 1).alias("successful_transfers"),
        F.count_if(success == 0).alias("unsuccessful_transfers"),
        F.round(100 * F.avg(success), 2).alias("transfer_success_rate_pct"),
    )
    overpay, rate, n = F.col("avg_overpay_pct"), F.col("transfer_success_rate_pct"), F.col("observed_365d_transfers")
    return grouped.select(
        "club_id", "club_name", "total_incoming_transfers", "transfers_with_known_fee",
        pct("transfers_with_known_fee", "total_incoming_transfers").alias("known_fee_coverage_pct"),
        "observed_365d_transfers",
        pct("observed_365d_transfers", "total_incoming_transfers").alias("outcome_365d_coverage_pct"),
        "avg_overpay_pct", "successful_transfers", "unsuccessful_transfers",
        "transfer_success_rate_pct",
        (n >= MIN_SAMPLE).alias("meets_minimum_sample_size"),
        F.when(n < MIN_SAMPLE, "insufficient_data")
        .when((overpay > 30) & (rate < 40), "high_risk")
        .when((overpay > 10) | (rate < 50), "medium_risk")
        .otherwise("low_risk").alias("transfer_risk_category"),
    )


def fct_club_transfer_portfolio(wh) -> DataFrame:
    rows = wh["fct_transfer_market_value_analysis"].where(~F.col("is_future_transfer")).select(
        "from_club_id", "to_club_id", "transfer_season", "transfer_fee",
        "fee_market_value_difference_pct", "market_value_change_after_transfer",
        "market_value_change_after_transfer_pct", "has_known_transfer_fee",
        "has_post_transfer_value_change")
    sides = F.array(
        F.struct(F.col("to_club_id").alias("club_id"), F.lit(True).alias("inbound")),
        F.struct(F.col("from_club_id").alias("club_id"), F.lit(False).alias("inbound")),
    )
    spread = (
        rows.withColumn("side", F.explode(sides)).select("*", "side.*")
        .where(F.col("club_id").isNotNull())
    )
    buys, sells, known = F.col("inbound"), ~F.col("inbound"), F.col("has_known_transfer_fee")
    fee = F.col("transfer_fee")

    def on(side: Column, what) -> Column:
        return F.when(side, F.col(what) if isinstance(what, str) else what)

    grouped = spread.groupBy("club_id", "transfer_season").agg(
        F.count_if(buys).alias("inbound_transfers"),
        F.count_if(sells).alias("outbound_transfers"),
        F.count_if(buys & known).alias("inbound_known_fee_transfers"),
        F.count_if(sells & known).alias("outbound_known_fee_transfers"),
        F.sum(on(buys, fee)).alias("inbound_transfer_spend"),
        F.sum(on(sells, fee)).alias("outbound_transfer_income"),
        F.round(money_avg(on(buys, fee)), 2).alias("avg_inbound_transfer_fee"),
        F.round(money_avg(on(sells, fee)), 2).alias("avg_outbound_transfer_fee"),
        F.round(fixed_avg(on(buys, "fee_market_value_difference_pct")), 2).alias("avg_inbound_fee_premium_pct"),
        F.round(fixed_avg(on(sells, "fee_market_value_difference_pct")), 2).alias("avg_outbound_fee_premium_pct"),
        F.round(fixed_avg(on(buys, "market_value_change_after_transfer_pct")), 2).alias("avg_inbound_post_transfer_value_change_pct"),
        F.count_if(buys & F.col("has_post_transfer_value_change")).alias("inbound_transfers_with_value_outcome"),
        F.count_if(buys & (F.col("market_value_change_after_transfer") > 0)).alias("n_up"),
    )
    zero = F.lit(0).cast(MONEY)
    names = wh["dim_clubs"].select("club_id", "club_name")
    return grouped.join(names, "club_id", "left").select(
        "club_id", "club_name", "transfer_season", "inbound_transfers", "outbound_transfers",
        "inbound_known_fee_transfers", "outbound_known_fee_transfers", "inbound_transfer_spend",
        "outbound_transfer_income",
        money_diff(F.coalesce("inbound_transfer_spend", zero), F.coalesce("outbound_transfer_income", zero))
        .alias("net_transfer_spend"),
        "avg_inbound_transfer_fee", "avg_outbound_transfer_fee", "avg_inbound_fee_premium_pct",
        "avg_outbound_fee_premium_pct", "avg_inbound_post_transfer_value_change_pct",
        "inbound_transfers_with_value_outcome",
        pct("n_up", "inbound_transfers_with_value_outcome").alias("inbound_positive_value_outcome_rate_pct"),
        pct("inbound_known_fee_transfers", "inbound_transfers").alias("inbound_fee_coverage_pct"),
        pct("outbound_known_fee_transfers", "outbound_transfers").alias("outbound_fee_coverage_pct"),
    )


def fct_agent_portfolio(wh) -> DataFrame:
    players = wh["dim_players"].where(
        F.col("agent_name").isNotNull() & (F.col("player_record_type") == "current_profile")
    ).select("player_id", "agent_name", "player_profile_completeness_status")
    play = wh["fct_player_performance"].select(
        "player_id", "has_current_market_value", "market_value_in_eur", "matches_played",
        "total_goals", "total_assists")
    # Per-player totals first: the join then cannot fan out.
    moves = wh["stg_transfers"].groupBy("player_id").agg(
        F.count("*").alias("n_moves"), F.count("transfer_fee").alias("n_fees"),
        F.sum("transfer_fee").alias("fees"), F.max("transfer_fee").alias("top_fee"))
    value = F.col("market_value_in_eur")
    complete = F.col("player_profile_completeness_status") == "complete"
    held = players.join(play, "player_id", "left")
    grouped = (
        held.join(moves, "player_id", "left")
        .groupBy("agent_name").agg(
            F.count("*").alias("player_count"),
            F.count_if(F.col("has_current_market_value")).alias("players_with_current_market_value"),
            F.sum(value).alias("total_current_market_value"),
            rounded_avg(value).alias("avg_current_market_value"),
            F.max(value).alias("max_current_market_value"),
            F.sum("matches_played").alias("total_player_matches"),
            F.sum("total_goals").alias("total_player_goals"),
            F.sum("total_assists").alias("total_player_assists"),
            F.sum("n_moves").alias("total_transfer_records"),
            F.sum("n_fees").alias("known_fee_transfer_records"),
            F.sum("fees").alias("total_known_transfer_fee"),
            F.max("top_fee").alias("max_known_transfer_fee"),
            F.count_if(complete).alias("complete_profile_players"),
        )
    )
    names = grouped.columns
    names.insert(names.index("avg_current_market_value") + 1, "median_current_market_value")
    grouped = with_quantiles(grouped, held, ["agent_name"], "market_value_in_eur", {"median_current_market_value": 0.5}).select(names)
    return grouped.withColumns({
        "transfer_fee_coverage_pct": pct("known_fee_transfer_records", "total_transfer_records"),
        "complete_profile_player_pct": pct("complete_profile_players", "player_count"),
    })
