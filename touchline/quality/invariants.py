"""The invariants of every table, as frames of offending rows.

Grouped by the kind of proof.  Each group is a function from a warehouse to
named frames; an empty frame is a pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.exprs import full_years, pct, per_90, ratio
from touchline.operators.compare import keyed_mismatches, symmetric_difference
from touchline.plans.dims import DATED, PLAYER_PROFILE, date_bounds
from touchline.plans.features import target_days, valuation_events
from touchline.plans.transfers import TRANSFER_IDENTITY, money_diff
from touchline.functions.exprs import row_key
from touchline.quality import checks

Frames = dict[str, DataFrame]

GRAINS = {
    "stg_appearances": ["player_id", "game_id"],
    "fct_market_value_history": ["player_id", "valuation_date"],
    "fct_player_career_timeline": ["player_id", "season", "competition_id"],
    "int_player_season_performance": ["player_id", "season", "competition_id"],
    "fct_match": ["game_id"],
    "fct_player_match_performance": ["appearance_id"],
    "fct_player_rolling_form": ["appearance_id"],
    "fct_club_season_performance": ["club_id", "season", "competition_id"],
    "fct_club_transfer_portfolio": ["club_id", "transfer_season"],
    "fct_transfer_fixed_horizon_outcomes": ["transfer_key"],
    "fct_transfer_cohort_performance": ["horizon_days", "cohort_type", "cohort_value"],
    "fct_data_coverage_bias": ["segment_type", "segment_value"],
    "fct_transfer_success_labels": ["transfer_key"],
    "fct_club_risk_profile": ["club_id"],
}


def grains(wh) -> Frames:
    out = {name: checks.duplicates(wh[name], keys) for name, keys in GRAINS.items()}
    out["stg_club_games"] = checks.duplicates(wh["stg_club_games"], ["game_id"], expected=2)
    return out


def recomputed(wh) -> Frames:
    """Summaries rebuilt by another route and compared key by key."""
    games = wh["stg_club_games"]
    clubs = games.dropDuplicates(["club_id", "game_id"]).groupBy("club_id").agg(F.count("*").alias("matches_played")).join(
        games.groupBy("club_id").agg(
            F.sum("is_win").alias("wins"), F.sum("own_goals").alias("goals_scored"),
            F.sum("opponent_goals").alias("goals_conceded"),
            F.sum(F.col("own_goals") - F.col("opponent_goals")).alias("goal_difference")), "club_id")
    stg_games = wh["stg_games"]
    competitions = stg_games.groupBy("competition_id").agg(
        F.count_distinct("game_id").alias("matches_played"),
        (F.sum("home_club_goals") + F.sum("away_club_goals")).alias("total_goals"))
    values = wh["stg_player_valuations"].where(F.col("market_value_in_eur").isNotNull())
    value_ends = values.groupBy("player_id").agg(
        F.min("valuation_date").alias("first_valuation_date"), F.max("valuation_date").alias("latest_valuation_date"),
        F.max("market_value_in_eur").alias("highest_market_value"))
    played = wh["stg_appearances"]
    totals = [F.sum(c).alias(n) for n, c in {
        "total_goals": "goals", "total_assists": "assists", "total_minutes_played": "minutes_played",
        "total_yellow_cards": "yellow_cards", "total_red_cards": "red_cards"}.items()]
    names = ["total_goals", "total_assists", "total_minutes_played", "total_yellow_cards", "total_red_cards"]
    seasons = played.join(stg_games.select("game_id", "season"), "game_id").groupBy(
        "player_id", "season", "competition_id").agg(*totals)
    moves = wh["stg_transfers"].groupBy("player_id").agg(
        F.count("*").alias("transfer_count"), F.sum("transfer_fee").alias("total_transfer_fee"),
        F.max("transfer_fee").alias("max_transfer_fee"), F.max("transfer_date").alias("latest_transfer_date"))
    facts = wh["fct_transfer_market_value_analysis"].where(~F.col("is_future_transfer"))

    def side(club: str, prefix: str) -> list[Column]:
        here = F.col(club).isNotNull()
        return [F.sum(F.when(here, F.col("transfer_fee"))).alias(prefix + "_fee"), F.count_if(here).alias(prefix + "_n")]

    source = facts.agg(*side("to_club_id", "in"), *side("from_club_id", "out")).withColumn("k", F.lit(1))
    report = wh["fct_club_transfer_portfolio"].agg(
        F.sum("inbound_transfer_spend").alias("in_fee"), F.sum("inbound_transfers").alias("in_n"),
        F.sum("outbound_transfer_income").alias("out_fee"), F.sum("outbound_transfers").alias("out_n"),
    ).withColumn("k", F.lit(1))
    return {
        "int_club_performance_summary": keyed_mismatches(
            clubs, wh["int_club_performance_summary"], ["club_id"],
            ["matches_played", "wins", "goals_scored", "goals_conceded", "goal_difference"]),
        "int_competition_summary": keyed_mismatches(
            competitions, wh["int_competition_summary"], ["competition_id"], ["matches_played", "total_goals"]),
        "int_player_market_value_summary": keyed_mismatches(
            value_ends, wh["int_player_market_value_summary"], ["player_id"],
            ["first_valuation_date", "latest_valuation_date", "highest_market_value"]),
        "int_player_performance_summary": keyed_mismatches(
            played.groupBy("player_id").agg(*totals), wh["int_player_performance_summary"], ["player_id"], names),
        "int_player_season_performance": keyed_mismatches(
            seasons, wh["int_player_season_performance"], ["player_id", "season", "competition_id"], names),
        "int_transfer_summary": keyed_mismatches(
            moves, wh["int_transfer_summary"], ["player_id"],
            ["transfer_count", "total_transfer_fee", "max_transfer_fee", "latest_transfer_date"]),
        "fct_club_transfer_portfolio": keyed_mismatches(source, report, ["k"], ["in_fee", "in_n", "out_fee", "out_n"]),
    }


def reconciled(wh) -> Frames:
    """Rows present in a table or in its source, but not in both."""
    def current(dim: str, staging: str, key: str, columns: list[str]) -> DataFrame:
        kept = wh[dim].join(wh[staging].select(key), key, "left_semi")
        return symmetric_difference(wh[staging].select(*columns), kept.select(*columns))

    def shared(table: str, source: str, columns: list[str]) -> DataFrame:
        return symmetric_difference(wh[source].select(*columns), wh[table].select(*columns))

    season = wh["int_player_season_performance"].columns
    play = [c for c in wh["int_player_performance_summary"].columns]
    value_cols = ["player_id", "valuation_date", "market_value_in_eur", "current_club_id", "current_club_name", "competition_id"]
    values = wh["stg_player_valuations"].withColumnRenamed("player_club_domestic_competition_id", "competition_id")
    move = [c for c in TRANSFER_IDENTITY]
    keyed = wh["stg_transfers"].select(
        row_key(*TRANSFER_IDENTITY).alias("transfer_key"), "player_id", "transfer_date", "transfer_fee",
        F.col("market_value_in_eur").alias("transfer_record_market_value"))
    expected_keys = target_days(wh).join(
        valuation_events(wh).select(
            "player_id", F.col("valuation_date").alias("target_market_value_date"),
            F.col("market_value_in_eur").alias("target_market_value_eur")),
        ["player_id", "target_market_value_date", "target_market_value_eur"], "left_semi",
    ).select(F.concat_ws("-", F.col("player_id").cast("string"), F.col("season").cast("string")).alias("training_row_key"))
    return {
        "dim_players": current("dim_players", "stg_players", "player_id", PLAYER_PROFILE),
        "dim_clubs": current("dim_clubs", "stg_clubs", "club_id", wh["stg_clubs"].columns),
        "dim_competitions": shared("dim_competitions", "stg_competitions", wh["dim_competitions"].columns),
        "fct_club_performance": shared(
            "fct_club_performance", "int_club_performance_summary", wh["int_club_performance_summary"].columns),
        "fct_competition_performance": shared(
            "fct_competition_performance", "int_competition_summary", wh["int_competition_summary"].columns),
        "fct_market_value_history": symmetric_difference(
            values.select(*value_cols), wh["fct_market_value_history"].select(*value_cols)),
        "fct_player_career_timeline": shared("fct_player_career_timeline", "int_player_season_performance", season),
        "fct_player_performance": shared("fct_player_performance", "int_player_performance_summary", play),
        "fct_transfers": shared("fct_transfers", "stg_transfers", move),
        "fct_transfer_market_value_analysis": symmetric_difference(
            keyed, wh["fct_transfer_market_value_analysis"].select(*keyed.columns)),
        "ml_player_market_value_training": symmetric_difference(
            expected_keys, wh["ml_player_market_value_training"].select("training_row_key")),
    }


def coverage(wh) -> DataFrame:
    """Expected and actual row counts of every derived table."""
    def keys(table: str, *columns: str) -> DataFrame:
        return wh[table].select(*columns).distinct()

    games = wh["stg_games"]
    outcomes = wh["fct_transfer_fixed_horizon_outcomes"]
    analysis = wh["fct_transfer_market_value_analysis"]
    club_ids = (
        wh["stg_clubs"].select("club_id")
        .unionByName(games.select(F.explode(F.array("home_club_id", "away_club_id")).alias("club_id")))
        .unionByName(wh["stg_transfers"].select(F.explode(F.array("from_club_id", "to_club_id")).alias("club_id")))
        .unionByName(wh["stg_player_valuations"].select(F.col("current_club_id").alias("club_id")))
        .unionByName(wh["stg_players"].select(F.col("current_club_id").alias("club_id")))
        .where(F.col("club_id").isNotNull()).distinct()
    )
    days = date_bounds(wh).select(F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))))
    past = games.where(F.col("game_date") <= F.lit(wh.as_of)).select("game_id", "season", "competition_id")
    expected = {
        "int_club_performance_summary": keys("stg_club_games", "club_id"),
        "int_competition_summary": keys("stg_games", "competition_id"),
        "int_player_market_value_summary": wh["stg_player_valuations"].where("market_value_in_eur is not null").select("player_id").distinct(),
        "int_player_performance_summary": keys("stg_appearances", "player_id"),
        "int_player_profile": wh["stg_players"],
        "int_player_season_performance": wh["stg_appearances"].join(games.select("game_id", "season"), "game_id")
        .select("player_id", "season", "competition_id").distinct(),
        "int_transfer_summary": keys("stg_transfers", "player_id"),
        "dim_players": keys("stg_players", "player_id").union(keys("stg_appearances", "player_id")).distinct(),
        "dim_clubs": club_ids,
        "dim_competitions": wh["stg_competitions"],
        "dim_date": days,
        "fct_club_performance": wh["int_club_performance_summary"],
        "fct_competition_performance": wh["int_competition_summary"],
        "fct_player_performance": wh["int_player_performance_summary"],
        "fct_player_career_timeline": wh["int_player_season_performance"],
        "fct_market_value_history": wh["stg_player_valuations"],
        "fct_transfers": wh["stg_transfers"],
        "fct_transfer_market_value_analysis": wh["stg_transfers"],
        "fct_match": games,
        "fct_player_match_performance": wh["stg_appearances"],
        "fct_player_rolling_form": wh["stg_appearances"],
        "fct_club_season_performance": wh["stg_club_games"].join(past, "game_id")
        .select("club_id", "season", "competition_id").distinct(),
        "fct_transfer_fixed_horizon_outcomes": analysis.where(~F.col("is_future_transfer")),
        "fct_transfer_success_labels": outcomes.where(F.col("has_365d_outcome")),
        "fct_club_risk_profile": outcomes.where("to_club_id is not null").select("to_club_id").distinct(),
    }
    return checks.row_count_differences(expected, {name: wh[name] for name in expected})


def _not_percent(*columns: str) -> Column:
    bad = F.lit(False)
    for c in columns:
        bad = bad | ~F.col(c).between(0, 100)
    return bad


def _differs(actual: str, expected: Column) -> Column:
    return ~F.col(actual).eqNullSafe(expected)


def _rate_rule(amount: str, minutes: str, rate: str) -> Column:
    return _differs(rate, per_90(amount, minutes, 4))


def _feature_rules(df: DataFrame, scoring: bool) -> DataFrame:
    count_columns = ["minutes_before_target", "goals_before_target", "assists_before_target",
                     "yellow_cards_before_target", "red_cards_before_target"]
    bad = F.lit(False)
    for c in count_columns:
        bad = bad | (F.col(c) < 0)
    floor = 1 if scoring else 0
    for c in ("matches_before_target", "competitions_played_before_target"):
        bad = bad | (F.col(c) < floor)
    has, value = F.col("has_previous_market_value"), F.col("previous_market_value_eur")
    bad = (
        bad | ~F.col("age_at_target_date").between(10, 60) | (has != value.isNotNull())
        | (value.isNull() != F.col("previous_market_value_date").isNull())
        | (has & (F.col("days_since_previous_market_value") < (0 if scoring else 1)))
        | (has & (F.col("prior_valuation_count") < 1)) | (value > F.col("prior_highest_market_value_eur"))
        | _rate_rule("goals_before_target", "minutes_before_target", "goals_per_90_before_target")
        | _rate_rule("assists_before_target", "minutes_before_target", "assists_per_90_before_target")
    )
    if not scoring:
        bad = bad | (F.col("target_market_value_eur") <= 0)
    return df.where(F.coalesce(bad, F.lit(False)))


def row_rules(wh) -> Frames:
    """Rows that break a rule a reader of the table relies on."""
    # First, so that the outcomes take their columns from its files.
    analysis = wh["fct_transfer_market_value_analysis"]
    cohort = wh["fct_transfer_cohort_performance"]
    parts = F.col("observed_outcome_count") + F.col("missing_baseline_count") + F.col("not_yet_observable_count") + F.col("missing_followup_count")
    coverage_pct = [c for c in wh["fct_data_coverage_bias"].columns if c.endswith("_coverage_pct")]
    outcomes = wh["fct_transfer_fixed_horizon_outcomes"]
    bad_outcome = (F.col("pre_180d_appearances") < 0) | (F.col("post_180d_appearances") < 0)
    base = F.col("market_value_baseline")
    for h in (90, 180, 365):
        seen = F.col(f"valuation_{h}d_date")
        bad_outcome = (
            bad_outcome
            | (F.col(f"has_{h}d_outcome") & (F.abs(F.datediff(seen, f"target_{h}d_date")) > 30))
            | (F.col(f"has_{h}d_outcome") != (seen.isNotNull() & base.isNotNull()))
            | _differs(f"market_value_change_{h}d", money_diff(F.col(f"market_value_{h}d"), base))
            | ~F.col(f"outcome_{h}d_status").isin("observed", "missing_baseline", "not_yet_observable", "missing_followup")
            | (base.isNull() != (F.col(f"outcome_{h}d_status") == "missing_baseline"))
        )
    match, home, away = wh["fct_match"], F.col("home_club_goals"), F.col("away_club_goals")
    played = wh["fct_player_match_performance"]
    form = wh["fct_player_rolling_form"]
    seasons = wh["int_player_season_performance"]
    values = wh["stg_player_valuations"].where("market_value_in_eur is not null").select(
        "player_id", F.col("valuation_date").alias("season_market_value_date"),
        F.col("market_value_in_eur").alias("season_market_value")).distinct()
    fee, day = F.col("transfer_fee"), F.col("transfer_date")
    recorded, prior = F.col("transfer_record_market_value"), F.col("prior_market_value")
    profile = wh["int_player_profile"]
    raw_players = wh.raw["players"].select(
        "player_id", F.struct("current_club_id", "last_season", "highest_market_value_in_eur").alias("_raw"))
    labels, risk = wh["fct_transfer_success_labels"], wh["fct_club_risk_profile"]
    label_change = F.col("market_value_change_at_horizon_pct")
    staged = {
        "stg_appearances": F.col("player_current_club_id") < 0,
        "stg_game_events": (F.col("minute") < 0) | (F.col("event_description") == ""),
        "stg_game_lineups": F.col("position") == "",
        "stg_players": ~F.col("height_in_cm").between(100, 250),
    }
    return {
        "cohort_rules": cohort.where(
            (parts != F.col("transfer_count")) | _not_percent("outcome_coverage_pct", "positive_outcome_rate_pct")
            | (F.col("meets_minimum_sample_size") != (F.col("observed_outcome_count") >= 30))
            | (F.col("avg_change_ci95_lower_pct") > F.col("avg_change_ci95_upper_pct"))),
        "coverage_rules": wh["fct_data_coverage_bias"].where(
            _not_percent(*coverage_pct, "maximum_material_missingness_pct")),
        "fixed_horizon_rules": outcomes.where(bad_outcome),
        "match_rules": match.where(
            _differs("total_goals", home + away) | _differs("home_goal_difference", home - away)
            | _differs("match_result", F.when(home > away, "home_win").when(away > home, "away_win").otherwise("draw"))),
        "player_match_rules": played.where(
            _rate_rule("goals", "minutes_played", "goals_per_90")
            | _rate_rule("assists", "minutes_played", "assists_per_90")
            | ~F.coalesce(F.col("club_points"), F.lit(0)).isin(0, 1, 3)
            | ((F.col("club_result") == "win") & (F.col("club_points") != 3))
            | ((F.col("club_result") == "draw") & (F.col("club_points") != 1))
            | ((F.col("club_result") == "loss") & (F.col("club_points") != 0))),
        "feature_rules_training": _feature_rules(wh["ml_player_market_value_training"], False),
        "feature_rules_scoring": _feature_rules(wh["ml_player_market_value_scoring"], True),
        "age_is_complete_years": profile.where(
            F.col("birth_date").isNotNull() & _differs("age", full_years(wh.as_of, "birth_date"))),
        "rolling_form_rules": form.where(
            ~F.col("rolling_5_appearances").between(1, 5)
            | (F.col("rolling_5_minutes") < F.col("minutes_played")) | (F.col("rolling_5_goals") < F.col("goals"))
            | (F.col("rolling_5_assists") < F.col("assists"))
            | ~F.col("rolling_5_starts").between(0, F.col("rolling_5_appearances"))
            | ~F.col("rolling_5_captain_appearances").between(0, F.col("rolling_5_appearances"))
            | _rate_rule("rolling_5_goals", "rolling_5_minutes", "rolling_5_goals_per_90")
            | _rate_rule("rolling_5_assists", "rolling_5_minutes", "rolling_5_assists_per_90")),
        "season_value_is_a_valuation": seasons.where("season_market_value is not null").join(
            values, ["player_id", "season_market_value_date", "season_market_value"], "left_anti"
        ).select("player_id").unionByName(seasons.where(
            F.col("season_market_value").isNull() != F.col("season_market_value_date").isNull()).select("player_id")),
        **{f"sentinels_{t}": wh[t].where(c) for t, c in staged.items()},
        "players_keep_source_values": wh["stg_players"].join(raw_players, "player_id").where(
            _differs("current_club_id", F.col("_raw.current_club_id"))
            | _differs("last_season", F.col("_raw.last_season"))
            | _differs("highest_market_value_in_eur", F.col("_raw.highest_market_value_in_eur"))),
        "transfer_calculations": wh["fct_transfers"].where(
            _differs("fee_market_value_difference", money_diff(fee, F.col("market_value_in_eur")))
            | _differs("fee_market_value_difference_pct", pct("fee_market_value_difference", "market_value_in_eur"))),
        "analysis_calculations": analysis.where(
            _differs("market_value_baseline", F.coalesce(recorded, prior.cast("decimal(38,9)")))
            | _differs("market_value_baseline_date", F.when(recorded.isNotNull(), day).otherwise(F.col("prior_valuation_date")))
            | _differs("days_since_market_value_baseline", F.datediff(day, "market_value_baseline_date"))
            | _differs("fee_market_value_difference", money_diff(fee, base))
            | _differs("fee_market_value_difference_pct", pct("fee_market_value_difference", base))
            | _differs("fee_to_market_value_ratio", F.round(ratio(fee, base), 4))
            | _differs("market_value_change_after_transfer", money_diff(F.col("next_market_value"), base))
            | _differs("market_value_change_after_transfer_pct", pct("market_value_change_after_transfer", base))
            | _differs("days_since_previous_transfer", F.datediff(day, "previous_transfer_date"))
            | _differs("days_to_next_transfer", F.datediff("next_transfer_date", day))
            | _differs("days_since_prior_valuation", F.datediff(day, "prior_valuation_date"))
            | _differs("days_to_next_valuation", F.datediff("next_valuation_date", day))),
        "valuation_matching": _valuation_matching(wh),
        "success_label_rules": labels.where(
            (F.col("label_horizon_days") != 365) | (F.col("label_status") != "observed")
            | (F.col("success_threshold_pct") != 20)
            | (F.col("is_successful_transfer") != F.when(label_change >= 20, 1).otherwise(0))),
        "club_risk_rules": risk.where(
            (F.col("observed_365d_transfers") != F.col("successful_transfers") + F.col("unsuccessful_transfers"))
            | _not_percent("outcome_365d_coverage_pct", "known_fee_coverage_pct")
            | F.coalesce(_not_percent("transfer_success_rate_pct"), F.lit(False))
            | (F.col("meets_minimum_sample_size") != (F.col("observed_365d_transfers") >= 30))
            | (~F.col("meets_minimum_sample_size") & (F.col("transfer_risk_category") != "insufficient_data"))),
    }


def _valuation_matching(wh) -> DataFrame:
    """Proof that prior and next valuations are adjacent and real.

    No valuation may lie strictly between prior and next.  With the sorted
    distinct valuation days of each player numbered, prior and next must be
    neighbours: next's number is prior's plus one.
    """
    from pyspark.sql import Window as W

    days = wh["stg_player_valuations"].where("valuation_date is not null").groupBy("player_id", "valuation_date").agg(F.count("*").alias("n"))
    # One row per player and day: bounded by the calendar.
    line = W.partitionBy("player_id").orderBy("valuation_date")
    numbered = days.select("player_id", "valuation_date", F.row_number().over(line).alias("pos"),
                           F.count("*").over(W.partitionBy("player_id")).alias("total"))
    moves = wh["fct_transfer_market_value_analysis"].where("transfer_date is not null").select(
        "transfer_key", "player_id", "transfer_date", "prior_valuation_date", "next_valuation_date",
        "prior_market_value", "next_market_value")

    def place(when: str) -> DataFrame:
        return numbered.select("player_id", F.col("valuation_date").alias(f"{when}_valuation_date"),
                               F.col("pos").alias(when), F.col("total").alias(f"{when}_total"))

    joined = (
        moves.join(place("prior"), ["player_id", "prior_valuation_date"], "left")
        .join(place("next"), ["player_id", "next_valuation_date"], "left")
        .join(days.groupBy("player_id").agg(F.count("*").alias("days")), "player_id", "left")
    )
    p, n = F.col("prior"), F.col("next")
    ok_order = (F.coalesce(F.col("prior_valuation_date") <= F.col("transfer_date"), F.lit(True))
                & F.coalesce(F.col("next_valuation_date") > F.col("transfer_date"), F.lit(True)))
    adjacent = F.coalesce(n, F.coalesce(F.col("days"), F.lit(0)) + 1) == F.coalesce(p, F.lit(0)) + 1
    real = (p.isNotNull() == F.col("prior_valuation_date").isNotNull()) & (n.isNotNull() == F.col("next_valuation_date").isNotNull())
    return joined.where(~(ok_order & adjacent & real)).select("transfer_key")


def leakage(wh) -> Frames:
    """Feature rows that know the future."""
    train, score = wh["ml_player_market_value_training"], wh["ml_player_market_value_scoring"]
    target, asof = F.col("target_market_value_date"), F.col("prediction_as_of_date")
    last, prior = F.col("feature_last_appearance_date"), F.col("previous_market_value_date")
    has, value = F.col("has_previous_market_value"), F.col("previous_market_value_eur")
    broken = (value < 0) | (F.col("prior_valuation_count") < 0) | (has != value.isNotNull())
    seasons = wh["int_player_season_performance"]
    last_games = (
        wh["stg_appearances"].join(wh["stg_games"].select("game_id", "season", "game_date"), "game_id")
        .groupBy("player_id", "season", "competition_id").agg(F.max("game_date").alias("last_game")))
    return {
        "features_precede_target": train.where(
            (last >= target) | (prior >= target) | (F.col("target_market_value_eur") <= 0) | (target > F.lit(wh.as_of))),
        "training_asof_integrity": train.where(
            F.col("target_market_value_eur").isNull() | (last >= target) | (prior >= target) | broken
            | (F.col("days_since_previous_market_value") < 1)),
        "scoring_asof_integrity": score.where(
            asof.isNull() | (last > asof) | (prior > asof) | broken | (F.col("days_since_previous_market_value") < 0)),
        "scoring_not_future": score.where((last > asof) | (prior > asof) | (asof != F.lit(wh.as_of))),
        "season_value_not_after_last_game": seasons.join(last_games, ["player_id", "season", "competition_id"]).where(
            F.col("season_market_value_date") > F.col("last_game")),
    }


# Highest accepted missing rates of the scoring table.
MISSING_LIMITS = {"previous_market_value_eur": 0.35, "competition_id": 0.35, "age_at_target_date": 0.05}


def scoring_readiness(wh) -> DataFrame:
    """Missing rate per watched column, with its limit and verdict."""
    counted = wh["ml_player_market_value_scoring"].agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in MISSING_LIMITS])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), ratio(c, "n").alias("observed_rate"), F.lit(limit).alias("maximum_rate"))
        for c, limit in MISSING_LIMITS.items()])
    return counted.select("n", F.explode(rows).alias("r")).select("r.*", "n").select(
        "column_name", "observed_rate", "maximum_rate",
        ((F.col("n") > 0) & (F.col("observed_rate") <= F.col("maximum_rate"))).alias("passed"))


def ml_coverage(wh) -> DataFrame:
    """Both feature tables have rows; scoring covers only the latest season."""
    train = wh["ml_player_market_value_training"].agg(F.count("*").alias("train_rows"))
    score = wh["ml_player_market_value_scoring"].agg(
        F.count("*").alias("score_rows"), F.min("season").alias("lo"), F.max("season").alias("hi"))
    latest = wh["stg_games"].where(F.col("game_date") <= F.lit(wh.as_of)).agg(F.max("season").alias("latest"))
    one = train.crossJoin(F.broadcast(score)).crossJoin(F.broadcast(latest))
    rows = F.array(
        F.struct(F.lit("training_has_rows").alias("validation_name"), (F.col("train_rows") > 0).alias("passed")),
        F.struct(F.lit("scoring_has_rows").alias("validation_name"), (F.col("score_rows") > 0).alias("passed")),
        F.struct(F.lit("scoring_uses_latest_observed_season").alias("validation_name"),
                 F.coalesce((F.col("lo") == F.col("hi")) & (F.col("hi") == F.col("latest")), F.lit(False)).alias("passed")),
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def volume_changes(audit: DataFrame, limit: float = 0.5) -> DataFrame:
    """Volumes of the newest audit row against the one before."""
    watched = ["historical_transfer_rows", "match_rows", "player_match_rows", "source_transfer_rows"]
    recent = audit.orderBy(F.desc("audit_generated_at_utc"), F.desc("audit_key")).limit(2).agg(
        F.max(F.struct("audit_generated_at_utc", "audit_key", *watched)).alias("new"),
        F.min(F.struct("audit_generated_at_utc", "audit_key", *watched)).alias("old"),
        F.count("*").alias("n"))
    rows = F.array(*[
        F.struct(F.lit(c).alias("metric_name"), F.col("new")[c].alias("latest_value"), F.col("old")[c].alias("previous_value"))
        for c in watched])
    moved = F.abs(ratio(F.col("latest_value") - F.col("previous_value"), "previous_value"))
    return recent.where("n = 2").select(F.explode(rows).alias("r")).select("r.*").where(
        (F.col("previous_value") > 0) & (moved > limit))


def history_validity(history: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Keys without exactly one open row, or with an empty validity span."""
    return history.groupBy(key).agg(
        F.count_if(F.col(valid_to).isNull()).alias("n_open"),
        F.count_if(F.col(valid_to) <= F.col(valid_from)).alias("n_inverted"),
    ).where((F.col("n_open") != 1) | (F.col("n_inverted") > 0)).select(key)


def sequence_proof(wh) -> DataFrame:
    """Transfers whose numbering or running fee breaks the induction.

    Each row is compared with its predecessor (same player, number - 1), an
    equality join on a unique pair, so no window over a whole player is needed.
    """
    rows = wh.columns(
        "fct_transfer_market_value_analysis", "transfer_key", "player_id", "transfer_date", "transfer_sequence_number",
        "player_transfer_count", "known_fee_transfer_count", "transfer_fee", "cumulative_known_transfer_fee",
        "total_transfer_fee", "is_latest_transfer").withColumnRenamed("transfer_sequence_number", "seq")
    before = rows.select("player_id", (F.col("seq") + 1).alias("seq"),
                         F.struct("transfer_date", "transfer_key", "cumulative_known_transfer_fee").alias("b"))
    joined = rows.join(before, ["player_id", "seq"], "left")
    zero = F.lit(0).cast("decimal(38,9)")
    step = F.coalesce("b.cumulative_known_transfer_fee", zero) + F.coalesce("transfer_fee", zero)
    later = F.struct("transfer_date", "transfer_key") >= F.struct("b.transfer_date", "b.transfer_key")
    bad_step = (
        ((F.col("seq") > 1) & F.col("b").isNull()) | ((F.col("seq") > 1) & ~later)
        | (F.coalesce("cumulative_known_transfer_fee", zero) != step)
        | (F.col("is_latest_transfer") != (F.col("seq") == F.col("player_transfer_count")))
    )
    totals = rows.groupBy("player_id").agg(
        F.count("*").alias("n"), F.max("seq").alias("top"), F.count("transfer_fee").alias("n_fee"),
        F.max("player_transfer_count").alias("said_n"), F.max("known_fee_transfer_count").alias("said_fee"),
        F.sum("transfer_fee").alias("fee"), F.max("total_transfer_fee").alias("said_total"))
    bad_total = totals.where(
        (F.col("n") != F.col("top")) | (F.col("n") != F.col("said_n")) | (F.col("n_fee") != F.col("said_fee"))
        | ~F.col("fee").eqNullSafe(F.col("said_total")))
    return joined.where(bad_step).select("player_id").unionByName(bad_total.select("player_id"))


def calendar_continuity(wh) -> DataFrame:
    """Bounds and row count of the calendar against the facts; empty is a pass."""
    want = date_bounds(wh).withColumn("expected_rows", F.datediff("end_date", "start_date") + 1)
    have = wh["dim_date"].agg(F.min("date_day").alias("min_date"), F.max("date_day").alias("max_date"),
                              F.count("*").alias("actual_rows"))
    return want.crossJoin(F.broadcast(have)).where(
        (F.col("start_date") != F.col("min_date")) | (F.col("end_date") != F.col("max_date"))
        | (F.col("expected_rows") != F.col("actual_rows")))


# Key columns that may not be null.
NOT_NULL = {
    "stg_games": ["game_id", "competition_id", "season", "game_date"],
    "stg_appearances": ["appearance_id", "game_id", "player_id", "player_current_club_id", "player_name"],
    "stg_transfers": ["player_id", "transfer_date", "transfer_fee", "market_value_in_eur"],
    "stg_player_valuations": ["player_id", "valuation_date", "market_value_in_eur", "current_club_id"],
}


def nulls(wh) -> DataFrame:
    out = None
    for table, columns in NOT_NULL.items():
        part = checks.null_counts(wh[table], columns).select(F.lit(table).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out
