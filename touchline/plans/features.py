"""Leakage-safe model features for training and current scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.exprs import full_years, per_90
from touchline.operators import timeline


def unanimous(c: str, where: Column | None = None) -> Column:
    """The only distinct value of a group, or null when there are several.

    Minimum and maximum agree exactly when one distinct value exists; unlike a
    distinct count this needs no second shuffle.
    """
    value = F.col(c) if where is None else F.when(where, F.col(c))
    return F.when(F.min(value) == F.max(value), F.max(value))


def valuation_events(wh) -> DataFrame:
    """One usable valuation per player and day; conflicting days drop out."""
    return (
        wh["stg_player_valuations"]
        .where(F.col("valuation_date").isNotNull() & (F.col("market_value_in_eur") > 0))
        .groupBy("player_id", "valuation_date").agg(
            unanimous("market_value_in_eur").alias("market_value_in_eur"),
            unanimous("player_club_domestic_competition_id").alias("competition_id"),
        )
        .where(F.col("market_value_in_eur").isNotNull())
    )


def _known_events(wh) -> DataFrame:
    """The usable valuations, which targets, their history and scoring share."""
    return wh.step("valuation_events", lambda: valuation_events(wh))


def target_days(wh) -> DataFrame:
    """Latest target day per player and season; null value when it conflicts."""
    seasons = wh["int_player_season_performance"].where(
        (F.col("season_market_value") > 0) & (F.col("season_market_value_date") <= F.lit(wh.as_of)))
    by_day = seasons.groupBy(
        "player_id", "season", F.col("season_market_value_date").alias("target_market_value_date")
    ).agg(unanimous("season_market_value").alias("target_market_value_eur"))
    return by_day.groupBy("player_id", "season").agg(
        F.max(F.struct("target_market_value_date", "target_market_value_eur")).alias("t")
    ).select("player_id", "season", "t.*")


def training_targets(wh) -> DataFrame:
    events = _known_events(wh).select(
        "player_id", F.col("valuation_date").alias("target_market_value_date"),
        F.col("market_value_in_eur").alias("target_market_value_eur"), "competition_id")
    return target_days(wh).join(
        events, ["player_id", "target_market_value_date", "target_market_value_eur"])


def _form_totals() -> list[Column]:
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return [
        F.count_distinct("game_id").alias("matches_before_target"),
        # A player is in few competitions; as a set they need no second distinct count, for which Spark would multiply the rows.
        F.size(F.collect_set("competition_id")).cast("long").alias("competitions_played_before_target"),
        total("minutes_played").alias("minutes_before_target"),
        total("goals").alias("goals_before_target"),
        total("assists").alias("assists_before_target"),
        total("yellow_cards").alias("yellow_cards_before_target"),
        total("red_cards").alias("red_cards_before_target"),
        per_90(F.sum("goals"), F.sum("minutes_played"), 4).alias("goals_per_90_before_target"),
        per_90(F.sum("assists"), F.sum("minutes_played"), 4).alias("assists_per_90_before_target"),
        F.max("appearance_date").alias("feature_last_appearance_date"),
    ]


_FORM_COLUMNS = ["player_id", "competition_id", "appearance_date", "minutes_played", "goals",
                 "assists", "yellow_cards", "red_cards", "game_id"]
_ZERO_COUNTS = ["matches_before_target", "competitions_played_before_target",
                "minutes_before_target", "goals_before_target", "assists_before_target",
                "yellow_cards_before_target", "red_cards_before_target"]


def _plausible_age(at: Column, birth: str) -> Column:
    age = full_years(at, birth)
    return F.when(age.between(10, 60), age)


def _describe(wh, df: DataFrame, at: Column) -> DataFrame:
    players = wh["dim_players"].select(
        "player_id", "player_name", "position", "sub_position", "preferred_foot", "height_in_cm",
        "country_of_citizenship", "birth_date")
    leagues = wh["dim_competitions"].select(
        "competition_id", "competition_type", F.col("country_name").alias("competition_country_name"),
        "confederation")
    return (
        df.join(players, "player_id", "left").join(leagues, "competition_id", "left")
        .withColumns({
            "has_competition_context": F.col("competition_id").isNotNull(),
            "age_at_target_date": _plausible_age(at, "birth_date"),
            "has_previous_market_value": F.col("previous_market_value_eur").isNotNull(),
            "days_since_previous_market_value": F.datediff(at, "previous_market_value_date"),
        })
    )


FEATURE_COLUMNS = [
    "player_id", "player_name", "season", "competition_id", "has_competition_context", "position",
    "sub_position", "preferred_foot", "height_in_cm", "country_of_citizenship",
    "competition_type", "competition_country_name", "confederation", "age_at_target_date",
    "matches_before_target", "competitions_played_before_target", "minutes_before_target",
    "goals_before_target", "assists_before_target", "yellow_cards_before_target",
    "red_cards_before_target", "goals_per_90_before_target", "assists_per_90_before_target",
    "feature_last_appearance_date", "previous_market_value_date", "previous_market_value_eur",
    "has_previous_market_value", "days_since_previous_market_value", "prior_valuation_count",
    "prior_highest_market_value_eur",
]


def ml_player_market_value_training(wh) -> DataFrame:
    targets = wh.step("training_targets", lambda: training_targets(wh))

    def totals() -> DataFrame:
        games = wh["stg_games"].select("game_id", "season")
        past = (
            wh["stg_appearances"].select(*_FORM_COLUMNS).join(games, "game_id")
            .join(targets.select("player_id", "season", "target_market_value_date"), ["player_id", "season"])
            .where(F.col("appearance_date") < F.col("target_market_value_date"))
        )
        return past.groupBy("player_id", "season").agg(*_form_totals())

    form = wh.step("training_form", totals)
    # Targets are few per player (one a season), so they are the probes
    # themselves; "backward" is strict, the target day is not seen.
    # A player's day has one event already.
    history = _known_events(wh).select(
        "player_id", F.col("valuation_date").alias(timeline.DAY),
        F.struct(F.col("valuation_date").alias("on"), "market_value_in_eur").alias(timeline.EVENT))
    line = timeline.merge(targets, history, "player_id", "target_market_value_date", strict="backward")
    valued = F.col(timeline.EVENT)["market_value_in_eur"]
    rows = line.probes(
        _previous=line.last_event(),
        prior_valuation_count=line.so_far(F.count(valued)),
        prior_highest_market_value_eur=line.so_far(F.max(valued)),
    ).drop(timeline.DAY).withColumns({
        "previous_market_value_date": F.col("_previous.on"),
        "previous_market_value_eur": F.col("_previous.market_value_in_eur"),
    })
    rows = rows.join(form, ["player_id", "season"], "left").fillna(0, _ZERO_COUNTS)
    key = F.concat(F.col("player_id").cast("string"), F.lit("-"), F.col("season").cast("string"))
    return _describe(wh, rows, F.col("target_market_value_date")).select(
        key.alias("training_row_key"), *FEATURE_COLUMNS,
        "target_market_value_date", "target_market_value_eur")


def ml_player_market_value_scoring(wh) -> DataFrame:
    today = F.lit(wh.as_of)
    games = wh["stg_games"].select("game_id", "season", "game_date")
    current = games.where(F.col("game_date") <= today).agg(F.max("season").alias("season"))
    # The one-row season joins as an equality: the scan of games is pruned first.
    this_season = games.join(F.broadcast(current), "season", "left_semi").select("game_id", "season")
    form = (
        wh["stg_appearances"].select(*_FORM_COLUMNS).where(F.col("appearance_date") <= today)
        .join(this_season, "game_id")
        .groupBy("player_id").agg(F.max("season").alias("season"), *_form_totals())
    )
    values = (
        _known_events(wh).where(F.col("valuation_date") <= today)
        .groupBy("player_id").agg(
            F.count("*").alias("prior_valuation_count"),
            F.max("market_value_in_eur").alias("prior_highest_market_value_eur"),
            F.max(F.struct("valuation_date", "market_value_in_eur", "competition_id")).alias("v"),
        )
        .select("player_id", "prior_valuation_count", "prior_highest_market_value_eur",
                F.col("v.valuation_date").alias("previous_market_value_date"),
                F.col("v.market_value_in_eur").alias("previous_market_value_eur"),
                F.col("v.competition_id").alias("competition_id"))
    )
    rows = form.join(values, "player_id", "left").fillna(0, ["prior_valuation_count"])
    return _describe(wh, rows, today).select(
        F.col("player_id").cast("string").alias("scoring_row_key"), *FEATURE_COLUMNS,
        today.alias("prediction_as_of_date"))
