"""Cleaned source tables: rename, trim, sentinel removal, key filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.exprs import MONEY, clean, null_if


def tidy(df: DataFrame, key: str, *columns: str | Column) -> DataFrame:
    """Columns of the rows that have a key."""
    return df.where(F.col(key).isNotNull()).select(*columns)


def trimmed(source: str, name: str | None = None) -> Column:
    return clean(source).alias(name or source)


def renamed(source: str, name: str) -> Column:
    return F.col(source).alias(name)


def stg_appearances(wh) -> DataFrame:
    return tidy(
        wh.raw["appearances"], "appearance_id",
        "appearance_id", "game_id", "player_id", "player_club_id",
        null_if("player_current_club_id", -1).alias("player_current_club_id"),
        renamed("date", "appearance_date"), trimmed("player_name"), "competition_id", "yellow_cards",
        "red_cards", "goals", "assists", "minutes_played",
    )


def stg_club_games(wh) -> DataFrame:
    return tidy(
        wh.raw["club_games"], "game_id",
        "game_id", "club_id", "own_goals", "own_position", trimmed("own_manager_name"), "opponent_id",
        "opponent_goals", "opponent_position", trimmed("opponent_manager_name"), trimmed("hosting"), "is_win",
    )


def stg_clubs(wh) -> DataFrame:
    return tidy(
        wh.raw["clubs"], "club_id",
        "club_id", trimmed("club_code"), trimmed("name", "club_name"), "domestic_competition_id",
        "total_market_value", "squad_size", "average_age", "foreigners_number", "foreigners_percentage",
        "national_team_players", trimmed("stadium_name"), "stadium_seats", trimmed("net_transfer_record"),
        trimmed("coach_name"), "last_season",
    )


def stg_competitions(wh) -> DataFrame:
    published = tidy(
        wh.raw["competitions"], "competition_id",
        trimmed("competition_id"), trimmed("competition_code"), trimmed("name", "competition_name"),
        trimmed("sub_type", "competition_sub_type"), trimmed("type", "competition_type"), "country_id",
        trimmed("country_name"), trimmed("domestic_league_code"), trimmed("confederation"), "total_clubs",
    )
    # Only identifiers are taken from games: no attribute is made up.
    unmapped = (
        wh["stg_games"].where(F.col("competition_id").isNotNull())
        .select("competition_id").distinct()
        .join(published, "competition_id", "left_anti")
        .select(
            "competition_id",
            F.col("competition_id").alias("competition_code"),
            F.concat(F.lit("Unmapped competition ("), "competition_id", F.lit(")")).alias("competition_name"),
        )
    )
    return published.unionByName(unmapped, allowMissingColumns=True)


def stg_countries(wh) -> DataFrame:
    return tidy(
        wh.raw["countries"], "country_id",
        "country_id", trimmed("country_name"), trimmed("country_code"), trimmed("confederation"), "total_clubs",
        "total_players", "average_age",
    )


def stg_game_events(wh) -> DataFrame:
    return tidy(
        wh.raw["game_events"], "game_event_id",
        trimmed("game_event_id"), renamed("date", "event_date"), "game_id",
        null_if("minute", -1).alias("minute"), F.lower(clean("type")).alias("event_type"), "club_id",
        trimmed("club_name"), "player_id", null_if(clean("description"), "").alias("event_description"),
        "player_in_id", "player_assist_id",
    )


def stg_game_lineups(wh) -> DataFrame:
    return tidy(
        wh.raw["game_lineups"], "game_lineups_id",
        trimmed("game_lineups_id"), renamed("date", "lineup_date"), "game_id", "player_id", "club_id",
        trimmed("player_name"), F.lower(clean("type")).alias("lineup_type"),
        null_if(F.upper(clean("position")), "").alias("position"), trimmed("number", "squad_number"),
        "team_captain",
    )


def stg_games(wh) -> DataFrame:
    return tidy(
        wh.raw["games"], "game_id",
        "game_id", "competition_id", "season", trimmed("round"), renamed("date", "game_date"), "home_club_id",
        "away_club_id", "home_club_goals", "away_club_goals", "home_club_position", "away_club_position",
        trimmed("home_club_manager_name"), trimmed("away_club_manager_name"), trimmed("stadium"), "attendance",
        trimmed("referee"), trimmed("home_club_formation"), trimmed("away_club_formation"),
        trimmed("home_club_name"), trimmed("away_club_name"), "aggregate", trimmed("competition_type"),
    )


def stg_national_teams(wh) -> DataFrame:
    return tidy(
        wh.raw["national_teams"], "national_team_id",
        "national_team_id", trimmed("name", "national_team_name"), trimmed("team_code"), "country_id",
        trimmed("country_name"), trimmed("country_code"), trimmed("confederation"), "squad_size", "average_age",
        "foreigners_number", "foreigners_percentage", "total_market_value", trimmed("coach_name"),
        "fifa_ranking", "last_season",
    )


def stg_player_valuations(wh) -> DataFrame:
    return tidy(
        wh.raw["player_valuations"], "player_id",
        "player_id", renamed("date", "valuation_date"), "market_value_in_eur", trimmed("current_club_name"),
        "current_club_id", "player_club_domestic_competition_id",
    )


def stg_players(wh) -> DataFrame:
    height = F.col("height_in_cm")
    return tidy(
        wh.raw["players"], "player_id",
        "player_id", trimmed("first_name"), trimmed("last_name"), trimmed("name", "player_name"), "last_season",
        "current_club_id", trimmed("country_of_birth"), trimmed("city_of_birth"),
        trimmed("country_of_citizenship"), F.col("date_of_birth").cast("date").alias("birth_date"),
        trimmed("sub_position"), trimmed("position"), trimmed("foot", "preferred_foot"),
        F.when(height.between(100, 250), height).alias("height_in_cm"),
        F.col("contract_expiration_date").cast("date").alias("contract_expiration_date"), trimmed("agent_name"),
        "international_caps", "international_goals", "current_national_team_id",
        "current_club_domestic_competition_id", trimmed("current_club_name"), "market_value_in_eur",
        "highest_market_value_in_eur",
    )


def stg_transfers(wh) -> DataFrame:
    return tidy(
        wh.raw["transfers"], "player_id",
        "player_id", "transfer_date", trimmed("transfer_season"), "from_club_id", "to_club_id",
        trimmed("from_club_name"), trimmed("to_club_name"),
        F.col("transfer_fee").cast(MONEY).alias("transfer_fee"),
        F.col("market_value_in_eur").cast(MONEY).alias("market_value_in_eur"), trimmed("player_name"),
    )
