"""Match, appearance, player and club facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.exprs import earliest, pct, per_90, rounded_avg
from touchline.operators.rolling import trailing_rows


def fct_match(wh) -> DataFrame:
    about = wh["dim_competitions"].select(
        "competition_id", "competition_name", "competition_type",
        F.col("country_name").alias("competition_country_name"))
    games = wh["stg_games"].drop("competition_type")
    home, away = F.col("home_club_goals"), F.col("away_club_goals")

    def both(what: str) -> Column:
        return F.col(f"home_club_{what}").isNotNull() & F.col(f"away_club_{what}").isNotNull()

    return games.join(about, "competition_id", "left").select(
        "game_id", "game_date", "season", "competition_id", "competition_name",
        "competition_type", "competition_country_name", "round", "home_club_id",
        "home_club_name", "away_club_id", "away_club_name", "home_club_goals", "away_club_goals",
        (home + away).alias("total_goals"),
        (home - away).alias("home_goal_difference"),
        F.when(home > away, "home_win").when(home < away, "away_win").otherwise("draw").alias("match_result"),
        "home_club_position", "away_club_position", "home_club_manager_name",
        "away_club_manager_name", "home_club_formation", "away_club_formation", "stadium",
        "attendance", "referee", "aggregate",
        (F.col("game_date") > F.lit(wh.as_of)).alias("is_future_game"),
        F.col("attendance").isNotNull().alias("has_attendance"),
        both("formation").alias("has_both_formations"),
        both("manager_name").alias("has_both_managers"),
        both("position").alias("has_both_table_positions"),
    )


def lineup_context(wh) -> DataFrame:
    return wh["stg_game_lineups"].groupBy("game_id", "player_id", "club_id").agg(
        F.bool_or(F.col("lineup_type") == "starting_lineup").alias("is_starter"),
        F.bool_or(F.col("team_captain") == 1).alias("is_captain"),
        earliest("position", "game_lineups_id").alias("lineup_position"),
    )


def fct_player_match_performance(wh) -> DataFrame:
    games = wh["stg_games"].select(
        "game_id", "season", "home_club_id", "away_club_id", "home_club_name", "away_club_name",
        "home_club_goals", "away_club_goals")
    lineups = lineup_context(wh).withColumnRenamed("club_id", "player_club_id").withColumn("has_lineup", F.lit(True))
    players = wh["dim_players"].select(
        "player_id", F.col("player_name").alias("known_name"), "position", "sub_position")
    clubs = wh["dim_clubs"].select(
        F.col("club_id").alias("player_club_id"), F.col("club_name").alias("player_club_name"))
    # Each join shuffles what those before it added, so the widest comes last.
    placed = wh.step("appearance_lineups", lambda: wh["stg_appearances"].join(
        lineups, ["game_id", "player_id", "player_club_id"], "left"))
    joined = (
        placed.join(players, "player_id", "left").join(games, "game_id").join(clubs, "player_club_id", "left")
    )
    at_home = F.col("player_club_id") == F.col("home_club_id")
    on_road = F.col("player_club_id") == F.col("away_club_id")

    def sided(home: Column, road: Column) -> Column:
        return F.when(at_home, home).when(on_road, road)

    hg, ag = F.col("home_club_goals"), F.col("away_club_goals")
    won = (at_home & (hg > ag)) | (on_road & (ag > hg))

    def outcome(win, draw, loss) -> Column:
        return F.when(won, win).when(hg == ag, draw).when(at_home | on_road, loss)

    return joined.select(
        "appearance_id", "game_id", "player_id", F.col("known_name").alias("player_name"),
        "position", "sub_position", "player_club_id", "player_club_name", "competition_id",
        "season", "appearance_date",
        F.coalesce(sided(F.lit("home"), F.lit("away")), F.lit("unknown")).alias("hosting"),
        sided(F.col("away_club_id"), F.col("home_club_id")).alias("opponent_club_id"),
        sided(F.col("away_club_name"), F.col("home_club_name")).alias("opponent_club_name"),
        sided(hg, ag).alias("club_goals"),
        sided(ag, hg).alias("opponent_goals"),
        F.coalesce(outcome("win", "draw", "loss"), F.lit("unknown")).alias("club_result"),
        outcome(3, 1, 0).alias("club_points"),
        "minutes_played", "goals", "assists", "yellow_cards", "red_cards",
        per_90("goals", "minutes_played", 4).alias("goals_per_90"),
        per_90("assists", "minutes_played", 4).alias("assists_per_90"),
        F.coalesce("is_starter", F.lit(False)).alias("is_starter"),
        F.coalesce("is_captain", F.lit(False)).alias("is_captain"),
        "lineup_position",
        F.col("has_lineup").isNotNull().alias("has_lineup_context"),
        (F.col("appearance_date") > F.lit(wh.as_of)).alias("is_future_appearance"),
    )


def fct_player_rolling_form(wh) -> DataFrame:
    base = wh["fct_player_match_performance"].select(
        "appearance_id", "game_id", "player_id", "player_name", "position", "sub_position",
        "player_club_id", "player_club_name", "competition_id", "season", "appearance_date",
        "hosting", "opponent_club_id", "opponent_club_name", "club_result", "club_points",
        "minutes_played", "goals", "assists", "is_starter", "is_captain", "yellow_cards", "red_cards")

    def measures(w):
        def total(c: str) -> Column:
            return F.sum(c).over(w)

        return {
            "rolling_5_appearances": F.count("*").over(w),
            "rolling_5_minutes": total("minutes_played"),
            "rolling_5_goals": total("goals"),
            "rolling_5_assists": total("assists"),
            "rolling_5_yellow_cards": total("yellow_cards"),
            "rolling_5_red_cards": total("red_cards"),
            "rolling_5_club_points": total("club_points"),
            "rolling_5_goals_per_90": per_90(total("goals"), total("minutes_played"), 4),
            "rolling_5_assists_per_90": per_90(total("assists"), total("minutes_played"), 4),
            "rolling_5_avg_minutes": F.round(F.avg("minutes_played").over(w), 2),
            "rolling_5_starts": F.count_if(F.col("is_starter")).over(w),
            "rolling_5_captain_appearances": F.count_if(F.col("is_captain")).over(w),
        }

    return trailing_rows(
        base, "player_id", "appearance_date", ["game_id", "appearance_id"], 5, measures,
        between=lambda rows: wh.step("numbered_appearances", lambda: rows),
    ).drop("yellow_cards", "red_cards")


def fct_player_performance(wh) -> DataFrame:
    # The profile columns used here come straight from the source profile, so
    # the valuation and transfer summaries need not be computed.
    profile = wh["stg_players"].select(
        "player_id", "player_name", "position", "sub_position", "current_club_id",
        "current_club_name", "market_value_in_eur")
    return wh["int_player_performance_summary"].join(profile, "player_id", "left").select(
        "player_id", "player_name", "position", "sub_position", "current_club_id",
        "current_club_name", "market_value_in_eur",
        F.col("market_value_in_eur").isNotNull().alias("has_current_market_value"),
        "matches_played", "total_goals", "total_assists", "total_minutes_played",
        "total_yellow_cards", "total_red_cards", "avg_minutes_per_match", "goals_per_match",
        "assists_per_match", "goals_per_90", "assists_per_90",
    )


def fct_player_career_timeline(wh) -> DataFrame:
    who = wh["dim_players"].select("player_id", "player_name", "position", "current_club_name")
    return (
        wh["int_player_season_performance"].join(who, "player_id", "left")
        .withColumn("has_season_market_value", F.col("season_market_value").isNotNull())
    )


def fct_club_performance(wh) -> DataFrame:
    who = wh["dim_clubs"].select("club_id", "club_name", "domestic_competition_id")
    return wh["int_club_performance_summary"].join(who, "club_id", "left")


def fct_club_season_performance(wh) -> DataFrame:
    games = wh["stg_games"].where(F.col("game_date") <= F.lit(wh.as_of)).select(
        "game_id", "season", "competition_id", "attendance", "home_club_formation", "away_club_formation")
    won, level = F.col("is_win") == 1, F.col("own_goals") == F.col("opponent_goals")
    differ, no_win = F.col("own_goals") != F.col("opponent_goals"), F.col("is_win") == 0
    at_home = F.col("hosting") == "home"
    formation = F.when(at_home, F.col("home_club_formation")).otherwise(F.col("away_club_formation"))
    grouped = (
        wh["stg_club_games"].join(games, "game_id")
        .groupBy("club_id", "season", "competition_id").agg(
            F.count_distinct("game_id").alias("matches_played"),
            F.count("*").alias("n_rows"),
            F.count_if(won).alias("wins"),
            F.count_if(no_win & level).alias("draws"),
            F.count_if(no_win & differ).alias("losses"),
            F.sum("own_goals").alias("goals_scored"),
            F.sum("opponent_goals").alias("goals_conceded"),
            F.sum(F.when(won, 3).when(level, 1).otherwise(0)).alias("points"),
            rounded_avg("own_goals").alias("avg_goals_scored"),
            rounded_avg("opponent_goals").alias("avg_goals_conceded"),
            rounded_avg("attendance").alias("avg_attendance"),
            F.count_if(at_home).alias("home_matches"),
            F.count_if(F.col("hosting") == "away").alias("away_matches"),
            # A club has few managers and formations in a season; as sets they need no second
            # distinct count, for which Spark would multiply the rows.
            F.size(F.collect_set("own_manager_name")).alias("managers_used"),
            F.size(F.collect_set(formation)).alias("formations_used"),
            # A numerically high table position is a bad one; the names are kept.
            F.max("own_position").alias("highest_recorded_position"),
            F.min("own_position").alias("lowest_recorded_position"),
        )
    )
    # Names are functions of the ids, so they join after the aggregate.
    clubs = wh["dim_clubs"].select("club_id", "club_name")
    competitions = wh["dim_competitions"].select("competition_id", "competition_name")
    return (
        grouped.join(clubs, "club_id", "left").join(competitions, "competition_id", "left")
        .select(
            "club_id", "club_name", "season",
            F.make_date(F.col("season").cast("int"), F.lit(7), F.lit(1)).alias("season_start_date"),
            "competition_id", "competition_name", "matches_played", "wins", "draws", "losses",
            "goals_scored", "goals_conceded",
            (F.col("goals_scored") - F.col("goals_conceded")).alias("goal_difference"),
            "points", pct("wins", "n_rows").alias("win_rate_pct"), "avg_goals_scored",
            "avg_goals_conceded", "avg_attendance", "home_matches", "away_matches",
            "managers_used", "formations_used", "highest_recorded_position",
            "lowest_recorded_position",
        )
    )


def fct_competition_performance(wh) -> DataFrame:
    return wh["int_competition_summary"]


def fct_market_value_history(wh) -> DataFrame:
    who = wh["dim_players"].select("player_id", "player_name", "position", "sub_position")
    league = F.col("player_club_domestic_competition_id")
    return wh["stg_player_valuations"].join(who, "player_id", "left").select(
        "player_id", "player_name", "position", "sub_position", "valuation_date",
        "market_value_in_eur", "current_club_id", "current_club_name",
        league.alias("competition_id"),
        F.col("current_club_id").isNotNull().alias("has_club_context"),
        league.isNotNull().alias("has_competition_context"),
    )
