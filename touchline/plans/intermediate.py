"""Per-club, per-player and per-competition summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.exprs import full_years, money_avg, pct, per_90, ratio, rounded_avg
from touchline.operators import timeline


def int_club_performance_summary(wh) -> DataFrame:
    won = F.col("is_win") == 1
    level = F.col("own_goals") == F.col("opponent_goals")
    beaten = F.col("own_goals") != F.col("opponent_goals")
    no_win = F.col("is_win") == 0
    return (
        wh["stg_club_games"].groupBy("club_id").agg(
            F.count_distinct("game_id").alias("matches_played"),
            F.count_if(won).alias("wins"),
            F.count_if(no_win & level).alias("draws"),
            F.count_if(no_win & beaten).alias("losses"),
            F.sum("own_goals").alias("goals_scored"),
            F.sum("opponent_goals").alias("goals_conceded"),
            rounded_avg("own_goals").alias("avg_goals_scored"),
            rounded_avg("opponent_goals").alias("avg_goals_conceded"),
        )
        .withColumns({
            "goal_difference": F.col("goals_scored") - F.col("goals_conceded"),
            "win_rate": pct("wins", "matches_played"),
        })
        .select("club_id", "matches_played", "wins", "draws", "losses", "goals_scored",
                "goals_conceded", "goal_difference", "win_rate", "avg_goals_scored",
                "avg_goals_conceded")
    )


def int_competition_summary(wh) -> DataFrame:
    games = wh["stg_games"]
    goals = F.col("home_club_goals") + F.col("away_club_goals")
    totals = games.groupBy("competition_id").agg(
        F.count_distinct("game_id").alias("matches_played"),
        F.sum(goals).alias("total_goals"),
        rounded_avg(goals).alias("avg_goals_per_match"),
        rounded_avg("attendance").alias("avg_attendance"),
    )
    clubs = (
        games.select("competition_id", F.explode(F.array("home_club_id", "away_club_id")).alias("club_id"))
        .groupBy("competition_id").agg(F.count_distinct("club_id").alias("club_participation_count"))
    )
    about = wh["stg_competitions"].select(
        "competition_id", "competition_name", "competition_type", "country_name", "confederation")
    return (
        totals.join(clubs, "competition_id", "left").join(about, "competition_id", "left")
        .select("competition_id", "competition_name", "competition_type", "country_name",
                "confederation", "matches_played", "total_goals", "avg_goals_per_match",
                "club_participation_count", "avg_attendance")
    )


# Tie-break of valuations that share a player and a day.
VALUATION_RANK = ["market_value_in_eur", "current_club_id", "current_club_name",
                  "player_club_domestic_competition_id"]


def int_player_market_value_summary(wh) -> DataFrame:
    row = F.struct("valuation_date", *VALUATION_RANK)
    summary = (
        wh["stg_player_valuations"].where(F.col("market_value_in_eur").isNotNull())
        .groupBy("player_id").agg(
            F.min(row).alias("first"), F.max(row).alias("last"),
            F.max("market_value_in_eur").alias("highest_market_value"),
        )
    )
    first, last = F.col("first.market_value_in_eur"), F.col("last.market_value_in_eur")
    return summary.select(
        "player_id",
        F.col("first.valuation_date").alias("first_valuation_date"),
        F.col("last.valuation_date").alias("latest_valuation_date"),
        first.alias("first_market_value"),
        last.alias("current_market_value"),
        "highest_market_value",
        (last - first).alias("market_value_growth"),
        pct(last - first, first).alias("market_value_growth_pct"),
        F.col("last.current_club_id").alias("latest_club_id"),
        F.col("last.current_club_name").alias("latest_club_name"),
    )


def performance_totals() -> list:
    """Totals shared by the career and the season summaries."""
    return [
        F.count_distinct("game_id").alias("matches_played"),
        F.sum("goals").alias("total_goals"),
        F.sum("assists").alias("total_assists"),
        F.sum("minutes_played").alias("total_minutes_played"),
        F.sum("yellow_cards").alias("total_yellow_cards"),
        F.sum("red_cards").alias("total_red_cards"),
    ]


def performance_rates() -> dict:
    return {
        "goals_per_match": F.round(ratio("total_goals", "matches_played"), 2),
        "assists_per_match": F.round(ratio("total_assists", "matches_played"), 2),
        "goals_per_90": per_90("total_goals", "total_minutes_played"),
        "assists_per_90": per_90("total_assists", "total_minutes_played"),
    }


def int_player_performance_summary(wh) -> DataFrame:
    return (
        wh["stg_appearances"].groupBy("player_id")
        .agg(*performance_totals(), rounded_avg("minutes_played").alias("avg_minutes_per_match"))
        .withColumns(performance_rates())
    )


def int_transfer_summary(wh) -> DataFrame:
    # Newest transfer under the full eight-column order.
    newest = F.max(F.struct(
        "transfer_date", "transfer_season", "to_club_id", "from_club_id", "transfer_fee",
        "market_value_in_eur", "to_club_name", "from_club_name",
    ))
    grouped = wh["stg_transfers"].groupBy("player_id").agg(
        F.count("*").alias("transfer_count"),
        F.sum("transfer_fee").alias("total_transfer_fee"),
        money_avg("transfer_fee").alias("avg_transfer_fee"),
        F.max("transfer_fee").alias("max_transfer_fee"),
        newest.alias("t"),
    )
    return grouped.select(
        "player_id", "transfer_count", "total_transfer_fee", "avg_transfer_fee", "max_transfer_fee",
        F.col("t.transfer_date").alias("latest_transfer_date"),
        F.col("t.transfer_season").alias("latest_transfer_season"),
        F.col("t.from_club_id").alias("latest_from_club_id"),
        F.col("t.to_club_id").alias("latest_to_club_id"),
        F.col("t.from_club_name").alias("latest_from_club_name"),
        F.col("t.to_club_name").alias("latest_to_club_name"),
        F.col("t.transfer_fee").alias("latest_transfer_fee"),
        F.col("t.market_value_in_eur").alias("latest_transfer_market_value"),
    )


def int_player_profile(wh) -> DataFrame:
    players = wh["stg_players"].select(
        "player_id", "player_name", "position", "sub_position", "preferred_foot",
        "country_of_birth", "country_of_citizenship", "birth_date",
        full_years(wh.as_of, "birth_date").alias("age"),
        "height_in_cm", "agent_name", "current_club_id", "current_club_name",
        "international_caps", "international_goals", "market_value_in_eur",
    )
    play = wh["int_player_performance_summary"].select(
        "player_id", "matches_played", "total_goals", "total_assists", "total_minutes_played",
        "goals_per_match", "assists_per_match", "goals_per_90", "assists_per_90")
    value = wh["int_player_market_value_summary"].select(
        "player_id", "first_market_value", "current_market_value", "highest_market_value",
        "market_value_growth", "market_value_growth_pct")
    moves = wh["int_transfer_summary"].select(
        "player_id", "transfer_count", "total_transfer_fee", "latest_transfer_fee")
    return (
        players.join(play, "player_id", "left").join(value, "player_id", "left")
        .join(moves, "player_id", "left")
    )


def int_player_season_performance(wh) -> DataFrame:
    def totals() -> DataFrame:
        games = wh["stg_games"].select("game_id", "season", "game_date")
        return (
            wh["stg_appearances"].join(games, "game_id")
            .groupBy("player_id", "season", "competition_id")
            .agg(*performance_totals(), F.max("game_date").alias("last_game"))
        )

    seasons = wh.step("season_totals", totals)
    # Value and date come from one valuation, the last with a known value.
    known = wh["stg_player_valuations"].where(F.col("market_value_in_eur").isNotNull())
    history = timeline.day_states(known, "player_id", "valuation_date", ["market_value_in_eur"])
    line = timeline.merge(seasons, history, "player_id", "last_game", strict="forward")
    return (
        # Rates follow from the totals, so only these are shuffled.
        line.probes(valued=line.last_event()).withColumns(performance_rates())
        .select("player_id", "season", "competition_id", "matches_played", "total_goals",
                "total_assists", "total_minutes_played", "total_yellow_cards", "total_red_cards",
                "goals_per_match", "assists_per_match", "goals_per_90", "assists_per_90",
                F.col("valued.market_value_in_eur").alias("season_market_value"),
                F.col("valued.on").alias("season_market_value_date"))
    )
