"""Profile of the raw tables: counts, duplicates, orphans, conflicts, issues."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.quality.checks import orphans

# Issue codes and severities.
ISSUES = {
    "SOURCE_ROW_COUNT_MISMATCH": ("critical", "row_count_mismatches"),
    "DUPLICATE_GAME_ID": ("critical", "duplicate_game_ids"),
    "MISSING_APPEARANCE_GAME": ("high", "appearances_without_game"),
    "MISSING_APPEARANCE_PLAYER": ("high", "appearances_without_player"),
    "CONFLICTING_SAME_DAY_VALUATIONS": ("high", "conflicting_valuation_days"),
    "UNMAPPED_COMPETITION_CODES_IN_SOURCE": ("medium", "games_without_competition"),
    "FUTURE_DATED_SOURCE_TRANSFERS": ("medium", "future_transfers"),
    "NONPOSITIVE_SOURCE_VALUATIONS": ("medium", "nonpositive_valuations"),
    "MISSING_GAME_DATE": ("high", "games_without_date"),
    "INVALID_SCORES": ("high", "games_with_negative_score"),
    "SAME_HOME_AND_AWAY_CLUB": ("high", "games_with_one_club"),
}


def source_profile(raw, as_of: date, expected_rows: dict[str, int] | None = None) -> DataFrame:
    """One row of profile figures; every source is aggregated on its own."""
    games = raw["games"].agg(
        F.count("*").alias("games"),
        (F.count("*") - F.count_distinct("game_id")).alias("duplicate_game_ids"),
        F.min("date").alias("first_game_date"), F.max("date").alias("last_game_date"),
        F.count_if(F.col("date").isNull()).alias("games_without_date"),
        F.count_if((F.col("home_club_goals") < 0) | (F.col("away_club_goals") < 0)).alias("games_with_negative_score"),
        F.count_if(F.col("home_club_id") == F.col("away_club_id")).alias("games_with_one_club"),
    )
    value = F.col("market_value_in_eur")
    days = raw["player_valuations"].groupBy("player_id", "date").agg(
        F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"),
        F.count_if(value.isNull()).alias("n_null"), F.count_if(value <= 0).alias("n_bad"))
    valuations = days.agg(
        F.sum("n").alias("valuations"),
        F.count_if(F.col("n") > 1).alias("repeated_valuation_days"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("extra_valuation_rows"),
        F.count_if(F.col("lo") < F.col("hi")).alias("conflicting_valuation_days"),
        F.min("date").alias("first_valuation_date"), F.max("date").alias("last_valuation_date"),
        F.coalesce(F.sum(F.when(F.col("date").isNull(), F.col("n"))), F.lit(0)).alias("valuations_without_date"),
        F.sum("n_bad").alias("nonpositive_valuations"), F.sum("n_null").alias("valuations_without_value"),
    )

    def missing(child: str, column: str, parent: str, name: str) -> DataFrame:
        return orphans(raw[child], column, raw[parent]).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias(name))

    transfers = raw["transfers"].agg(
        F.count("*").alias("transfers"),
        F.min("transfer_date").alias("first_transfer_date"), F.max("transfer_date").alias("last_transfer_date"),
        F.count_if(F.col("transfer_date").isNull()).alias("transfers_without_date"),
        F.count_if(F.col("transfer_fee") < 0).alias("transfers_with_negative_fee"),
        F.count_if(value < 0).alias("transfers_with_negative_value"),
        F.count_if(F.col("transfer_date") > F.lit(as_of)).alias("future_transfers"),
    )
    one = games
    parts = [
        valuations, transfers,
        missing("appearances", "game_id", "games", "appearances_without_game"),
        missing("appearances", "player_id", "players", "appearances_without_player"),
        missing("games", "competition_id", "competitions", "games_without_competition"),
        *[raw[t].agg(F.count("*").alias(t)) for t in ("appearances", "players", "clubs", "competitions")],
    ]
    for part in parts:
        one = one.crossJoin(F.broadcast(part))
    actual = {"player_valuations": "valuations"}
    wrong = sum((F.coalesce((F.col(actual.get(t, t)) != n).cast("long"), F.lit(1))
                 for t, n in (expected_rows or {}).items()), F.lit(0).cast("long"))
    return one.withColumn("row_count_mismatches", wrong)


def source_issues(profile: DataFrame) -> DataFrame:
    """Issues with at least one affected row."""
    rows = F.array(*[
        F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.col(c).cast("long").alias("affected"))
        for code, (severity, c) in ISSUES.items()])
    return profile.select(F.explode(rows).alias("i")).select("i.*").where(F.col("affected") > 0)
