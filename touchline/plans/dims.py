"""Dimensions: current profiles plus identifiers seen only in the facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.exprs import latest, null_if, share_known


def _record_type(kind: str) -> Column:
    return F.lit(kind)


def _completeness(pct: str) -> Column:
    return (
        F.when(F.col(pct) >= 90, "complete").when(F.col(pct) >= 60, "partial").otherwise("limited")
    )


def _display(name: str, fallback: Column) -> Column:
    return F.coalesce(null_if(name, ""), fallback)


def _club_sightings(wh) -> DataFrame:
    """Every mention of a club, one scan per source."""
    def seen(club: str, name: str | None, coach: str | None, season: Column, day: Column, weight: int):
        return F.struct(
            F.col(club).alias("club_id"),
            (null_if(name, "") if name else F.lit(None).cast("string")).alias("club_name"),
            (null_if(coach, "") if coach else F.lit(None).cast("string")).alias("coach_name"),
            season.cast("long").alias("season"), day.alias("seen_on"), F.lit(weight).alias("weight"),
        )

    def scan(df: DataFrame, *sides: Column, need_club: bool = True) -> DataFrame:
        out = df.select(F.explode(F.array(*sides)).alias("s")).select("s.*")
        return out.where(F.col("club_id").isNotNull()) if need_club else out

    game_day, move_day, value_day = F.col("game_date"), F.col("transfer_date"), F.col("valuation_date")
    games = scan(
        wh["stg_games"],
        *[seen(f"{s}_club_id", f"{s}_club_name", f"{s}_club_manager_name", F.col("season"), game_day, 3)
          for s in ("home", "away")],
        need_club=False,
    )
    moves = scan(
        wh["stg_transfers"],
        *[seen(f"{s}_club_id", f"{s}_club_name", None, F.year(move_day), move_day, 2) for s in ("from", "to")],
    )
    values = scan(
        wh["stg_player_valuations"],
        seen("current_club_id", "current_club_name", None, F.year(value_day), value_day, 1),
    )
    profiles = scan(
        wh["stg_players"],
        seen("current_club_id", "current_club_name", None, F.col("last_season"),
             F.lit(date(9999, 12, 31)), 4),
    )
    return games.unionByName(moves).unionByName(values).unionByName(profiles)


def dim_clubs(wh) -> DataFrame:
    current = wh["stg_clubs"].withColumn("club_record_type", _record_type("current_profile"))
    historical = (
        _club_sightings(wh).groupBy("club_id").agg(
            latest("club_name", "seen_on", "weight", "club_name").alias("club_name"),
            latest("coach_name", "seen_on", "weight", "coach_name").alias("coach_name"),
            F.max("season").alias("last_season"),
        )
        .join(current.select("club_id"), "club_id", "left_anti")
        .withColumn("club_record_type", _record_type("historical_reference"))
    )
    scored = current.unionByName(historical, allowMissingColumns=True).withColumn(
        "club_profile_completeness_pct",
        share_known("club_name", "domestic_competition_id", "squad_size", "average_age",
                    "foreigners_number", "national_team_players", "stadium_name",
                    "stadium_seats", "coach_name", "last_season"),
    )
    unknown = F.concat(F.lit("Unknown Club #"), F.col("club_id").cast("string"))
    return scored.withColumns({
        "club_name_display": _display("club_name", unknown),
        "has_club_name": F.col("club_name").isNotNull(),
        "has_current_profile": F.col("club_record_type") == "current_profile",
        "club_profile_completeness_status": _completeness("club_profile_completeness_pct"),
    })


PLAYER_PROFILE = [
    "player_id", "player_name", "position", "sub_position", "birth_date", "country_of_birth",
    "country_of_citizenship", "height_in_cm", "preferred_foot", "agent_name", "current_club_id",
    "current_club_name", "last_season",
]


def dim_players(wh) -> DataFrame:
    current = wh["stg_players"].select(*PLAYER_PROFILE).withColumn(
        "player_record_type", _record_type("current_profile"))
    seasons = wh["stg_games"].select("game_id", "season")
    when = ("appearance_date", "appearance_id")
    seen = (
        wh["stg_appearances"]
        .join(current.select("player_id"), "player_id", "left_anti")
        .join(seasons, "game_id")
        .groupBy("player_id").agg(
            latest("player_name", *when).alias("player_name"),
            latest("player_club_id", *when).alias("current_club_id"),
            F.max("season").alias("last_season"),
        )
    )
    clubs = wh["dim_clubs"].select(
        F.col("club_id").alias("current_club_id"), F.col("club_name").alias("current_club_name"))
    historical = seen.join(clubs, "current_club_id", "left").withColumn(
        "player_record_type", _record_type("historical_reference"))
    scored = current.unionByName(historical, allowMissingColumns=True).withColumn(
        "player_profile_completeness_pct",
        share_known("player_name", "position", "sub_position", "birth_date",
                    "country_of_citizenship", "height_in_cm", "preferred_foot", "agent_name",
                    "current_club_id", "current_club_name"),
    )
    unknown = F.concat(F.lit("Unknown Player #"), F.col("player_id").cast("string"))
    return scored.withColumns({
        "player_name_display": _display("player_name", unknown),
        "position_display": _display("position", F.lit("Unknown Position")),
        "current_club_name_display": _display("current_club_name", F.lit("Unknown Club")),
        "has_current_profile": F.col("player_record_type") == "current_profile",
        "player_profile_completeness_status": _completeness("player_profile_completeness_pct"),
    })


def dim_competitions(wh) -> DataFrame:
    return wh["stg_competitions"].select(
        "competition_id", "competition_code", "competition_name", "competition_sub_type",
        "competition_type", "country_id", "country_name", "domestic_league_code",
        "confederation", "total_clubs")


def dim_national_teams(wh) -> DataFrame:
    unknown = F.concat(F.lit("Unknown National Team #"), F.col("national_team_id").cast("string"))
    return wh["stg_national_teams"].withColumns({
        "national_team_name_display": _display("national_team_name", unknown),
        "has_team_name": F.col("national_team_name").isNotNull(),
        "has_total_market_value": F.col("total_market_value").isNotNull(),
        "has_fifa_ranking": F.col("fifa_ranking").isNotNull(),
    })


# Fact columns whose days the calendar has to cover.
DATED = {
    "stg_games": "game_date", "stg_appearances": "appearance_date",
    "stg_transfers": "transfer_date", "stg_player_valuations": "valuation_date",
}


def date_bounds(wh) -> DataFrame:
    """First and last day of the calendar, as one row."""
    parts = None
    for table, day in DATED.items():
        ends = wh[table].agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
        parts = ends if parts is None else parts.unionByName(ends)
    return parts.agg(
        F.min("lo").alias("start_date"),
        F.greatest(F.max("hi"), F.lit(wh.as_of)).alias("end_date"),
    ).where(F.col("start_date").isNotNull())


def dim_date(wh) -> DataFrame:
    day = F.col("date_day")
    days = date_bounds(wh).select(
        F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias("date_day"))
    weekday = F.dayofweek(day)
    return days.select(
        day,
        F.date_format(day, "yyyyMMdd").cast("long").alias("date_key"),
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter_number"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("calendar_quarter_name"),
        F.month(day).alias("calendar_month_number"),
        F.date_format(day, "MMMM").alias("calendar_month_name"),
        F.date_format(day, "MMM").alias("calendar_month_short_name"),
        F.date_format(day, "yyyy-MM").alias("calendar_year_month"),
        F.date_format(day, "yyyyMM").cast("long").alias("calendar_year_month_sort"),
        F.extract(F.lit("YEAROFWEEK"), day).alias("iso_year"),
        F.weekofyear(day).alias("iso_week_number"),
        (F.weekday(day) + 1).alias("iso_day_of_week_number"),
        F.dayofmonth(day).alias("calendar_day_of_month"),
        F.date_format(day, "EEEE").alias("calendar_day_name"),
        weekday.isin(1, 7).alias("is_weekend"),
        (day == F.lit(wh.as_of)).alias("is_today"),
        (day > F.lit(wh.as_of)).alias("is_future_date"),
    )


# Ends of the metric time spine.
SPINE = (date(2000, 1, 1), date(2035, 12, 31))


def daily_spine(spark: SparkSession, lo: date = SPINE[0], hi: date = SPINE[1]) -> DataFrame:
    days = (hi - lo).days + 1
    return spark.range(days).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("date_day"))


def time_spine_daily(wh) -> DataFrame:
    return daily_spine(wh.spark)
