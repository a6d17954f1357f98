"""Transfer facts: valuation context, fixed-horizon outcomes, success labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.functions import labels as L
from touchline.functions.exprs import (MONEY, band, full_years, least_known, null_if, pct, ratio,
                                       row_key)
from touchline.operators import timeline
from touchline.plans.intermediate import VALUATION_RANK

# One digit of headroom keeps the full scale of a money difference.
_WIDE = "decimal(37,9)"


def money_diff(a: Column, b: Column) -> Column:
    return (a.cast(_WIDE) - b.cast(_WIDE)).cast(MONEY)


def fct_transfers(wh) -> DataFrame:
    who = wh["dim_players"].select("player_id", "position", "sub_position")
    gap = money_diff(F.col("transfer_fee"), F.col("market_value_in_eur"))
    return wh["stg_transfers"].join(who, "player_id", "left").select(
        "player_id", "position", "sub_position", "player_name", "transfer_date",
        "transfer_season", "from_club_id", "to_club_id", "from_club_name", "to_club_name",
        "transfer_fee", "market_value_in_eur",
        gap.alias("fee_market_value_difference"),
        pct(gap, "market_value_in_eur").alias("fee_market_value_difference_pct"),
    )


TRANSFER_IDENTITY = [
    "player_id", "transfer_date", "transfer_season", "from_club_id", "to_club_id",
    "from_club_name", "to_club_name", "transfer_fee", "market_value_in_eur", "player_name",
]


# Player and day of a transfer, as keys without nulls: the date of an undated one is not looked at.
DAY_KEY = ["player_id", "_on", "_dated"]


def _day_key() -> list[Column]:
    day = F.col("transfer_date")
    return [F.col("player_id"), F.coalesce(day, F.lit(date(1970, 1, 1))).alias("_on"), day.isNotNull().alias("_dated")]


def _transfer_days(wh) -> DataFrame:
    """Per player and day: totals before and after, valuations around it, and the player's context.

    Works on one row per player and day, so a player with any number of
    transfers or valuations is bounded by the calendar.  The context joins here,
    where the rows already lie by player.
    """
    per_day = (
        wh["stg_transfers"].groupBy("player_id", "transfer_date").agg(
            F.count("*").alias("n"),
            F.count("transfer_fee").alias("n_fee"),
            F.sum("transfer_fee").alias("fee"),
        )
    )
    history = timeline.day_states(
        wh["stg_player_valuations"], "player_id", "valuation_date", VALUATION_RANK)
    line = timeline.merge(per_day, history, "player_id", "transfer_date", strict="forward")
    earlier = line.past.rowsBetween(W.unboundedPreceding, -1)
    later = line.future.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy("player_id")
    days = line.probes(
        n_before=F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        fee_before=F.sum("fee").over(earlier),
        day_before=F.last("transfer_date", ignorenulls=True).over(earlier),
        prior=line.last_event(),
        day_after=F.last("transfer_date", ignorenulls=True).over(later),
        # An undated transfer has no before or after.
        upcoming=F.when(F.col("transfer_date").isNotNull(), line.next_event()),
        player_transfer_count=F.sum("n").over(everything),
        known_fee_transfer_count=F.sum("n_fee").over(everything),
    ).select(
        *_day_key(), F.col("n").alias("n_day"),
        "n_before", "fee_before", "day_before", "day_after", "prior", "upcoming",
        "player_transfer_count", "known_fee_transfer_count",
    )
    return days.join(_player_context(wh), F.col("player_id") == F.col("_player"), "left").drop("_player")


def _sequenced(wh, days: DataFrame | None = None) -> DataFrame:
    """Transfers with key, sequence, running fee and neighbouring dates.

    Copies of a transfer are equal in every column.  They travel as one row
    with a counter and are spread out again at the end.  Rows are dealt by player
    and day once, while they are narrow; the count, the key, the window and the join need no other shuffle.
    """
    def club(side: str) -> DataFrame:
        return wh["dim_clubs"].select(
            F.col("club_id").alias(f"{side}_club_id"), F.col("club_name").alias(f"known_{side}_club"))

    distinct = (
        wh["stg_transfers"].select("*", *_day_key()[1:]).repartition(*DAY_KEY)
        .groupBy(*TRANSFER_IDENTITY, *DAY_KEY[1:]).agg(F.count("*").alias("copies"))
        .withColumn("transfer_key", row_key(*TRANSFER_IDENTITY))
    )
    earlier = (
        W.partitionBy(*DAY_KEY).orderBy("transfer_key").rowsBetween(W.unboundedPreceding, -1)
    )
    fee = F.col("transfer_fee")
    numbered = distinct.withColumns({
        "n_same_day": F.coalesce(F.sum("copies").over(earlier), F.lit(0)),
        "fee_same_day": F.sum((fee * F.col("copies")).cast(MONEY)).over(earlier),
    })
    placed = (
        numbered.join(club("from"), "from_club_id", "left").join(club("to"), "to_club_id", "left")
        .join(_transfer_days(wh) if days is None else days, DAY_KEY)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
    in_day = F.col("n_same_day") + F.col("copy")
    own = (fee * F.col("copy")).cast(MONEY)
    parts = ("fee_before", "fee_same_day")
    running = own
    for part in parts:
        # A sum over no known fee stays null, as in a running SUM.
        total = F.col(part)
        running = F.when(running.isNull(), total).when(total.isNull(), running).otherwise(
            (running.cast(_WIDE) + total.cast(_WIDE)).cast(MONEY))
    return placed.withColumns({
        "transfer_sequence_number": F.col("n_before") + in_day,
        "cumulative_known_transfer_fee": running,
        "previous_transfer_date": F.when(in_day > 1, F.col("transfer_date")).otherwise(F.col("day_before")),
        "next_transfer_date": F.when(in_day < F.col("n_day"), F.col("transfer_date")).otherwise(F.col("day_after")),
    })


def _player_context(wh) -> DataFrame:
    """Everything keyed by player, joined once before it meets the transfers."""
    who = wh["dim_players"].select(
        F.col("player_id").alias("_player"), F.col("player_name").alias("known_name"), "position",
        "sub_position", "birth_date", "country_of_citizenship")
    value = wh["int_player_market_value_summary"].select(
        F.col("player_id").alias("_player"), "first_valuation_date", "latest_valuation_date",
        "first_market_value", "current_market_value", "highest_market_value",
        F.col("market_value_growth").alias("career_market_value_growth"),
        F.col("market_value_growth_pct").alias("career_market_value_growth_pct"))
    moves = wh["int_transfer_summary"].select(
        F.col("player_id").alias("_player"), "total_transfer_fee", "avg_transfer_fee", "max_transfer_fee")
    return who.join(value, "_player", "full_outer").join(moves, "_player", "full_outer")


def fct_transfer_market_value_analysis(wh) -> DataFrame:
    def competition(when: str) -> DataFrame:
        return wh["dim_competitions"].select(
            F.col("competition_id").alias(f"{when}_competition_id"),
            F.col("competition_name").alias(f"{when}_competition_name"),
            F.col("country_name").alias(f"{when}_competition_country_name"),
            F.col("confederation").alias(f"{when}_competition_confederation"))

    league = "player_club_domestic_competition_id"
    rows = (
        _sequenced(wh, wh.step("transfer_days", lambda: _transfer_days(wh)))
        .withColumns({
            "prior_competition_id": F.col("prior")[league],
            "next_competition_id": F.col("upcoming")[league],
        })
        .join(competition("prior"), "prior_competition_id", "left")
        .join(competition("next"), "next_competition_id", "left")
    )
    recorded = F.col("market_value_in_eur")
    prior_value = F.col("prior.market_value_in_eur")
    rows = rows.withColumns({
        "market_value_baseline": F.coalesce(recorded, prior_value.cast(MONEY)),
        "market_value_baseline_date": F.when(recorded.isNotNull(), F.col("transfer_date")).otherwise(F.col("prior.on")),
        "market_value_baseline_source": F.when(recorded.isNotNull(), "transfer_record")
        .when(prior_value.isNotNull(), "latest_prior_valuation").otherwise("unavailable"),
    })
    day, fee = F.col("transfer_date"), F.col("transfer_fee")
    base = F.col("market_value_baseline")
    next_value = F.col("upcoming.market_value_in_eur")
    premium = money_diff(fee, base)
    change = money_diff(next_value, base)
    direction = (
        F.when(next_value.isNull() | base.isNull(), "unavailable")
        .when(next_value > base, "increase").when(next_value < base, "decrease")
        .otherwise("unchanged")
    )
    country = (F.col("prior_competition_country_name"), F.col("next_competition_country_name"))
    context = (
        F.when(F.col("prior_competition_id").isNull() | F.col("next_competition_id").isNull(), "unavailable")
        .when(F.col("prior_competition_id") == F.col("next_competition_id"), "same_competition")
        .when(country[0] != country[1], "country_change").otherwise("competition_change")
    )

    def valuation(struct: str, when: str) -> list[Column]:
        return [
            F.col(struct + ".on").alias(f"{when}_valuation_date"),
            F.col(struct + ".market_value_in_eur").alias(f"{when}_market_value"),
            F.col(struct + ".current_club_id").alias(f"{when}_valuation_club_id"),
            F.col(struct + ".current_club_name").alias(f"{when}_valuation_club_name"),
            F.col(f"{when}_competition_id").alias(f"{when}_valuation_competition_id"),
            F.col(f"{when}_competition_name"), F.col(f"{when}_competition_country_name"),
            F.col(f"{when}_competition_confederation"),
            F.col(struct + ".on").isNotNull().alias(f"has_{when}_valuation"),
        ]

    return rows.select(
        "transfer_key", "player_id",
        F.coalesce(null_if("player_name", ""), F.col("known_name")).alias("player_name"),
        "position",
        L.lookup(L.POSITION_TR, "position", F.coalesce("position", F.lit(L.UNKNOWN_TR))).alias("pozisyon_tr"),
        "sub_position", "birth_date", "country_of_citizenship",
        full_years(day, "birth_date").alias("age_at_transfer"),
        "transfer_date",
        F.year(day).cast("long").alias("transfer_year"),
        F.month(day).cast("long").alias("transfer_month"),
        "transfer_season",
        (day > F.lit(wh.as_of)).alias("is_future_transfer"),
        "transfer_sequence_number", "player_transfer_count", "known_fee_transfer_count",
        (F.col("transfer_sequence_number") == F.col("player_transfer_count")).alias("is_latest_transfer"),
        "previous_transfer_date",
        F.datediff(day, "previous_transfer_date").alias("days_since_previous_transfer"),
        "next_transfer_date",
        F.datediff("next_transfer_date", day).alias("days_to_next_transfer"),
        "from_club_id",
        F.coalesce(null_if("from_club_name", ""), F.col("known_from_club")).alias("from_club_name"),
        "to_club_id",
        F.coalesce(null_if("to_club_name", ""), F.col("known_to_club")).alias("to_club_name"),
        "transfer_fee", "cumulative_known_transfer_fee", "total_transfer_fee", "avg_transfer_fee",
        "max_transfer_fee",
        F.when(fee.isNull(), "unknown").when(fee == 0, "zero_fee").otherwise("paid").alias("fee_status"),
        fee.isNotNull().alias("has_known_transfer_fee"),
        recorded.alias("transfer_record_market_value"),
        recorded.isNotNull().alias("has_transfer_record_market_value"),
        "market_value_baseline_date", "market_value_baseline", "market_value_baseline_source",
        base.isNotNull().alias("has_market_value_baseline"),
        (fee.isNotNull() & base.isNotNull()).alias("has_fee_market_value_comparison"),
        F.datediff(day, "market_value_baseline_date").alias("days_since_market_value_baseline"),
        premium.alias("fee_market_value_difference"),
        pct(premium, base).alias("fee_market_value_difference_pct"),
        F.round(ratio(fee, base), 4).alias("fee_to_market_value_ratio"),
        *valuation("prior", "prior"),
        F.datediff(day, "prior.on").alias("days_since_prior_valuation"),
        *valuation("upcoming", "next"),
        F.datediff("upcoming.on", day).alias("days_to_next_valuation"),
        change.alias("market_value_change_after_transfer"),
        pct(change, base).alias("market_value_change_after_transfer_pct"),
        (next_value.isNotNull() & base.isNotNull()).alias("has_post_transfer_value_change"),
        direction.alias("market_value_direction_after_transfer"),
        L.lookup(L.DIRECTION_TR, direction, None).alias("yon_etiketi_tr"),
        context.alias("valuation_context_change"),
        "first_valuation_date", "latest_valuation_date", "first_market_value",
        "current_market_value", "highest_market_value", "career_market_value_growth",
        "career_market_value_growth_pct",
    )


# Outcome horizons in days, tolerance, and form window.
HORIZONS = (90, 180, 365)
TOLERANCE_DAYS = 30
FORM_DAYS = 180


def _outcome_status(h: int, base: Column, seen: Column, cutoff: Column) -> Column:
    return (
        F.when(base.isNull(), "missing_baseline").when(seen.isNotNull(), "observed")
        .when(F.date_add("transfer_date", h + TOLERANCE_DAYS) > cutoff, "not_yet_observable")
        .otherwise("missing_followup")
    )


def outcomes_as_of(outcomes: DataFrame, as_of: date) -> DataFrame:
    """Outcomes of a later reporting date as ``as_of`` reports them: its transfers, with its statuses."""
    cutoff = least_known(F.lit(as_of), "source_latest_valuation_date")
    return outcomes.where(F.col("transfer_date") <= F.lit(as_of)).withColumns({
        f"outcome_{h}d_status": _outcome_status(h, F.col("market_value_baseline"), F.col(f"valuation_{h}d_date"), cutoff)
        for h in HORIZONS})


# Columns of the wide transfer fact that the outcomes use.
MOVE = [
    "transfer_key", "player_id", "player_name", "position", "sub_position", "age_at_transfer",
    "transfer_date", "transfer_year", "transfer_season", "from_club_id", "from_club_name", "to_club_id",
    "to_club_name", "transfer_fee", "market_value_baseline", "fee_market_value_difference",
    "fee_market_value_difference_pct", "valuation_context_change", "has_known_transfer_fee",
    "has_fee_market_value_comparison", "is_future_transfer",
]


def _lookups(wh) -> DataFrame:
    """Valuations at the horizons and form around each player's transfer days."""
    days = wh["stg_transfers"].where(F.col("transfer_date") <= F.lit(wh.as_of)).select("player_id", "transfer_date")
    found = timeline.nearest_within(
        days, wh["stg_player_valuations"], "player_id", "transfer_date", "valuation_date",
        VALUATION_RANK[:1], {f"h{h}": h for h in HORIZONS}, TOLERANCE_DAYS)
    form = timeline.window_sums(
        days, wh["stg_appearances"], "player_id", "transfer_date", "appearance_date",
        {"appearances": F.lit(1), "minutes": F.col("minutes_played"),
         "goals": F.col("goals"), "assists": F.col("assists")},
        {f"pre_{FORM_DAYS}d": (-FORM_DAYS, -1), f"post_{FORM_DAYS}d": (0, FORM_DAYS)})
    return found.join(form, ["player_id", "transfer_date"], "full_outer")


def fct_transfer_fixed_horizon_outcomes(wh) -> DataFrame:
    # A third of the columns is used, so only they are stored where the wide fact is not.
    moves = wh.columns("fct_transfer_market_value_analysis", *MOVE).where(~F.col("is_future_transfer"))
    limits = wh["stg_player_valuations"].agg(F.max("valuation_date").alias("source_latest_valuation_date"))
    joined = (
        moves.join(wh.step("transfer_lookups", lambda: _lookups(wh)), ["player_id", "transfer_date"], "left")
        .crossJoin(F.broadcast(limits))
    )
    day, base = F.col("transfer_date"), F.col("market_value_baseline")
    cutoff = least_known(F.lit(wh.as_of), "source_latest_valuation_date")
    premium = F.col("fee_market_value_difference_pct")

    def horizon(h: int) -> list[Column]:
        seen, value = F.col(f"h{h}.on"), F.col(f"h{h}.market_value_in_eur")
        change = money_diff(value, base)
        return [
            F.date_add(day, h).alias(f"target_{h}d_date"),
            seen.alias(f"valuation_{h}d_date"),
            value.alias(f"market_value_{h}d"),
            F.datediff(seen, day).alias(f"days_to_{h}d_valuation"),
            change.alias(f"market_value_change_{h}d"),
            pct(change, base).alias(f"market_value_change_{h}d_pct"),
            (seen.isNotNull() & base.isNotNull()).alias(f"has_{h}d_outcome"),
            _outcome_status(h, base, seen, cutoff).alias(f"outcome_{h}d_status"),
        ]

    pre, post = f"pre_{FORM_DAYS}d", f"post_{FORM_DAYS}d"
    totals = ("appearances", "minutes", "goals", "assists")
    return joined.select(
        "transfer_key", "player_id", "player_name", "position", "sub_position", "age_at_transfer",
        band("age_at_transfer", L.TRANSFER_AGE_CUTS, L.TRANSFER_AGE_TOP, "unknown").alias("age_band_at_transfer"),
        "transfer_date", "transfer_year", "transfer_season", "from_club_id", "from_club_name",
        "to_club_id", "to_club_name", "transfer_fee", "market_value_baseline",
        "fee_market_value_difference", "fee_market_value_difference_pct",
        F.when(premium.isNull(), "unavailable").when(premium < -20, "discount_20_plus")
        .when(premium <= 20, "within_20_pct").otherwise("premium_20_plus").alias("fee_premium_band"),
        "valuation_context_change", "has_known_transfer_fee", "has_fee_market_value_comparison",
        *[c for h in HORIZONS for c in horizon(h)],
        *[F.coalesce(F.col(f"{side}_{t}"), F.lit(0)).alias(f"{side}_{t}") for side in (pre, post) for t in totals],
        (F.coalesce(f"{pre}_appearances", F.lit(0)) > 0).alias(f"has_{pre}_performance"),
        (F.coalesce(f"{post}_appearances", F.lit(0)) > 0).alias(f"has_{post}_performance"),
        *[(F.coalesce(f"{post}_{t}", F.lit(0)) - F.coalesce(f"{pre}_{t}", F.lit(0)))
          .alias(f"{t}_change_post_vs_pre_{FORM_DAYS}d") for t in totals[1:]],
        "source_latest_valuation_date",
    )


# Label horizon and threshold.
LABEL_HORIZON = 365
SUCCESS_PCT = 20


def fct_transfer_success_labels(wh) -> DataFrame:
    h = LABEL_HORIZON
    change = F.col(f"market_value_change_{h}d_pct")
    return wh["fct_transfer_fixed_horizon_outcomes"].where(F.col(f"has_{h}d_outcome")).select(
        "transfer_key", "player_id", "player_name", "position", "age_at_transfer", "transfer_date",
        "transfer_year", "transfer_season", "from_club_id", "from_club_name", "to_club_id",
        "to_club_name", "transfer_fee", "has_known_transfer_fee", "market_value_baseline",
        "fee_market_value_difference_pct",
        F.lit(h).alias("label_horizon_days"),
        F.col(f"valuation_{h}d_date").alias("outcome_valuation_date"),
        F.col(f"market_value_{h}d").alias("outcome_market_value"),
        change.alias("market_value_change_at_horizon_pct"),
        F.col(f"outcome_{h}d_status").alias("label_status"),
        F.lit(SUCCESS_PCT).alias("success_threshold_pct"),
        # A null change (zero baseline) counts as not successful.
        F.when(change >= SUCCESS_PCT, 1).otherwise(0).alias("is_successful_transfer"),
    )
