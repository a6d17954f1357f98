"""Declared column rules of all tables, checked together.

Every table is read once and turned into cells: the values that a uniqueness or key rule looks at,
a parent's own keys, and nothing else but what already breaks a rule.  Equal cells of a table are
joined, and what its own rules pass is dropped: a value that comes once keeps its uniqueness rule.
What is left is stored, so that the shuffles behind one table are gone before the next is built.
Key cells of all tables then meet in one aggregate by (domain, value): a value that children use and
no parent row holds breaks the key rules that its bits name.  So there is no join a rule, and a hot
key collapses before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import stored

NOT_NULL, UNIQUE, KEY, ACCEPTED = "not_null", "unique", "foreign_key", "accepted_values"


@dataclass(frozen=True)
class Rule:
    kind: str
    table: str
    column: str
    parent: str = ""
    parent_column: str = ""
    accepted: tuple = ()


# The declared columns that may not be null.  ``source.`` names a raw table.
REQUIRED = {
    "int_club_performance_summary": ["club_id"],
    "int_competition_summary": ["competition_id"],
    "int_player_market_value_summary": ["player_id"],
    "int_player_performance_summary": ["player_id"],
    "int_player_profile": ["player_id"],
    "int_transfer_summary": ["player_id"],
    "time_spine_daily": ["date_day"],
    "dim_national_teams": ["national_team_id"],
    "fct_match": ["game_id"],
    "fct_player_match_performance": ["appearance_id"],
    "fct_player_rolling_form": ["appearance_id"],
    "fct_transfer_fixed_horizon_outcomes": ["transfer_key"],
    "fct_agent_portfolio": ["agent_name"],
    "fct_analytics_refresh_audit": ["audit_key"],
    "dim_players": ["player_id", "player_name_display", "position_display", "current_club_name_display", "has_current_profile"],
    "dim_clubs": ["club_id", "club_name_display", "has_club_name", "has_current_profile"],
    "dim_competitions": ["competition_id"],
    "dim_date": ["date_day", "date_key", "is_weekend", "is_today", "is_future_date"],
    "fct_club_performance": ["club_id"],
    "fct_competition_performance": ["competition_id"],
    "fct_player_performance": ["player_id", "has_current_market_value"],
    "fct_player_career_timeline": ["player_id", "season", "competition_id", "has_season_market_value"],
    "fct_market_value_history": ["player_id", "valuation_date", "has_club_context", "has_competition_context"],
    "fct_transfers": ["player_id", "transfer_date"],
    "fct_transfer_market_value_analysis": [
        "transfer_key", "player_id", "transfer_date", "has_known_transfer_fee", "has_transfer_record_market_value",
        "has_market_value_baseline", "has_fee_market_value_comparison", "has_prior_valuation", "has_next_valuation",
        "has_post_transfer_value_change"],
    "fct_transfer_success_labels": ["transfer_key", "label_horizon_days"],
    "fct_club_risk_profile": ["club_id"],
    "ml_player_market_value_training": [
        "training_row_key", "player_id", "season", "has_competition_context", "matches_before_target",
        "competitions_played_before_target", "minutes_before_target", "goals_before_target", "assists_before_target",
        "yellow_cards_before_target", "red_cards_before_target", "has_previous_market_value", "prior_valuation_count",
        "target_market_value_date", "target_market_value_eur"],
    "ml_player_market_value_scoring": [
        "scoring_row_key", "player_id", "season", "has_competition_context", "matches_before_target",
        "competitions_played_before_target", "minutes_before_target", "goals_before_target", "assists_before_target",
        "yellow_cards_before_target", "red_cards_before_target", "has_previous_market_value", "prior_valuation_count",
        "prediction_as_of_date"],
    "stg_players": ["player_id"],
    "source.players": ["player_id"],
    "source.clubs": ["club_id"],
    "source.appearances": ["appearance_id", "game_id", "player_id"],
    "source.games": ["game_id"],
    "source.transfers": ["player_id", "transfer_date"],
    "source.player_valuations": ["player_id", "date"],
    "source.competitions": ["competition_id"],
    "source.countries": ["country_id"],
    "source.club_games": ["game_id", "club_id"],
    "source.game_events": ["game_event_id"],
    "source.game_lineups": ["game_lineups_id"],
    "source.national_teams": ["national_team_id"],
}
# The declared unique columns.
DISTINCT = {
    "int_club_performance_summary": ["club_id"],
    "int_competition_summary": ["competition_id"],
    "int_player_market_value_summary": ["player_id"],
    "int_player_performance_summary": ["player_id"],
    "int_player_profile": ["player_id"],
    "int_transfer_summary": ["player_id"],
    "time_spine_daily": ["date_day"],
    "dim_national_teams": ["national_team_id"],
    "fct_match": ["game_id"],
    "fct_player_match_performance": ["appearance_id"],
    "fct_player_rolling_form": ["appearance_id"],
    "fct_transfer_fixed_horizon_outcomes": ["transfer_key"],
    "fct_agent_portfolio": ["agent_name"],
    "fct_analytics_refresh_audit": ["audit_key"],
    "dim_players": ["player_id"],
    "dim_clubs": ["club_id"],
    "dim_competitions": ["competition_id"],
    "dim_date": ["date_day", "date_key"],
    "fct_club_performance": ["club_id"],
    "fct_competition_performance": ["competition_id"],
    "fct_player_performance": ["player_id"],
    "fct_transfer_market_value_analysis": ["transfer_key"],
    "fct_transfer_success_labels": ["transfer_key"],
    "fct_club_risk_profile": ["club_id"],
    "ml_player_market_value_training": ["training_row_key"],
    "ml_player_market_value_scoring": ["scoring_row_key"],
    "stg_players": ["player_id"],
    "source.players": ["player_id"],
    "source.clubs": ["club_id"],
    "source.appearances": ["appearance_id"],
    "source.games": ["game_id"],
    "source.competitions": ["competition_id"],
    "source.countries": ["country_id"],
    "source.game_events": ["game_event_id"],
    "source.game_lineups": ["game_lineups_id"],
    "source.national_teams": ["national_team_id"],
}
# The declared references, as child table, child column, parent table, parent column.
REFERENCES = [
    ("dim_players", "current_club_id", "dim_clubs", "club_id"),
    ("dim_clubs", "domestic_competition_id", "dim_competitions", "competition_id"),
    ("fct_club_performance", "club_id", "dim_clubs", "club_id"),
    ("fct_competition_performance", "competition_id", "dim_competitions", "competition_id"),
    ("fct_player_performance", "player_id", "dim_players", "player_id"),
    ("fct_player_career_timeline", "player_id", "dim_players", "player_id"),
    ("fct_player_career_timeline", "competition_id", "dim_competitions", "competition_id"),
    ("fct_player_career_timeline", "season_market_value_date", "dim_date", "date_day"),
    ("fct_market_value_history", "player_id", "dim_players", "player_id"),
    ("fct_market_value_history", "valuation_date", "dim_date", "date_day"),
    ("fct_market_value_history", "current_club_id", "dim_clubs", "club_id"),
    ("fct_market_value_history", "competition_id", "dim_competitions", "competition_id"),
    ("fct_transfers", "player_id", "dim_players", "player_id"),
    ("fct_transfers", "transfer_date", "dim_date", "date_day"),
    ("fct_transfers", "from_club_id", "dim_clubs", "club_id"),
    ("fct_transfers", "to_club_id", "dim_clubs", "club_id"),
    ("fct_transfer_market_value_analysis", "player_id", "dim_players", "player_id"),
    ("fct_transfer_market_value_analysis", "transfer_date", "dim_date", "date_day"),
    ("fct_transfer_market_value_analysis", "from_club_id", "dim_clubs", "club_id"),
    ("fct_transfer_market_value_analysis", "to_club_id", "dim_clubs", "club_id"),
    ("fct_transfer_market_value_analysis", "prior_valuation_date", "dim_date", "date_day"),
    ("fct_transfer_market_value_analysis", "prior_valuation_club_id", "dim_clubs", "club_id"),
    ("fct_transfer_market_value_analysis", "prior_valuation_competition_id", "dim_competitions", "competition_id"),
    ("fct_transfer_market_value_analysis", "next_valuation_date", "dim_date", "date_day"),
    ("fct_transfer_market_value_analysis", "next_valuation_club_id", "dim_clubs", "club_id"),
    ("fct_transfer_market_value_analysis", "next_valuation_competition_id", "dim_competitions", "competition_id"),
    ("ml_player_market_value_training", "player_id", "dim_players", "player_id"),
    ("ml_player_market_value_training", "competition_id", "dim_competitions", "competition_id"),
    ("ml_player_market_value_training", "target_market_value_date", "dim_date", "date_day"),
    ("ml_player_market_value_scoring", "player_id", "dim_players", "player_id"),
    ("ml_player_market_value_scoring", "competition_id", "dim_competitions", "competition_id"),
    ("ml_player_market_value_scoring", "prediction_as_of_date", "dim_date", "date_day"),
    ("stg_appearances", "game_id", "stg_games", "game_id"),
    ("stg_games", "competition_id", "stg_competitions", "competition_id"),
    ("stg_club_games", "game_id", "stg_games", "game_id"),
    ("stg_player_valuations", "player_id", "stg_players", "player_id"),
    ("stg_transfers", "player_id", "stg_players", "player_id"),
]
# The declared lists of accepted values.
LISTS = {
    ("fct_match", "match_result"): ["home_win", "away_win", "draw"],
    ("fct_player_match_performance", "hosting"): ["home", "away", "unknown"],
    ("fct_player_match_performance", "club_result"): ["win", "draw", "loss", "unknown"],
    ("fct_transfer_cohort_performance", "analytical_reliability"): ["strong", "directional", "insufficient"],
    ("fct_data_coverage_bias", "coverage_bias_risk"): ["acceptable", "monitor", "high_bias_risk", "insufficient_sample"],
    ("dim_players", "player_record_type"): ["current_profile", "historical_reference"],
    ("dim_players", "player_profile_completeness_status"): ["complete", "partial", "limited"],
    ("dim_clubs", "club_record_type"): ["current_profile", "historical_reference"],
    ("dim_clubs", "club_profile_completeness_status"): ["complete", "partial", "limited"],
    ("fct_transfer_market_value_analysis", "fee_status"): ["unknown", "zero_fee", "paid"],
    ("fct_transfer_market_value_analysis", "market_value_baseline_source"): ["transfer_record", "latest_prior_valuation", "unavailable"],
    ("fct_transfer_market_value_analysis", "market_value_direction_after_transfer"): ["increase", "decrease", "unchanged", "unavailable"],
    ("fct_transfer_market_value_analysis", "valuation_context_change"):
        ["same_competition", "competition_change", "country_change", "unavailable"],
    ("fct_transfer_success_labels", "label_status"): ["observed"],
    ("fct_transfer_success_labels", "is_successful_transfer"): [0, 1],
    ("fct_club_risk_profile", "transfer_risk_category"): ["low_risk", "medium_risk", "high_risk", "insufficient_data"],
}


def declared(*kinds: str) -> list[Rule]:
    """The declared rules, of some kinds only if any are named."""
    rules = [Rule(NOT_NULL, t, c) for t, cs in REQUIRED.items() for c in cs]
    rules += [Rule(UNIQUE, t, c) for t, cs in DISTINCT.items() for c in cs]
    rules += [Rule(KEY, *r) for r in REFERENCES]
    rules += [Rule(ACCEPTED, t, c, accepted=tuple(v)) for (t, c), v in LISTS.items()]
    return [r for r in rules if not kinds or r.kind in kinds]


def violations(spark: SparkSession, frame_of: Callable[[str], DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """``kind``, ``table_name``, ``column_name`` and ``violations`` of every rule.

    Violations are rows for nulls and unexpected values, distinct values for repeated and missing keys.
    """
    rules = list(rules)
    parents = list(dict.fromkeys((r.parent, r.parent_column) for r in rules if r.kind == KEY))
    bits: dict[int, int] = {}  # rule -> its bit among the rules of one parent
    for i, r in enumerate(rules):
        if r.kind == KEY:
            bits[i] = sum((rules[j].parent, rules[j].parent_column) == (r.parent, r.parent_column) for j in bits)
    if max(bits.values(), default=0) > 62:
        raise ValueError("more than 63 references to one parent key: check them in two sets")

    def cell(domain: int, value=None, mask: int = 0, held: bool = False):
        value = F.lit(None).cast("string") if value is None else F.col(value).cast("string")
        return F.struct(F.lit(domain).alias("domain"), value.alias("value"), F.lit(mask).cast("bigint").alias("mask"), F.lit(held).alias("held"))

    cells: dict[str, list] = {}
    for i, r in enumerate(rules):
        c, mine = F.col(r.column), cells.setdefault(r.table, [])
        if r.kind == NOT_NULL:
            mine.append(F.when(c.isNull(), cell(i)))
        elif r.kind == ACCEPTED:
            mine.append(F.when(c.isNotNull() & ~c.isin(*r.accepted), cell(i)))
        elif r.kind == UNIQUE:
            mine.append(F.when(c.isNotNull(), cell(i, r.column)))
        else:
            domain = len(rules) + parents.index((r.parent, r.parent_column))
            mine.append(F.when(c.isNotNull(), cell(domain, r.column, 1 << bits[i])))
    for d, (table, column) in enumerate(parents):
        cells.setdefault(table, []).append(F.when(F.col(column).isNotNull(), cell(len(rules) + d, column, held=True)))

    single = [i for i, r in enumerate(rules) if r.kind in (NOT_NULL, ACCEPTED)]

    def own(table: str, cs: list) -> DataFrame:
        """Cells of one table that its own rules do not settle."""
        found = frame_of(table).select(F.explode(F.filter(F.array(*cs), lambda x: x.isNotNull())).alias("c")).select("c.*")
        joined = found.groupBy("domain", "value").agg(
            F.count("*").alias("n"), F.bit_or("mask").alias("mask"), F.max("held").alias("held"))
        return stored(joined.where((F.col("domain") >= len(rules)) | F.col("domain").isin(single) | (F.col("n") > 1)), "rule_cells")

    met = reduce(DataFrame.union, [own(t, cs) for t, cs in cells.items()]).groupBy("domain", "value").agg(
        F.sum("n").alias("n"), F.bit_or("mask").alias("mask"), F.max("held").alias("held"))
    broken = [F.when(F.col("domain").isin(single), F.struct(F.col("domain").alias("rule"), F.col("n").alias("amount")))] if single else []
    if any(r.kind == UNIQUE for r in rules):
        unique = [i for i, r in enumerate(rules) if r.kind == UNIQUE]
        broken.append(F.when(F.col("domain").isin(unique) & (F.col("n") > 1),
                             F.struct(F.col("domain").alias("rule"), F.lit(1).cast("bigint").alias("amount"))))
    for i, bit in bits.items():
        domain = len(rules) + parents.index((rules[i].parent, rules[i].parent_column))
        lost = (F.col("domain") == domain) & ~F.col("held") & (F.col("mask").bitwiseAND(F.lit(1 << bit)) != 0)
        broken.append(F.when(lost, F.struct(F.lit(i).alias("rule"), F.lit(1).cast("bigint").alias("amount"))))
    suspect = met.where((F.col("domain") < len(rules)) | ~F.col("held"))
    found = suspect.select(F.explode(F.filter(F.array(*broken), lambda x: x.isNotNull())).alias("b")).groupBy("b.rule").agg(
        F.sum("b.amount").alias("violations"))
    names = spark.createDataFrame([(i, r.kind, r.table, r.column) for i, r in enumerate(rules)],
                                  "rule int, kind string, table_name string, column_name string")
    return names.join(found, "rule", "left").select(
        "kind", "table_name", "column_name", F.coalesce("violations", F.lit(0)).alias("violations"))
