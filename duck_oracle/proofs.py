"""DuckDB statements of table proofs, audits and histories.

Each counts violations from the tables themselves, by a plainer route than the Spark side.
"""

from duck_oracle.common import AS_OF, div, exact_mean
from duck_oracle.queries import _tally
from touchline.quality import rule_set

_T = "fct_transfer_market_value_analysis"
_H = "fct_transfer_fixed_horizon_outcomes"
EARLY = "DATE '1997-06-30'"



def _rule(r) -> str:
    """Violations of one declared rule."""
    # The cleaned tables hold the rows of their sources.
    t, c = r.table.replace("source.", "stg_"), "valuation_date" if r.column == "date" else r.column
    if r.kind == "not_null":
        return f"select count(*) from {t} where {c} is null"
    if r.kind == "unique":
        return f"select count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1)"
    if r.kind == "foreign_key":
        return (f"select count(distinct {c}) from {t} where {c} is not null "
                f"and {c} not in (select {r.parent_column} from {r.parent} where {r.parent_column} is not null)")
    return f"select count(*) from {t} where {c} is not null and {c} not in ({', '.join(map(repr, r.accepted))})"


def declared_rules(audit: str) -> str:
    """All declared rules; ``audit`` is the statement of the audit rows."""
    return " union all ".join(
        f"select '{r.kind}' as kind, '{r.table}' as table_name, '{r.column}' as column_name, ({_rule(r)})::bigint as violations"
        for r in rule_set.declared()).replace("fct_analytics_refresh_audit where", f"({audit}) where")


def _apart(a: str, b: str) -> str:
    """Rows in one of two selections only."""
    return f"select count(*) from ((({a}) except ({b})) union all (({b}) except ({a})))"


def _unequal(a: str, b: str, keys: list[str], values: list[str]) -> str:
    """Keys that are missing on a side or differ in a value."""
    bad = " or ".join(f"x.{v} is distinct from y.{v}" for v in values)
    return (f"select count(*) from ({a}) x full join (select {', '.join(keys + values)} from {b}) y using ({', '.join(keys)}) where {bad}")


_TOTALS = """sum(goals) as total_goals, sum(assists) as total_assists, sum(minutes_played) as total_minutes_played,
    sum(yellow_cards) as total_yellow_cards, sum(red_cards) as total_red_cards"""
_TOTAL_NAMES = ["total_goals", "total_assists", "total_minutes_played", "total_yellow_cards", "total_red_cards"]

RECOMPUTED = {
    "int_club_performance_summary": _unequal(
        """select club_id, count(distinct game_id) as matches_played, sum(is_win) as wins, sum(own_goals) as goals_scored,
               sum(opponent_goals) as goals_conceded, sum(own_goals) - sum(opponent_goals) as goal_difference
           from stg_club_games group by 1""",
        "int_club_performance_summary", ["club_id"], ["matches_played", "wins", "goals_scored", "goals_conceded", "goal_difference"]),
    "int_competition_summary": _unequal(
        """select competition_id, count(distinct game_id) as matches_played, sum(home_club_goals + away_club_goals) as total_goals
           from stg_games group by 1""", "int_competition_summary", ["competition_id"], ["matches_played", "total_goals"]),
    "int_player_market_value_summary": _unequal(
        """select player_id, min(valuation_date) as first_valuation_date, max(valuation_date) as latest_valuation_date,
               max(market_value_in_eur) as highest_market_value
           from stg_player_valuations where market_value_in_eur is not null group by 1""",
        "int_player_market_value_summary", ["player_id"], ["first_valuation_date", "latest_valuation_date", "highest_market_value"]),
    "int_player_performance_summary": _unequal(
        f"select player_id, {_TOTALS} from stg_appearances group by 1", "int_player_performance_summary", ["player_id"], _TOTAL_NAMES),
    "int_player_season_performance": _unequal(
        f"""select player_id, season, a.competition_id, {_TOTALS} from stg_appearances a
            join (select game_id, season from stg_games) using (game_id) group by 1, 2, 3""",
        "int_player_season_performance", ["player_id", "season", "competition_id"], _TOTAL_NAMES),
    "int_transfer_summary": _unequal(
        """select player_id, count(*) as transfer_count, sum(transfer_fee) as total_transfer_fee,
               max(transfer_fee) as max_transfer_fee, max(transfer_date) as latest_transfer_date from stg_transfers group by 1""",
        "int_transfer_summary", ["player_id"], ["transfer_count", "total_transfer_fee", "max_transfer_fee", "latest_transfer_date"]),
    "fct_club_transfer_portfolio": f"""
        select count(*) from
            (select sum(transfer_fee) filter (to_club_id is not null) as a, count(to_club_id) as b,
                 sum(transfer_fee) filter (from_club_id is not null) as c, count(from_club_id) as d from {_T} where not is_future_transfer) x,
            (select sum(inbound_transfer_spend) as e, sum(inbound_transfers) as f, sum(outbound_transfer_income) as g,
                 sum(outbound_transfers) as h from fct_club_transfer_portfolio) y
        where a is distinct from e or b is distinct from f or c is distinct from g or d is distinct from h""",
}

_VALUES = "player_id, valuation_date, market_value_in_eur, current_club_id, current_club_name"
RECONCILED = {
    "dim_players": _apart("select player_id, player_name, birth_date from stg_players",
                          "select player_id, player_name, birth_date from dim_players where player_id in (select player_id from stg_players)"),
    "dim_clubs": _apart("select club_id, club_name, squad_size from stg_clubs",
                        "select club_id, club_name, squad_size from dim_clubs where club_id in (select club_id from stg_clubs)"),
    "dim_competitions": _apart("select competition_id, competition_name from stg_competitions", "select competition_id, competition_name from dim_competitions"),
    "fct_club_performance": _apart("select club_id, matches_played, wins from int_club_performance_summary", "select club_id, matches_played, wins from fct_club_performance"),
    "fct_competition_performance": _apart("select competition_id, matches_played from int_competition_summary", "select competition_id, matches_played from fct_competition_performance"),
    "fct_market_value_history": _apart(f"select {_VALUES} from stg_player_valuations", f"select {_VALUES} from fct_market_value_history"),
    "fct_player_career_timeline": _apart("select player_id, season, competition_id, total_goals from int_player_season_performance",
                                         "select player_id, season, competition_id, total_goals from fct_player_career_timeline"),
    "fct_player_performance": _apart("select player_id, total_goals, total_minutes_played from int_player_performance_summary",
                                     "select player_id, total_goals, total_minutes_played from fct_player_performance"),
    "fct_transfers": _apart("select player_id, transfer_date, from_club_id, to_club_id, transfer_fee from stg_transfers",
                            "select player_id, transfer_date, from_club_id, to_club_id, transfer_fee from fct_transfers"),
    "fct_transfer_market_value_analysis": _apart(
        "select player_id, transfer_date, transfer_fee, market_value_in_eur as v from stg_transfers",
        f"select player_id, transfer_date, transfer_fee, transfer_record_market_value as v from {_T}"),
    "ml_player_market_value_training": _apart(
        "select d.player_id || '-' || season as k from target_days d join value_events e on e.player_id = d.player_id and e.valuation_date = d.d and e.v = d.v",
        "select training_row_key as k from ml_player_market_value_training"),
}

_CLUBS = """select club_id from stg_clubs union select home_club_id from stg_games union select away_club_id from stg_games
    union select from_club_id from stg_transfers union select to_club_id from stg_transfers
    union select current_club_id from stg_player_valuations union select current_club_id from stg_players"""
_COUNTS = {
    "int_club_performance_summary": "select count(distinct club_id) from stg_club_games",
    "int_competition_summary": "select count(distinct competition_id) from stg_games",
    "int_player_market_value_summary": "select count(distinct player_id) from stg_player_valuations where market_value_in_eur is not null",
    "int_player_performance_summary": "select count(distinct player_id) from stg_appearances",
    "int_player_profile": "select count(*) from stg_players",
    "int_player_season_performance": "select count(*) from (select distinct player_id, season, a.competition_id from stg_appearances a join (select game_id, season from stg_games) using (game_id))",
    "int_transfer_summary": "select count(distinct player_id) from stg_transfers",
    "dim_players": "select count(*) from (select player_id from stg_players union select player_id from stg_appearances)",
    "dim_clubs": f"select count(club_id) from ({_CLUBS})",
    "dim_competitions": "select count(*) from stg_competitions",
    "dim_date": "select max(date_day) - min(date_day) + 1 from dim_date",
    "fct_club_performance": "select count(*) from int_club_performance_summary",
    "fct_competition_performance": "select count(*) from int_competition_summary",
    "fct_player_performance": "select count(*) from int_player_performance_summary",
    "fct_player_career_timeline": "select count(*) from int_player_season_performance",
    "fct_market_value_history": "select count(*) from stg_player_valuations",
    "fct_transfers": "select count(*) from stg_transfers",
    _T: "select count(*) from stg_transfers",
    "fct_match": "select count(*) from stg_games",
    "fct_player_match_performance": "select count(*) from stg_appearances",
    "fct_player_rolling_form": "select count(*) from stg_appearances",
    "fct_club_season_performance": f"select count(*) from (select distinct club_id, season, competition_id from stg_club_games join (select game_id, season, competition_id, game_date from stg_games) using (game_id) where game_date <= {AS_OF})",
    _H: f"select count(*) from {_T} where not is_future_transfer",
    "fct_transfer_success_labels": f"select count(*) from {_H} where has_365d_outcome",
    "fct_club_risk_profile": f"select count(distinct to_club_id) from {_H}",
}

LEAKAGE = {
    "features_precede_target": f"""select count(*) from ml_player_market_value_training where feature_last_appearance_date >= target_market_value_date
        or previous_market_value_date >= target_market_value_date or target_market_value_eur <= 0 or target_market_value_date > {AS_OF}""",
    "training_asof_integrity": """select count(*) from ml_player_market_value_training where target_market_value_eur is null
        or feature_last_appearance_date >= target_market_value_date or previous_market_value_date >= target_market_value_date
        or previous_market_value_eur < 0 or prior_valuation_count < 0 or has_previous_market_value <> (previous_market_value_eur is not null)
        or days_since_previous_market_value < 1""",
    "scoring_asof_integrity": """select count(*) from ml_player_market_value_scoring where prediction_as_of_date is null
        or feature_last_appearance_date > prediction_as_of_date or previous_market_value_date > prediction_as_of_date
        or previous_market_value_eur < 0 or prior_valuation_count < 0 or has_previous_market_value <> (previous_market_value_eur is not null)
        or days_since_previous_market_value < 0""",
    "scoring_not_future": f"""select count(*) from ml_player_market_value_scoring where feature_last_appearance_date > prediction_as_of_date
        or previous_market_value_date > prediction_as_of_date or prediction_as_of_date <> {AS_OF}""",
    "season_value_not_after_last_game": """
        select count(*) from int_player_season_performance s join
            (select player_id, season, a.competition_id, max(game_date) as d from stg_appearances a
             join (select game_id, season, game_date from stg_games) using (game_id) group by 1, 2, 3) l
            on l.player_id = s.player_id and l.season = s.season and l.competition_id = s.competition_id where season_market_value_date > d""",
}


def _population(name: str, table: str, key: str, day: str, bad: str, op: str) -> str:
    return f"""
    select '{name}' as population, count(*) as row_count, count(distinct {key}) as distinct_keys, count(distinct player_id) as distinct_players,
        min(season) as earliest_season, max(season) as latest_season, min({day}) as earliest_target_or_asof_date,
        max({day}) as latest_target_or_asof_date, {bad} as nonpositive_or_missing_targets,
        count(*) filter (feature_last_appearance_date {op} {day}) as invalid_appearance_timestamps,
        count(*) filter (previous_market_value_date {op} {day}) as invalid_prior_valuation_timestamps,
        count(*) filter (previous_market_value_eur < 0) as negative_prior_values,
        count(*) filter (previous_market_value_eur is null) as missing_prior_values,
        count(*) filter (prior_valuation_count < 0) as negative_valuation_counts from {table}"""


_AUDIT = """
    select 'run-{day}' as audit_key, 'spark' as target_name, (select count(*) from stg_games) as source_game_rows,
        (select count(*) from stg_appearances) as source_appearance_rows, (select count(*) from stg_transfers) as source_transfer_rows,
        (select count(*) from stg_player_valuations) as source_valuation_rows, (select count(*) from fct_match) as match_rows,
        (select count(*) from fct_player_match_performance) as player_match_rows,
        (select count(*) from fct_transfer_fixed_horizon_outcomes) as historical_transfer_rows,
        max(known_fee_coverage_pct) filter (o) as overall_known_fee_coverage_pct,
        max(fee_value_comparison_coverage_pct) filter (o) as overall_fee_value_comparison_coverage_pct,
        max(outcome_365d_coverage_pct) filter (o) as overall_365d_outcome_coverage_pct,
        count(*) filter (coverage_bias_risk = 'high_bias_risk') as high_bias_risk_segment_count,
        (select count(*) from fct_transfer_cohort_performance where not meets_minimum_sample_size) as insufficient_sample_cohort_count
    from (select *, segment_type = 'overall' and segment_value = 'all' as o from fct_data_coverage_bias)"""


def audits(compose, at) -> str:
    """Audit rows of both reporting dates."""
    final = compose(_AUDIT.replace("{day}", "2001-12-31"))
    early = at(EARLY, compose(_AUDIT.replace("{day}", "1997-06-30")))
    return f"select * from ({early}) union all select * from ({final})"


def volumes(both: str) -> str:
    watched = ["historical_transfer_rows", "match_rows", "player_match_rows", "source_transfer_rows"]
    moved = " union all ".join(
        f"select '{c}' as metric_name, max({c}) filter (audit_key = 'run-2001-12-31') as latest_value, max({c}) filter (audit_key = 'run-1997-06-30') as previous_value from a"
        for c in watched)
    return f"with a as ({both}) select * from ({moved}) where previous_value > 0 and abs(latest_value - previous_value) > 0.5 * previous_value"


_STATE = """
    select {n} as n, DATE '{day}' as day, player_id, current_club_id as club_id, current_club_name as club_name, market_value_in_eur
    from stg_player_valuations where valuation_date <= DATE '{day}'
    qualify row_number() over (partition by player_id order by valuation_date desc nulls last, market_value_in_eur desc nulls last,
        current_club_id desc nulls last, current_club_name desc nulls last) = 1"""
_STATES = " union all ".join(f"select * from ({_STATE.format(n=n, day=day)})" for n, day in enumerate(("1996-12-31", "1999-12-31", "2001-12-31")))
HISTORY = f"""
    select player_id, club_id, club_name, market_value_in_eur, day as valid_from,
        lead(day) over (partition by player_id order by n) as valid_to
    from (select *, lag(n) over w is null or lag(club_id) over w is distinct from club_id or lag(club_name) over w is distinct from club_name
              or lag(market_value_in_eur) over w is distinct from market_value_in_eur as starts
          from ({_STATES}) window w as (partition by player_id order by n))
    where starts"""

_DAYS = ("1996-12-31", "1999-12-31", "2001-12-31")


def _type2(key: str, checked: list[str], state: str) -> str:
    """Type-2 versions: a row a change between the states of consecutive days."""
    states = " union all ".join(f"select {n} as n, DATE '{day}' as day, * from ({state.replace('{day}', day)})" for n, day in enumerate(_DAYS))
    moved = " or ".join(f"lag({c}) over w is distinct from {c}" for c in checked)
    return f"""
        select {key}, {', '.join(checked)}, day as valid_from, lead(day) over (partition by {key} order by n) as valid_to
        from (select *, lag(n) over w is null or {moved} as starts from ({states}) window w as (partition by {key} order by n)) where starts"""


_PLAYER = """select p.player_id, player_name, v.current_club_id, position, sub_position, agent_name, v.market_value_in_eur, contract_expiration_date
    from (select * exclude (current_club_id, market_value_in_eur) from stg_players) p left join
        (select player_id, current_club_id, market_value_in_eur from stg_player_valuations where valuation_date <= DATE '{day}'
         qualify row_number() over (partition by player_id order by valuation_date desc nulls last, market_value_in_eur desc nulls last,
             current_club_id desc nulls last, current_club_name desc nulls last) = 1) v using (player_id)"""
_CLUB_STATE = """select c.club_id, club_name, domestic_competition_id, squad_size, average_age, g.coach_name, net_transfer_record
    from (select * exclude (coach_name) from stg_clubs) c left join
        (select club_id, own_manager_name as coach_name from stg_club_games join (select game_id, game_date from stg_games) using (game_id)
         where game_date <= DATE '{day}' qualify row_number() over (partition by club_id order by game_date desc, game_id desc) = 1) g using (club_id)"""

_NUMERIC = ["season", "height_in_cm", "age_at_target_date", "matches_before_target", "competitions_played_before_target",
            "minutes_before_target", "goals_before_target", "assists_before_target", "yellow_cards_before_target",
            "red_cards_before_target", "goals_per_90_before_target", "assists_per_90_before_target", "previous_market_value_eur",
            "days_since_previous_market_value", "prior_valuation_count", "prior_highest_market_value_eur"]


def _rules(table: str, rules: dict[str, str]) -> str:
    return " union all ".join(f"select '{n}' as rule, ({r})::bigint as violations from {table}" for n, r in rules.items())


def _frame_rules(table: str, key: str, target: bool, research: bool = False) -> str:
    keys = {"blank_keys": f"count(*) filter ({key} is null or trim({key}) = '')", "repeated_keys": f"count({key}) - count(distinct {key})"}
    bad = {"empty_frame": "case when count(*) = 0 then 1 else 0 end", **({} if research else keys),
           "missing_player": "count(*) filter (player_id is null)", "invalid_season": "count(*) filter (season is null or season <= 0)",
           "infinite_numeric": "count(*) filter (" + " or ".join(f"isinf({c}::double)" for c in _NUMERIC) + ")",
           ("invalid_prior_value" if research else "negative_prior_value"): "count(*) filter (previous_market_value_eur < 0)"}
    if target:
        bad["invalid_target"] = "count(*) filter (target_market_value_eur is null or target_market_value_eur <= 0)"
    return _rules(table, bad | keys)


SQL = {
    "audit_ml_feature_lineage": _population(
        "historical_training", "ml_player_market_value_training", "training_row_key", "target_market_value_date",
        "count(*) filter (target_market_value_eur is null or target_market_value_eur <= 0)", ">=") + " union all " + _population(
        "current_scoring", "ml_player_market_value_scoring", "scoring_row_key", "prediction_as_of_date", "null::bigint", ">"),
    "metrics_transfers_selected": f"""
        select player_id, count(distinct transfer_key) as selected_player_transfer_count, sum(transfer_fee) as selected_player_known_fee,
            {exact_mean('case when has_post_transfer_value_change then market_value_change_after_transfer_pct end')} / 100 as selected_player_post_transfer_change
        from {_T} group by 1""",
    "metrics_reference": f"""
        select 'observed_transfer_outcomes' as metric, sum(observed_outcome_count)::double as value from fct_transfer_cohort_performance
        union all select 'cohort_outcome_coverage', {div('sum(observed_outcome_count)', 'sum(transfer_count)')} from fct_transfer_cohort_performance
        union all select 'average_reliable_cohort_median_change', {exact_mean('case when meets_minimum_sample_size then median_market_value_change_pct end')} from fct_transfer_cohort_performance
        union all select 'segment_known_fee_coverage', {div('sum(known_fee_count)', 'sum(transfer_count)')} from fct_data_coverage_bias
        union all select 'net_transfer_spend', sum(net_transfer_spend)::double from fct_club_transfer_portfolio
        union all select 'reliable_club_success_rate', {exact_mean('case when meets_minimum_sample_size then transfer_success_rate_pct end')} from fct_club_risk_profile
        union all select 'rolling_5_goals_per_90', {exact_mean('rolling_5_goals_per_90', 4)} from fct_player_rolling_form""",
    "check_accepted_values": _tally({f"{r.table}.{r.column}": _rule(r) for r in rule_set.declared(rule_set.ACCEPTED)}),
    "check_foreign_keys": _tally({f"{r.table}.{r.column}": _rule(r) for r in rule_set.declared(rule_set.KEY)}),
    "check_recomputed": _tally(RECOMPUTED),
    "check_reconciled": _tally(RECONCILED),
    "check_leakage": _tally(LEAKAGE),
    "check_row_counts": " union all ".join(
        f"select '{n}' as model_name, ({q})::bigint as expected_rows, (select count(*) from {n}) as actual_rows" for n, q in _COUNTS.items()),
    "check_ml_coverage": f"""
        select 'training_has_rows' as validation_name, (select count(*) > 0 from ml_player_market_value_training) as passed
        union all select 'scoring_has_rows', (select count(*) > 0 from ml_player_market_value_scoring)
        union all select 'scoring_uses_latest_observed_season', (select min(season) = max(season) and max(season) =
            (select max(season) from stg_games where game_date <= {AS_OF}) from ml_player_market_value_scoring)""",
    "check_scoring_readiness": " union all ".join(
        f"select '{c}' as column_name, x as observed_rate, {m}::double as maximum_rate, x <= {m} as passed from (select {div(f'count(*) filter ({c} is null)', 'count(*)')} as x from ml_player_market_value_scoring)"
        for c, m in (("previous_market_value_eur", 0.35), ("competition_id", 0.35), ("age_at_target_date", 0.05))),
    "check_sequence": _tally({"transfer_sequence": f"""
        select count(*) from (select *, row_number() over w as r, count(*) over (partition by player_id) as n,
                coalesce(sum(transfer_fee) over w, 0) as running, count(transfer_fee) over (partition by player_id) as fees
            from {_T} window w as (partition by player_id order by transfer_sequence_number rows unbounded preceding))
        where r <> transfer_sequence_number or n <> player_transfer_count or fees <> known_fee_transfer_count
            or coalesce(cumulative_known_transfer_fee, 0) <> running or is_latest_transfer <> (r = n)"""}),
    "check_calendar": _tally({"calendar": "select case when max(date_day) - min(date_day) + 1 = count(distinct date_day) and count(*) = count(distinct date_day) then 0 else 1 end from dim_date"}),
    "profile_history": HISTORY,
    "player_profile_history": _type2("player_id", ["player_name", "current_club_id", "position", "sub_position", "agent_name",
                                                   "market_value_in_eur", "contract_expiration_date"], _PLAYER),
    "club_profile_history": _type2("club_id", ["club_name", "domestic_competition_id", "squad_size", "average_age", "coach_name",
                                               "net_transfer_record"], _CLUB_STATE),
    "check_history": _tally({"history": f"""
        select count(*) from (select player_id from ({HISTORY}) group by 1
            having count(*) filter (valid_to is null) <> 1 or count(*) filter (valid_to <= valid_from) > 0)"""}),
    "model_training_violations": _frame_rules("ml_player_market_value_training", "training_row_key", True),
    "model_scoring_violations": _frame_rules("ml_player_market_value_scoring", "scoring_row_key", False),
    "model_research_violations": _frame_rules("ml_player_market_value_training", "training_row_key", True, True),
}
