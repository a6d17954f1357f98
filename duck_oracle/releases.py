"""DuckDB statements of the row-level transfer audit, source profile and release checks."""

from duck_oracle.common import AS_OF, pct
from duck_oracle.queries import MIDWAY

_H = "fct_transfer_fixed_horizon_outcomes"


def row_level(day: str) -> str:
    """Transfers whose matured observation and label disagree at a capture date."""
    return f"""
    select *, case when transfer_key is null then 'null_transfer_key' when horizon_rows > 1 then 'duplicate_horizon_key'
            when label_rows > 1 then 'duplicate_label_key' when horizon_rows = 0 then 'label_without_horizon_key'
            when in_success_labels and not dax_observed and observed_horizon_rows > 0 and matured_horizon_rows = 0 then 'label_before_maturity_cutoff'
            when in_success_labels and not dax_observed then 'label_without_matured_observation'
            when dax_observed and not in_success_labels then 'matured_observation_without_label' else 'unexpected_inconsistency' end as discrepancy_reason
    from (select transfer_key, {day} as capture_date, latest as source_latest_valuation_date, cut as effective_cutoff_date,
              coalesce(n, 0) as horizon_rows, coalesce(n_seen, 0) as observed_horizon_rows, coalesce(n_mature, 0) as matured_horizon_rows,
              coalesce(n_both, 0) > 0 as dax_observed, coalesce(l_rows, 0) > 0 as in_success_labels, coalesce(l_rows, 0) as label_rows,
              first_transfer_date, last_transfer_date, first_target_365d_date, last_target_365d_date
          from (select transfer_key, count(*) as n, count(*) filter (has_365d_outcome) as n_seen,
                    count(*) filter (target_365d_date + 30 <= cut) as n_mature, count(*) filter (has_365d_outcome and target_365d_date + 30 <= cut) as n_both,
                    min(transfer_date) as first_transfer_date, max(transfer_date) as last_transfer_date,
                    min(target_365d_date) as first_target_365d_date, max(target_365d_date) as last_target_365d_date
                from {_H}, (select least({day}, max(source_latest_valuation_date)) as cut from {_H}) group by 1)
              full join (select transfer_key, count(*) as l_rows from fct_transfer_success_labels group by 1) using (transfer_key),
              (select max(source_latest_valuation_date) as latest, least({day}, max(source_latest_valuation_date)) as cut from {_H}))
    where dax_observed <> in_success_labels or horizon_rows <> 1 or label_rows > 1 or transfer_key is null"""


_PROFILE = f"""
    select * from
        (select count(*) as games, count(*) - count(distinct game_id) as duplicate_game_ids, min(game_date) as first_game_date,
             max(game_date) as last_game_date, count(*) filter (game_date is null) as games_without_date,
             count(*) filter (home_club_goals < 0 or away_club_goals < 0) as games_with_negative_score,
             count(*) filter (home_club_id = away_club_id) as games_with_one_club,
             count(*) filter (competition_id not in (select competition_id from published_competitions)) as games_without_competition from stg_games),
        (select sum(n)::bigint as valuations, count(*) filter (n > 1) as repeated_valuation_days, sum(n - 1)::bigint as extra_valuation_rows,
             count(*) filter (v > 1) as conflicting_valuation_days, min(valuation_date) as first_valuation_date, max(valuation_date) as last_valuation_date,
             coalesce(sum(n) filter (valuation_date is null), 0)::bigint as valuations_without_date, sum(bad)::bigint as nonpositive_valuations,
             sum(gone)::bigint as valuations_without_value
         from (select valuation_date, count(*) as n, count(distinct market_value_in_eur) as v, count(*) filter (market_value_in_eur <= 0) as bad,
                   count(*) filter (market_value_in_eur is null) as gone from stg_player_valuations group by player_id, valuation_date)),
        (select count(*) as transfers, min(transfer_date) as first_transfer_date, max(transfer_date) as last_transfer_date,
             count(*) filter (transfer_date is null) as transfers_without_date, count(*) filter (transfer_fee < 0) as transfers_with_negative_fee,
             count(*) filter (market_value_in_eur < 0) as transfers_with_negative_value, count(*) filter (transfer_date > {MIDWAY}) as future_transfers from stg_transfers),
        (select count(*) as appearances, count(*) filter (game_id not in (select game_id from stg_games)) as appearances_without_game,
             count(*) filter (player_id not in (select player_id from stg_players)) as appearances_without_player from stg_appearances),
        (select count(*) as players from stg_players), (select count(*) as clubs from stg_clubs),
        (select count(*) as competitions from published_competitions), (select 0::bigint as row_count_mismatches)"""

_ISSUES = [
    ("SOURCE_ROW_COUNT_MISMATCH", "critical", "row_count_mismatches"), ("DUPLICATE_GAME_ID", "critical", "duplicate_game_ids"),
    ("MISSING_APPEARANCE_GAME", "high", "appearances_without_game"), ("MISSING_APPEARANCE_PLAYER", "high", "appearances_without_player"),
    ("CONFLICTING_SAME_DAY_VALUATIONS", "high", "conflicting_valuation_days"),
    ("UNMAPPED_COMPETITION_CODES_IN_SOURCE", "medium", "games_without_competition"),
    ("FUTURE_DATED_SOURCE_TRANSFERS", "medium", "future_transfers"), ("NONPOSITIVE_SOURCE_VALUATIONS", "medium", "nonpositive_valuations"),
    ("MISSING_GAME_DATE", "high", "games_without_date"), ("INVALID_SCORES", "high", "games_with_negative_score"),
    ("SAME_HOME_AND_AWAY_CLUB", "high", "games_with_one_club"),
]


def _outside(c: str) -> str:
    return f"count(*) filter ({c} < 0 or {c} > 100)"


def _values(table: str, source: str, rules: dict[str, str]) -> str:
    return " union all ".join(f"select '{table}' as table_name, '{r}' as rule, ({x})::double as value from {source}" for r, x in rules.items())


_DOMAINS = _values("club_performance", "fct_club_performance", {
    "n": "count(*)", "unique_clubs": "count(distinct club_id)", "invalid_matches": "count(*) filter (matches_played <= 0 or matches_played is null)",
    "win_rate_mismatch": f"count(*) filter (abs(win_rate - {pct('wins', 'matches_played')}) > 0.11)", "invalid_win_rate": _outside("win_rate"),
    "min_win_rate": "min(win_rate)", "max_win_rate": "max(win_rate)"}) + " union all " + _values("club_risk", "fct_club_risk_profile", {
        "n": "count(*)", "unique_clubs": "count(distinct club_id)", "negative_transfers": "count(*) filter (total_incoming_transfers < 0)",
        "fee_coverage_outside_pct": _outside("known_fee_coverage_pct"), "outcome_coverage_outside_pct": _outside("outcome_365d_coverage_pct"),
        "success_outside_pct": _outside("transfer_success_rate_pct"),
        "outcome_exceeds_population": "count(*) filter (observed_365d_transfers > total_incoming_transfers)"})

_EXPORT = {
    "unexpected_capture_date": f"capture_date is distinct from {MIDWAY}", "invalid_cutoff": "effective_cutoff_date is null",
    "cutoff_after_capture": f"effective_cutoff_date > {MIDWAY}",
    "unknown_reason": "discrepancy_reason is null or discrepancy_reason = 'other'", "negative_count": "horizon_rows < 0 or label_rows < 0",
    "label_flag_mismatch": "in_success_labels <> (label_rows > 0)", "observed_without_horizon": "dax_observed and horizon_rows = 0",
    "label_only_misclassified": "discrepancy_reason in ('label_before_maturity_cutoff', 'label_without_matured_observation') and (not in_success_labels or dax_observed)",
    "observed_only_misclassified": "discrepancy_reason = 'matured_observation_without_label' and (not dax_observed or in_success_labels)",
    "missing_horizon_misclassified": "discrepancy_reason = 'label_without_horizon_key' and (horizon_rows <> 0 or label_rows = 0)",
    "duplicate_horizon_misclassified": "discrepancy_reason = 'duplicate_horizon_key' and horizon_rows <= 1",
    "duplicate_label_misclassified": "discrepancy_reason = 'duplicate_label_key' and label_rows <= 1",
    "key_marked_null": "discrepancy_reason = 'null_transfer_key' and trim(coalesce(transfer_key, '')) <> ''",
    "spurious_row": "dax_observed = in_success_labels and horizon_rows = 1 and label_rows <= 1 and trim(coalesce(transfer_key, '')) <> ''",
}

SQL = {
    "audit_transfer_365d_row_level": row_level(AS_OF),
    "source_profile": _PROFILE,
    "source_issues": " union all ".join(
        f"select '{code}' as code, '{severity}' as severity, {c}::bigint as affected from ({_PROFILE}) where {c} > 0" for code, severity, c in _ISSUES),
    "check_domains": _DOMAINS,
    "check_assessment": f"""
        select b::bigint as blocking_findings, 0 as warnings, 32.0 as latest_audit_age_days, case when b > 0 then 'FAIL' else 'PASS' end as status
        from (select sum(broken + (n < 1)::int + (n <> u)::int + (t = 'club_performance' and (lo is null or hi is null))::int) as b from (
            select table_name as t, max(value) filter (rule = 'n') as n, max(value) filter (rule = 'unique_clubs') as u,
                max(value) filter (rule = 'min_win_rate') as lo, max(value) filter (rule = 'max_win_rate') as hi,
                count(*) filter (rule not in ('n', 'unique_clubs', 'min_win_rate', 'max_win_rate') and value <> 0) as broken
            from ({_DOMAINS}) group by 1))""",
    "check_export": f"with e as ({row_level(MIDWAY)}) " + " union all ".join(
        f"select '{r}' as rule, count(*) filter ({c}) as violations from e" for r, c in _EXPORT.items()) + """
        union all select 'empty_export', (count(*) = 0)::bigint from e
        union all select 'inconsistent_cutoff', (count(distinct effective_cutoff_date) > 1)::bigint from e
        union all select 'duplicate_key', count(*) - count(distinct trim(coalesce(transfer_key, ''))) from e""",
}
