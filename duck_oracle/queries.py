"""DuckDB statements of the registered analyses, metrics and checks."""

from duck_oracle.common import AS_OF, div, exact_mean, pct, rnd

MIDWAY = "DATE '2000-06-30'"
_T = "fct_transfer_market_value_analysis"
_H = "fct_transfer_fixed_horizon_outcomes"


def _capture(day: str) -> str:
    return f"""
    select cohort, segment, max(cut) as effective_cutoff_date, count(*) as fixed_horizon_rows,
        count(distinct transfer_key) as fixed_horizon_keys, count(*) filter (seen) as observed_anytime,
        count(distinct transfer_key) filter (lab) as success_label_rows,
        count(distinct transfer_key) filter (mature) as dax_eligible_transfer_rows,
        count(distinct transfer_key) filter (mature and seen) as dax_observed_transfer_rows,
        count(*) filter (lab and not mature) as label_rows_excluded_by_dax_maturity,
        count(*) filter (mature and seen and not lab) as matured_observed_missing_success_label,
        count(*) filter (lab and not seen) as unexpected_label_without_outcome,
        {pct('count(distinct transfer_key) filter (mature and seen)', 'count(distinct transfer_key) filter (mature)')} as dax_observed_coverage_pct,
        count(distinct transfer_key) filter (lab) - count(distinct transfer_key) filter (mature and seen) as observed_vs_label_row_difference
    from (
        select h.*, has_365d_outcome as seen, l.transfer_key is not null as lab,
            target_365d_date + 30 <= cut as mature, cut,
            unnest([{{'cohort': 'all', 'segment': 'overall'}},
                    {{'cohort': 'position', 'segment': coalesce(position, '<NULL_POSITION>')}}], recursive := true)
        from {_H} h left join (select distinct transfer_key from fct_transfer_success_labels) l using (transfer_key),
            (select least({day}, max(source_latest_valuation_date)) as cut from {_H}))
    group by 1, 2"""


_KEYS = "count(distinct transfer_key)"


def _tally(counts: dict[str, str]) -> str:
    return " union all ".join(f"select '{n}' as check_name, ({sql})::bigint as violations" for n, sql in counts.items())


def _dup(table: str, keys: str, n: int = 1) -> str:
    return f"select count(*) from (select 1 from {table} group by {keys} having count(*) <> {n})"


def _orphan(child: str, c: str, parent: str, p: str) -> str:
    return f"select count(distinct {c}) from {child} where {c} is not null and {c} not in (select {p} from {parent} where {p} is not null)"


SQL = {
    "agent_portfolio_benchmark": "select * from fct_agent_portfolio where player_count >= 5 and transfer_fee_coverage_pct >= 50",
    "data_coverage_release_gate": "select * from fct_data_coverage_bias where coverage_bias_risk in ('high_bias_risk', 'insufficient_sample')",
    "manager_formation_benchmark": f"""
        select season, competition_id, home_club_manager_name as manager_name, home_club_formation as formation,
            count(*) as home_matches, {pct("count(*) filter (match_result = 'home_win')", 'count(*)')} as home_win_rate_pct,
            {rnd('avg(home_club_goals)')} as avg_home_goals, {rnd('avg(away_club_goals)')} as avg_goals_conceded,
            {rnd('avg(attendance)')} as avg_attendance
        from fct_match where not is_future_game and home_club_manager_name is not null and home_club_formation is not null
        group by 1, 2, 3, 4 having count(*) >= 10""",
    "transfer_cohort_decision_report": """
        select horizon_days, cohort_type, cohort_value, transfer_count, observed_outcome_count, outcome_coverage_pct,
            median_market_value_change_pct, avg_market_value_change_pct, avg_change_ci95_lower_pct,
            avg_change_ci95_upper_pct, positive_outcome_rate_pct, analytical_reliability
        from fct_transfer_cohort_performance where meets_minimum_sample_size and cohort_type <> 'overall'""",
    "transfer_observational_matched_comparison": f"""
        select *, {rnd('b_mean - a_mean')} as observational_difference_pct
        from (
            select transfer_year, position, age_band_at_transfer, fee_premium_band, a_n as same_competition_observed_transfers,
                b_n as country_change_observed_transfers, {rnd('a_mean')} as same_competition_avg_change_365d_pct,
                {rnd('b_mean')} as country_change_avg_change_365d_pct, a_mean, b_mean
            from (
                select transfer_year, position, age_band_at_transfer, fee_premium_band,
                    count(*) filter (has_365d_outcome and valuation_context_change = 'same_competition') as a_n,
                    count(*) filter (has_365d_outcome and valuation_context_change = 'country_change') as b_n,
                    {exact_mean("case when has_365d_outcome and valuation_context_change = 'same_competition' then market_value_change_365d_pct end")} as a_mean,
                    {exact_mean("case when has_365d_outcome and valuation_context_change = 'country_change' then market_value_change_365d_pct end")} as b_mean
                from {_H} group by 1, 2, 3, 4)
            where a_n >= 30 and b_n >= 30 and position is not null)""".replace("select *, round", "select * exclude (a_mean, b_mean), round"),
    "audit_ml_valuation_event_grain": """
        select (select count(*) from stg_player_valuations) as raw_valuation_rows, g.*, t.*
        from (select count(*) as player_date_valuation_groups, count(*) filter (n > 1) as multirow_player_dates,
                  count(*) filter (n_good > 1 and n_val = 1) as duplicated_consistent_positive_days,
                  count(*) filter (n_val > 1) as conflicting_positive_value_days,
                  count(*) filter (n_val = 1 and n_comp > 1) as conflicting_competition_only_days
              from (select count(*) as n, count(*) filter (market_value_in_eur > 0) as n_good,
                        count(distinct market_value_in_eur) filter (market_value_in_eur > 0) as n_val,
                        count(distinct player_club_domestic_competition_id) filter (market_value_in_eur > 0) as n_comp
                    from stg_player_valuations group by player_id, valuation_date)) g,
             (select count(*) as candidate_player_season_targets, count(*) filter (d.v is null) as conflicted_latest_player_season_targets,
                  count(*) filter (e.v = d.v) as matched_unambiguous_targets,
                  count(*) filter (coalesce(e.v = d.v, false) = false) as excluded_ambiguous_or_unmatched_targets
              from target_days d left join value_events e on e.player_id = d.player_id and e.valuation_date = d.d) t""",
    "audit_transfer_365d_capture": _capture(AS_OF),
    "audit_transfer_365d_capture_midway": _capture(MIDWAY),
    "metrics_governed_transfers": f"""
        select position, age_band_at_transfer, count(*) as transfers,
            count(*) filter (has_365d_outcome) as observed_365d_transfers,
            {div('count(*) filter (has_365d_outcome)', 'count(*)')} as transfer_365d_outcome_coverage,
            {exact_mean('market_value_change_365d_pct')} as average_365d_market_value_change_pct,
            {exact_mean('fee_market_value_difference_pct')} as average_transfer_fee_premium_pct
        from {_H} group by 1, 2""",
    "metrics_governed_clubs": """
        select season, sum(matches_played)::bigint as club_matches, sum(points)::bigint as club_points
        from fct_club_season_performance group by 1""",
    "metrics_transfers_by_year": f"""
        select transfer_year, {_KEYS} as transfer_count, {_KEYS} filter (has_known_transfer_fee) as known_fee_transfer_count,
            coalesce({div(f'{_KEYS} filter (has_known_transfer_fee)', _KEYS)}, 0) as known_fee_coverage,
            {div('sum(transfer_fee)', 'count(transfer_fee)')} as average_known_transfer_fee,
            sum(transfer_fee) as total_known_transfer_fee, max(transfer_fee) as max_known_transfer_fee,
            {_KEYS} filter (has_fee_market_value_comparison) as comparable_transfer_count,
            {div(f'{_KEYS} filter (has_fee_market_value_comparison)', _KEYS)} as comparison_coverage,
            {exact_mean('case when has_fee_market_value_comparison then fee_market_value_difference_pct end')} / 100 as average_fee_premium,
            {_KEYS} filter (has_post_transfer_value_change) as post_transfer_outcome_count,
            coalesce({div(f'{_KEYS} filter (has_post_transfer_value_change)', _KEYS)}, 0) as post_transfer_outcome_coverage,
            {exact_mean('case when has_post_transfer_value_change then market_value_change_after_transfer_pct end')} / 100 as average_post_transfer_value_change,
            coalesce({div(f"{_KEYS} filter (market_value_direction_after_transfer = 'increase')", f'{_KEYS} filter (has_post_transfer_value_change)')}, 0) as value_increase_rate,
            {_KEYS} filter (fee_market_value_difference_pct > 30) as high_premium_transfer_count,
            {div('sum(transfer_fee)', 'sum(market_value_baseline)')} as transfer_value_index
        from {_T} group by 1""",
    "metrics_fee_year_over_year": f"""
        with y as (select transfer_year, {div('sum(transfer_fee)', 'count(transfer_fee)')} as f from {_T} group by 1)
        select a.transfer_year, a.f as average_known_transfer_fee, b.f as previous_year_fee, (a.f - b.f) / b.f as fee_change
        from y a left join y b on b.transfer_year = a.transfer_year - 1""",
    "metrics_performance": f"""
        select position, sum(total_goals)::bigint as total_goals, sum(total_assists)::bigint as total_assists,
            sum(total_minutes_played)::bigint as total_minutes, count(distinct player_id) as total_players,
            {div('sum(total_goals) + sum(total_assists)', 'sum(total_minutes_played)')} * 90 as player_goals_assists_per_90,
            {exact_mean('coalesce(goals_per_90, 0) + coalesce(assists_per_90, 0)')} as average_goals_assists_per_90,
            {exact_mean('avg_minutes_per_match')} as average_minutes
        from fct_player_performance group by 1""",
    "metrics_labels": f"""
        select position, {_KEYS} as labelled_transfers_365d, {div('sum(transfer_fee)', 'count(transfer_fee)')} as average_transfer_fee_365d,
            avg(is_successful_transfer) as transfer_success_rate_365d
        from fct_transfer_success_labels group by 1""",
    "metrics_outcome_status": f"""
        select outcome_365d_status, case outcome_365d_status when 'missing_baseline' then 'No baseline'
            when 'missing_followup' then 'No follow-up' when 'not_yet_observable' then 'Too early'
            when 'observed' then 'Observed' end as follow_up_label, {_KEYS} as transfers
        from {_H} group by 1, 2""",
    "metrics_matured_outcomes": f"""
        select *, {div('observed_transfers_365d', 'eligible_transfers_365d')} as outcome_coverage_365d,
            case when eligible_transfers_365d = 0 then 'NO MATURED COHORT' when observed_transfers_365d < 30 then 'SMALL OBSERVED SAMPLE'
                when observed_transfers_365d < 0.8 * eligible_transfers_365d then 'LOW FOLLOW-UP COVERAGE' else 'OBSERVATIONAL ONLY' end as reliability_notice_365d
        from (select transfer_year, {_KEYS} filter (target_365d_date + 30 <= least({AS_OF}, source_latest_valuation_date)) as eligible_transfers_365d,
                  {_KEYS} filter (has_365d_outcome and target_365d_date + 30 <= least({AS_OF}, source_latest_valuation_date)) as observed_transfers_365d
              from {_H} group by 1)""",
    "metrics_median_change": f"select position, quantile_cont(market_value_change_365d_pct, 0.5) as median_change_365d_pct from {_H} where has_365d_outcome group by 1",
    "report_age_groups": f"""
        select case when a < 22 then '18-21' when a < 26 then '22-25' when a < 30 then '26-29' when a < 34 then '30-33' else '34+' end as age_group,
            count(distinct player_id) as total_players
        from (select player_id, coalesce(year({AS_OF}) - year(birth_date), 0) as a from dim_players) group by 1""",
    "report_fee_ranges": f"""
        select case when transfer_fee >= 50000000 then 'Mega Transfer (≥50M€)' when transfer_fee >= 20000000 then 'Büyük Transfer (20-50M€)'
            when transfer_fee >= 5000000 then 'Orta Transfer (5-20M€)' when transfer_fee > 0 then 'Küçük Transfer (<5M€)'
            when transfer_fee is null then 'Ücretsiz/Bilinmiyor' else 'Veri Yok' end as fee_range_category_tr, {_KEYS} as transfers
        from {_T} group by 1""",
    "report_competition_labels": """
        select competition_id, case competition_id when 'IT1' then 'Serie A (IT)' when 'ES1' then 'La Liga (ES)' when 'GB1' then 'Premier L. (ENG)'
                else substr(replace(competition_name, '-', ' '), 1, 18) || ' (' || competition_id || ')' end as competition_short_label,
            matches_played from int_competition_summary""",
    "check_grains": _tally({
        "stg_appearances": _dup("stg_appearances", "player_id, game_id"),
        "fct_market_value_history": _dup("stg_player_valuations", "player_id, valuation_date"),
        "fct_player_career_timeline": _dup("int_player_season_performance", "player_id, season, competition_id"),
        "int_player_season_performance": _dup("int_player_season_performance", "player_id, season, competition_id"),
        "fct_match": _dup("fct_match", "game_id"),
        "fct_player_match_performance": _dup("fct_player_match_performance", "appearance_id"),
        "fct_player_rolling_form": _dup("fct_player_match_performance", "appearance_id"),
        "fct_club_season_performance": _dup("fct_club_season_performance", "club_id, season, competition_id"),
        "fct_club_transfer_portfolio": _dup("fct_club_transfer_portfolio", "club_id, transfer_season"),
        "fct_transfer_fixed_horizon_outcomes": _dup(_H, "transfer_key"),
        "fct_transfer_cohort_performance": _dup("fct_transfer_cohort_performance", "horizon_days, cohort_type, cohort_value"),
        "fct_data_coverage_bias": _dup("fct_data_coverage_bias", "segment_type, segment_value"),
        "fct_transfer_success_labels": _dup("fct_transfer_success_labels", "transfer_key"),
        "fct_club_risk_profile": _dup("fct_club_risk_profile", "club_id"),
        "stg_club_games": _dup("stg_club_games", "game_id", 2),
    }),
    "check_nulls": " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as violations from {t}"
        for t, cs in {
            "stg_games": ["game_id", "competition_id", "season", "game_date"],
            "stg_appearances": ["appearance_id", "game_id", "player_id", "player_current_club_id", "player_name"],
            "stg_transfers": ["player_id", "transfer_date", "transfer_fee", "market_value_in_eur"],
            "stg_player_valuations": ["player_id", "valuation_date", "market_value_in_eur", "current_club_id"]}.items() for c in cs),
    "model_rolling_folds": """
        select f.fold::bigint as fold, case when season = f.fold then 'test' else 'train' end as role, season,
            count(*) as row_count, count(distinct player_id) as players
        from ml_player_market_value_training t,
            (select season as fold, row_number() over (order by season) as n from (select distinct season from ml_player_market_value_training)) f
        where f.n > 4 and t.season <= f.fold group by 1, 2, 3""",
    "model_conformal_radius": """
        select n, gap as radius from (
            select count(*) over () as n, row_number() over (order by gap) as r, gap
            from (select abs(target_market_value_eur - coalesce(previous_market_value_eur::double, m)) as gap
                  from ml_player_market_value_training, (select quantile_cont(target_market_value_eur, 0.5) as m
                      from ml_player_market_value_training where season <= 1998)
                  where season = 1999))
        where r = ceil((n + 1) * (1 - 0.1))""",
    "scan_training_features": """
        select training_row_key, season, height_in_cm, age_at_target_date, matches_before_target,
            competitions_played_before_target, minutes_before_target, goals_before_target, assists_before_target,
            yellow_cards_before_target, red_cards_before_target, goals_per_90_before_target,
            assists_per_90_before_target, previous_market_value_eur, days_since_previous_market_value,
            prior_valuation_count, prior_highest_market_value_eur, target_market_value_eur
        from ml_player_market_value_training where season >= 1998 and has_previous_market_value""",
}
