"""Match, player, club and transfer facts."""

from duck_oracle.common import AS_OF, div, exact_mean, pct, per90, rnd, years


def _case(col: str, pairs: dict, default: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in pairs.items())
    return f"case {col} {whens} else {default} end"


_POSITIONS = {"Attack": "Forvet", "Defender": "Defans", "Goalkeeper": "Kaleci",
              "Midfield": "Orta Saha", "Missing": "Bilinmiyor"}

_JSON = " || ',' || ".join([
    "'\"player_id\":' || player_id",
    "'\"transfer_date\":\"' || strftime(transfer_date, '%Y-%m-%d') || '\"'",
    "'\"transfer_season\":\"' || transfer_season || '\"'",
    "'\"from_club_id\":' || from_club_id",
    "'\"to_club_id\":' || to_club_id",
    "'\"from_club_name\":' || coalesce('\"' || from_club_name || '\"', 'null')",
    "'\"to_club_name\":' || coalesce('\"' || to_club_name || '\"', 'null')",
    "'\"transfer_fee\":' || coalesce(case when transfer_fee = 0 then '0E-9' else transfer_fee || '.000000000' end, 'null')",
    "'\"market_value_in_eur\":' || coalesce(case when market_value_in_eur = 0 then '0E-9' else market_value_in_eur || '.000000000' end, 'null')",
    "'\"player_name\":' || coalesce('\"' || player_name || '\"', 'null')",
])


def _horizon(h: int) -> str:
    v, d = f"v{h}.market_value_in_eur", f"v{h}.valuation_date"
    return f"""
        t.transfer_date + {h} as target_{h}d_date, {d} as valuation_{h}d_date,
        {v} as market_value_{h}d, date_diff('day', t.transfer_date, {d}) as days_to_{h}d_valuation,
        ({v} - base)::double as market_value_change_{h}d,
        {pct(f'{v} - base', 'base')} as market_value_change_{h}d_pct,
        {d} is not null and base is not null as has_{h}d_outcome,
        case when base is null then 'missing_baseline' when {d} is not null then 'observed'
            when t.transfer_date + {h + 30} > least({AS_OF}, lim) then 'not_yet_observable'
            else 'missing_followup' end as outcome_{h}d_status"""


_ROLL = "over (partition by player_id order by appearance_date, game_id, appearance_id rows 4 preceding)"
_FORM = ("appearances", "minutes", "goals", "assists")

PARTS = {
    "fct_match": f"""
        select g.* exclude (competition_type), c.competition_name, c.competition_type,
            c.country_name as competition_country_name,
            home_club_goals + away_club_goals as total_goals,
            home_club_goals - away_club_goals as home_goal_difference,
            case sign(home_club_goals - away_club_goals) when 1 then 'home_win' when -1 then 'away_win' else 'draw' end as match_result,
            game_date > {AS_OF} as is_future_game, attendance is not null as has_attendance,
            (home_club_formation is null or away_club_formation is null) = false as has_both_formations,
            (home_club_manager_name is null or away_club_manager_name is null) = false as has_both_managers,
            (home_club_position is null or away_club_position is null) = false as has_both_table_positions
        from stg_games g left join dim_competitions c using (competition_id)""",
    "lineup_rows": """
        select game_id, player_id, club_id, bool_or(lineup_type = 'starting_lineup') as is_starter,
            bool_or(team_captain = 1) as is_captain,
            (array_agg(position order by game_lineups_id) filter (position is not null))[1] as lineup_position
        from stg_game_lineups group by 1, 2, 3""",
    "fct_player_match_performance": f"""
        select appearance_id, x.game_id, x.player_id, p.player_name, p.position, p.sub_position,
            x.player_club_id, c.club_name as player_club_name, x.competition_id, season, appearance_date,
            case side when 1 then 'home' when 2 then 'away' else 'unknown' end as hosting,
            case side when 1 then away_club_id when 2 then home_club_id end as opponent_club_id,
            case side when 1 then away_club_name when 2 then home_club_name end as opponent_club_name,
            case side when 1 then home_club_goals when 2 then away_club_goals end as club_goals,
            case side when 1 then away_club_goals when 2 then home_club_goals end as opponent_goals,
            case pts when 3 then 'win' when 1 then 'draw' when 0 then 'loss' else 'unknown' end as club_result,
            pts as club_points, minutes_played, goals, assists, yellow_cards, red_cards,
            {per90('goals', 'minutes_played', 4)} as goals_per_90,
            {per90('assists', 'minutes_played', 4)} as assists_per_90,
            coalesce(is_starter, false) as is_starter, coalesce(is_captain, false) as is_captain,
            lineup_position, l.player_id is not null as has_lineup_context,
            appearance_date > {AS_OF} as is_future_appearance
        from (
            select *, (case when side = 1 and home_club_goals > away_club_goals then 3
                when side = 2 and away_club_goals > home_club_goals then 3
                when home_club_goals = away_club_goals then 1 when side > 0 then 0 end)::bigint as pts
            from (select a.*, g.season, home_club_id, away_club_id, home_club_name, away_club_name,
                      home_club_goals, away_club_goals,
                      case when player_club_id = home_club_id then 1 when player_club_id = away_club_id then 2 end as side
                  from stg_appearances a join stg_games g using (game_id))) x
        left join lineup_rows l on l.game_id = x.game_id and l.player_id = x.player_id and l.club_id = x.player_club_id
        left join dim_players p on p.player_id = x.player_id
        left join dim_clubs c on c.club_id = x.player_club_id""",
    "fct_player_rolling_form": f"""
        select appearance_id, game_id, player_id, player_name, position, sub_position, player_club_id,
            player_club_name, competition_id, season, appearance_date, hosting, opponent_club_id,
            opponent_club_name, club_result, club_points, minutes_played, goals, assists, is_starter,
            is_captain, count(*) {_ROLL} as rolling_5_appearances,
            (sum(minutes_played) {_ROLL})::bigint as rolling_5_minutes,
            (sum(goals) {_ROLL})::bigint as rolling_5_goals,
            (sum(assists) {_ROLL})::bigint as rolling_5_assists,
            (sum(yellow_cards) {_ROLL})::bigint as rolling_5_yellow_cards,
            (sum(red_cards) {_ROLL})::bigint as rolling_5_red_cards,
            (sum(club_points) {_ROLL})::bigint as rolling_5_club_points,
            {per90(f'sum(goals) {_ROLL}', f'sum(minutes_played) {_ROLL}', 4)} as rolling_5_goals_per_90,
            {per90(f'sum(assists) {_ROLL}', f'sum(minutes_played) {_ROLL}', 4)} as rolling_5_assists_per_90,
            {rnd(f'avg(minutes_played) {_ROLL}')} as rolling_5_avg_minutes,
            (sum(is_starter::int) {_ROLL})::bigint as rolling_5_starts,
            (sum(is_captain::int) {_ROLL})::bigint as rolling_5_captain_appearances
        from fct_player_match_performance""",
    "fct_player_performance": """
        select s.player_id, player_name, position, sub_position, current_club_id, current_club_name,
            market_value_in_eur, market_value_in_eur is not null as has_current_market_value,
            s.* exclude (player_id)
        from int_player_performance_summary s left join stg_players p on p.player_id = s.player_id""",
    "fct_player_career_timeline": """
        select t.*, player_name, position, current_club_name,
            season_market_value is not null as has_season_market_value
        from int_player_season_performance t left join dim_players p using (player_id)""",
    "fct_club_performance": """
        select s.*, club_name, domestic_competition_id
        from int_club_performance_summary s left join dim_clubs c using (club_id)""",
    "fct_club_season_performance": f"""
        select cg.club_id, c.club_name, g.season, make_date(g.season, 7, 1) as season_start_date,
            g.competition_id, k.competition_name, count(distinct cg.game_id) as matches_played,
            count(*) filter (is_win = 1) as wins,
            count(*) filter (is_win = 0 and own_goals = opponent_goals) as draws,
            count(*) filter (is_win = 0 and own_goals <> opponent_goals) as losses,
            sum(own_goals)::bigint as goals_scored, sum(opponent_goals)::bigint as goals_conceded,
            sum(own_goals - opponent_goals)::bigint as goal_difference,
            (3 * count(*) filter (is_win = 1) + count(*) filter (is_win = 0 and own_goals = opponent_goals))::bigint as points,
            {pct('count(*) filter (is_win = 1)', 'count(*)')} as win_rate_pct,
            {rnd('avg(own_goals)')} as avg_goals_scored, {rnd('avg(opponent_goals)')} as avg_goals_conceded,
            {rnd('avg(attendance)')} as avg_attendance,
            count(*) filter (hosting = 'home') as home_matches, count(*) filter (hosting = 'away') as away_matches,
            count(distinct own_manager_name) as managers_used,
            count(distinct case when hosting = 'home' then home_club_formation else away_club_formation end) as formations_used,
            max(own_position) as highest_recorded_position, min(own_position) as lowest_recorded_position
        from stg_club_games cg join stg_games g using (game_id)
        left join dim_clubs c on c.club_id = cg.club_id
        left join dim_competitions k on k.competition_id = g.competition_id
        where g.game_date <= {AS_OF} group by 1, 2, 3, 4, 5, 6""",
    "fct_competition_performance": "select * from int_competition_summary",
    "fct_market_value_history": """
        select v.player_id, player_name, position, sub_position, valuation_date, market_value_in_eur,
            v.current_club_id, v.current_club_name, player_club_domestic_competition_id as competition_id,
            v.current_club_id is not null as has_club_context,
            player_club_domestic_competition_id is not null as has_competition_context
        from stg_player_valuations v left join dim_players p on p.player_id = v.player_id""",
    "fct_transfers": f"""
        select t.player_id, position, sub_position, t.player_name, transfer_date, transfer_season,
            from_club_id, to_club_id, from_club_name, to_club_name, transfer_fee::double as transfer_fee,
            market_value_in_eur::double as market_value_in_eur,
            (transfer_fee - market_value_in_eur)::double as fee_market_value_difference,
            {pct('transfer_fee - market_value_in_eur', 'market_value_in_eur')} as fee_market_value_difference_pct
        from stg_moves t left join dim_players p on p.player_id = t.player_id""",
    "keyed_moves": f"select *, md5('{{' || {_JSON} || '}}') as transfer_key from stg_moves",
    "ordered_moves": """
        select *, row_number() over w as seq, count(*) over p as n_player, count(transfer_fee) over p as n_fee,
            sum(transfer_fee) over (partition by player_id order by transfer_date, transfer_key rows unbounded preceding) as run_fee,
            lag(transfer_date) over w as prev_date, lead(transfer_date) over w as next_date
        from keyed_moves
        window w as (partition by player_id order by transfer_date, transfer_key), p as (partition by player_id)""",
    "move_context": """
        select t.*, coalesce(t.market_value_in_eur, b.market_value_in_eur) as base,
            case when t.market_value_in_eur is not null then t.transfer_date else b.valuation_date end as base_date,
            case when t.market_value_in_eur is not null then 'transfer_record'
                when b.market_value_in_eur is not null then 'latest_prior_valuation' else 'unavailable' end as base_source,
            b.valuation_date as b_date, b.market_value_in_eur as b_value, b.current_club_id as b_club,
            b.current_club_name as b_name, b.player_club_domestic_competition_id as b_comp,
            n.valuation_date as n_date, n.market_value_in_eur as n_value, n.current_club_id as n_club,
            n.current_club_name as n_name, n.player_club_domestic_competition_id as n_comp
        from ordered_moves t
        asof left join day_values b on b.player_id = t.player_id and t.transfer_date >= b.valuation_date
        asof left join day_values n on n.player_id = t.player_id and t.transfer_date < n.valuation_date""",
    "fct_transfer_market_value_analysis": f"""
        select transfer_key, t.player_id, coalesce(nullif(t.player_name, ''), p.player_name) as player_name,
            p.position, {_case('p.position', _POSITIONS, "coalesce(p.position, 'Bilinmiyor')")} as pozisyon_tr,
            p.sub_position, p.birth_date, p.country_of_citizenship,
            {years('transfer_date', 'p.birth_date')} as age_at_transfer, transfer_date,
            year(transfer_date)::bigint as transfer_year, month(transfer_date)::bigint as transfer_month,
            transfer_season, transfer_date > {AS_OF} as is_future_transfer,
            seq as transfer_sequence_number, n_player as player_transfer_count,
            n_fee as known_fee_transfer_count, seq = n_player as is_latest_transfer,
            prev_date as previous_transfer_date, date_diff('day', prev_date, transfer_date) as days_since_previous_transfer,
            next_date as next_transfer_date, date_diff('day', transfer_date, next_date) as days_to_next_transfer,
            from_club_id, coalesce(nullif(from_club_name, ''), cf.club_name) as from_club_name,
            to_club_id, coalesce(nullif(to_club_name, ''), ct.club_name) as to_club_name,
            transfer_fee::double as transfer_fee, run_fee::double as cumulative_known_transfer_fee,
            s.total_transfer_fee, s.avg_transfer_fee, s.max_transfer_fee,
            case when transfer_fee is null then 'unknown' when transfer_fee = 0 then 'zero_fee' else 'paid' end as fee_status,
            transfer_fee is not null as has_known_transfer_fee,
            t.market_value_in_eur::double as transfer_record_market_value,
            t.market_value_in_eur is not null as has_transfer_record_market_value,
            base_date as market_value_baseline_date, base::double as market_value_baseline,
            base_source as market_value_baseline_source, base is not null as has_market_value_baseline,
            transfer_fee is not null and base is not null as has_fee_market_value_comparison,
            date_diff('day', base_date, transfer_date) as days_since_market_value_baseline,
            (transfer_fee - base)::double as fee_market_value_difference,
            {pct('transfer_fee - base', 'base')} as fee_market_value_difference_pct,
            {rnd(div('transfer_fee', 'base'), 4)} as fee_to_market_value_ratio,
            b_date as prior_valuation_date, b_value as prior_market_value, b_club as prior_valuation_club_id,
            b_name as prior_valuation_club_name, b_comp as prior_valuation_competition_id,
            kb.competition_name as prior_competition_name, kb.country_name as prior_competition_country_name,
            kb.confederation as prior_competition_confederation, b_date is not null as has_prior_valuation,
            date_diff('day', b_date, transfer_date) as days_since_prior_valuation,
            n_date as next_valuation_date, n_value as next_market_value, n_club as next_valuation_club_id,
            n_name as next_valuation_club_name, n_comp as next_valuation_competition_id,
            kn.competition_name as next_competition_name, kn.country_name as next_competition_country_name,
            kn.confederation as next_competition_confederation, n_date is not null as has_next_valuation,
            date_diff('day', transfer_date, n_date) as days_to_next_valuation,
            (n_value - base)::double as market_value_change_after_transfer,
            {pct('n_value - base', 'base')} as market_value_change_after_transfer_pct,
            n_value - base is not null as has_post_transfer_value_change,
            case sign(n_value - base) when 1 then 'increase' when -1 then 'decrease' when 0 then 'unchanged' else 'unavailable' end as market_value_direction_after_transfer,
            case sign(n_value - base) when 1 then 'Arttı' when -1 then 'Düştü' when 0 then 'Değişmedi' else 'Belirsiz' end as yon_etiketi_tr,
            case when b_comp = n_comp then 'same_competition' when b_comp is null or n_comp is null then 'unavailable'
                when kb.country_name <> kn.country_name then 'country_change' else 'competition_change' end as valuation_context_change,
            m.first_valuation_date, m.latest_valuation_date, m.first_market_value, m.current_market_value,
            m.highest_market_value, m.market_value_growth as career_market_value_growth,
            m.market_value_growth_pct as career_market_value_growth_pct
        from move_context t
        left join dim_players p on p.player_id = t.player_id
        left join dim_clubs cf on cf.club_id = t.from_club_id
        left join dim_clubs ct on ct.club_id = t.to_club_id
        left join dim_competitions kb on kb.competition_id = b_comp
        left join dim_competitions kn on kn.competition_id = n_comp
        left join int_player_market_value_summary m on m.player_id = t.player_id
        left join int_transfer_summary s on s.player_id = t.player_id""",
    # Brute-force range joins: every valuation and appearance around a move.
    "near_values": """
        select transfer_key, h, v.valuation_date, v.market_value_in_eur
        from keyed_moves t, (values (90), (180), (365)) hs(h), day_values v
        where v.player_id = t.player_id and abs(date_diff('day', t.transfer_date + h, v.valuation_date)) <= 30
        qualify row_number() over (partition by transfer_key, h
            order by abs(date_diff('day', t.transfer_date + h, v.valuation_date)), v.valuation_date) = 1""",
    "near_form": """
        select transfer_key, count(*) filter (gap < 0) as pre_appearances,
            sum(minutes_played) filter (gap < 0) as pre_minutes, sum(goals) filter (gap < 0) as pre_goals,
            sum(assists) filter (gap < 0) as pre_assists, count(*) filter (gap >= 0) as post_appearances,
            sum(minutes_played) filter (gap >= 0) as post_minutes, sum(goals) filter (gap >= 0) as post_goals,
            sum(assists) filter (gap >= 0) as post_assists
        from (select transfer_key, date_diff('day', t.transfer_date, appearance_date) as gap, a.*
              from keyed_moves t join stg_appearances a on a.player_id = t.player_id)
        where gap between -180 and 180 group by 1""",
    "fct_transfer_fixed_horizon_outcomes": f"""
        select t.transfer_key, player_id, player_name, position, sub_position, age_at_transfer,
            case when age_at_transfer is null then 'unknown' when age_at_transfer <= 20 then 'under_21'
                when age_at_transfer <= 24 then '21_to_24' when age_at_transfer <= 28 then '25_to_28'
                when age_at_transfer <= 32 then '29_to_32' else '33_plus' end as age_band_at_transfer,
            transfer_date, transfer_year, transfer_season, from_club_id, from_club_name, to_club_id,
            to_club_name, transfer_fee, base as market_value_baseline, fee_market_value_difference,
            fee_market_value_difference_pct,
            case when fee_market_value_difference_pct > 20 then 'premium_20_plus'
                when fee_market_value_difference_pct >= -20 then 'within_20_pct'
                when fee_market_value_difference_pct < -20 then 'discount_20_plus' else 'unavailable' end as fee_premium_band,
            valuation_context_change, has_known_transfer_fee, has_fee_market_value_comparison,
            {_horizon(90)}, {_horizon(180)}, {_horizon(365)},
            {", ".join(f"coalesce({s}_{c}, 0)::bigint as {s}_180d_{c}" for s in ("pre", "post") for c in _FORM)},
            coalesce(pre_appearances, 0) > 0 as has_pre_180d_performance,
            coalesce(post_appearances, 0) > 0 as has_post_180d_performance,
            {", ".join(f"(coalesce(post_{c}, 0) - coalesce(pre_{c}, 0))::bigint as {c}_change_post_vs_pre_180d" for c in _FORM[1:])},
            lim as source_latest_valuation_date
        from (select *, market_value_baseline as base from fct_transfer_market_value_analysis where not is_future_transfer) t
        left join near_values v90 on v90.transfer_key = t.transfer_key and v90.h = 90
        left join near_values v180 on v180.transfer_key = t.transfer_key and v180.h = 180
        left join near_values v365 on v365.transfer_key = t.transfer_key and v365.h = 365
        left join near_form f on f.transfer_key = t.transfer_key,
        (select max(valuation_date) as lim from stg_player_valuations)""",
    "fct_transfer_success_labels": """
        select transfer_key, player_id, player_name, position, age_at_transfer, transfer_date, transfer_year,
            transfer_season, from_club_id, from_club_name, to_club_id, to_club_name, transfer_fee,
            has_known_transfer_fee, market_value_baseline, fee_market_value_difference_pct,
            365::bigint as label_horizon_days, valuation_365d_date as outcome_valuation_date,
            market_value_365d as outcome_market_value,
            market_value_change_365d_pct as market_value_change_at_horizon_pct,
            outcome_365d_status as label_status, 20::bigint as success_threshold_pct,
            coalesce((market_value_change_365d_pct >= 20)::bigint, 0) as is_successful_transfer
        from fct_transfer_fixed_horizon_outcomes where has_365d_outcome""",
    "value_events": """
        select player_id, valuation_date, max(market_value_in_eur) as v,
            case when count(distinct player_club_domestic_competition_id) = 1
                then max(player_club_domestic_competition_id) end as competition_id
        from stg_player_valuations where market_value_in_eur > 0 and valuation_date is not null
        group by 1, 2 having count(distinct market_value_in_eur) = 1""",
    "target_days": f"""
        select * from (
            select player_id, season, season_market_value_date as d,
                case when count(distinct season_market_value) = 1 then max(season_market_value) end as v
            from int_player_season_performance
            where season_market_value > 0 and season_market_value_date <= {AS_OF} group by 1, 2, 3)
        qualify row_number() over (partition by player_id, season order by d desc) = 1""",
    "season_games": "select a.*, g.season from stg_appearances a join stg_games g using (game_id)",
    "ml_player_market_value_training": f"""
        select t.player_id || '-' || t.season as training_row_key, t.player_id, p.player_name, t.season,
            e.competition_id, e.competition_id is not null as has_competition_context, p.position,
            p.sub_position, p.preferred_foot, p.height_in_cm, p.country_of_citizenship,
            k.competition_type, k.country_name as competition_country_name, k.confederation,
            case when {years('t.d', 'p.birth_date')} between 10 and 60 then {years('t.d', 'p.birth_date')} end as age_at_target_date,
            coalesce(f.n, 0) as matches_before_target, coalesce(f.nc, 0) as competitions_played_before_target,
            coalesce(f.mi, 0)::bigint as minutes_before_target, coalesce(f.go, 0)::bigint as goals_before_target,
            coalesce(f.ass, 0)::bigint as assists_before_target, coalesce(f.yc, 0)::bigint as yellow_cards_before_target,
            coalesce(f.rc, 0)::bigint as red_cards_before_target,
            {per90('f.go', 'f.mi', 4)} as goals_per_90_before_target,
            {per90('f.ass', 'f.mi', 4)} as assists_per_90_before_target,
            f.last_seen as feature_last_appearance_date, b.valuation_date as previous_market_value_date,
            b.v as previous_market_value_eur, b.v is not null as has_previous_market_value,
            date_diff('day', b.valuation_date, t.d) as days_since_previous_market_value,
            coalesce(h.n, 0) as prior_valuation_count, h.top as prior_highest_market_value_eur,
            t.d as target_market_value_date, t.v as target_market_value_eur
        from target_days t
        join value_events e on e.player_id = t.player_id and e.valuation_date = t.d and e.v = t.v
        asof left join value_events b on b.player_id = t.player_id and t.d > b.valuation_date
        left join (select t.player_id, t.season, count(*) as n, max(x.v) as top
                   from target_days t join value_events x on x.player_id = t.player_id and x.valuation_date < t.d
                   group by 1, 2) h on h.player_id = t.player_id and h.season = t.season
        left join (select t.player_id, t.season, count(distinct game_id) as n, count(distinct competition_id) as nc,
                       sum(minutes_played) as mi, sum(goals) as go, sum(assists) as ass, sum(yellow_cards) as yc,
                       sum(red_cards) as rc, max(appearance_date) as last_seen
                   from target_days t join season_games s on s.player_id = t.player_id and s.season = t.season
                       and s.appearance_date < t.d
                   group by 1, 2) f on f.player_id = t.player_id and f.season = t.season
        left join dim_players p on p.player_id = t.player_id
        left join dim_competitions k on k.competition_id = e.competition_id""",
    "ml_player_market_value_scoring": f"""
        select f.player_id::varchar as scoring_row_key, f.player_id, p.player_name, f.season,
            e.competition_id, e.competition_id is not null as has_competition_context, p.position,
            p.sub_position, p.preferred_foot, p.height_in_cm, p.country_of_citizenship,
            k.competition_type, k.country_name as competition_country_name, k.confederation,
            case when {years(AS_OF, 'p.birth_date')} between 10 and 60 then {years(AS_OF, 'p.birth_date')} end as age_at_target_date,
            f.n as matches_before_target, f.nc as competitions_played_before_target,
            f.mi::bigint as minutes_before_target, f.go::bigint as goals_before_target,
            f.ass::bigint as assists_before_target, f.yc::bigint as yellow_cards_before_target,
            f.rc::bigint as red_cards_before_target,
            {per90('f.go', 'f.mi', 4)} as goals_per_90_before_target,
            {per90('f.ass', 'f.mi', 4)} as assists_per_90_before_target,
            f.last_seen as feature_last_appearance_date, e.valuation_date as previous_market_value_date,
            e.v as previous_market_value_eur, e.v is not null as has_previous_market_value,
            date_diff('day', e.valuation_date, {AS_OF}) as days_since_previous_market_value,
            coalesce(h.n, 0) as prior_valuation_count, h.top as prior_highest_market_value_eur,
            {AS_OF} as prediction_as_of_date
        from (select player_id, max(season) as season, count(distinct game_id) as n,
                  count(distinct competition_id) as nc, sum(minutes_played) as mi, sum(goals) as go,
                  sum(assists) as ass, sum(yellow_cards) as yc, sum(red_cards) as rc,
                  max(appearance_date) as last_seen
              from season_games
              where season = (select max(season) from stg_games where game_date <= {AS_OF})
                  and appearance_date <= {AS_OF}
              group by 1) f
        left join (select player_id, count(*) as n, max(v) as top, max(valuation_date) as last_day
                   from value_events where valuation_date <= {AS_OF} group by 1) h on h.player_id = f.player_id
        left join value_events e on e.player_id = f.player_id and e.valuation_date = h.last_day
        left join dim_players p on p.player_id = f.player_id
        left join dim_competitions k on k.competition_id = e.competition_id""",
}
