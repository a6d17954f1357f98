"""Per-entity summaries and dimensions."""

from duck_oracle.common import AS_OF, div, pct, per90, rnd, years

_VAL_DESC = ("market_value_in_eur desc nulls last, current_club_id desc nulls last, "
             "current_club_name desc nulls last, player_club_domestic_competition_id desc nulls last")
_VAL_ASC = ("market_value_in_eur nulls first, current_club_id nulls first, "
            "current_club_name nulls first, player_club_domestic_competition_id nulls first")


def _status(p: str) -> str:
    return f"case when {p} >= 90 then 'complete' when {p} >= 60 then 'partial' else 'limited' end"


def _known(*cols: str) -> str:
    return rnd("(" + " + ".join(f"({c} is not null)::int" for c in cols) + f")::double / {len(cols)} * 100")


PARTS = {
    "int_club_performance_summary": f"""
        select club_id, count(distinct game_id) as matches_played,
            count(*) filter (is_win = 1) as wins,
            count(*) filter (is_win = 0 and own_goals = opponent_goals) as draws,
            count(*) filter (is_win = 0 and own_goals <> opponent_goals) as losses,
            sum(own_goals)::bigint as goals_scored, sum(opponent_goals)::bigint as goals_conceded,
            (sum(own_goals) - sum(opponent_goals))::bigint as goal_difference,
            {pct('count(*) filter (is_win = 1)', 'count(distinct game_id)')} as win_rate,
            {rnd('avg(own_goals)')} as avg_goals_scored,
            {rnd('avg(opponent_goals)')} as avg_goals_conceded
        from stg_club_games group by club_id""",
    "int_competition_summary": f"""
        select g.competition_id, any_value(competition_name) as competition_name,
            any_value(c.competition_type) as competition_type, any_value(country_name) as country_name,
            any_value(confederation) as confederation, count(distinct game_id) as matches_played,
            sum(home_club_goals + away_club_goals)::bigint as total_goals,
            {rnd('avg(home_club_goals + away_club_goals)')} as avg_goals_per_match,
            any_value(n) as club_participation_count, {rnd('avg(attendance)')} as avg_attendance
        from stg_games g left join stg_competitions c using (competition_id)
        left join (
            select competition_id, count(distinct club_id) as n
            from (select competition_id, unnest([home_club_id, away_club_id]) as club_id from stg_games)
            group by 1) using (competition_id)
        group by g.competition_id""",
    "valued": f"""
        select *, row_number() over (partition by player_id order by valuation_date desc, {_VAL_DESC}) as newest,
            row_number() over (partition by player_id order by valuation_date, {_VAL_ASC}) as oldest
        from stg_player_valuations where market_value_in_eur is not null""",
    "int_player_market_value_summary": f"""
        select b.player_id, a.valuation_date as first_valuation_date,
            b.valuation_date as latest_valuation_date, a.market_value_in_eur as first_market_value,
            b.market_value_in_eur as current_market_value, top as highest_market_value,
            b.market_value_in_eur - a.market_value_in_eur as market_value_growth,
            {pct('b.market_value_in_eur - a.market_value_in_eur', 'a.market_value_in_eur')} as market_value_growth_pct,
            b.current_club_id as latest_club_id, b.current_club_name as latest_club_name
        from valued b join valued a on a.player_id = b.player_id and a.oldest = 1
        join (select player_id, max(market_value_in_eur) as top from valued group by 1) t
            on t.player_id = b.player_id
        where b.newest = 1""",
    "int_player_performance_summary": f"""
        select player_id, count(distinct game_id) as matches_played, sum(goals)::bigint as total_goals,
            sum(assists)::bigint as total_assists, sum(minutes_played)::bigint as total_minutes_played,
            sum(yellow_cards)::bigint as total_yellow_cards, sum(red_cards)::bigint as total_red_cards,
            {rnd('avg(minutes_played)')} as avg_minutes_per_match,
            {rnd(div('sum(goals)', 'count(distinct game_id)'))} as goals_per_match,
            {rnd(div('sum(assists)', 'count(distinct game_id)'))} as assists_per_match,
            {per90('sum(goals)', 'sum(minutes_played)')} as goals_per_90,
            {per90('sum(assists)', 'sum(minutes_played)')} as assists_per_90
        from stg_appearances group by player_id""",
    "move_totals": f"""
        select player_id, count(*) as transfer_count, sum(transfer_fee)::double as total_transfer_fee,
            {div('sum(transfer_fee)', 'count(transfer_fee)')} as avg_transfer_fee,
            max(transfer_fee)::double as max_transfer_fee
        from stg_moves group by player_id""",
    "last_moves": """
        select * from (
            select *, row_number() over (partition by player_id order by transfer_date desc,
                transfer_season desc, to_club_id desc nulls last, from_club_id desc nulls last,
                transfer_fee desc nulls last, market_value_in_eur desc nulls last,
                to_club_name desc nulls last, from_club_name desc nulls last) as n
            from stg_moves) where n = 1""",
    "int_transfer_summary": """
        select player_id, t.transfer_count, t.total_transfer_fee, t.avg_transfer_fee, t.max_transfer_fee,
            l.transfer_date as latest_transfer_date, l.transfer_season as latest_transfer_season,
            l.from_club_id as latest_from_club_id, l.to_club_id as latest_to_club_id,
            l.from_club_name as latest_from_club_name, l.to_club_name as latest_to_club_name,
            l.transfer_fee::double as latest_transfer_fee,
            l.market_value_in_eur::double as latest_transfer_market_value
        from move_totals t join last_moves l using (player_id)""",
    "int_player_profile": f"""
        select p.player_id, p.player_name, p.position, p.sub_position, p.preferred_foot,
            p.country_of_birth, p.country_of_citizenship, p.birth_date,
            {years(AS_OF, 'p.birth_date')} as age, p.height_in_cm, p.agent_name, p.current_club_id,
            p.current_club_name, p.international_caps, p.international_goals, p.market_value_in_eur,
            matches_played, total_goals, total_assists, total_minutes_played, goals_per_match,
            assists_per_match, goals_per_90, assists_per_90, first_market_value,
            current_market_value, highest_market_value, market_value_growth,
            market_value_growth_pct, transfer_count, total_transfer_fee, latest_transfer_fee
        from stg_players p left join int_player_performance_summary using (player_id)
        left join int_player_market_value_summary using (player_id)
        left join int_transfer_summary using (player_id)""",
    "season_totals": f"""
        select a.player_id, g.season, a.competition_id, count(distinct a.game_id) as matches_played,
            sum(goals)::bigint as total_goals, sum(assists)::bigint as total_assists,
            sum(minutes_played)::bigint as total_minutes_played,
            sum(yellow_cards)::bigint as total_yellow_cards, sum(red_cards)::bigint as total_red_cards,
            {rnd(div('sum(goals)', 'count(distinct a.game_id)'))} as goals_per_match,
            {rnd(div('sum(assists)', 'count(distinct a.game_id)'))} as assists_per_match,
            {per90('sum(goals)', 'sum(minutes_played)')} as goals_per_90,
            {per90('sum(assists)', 'sum(minutes_played)')} as assists_per_90,
            max(g.game_date) as last_game
        from stg_appearances a join stg_games g using (game_id) group by 1, 2, 3""",
    "day_values": f"""
        select * from (
            select *, row_number() over (partition by player_id, valuation_date order by {_VAL_DESC}) as n
            from stg_player_valuations where valuation_date is not null)
        where n = 1""",
    "int_player_season_performance": """
        select s.* exclude (last_game), v.market_value_in_eur as season_market_value,
            v.valuation_date as season_market_value_date
        from season_totals s asof left join
            (select player_id, valuation_date, market_value_in_eur from day_values
             where market_value_in_eur is not null) v
            on s.player_id = v.player_id and s.last_game >= v.valuation_date""",
    "club_sightings": """
        select home_club_id as club_id, home_club_name as club_name,
            home_club_manager_name as coach_name, season, game_date as d, 3 as w from stg_games
        union all select away_club_id, away_club_name, away_club_manager_name, season, game_date, 3 from stg_games
        union all select from_club_id, nullif(from_club_name, ''), null, year(transfer_date), transfer_date, 2 from stg_moves
        union all select to_club_id, nullif(to_club_name, ''), null, year(transfer_date), transfer_date, 2 from stg_moves
        union all select current_club_id, current_club_name, null, year(valuation_date), valuation_date, 1
            from stg_player_valuations where current_club_id is not null
        union all select current_club_id, current_club_name, null, last_season, DATE '9999-12-31', 4
            from stg_players where current_club_id is not null""",
    "past_clubs": """
        select club_id, max(season)::bigint as last_season,
            (array_agg(club_name order by d desc, w desc, club_name desc) filter (club_name is not null))[1] as club_name,
            (array_agg(coach_name order by d desc, w desc, coach_name desc) filter (coach_name is not null))[1] as coach_name
        from club_sightings where club_id not in (select club_id from stg_clubs) group by club_id""",
    "dim_clubs": f"""
        select *, coalesce(nullif(club_name, ''), 'Unknown Club #' || club_id) as club_name_display,
            club_name is not null as has_club_name,
            club_record_type = 'current_profile' as has_current_profile,
            {_status('club_profile_completeness_pct')} as club_profile_completeness_status
        from (
            select *, {_known('club_name', 'domestic_competition_id', 'squad_size', 'average_age',
                              'foreigners_number', 'national_team_players', 'stadium_name',
                              'stadium_seats', 'coach_name', 'last_season')} as club_profile_completeness_pct
            from (select *, 'current_profile' as club_record_type from stg_clubs
                  union all by name
                  select *, 'historical_reference' as club_record_type from past_clubs))""",
    "past_players": """
        select a.player_id, max(g.season) as last_season,
            (array_agg(player_name order by appearance_date desc, appearance_id desc) filter (player_name is not null))[1] as player_name,
            (array_agg(player_club_id order by appearance_date desc, appearance_id desc) filter (player_club_id is not null))[1] as current_club_id
        from stg_appearances a join stg_games g using (game_id)
        where a.player_id not in (select player_id from stg_players) group by 1""",
    "dim_players": f"""
        select *, coalesce(nullif(player_name, ''), 'Unknown Player #' || player_id) as player_name_display,
            coalesce(nullif(position, ''), 'Unknown Position') as position_display,
            coalesce(nullif(current_club_name, ''), 'Unknown Club') as current_club_name_display,
            player_record_type = 'current_profile' as has_current_profile,
            {_status('player_profile_completeness_pct')} as player_profile_completeness_status
        from (
            select *, {_known('player_name', 'position', 'sub_position', 'birth_date',
                              'country_of_citizenship', 'height_in_cm', 'preferred_foot',
                              'agent_name', 'current_club_id', 'current_club_name')} as player_profile_completeness_pct
            from (select player_id, player_name, position, sub_position, birth_date, country_of_birth,
                      country_of_citizenship, height_in_cm, preferred_foot, agent_name,
                      current_club_id, current_club_name, last_season,
                      'current_profile' as player_record_type
                  from stg_players
                  union all by name
                  select p.*, c.club_name as current_club_name, 'historical_reference' as player_record_type
                  from past_players p left join dim_clubs c on p.current_club_id = c.club_id))""",
    "dim_competitions": "select * from stg_competitions",
    "dim_national_teams": """
        select *, coalesce(nullif(national_team_name, ''), 'Unknown National Team #' || national_team_id) as national_team_name_display,
            national_team_name is not null as has_team_name,
            total_market_value is not null as has_total_market_value,
            fifa_ranking is not null as has_fifa_ranking
        from stg_national_teams""",
    "fact_days": """
        select game_date as d from stg_games union all select appearance_date from stg_appearances
        union all select transfer_date from stg_moves union all select valuation_date from stg_player_valuations""",
    "dim_date": f"""
        select d as date_day, strftime(d, '%Y%m%d')::bigint as date_key, year(d)::bigint as calendar_year,
            quarter(d)::bigint as calendar_quarter_number, 'Q' || quarter(d) as calendar_quarter_name,
            month(d)::bigint as calendar_month_number, strftime(d, '%B') as calendar_month_name,
            strftime(d, '%b') as calendar_month_short_name, strftime(d, '%Y-%m') as calendar_year_month,
            strftime(d, '%Y%m')::bigint as calendar_year_month_sort, isoyear(d)::bigint as iso_year,
            weekofyear(d)::bigint as iso_week_number, isodow(d)::bigint as iso_day_of_week_number,
            day(d)::bigint as calendar_day_of_month, strftime(d, '%A') as calendar_day_name,
            isodow(d) >= 6 as is_weekend, d = {AS_OF} as is_today, d > {AS_OF} as is_future_date
        from (select unnest(generate_series(lo, greatest(hi, {AS_OF}), interval 1 day))::date as d
              from (select min(d) as lo, max(d) as hi from fact_days))""",
    "time_spine_daily": """
        select unnest(generate_series(DATE '2000-01-01', DATE '2035-12-31', interval 1 day))::date as date_day""",
}
