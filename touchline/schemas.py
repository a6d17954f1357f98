"""Raw source tables.  Types are inferred from use; no source declares them."""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

_COLUMNS = {
    "players": """player_id long, first_name string, last_name string, name string,
        last_season long, current_club_id long, country_of_birth string, city_of_birth string,
        country_of_citizenship string, date_of_birth date, sub_position string, position string,
        foot string, height_in_cm long, contract_expiration_date date, agent_name string,
        international_caps long, international_goals long, current_national_team_id long,
        current_club_domestic_competition_id string, current_club_name string,
        market_value_in_eur long, highest_market_value_in_eur long""",
    "clubs": """club_id long, club_code string, name string, domestic_competition_id string,
        total_market_value double, squad_size long, average_age double, foreigners_number long,
        foreigners_percentage double, national_team_players long, stadium_name string,
        stadium_seats long, net_transfer_record string, coach_name string, last_season long""",
    "competitions": """competition_id string, competition_code string, name string, sub_type string,
        type string, country_id long, country_name string, domestic_league_code string,
        confederation string, total_clubs long""",
    "countries": """country_id long, country_name string, country_code string,
        confederation string, total_clubs long, total_players long, average_age double""",
    "games": """game_id long, competition_id string, season long, round string, date date,
        home_club_id long, away_club_id long, home_club_goals long, away_club_goals long,
        home_club_position long, away_club_position long, home_club_manager_name string,
        away_club_manager_name string, stadium string, attendance long, referee string,
        home_club_formation string, away_club_formation string, home_club_name string,
        away_club_name string, aggregate string, competition_type string""",
    "club_games": """game_id long, club_id long, own_goals long, own_position long,
        own_manager_name string, opponent_id long, opponent_goals long,
        opponent_position long, opponent_manager_name string, hosting string, is_win long""",
    "appearances": """appearance_id string, game_id long, player_id long, player_club_id long,
        player_current_club_id long, date date, player_name string, competition_id string,
        yellow_cards long, red_cards long, goals long, assists long, minutes_played long""",
    "game_events": """game_event_id string, date date, game_id long, minute long, type string,
        club_id long, club_name string, player_id long, description string,
        player_in_id long, player_assist_id long""",
    "game_lineups": """game_lineups_id string, date date, game_id long, player_id long,
        club_id long, player_name string, type string, position string, number string,
        team_captain long""",
    "player_valuations": """player_id long, date date, market_value_in_eur long,
        current_club_name string, current_club_id long,
        player_club_domestic_competition_id string""",
    "transfers": """player_id long, transfer_date date, transfer_season string,
        from_club_id long, to_club_id long, from_club_name string, to_club_name string,
        transfer_fee decimal(38,9), market_value_in_eur decimal(38,9), player_name string""",
    "national_teams": """national_team_id long, name string, team_code string, country_id long,
        country_name string, country_code string, confederation string, squad_size long,
        average_age double, foreigners_number long, foreigners_percentage double,
        total_market_value double, coach_name string, fifa_ranking long, last_season long""",
}


_COLUMN = re.compile(r"(\w+) (\w+(?:\(\d+,\d+\))?)")


def _schema(columns: str) -> StructType:
    out = StructType()
    for name, kind in _COLUMN.findall(columns):
        out = out.add(name, kind)
    return out


RAW: dict[str, StructType] = {name: _schema(columns) for name, columns in _COLUMNS.items()}
RAW_TABLES = tuple(RAW)
