"""Named tables over one set of sources and one reporting date."""

from __future__ import annotations

from datetime import date
from typing import Callable, Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans import dims, features, governance, intermediate, match, staging, transfers
from touchline.session import stored
from touchline.sources import sinks

# Tables stored by year of a date column, and sorted within files.
YEARLY = {
    "fct_match": ("game_date", ["competition_id", "season", "home_club_id", "away_club_id"]),
    "fct_player_match_performance": ("appearance_date", ["player_id", "player_club_id", "competition_id"]),
    "fct_player_rolling_form": ("appearance_date", ["player_id", "competition_id", "player_club_id"]),
    "fct_transfer_market_value_analysis": ("transfer_date", ["player_id", "to_club_id", "from_club_id"]),
    "fct_transfer_fixed_horizon_outcomes": ("transfer_date", ["player_id", "to_club_id", "transfer_year"]),
    "fct_transfer_success_labels": ("transfer_date", ["to_club_id", "position", "transfer_year"]),
    "ml_player_market_value_training": ("target_market_value_date", ["season", "position", "competition_id"]),
}
SORTED = {
    "fct_club_risk_profile": ["transfer_risk_category", "club_id"],
    "fct_club_season_performance": ["season", "competition_id", "club_id"],
    "fct_club_transfer_portfolio": ["transfer_season", "club_id"],
    "fct_data_coverage_bias": ["segment_type", "segment_value"],
    "fct_transfer_cohort_performance": ["horizon_days", "cohort_type", "cohort_value"],
    "ml_player_market_value_scoring": ["position", "competition_id"],
}

# Tables that several others and most reports are built on.  The competitions are few, but their plan
# reads all games: only as files are they known to be small, so that wide rows need no shuffle by competition.
SHARED = frozenset({
    "stg_competitions", "stg_players", "stg_games", "stg_club_games", "stg_appearances", "stg_transfers", "stg_player_valuations", "dim_players", "dim_clubs",
    "fct_transfer_market_value_analysis", "fct_transfer_fixed_horizon_outcomes", "fct_player_match_performance",
    "int_player_season_performance",
})

# Shared tables that know the reporting date, and how a later date's table becomes an earlier one's.
REDATED: dict[str, Callable[[DataFrame, date], DataFrame]] = {
    "fct_transfer_market_value_analysis":
        lambda df, day: df.withColumn("is_future_transfer", F.col("transfer_date") > F.lit(day)),
    "fct_player_match_performance":
        lambda df, day: df.withColumn("is_future_appearance", F.col("appearance_date") > F.lit(day)),
    "fct_transfer_fixed_horizon_outcomes": transfers.outcomes_as_of,
}

_PREFIXES = ("stg_", "int_", "dim_", "fct_", "ml_", "time_spine_")


def _models() -> dict[str, Callable[["Warehouse"], DataFrame]]:
    found = {}
    for module in (staging, intermediate, dims, match, transfers, governance, features):
        for name, value in vars(module).items():
            if name.startswith(_PREFIXES) and callable(value):
                found[name] = value
    return found


MODELS = _models()


class Warehouse:
    """Memoised frames by name: ``wh["fct_match"]``.

    Nothing runs until an action, but for tables named in ``shared``: their first use writes
    them to the session's shared folder, and all plans of this warehouse start at the files.
    ``store(name)`` writes a table to ``location`` and serves later reads from there, which is
    how a fact used by several reports is shared between jobs.
    With ``later``, a warehouse of the same sources at a later date, shared tables are taken from there.
    """

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], as_of: date,
                 location: str | None = None, shared: Collection[str] = (), later: "Warehouse | None" = None):
        if later is not None and later.as_of < as_of:
            raise ValueError("tables can be taken from a later reporting date only")
        self.spark, self.raw, self.as_of, self.location, self.shared, self.later = spark, raw, as_of, location, shared, later
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in self.shared and self.later is not None:
                self._made[name] = self._redated(name, self.later[name])
            else:
                made = MODELS[name](self)
                self._made[name] = stored(made, name) if name in self.shared else made
        return self._made[name]

    def _redated(self, name: str, df: DataFrame) -> DataFrame:
        return REDATED[name](df, self.as_of) if name in REDATED else df

    def unstored(self, name: str) -> DataFrame:
        """The table for a use of few columns: its files where it has any, else its plan, and nothing is written."""
        if name in self._made:
            return self._made[name]
        if name in self.shared and self.later is not None:
            return self._redated(name, self.later.unstored(name))
        return MODELS[name](self)

    def step(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A step of a long plan, stored at its first use where tables are shared: the shuffles behind it go then."""
        if not self.shared:
            return build()
        if name not in self._made:
            self._made[name] = stored(build(), name)
        return self._made[name]

    def columns(self, name: str, *names: str) -> DataFrame:
        """Some columns of a table for several reads: from its files where it has any, else stored by themselves."""
        part = self.unstored(name).select(*names)
        filed = name in self._made or (self.later is not None and name in self.later._made)
        return part if filed or name not in self.shared else stored(part, name)

    def __contains__(self, name: str) -> bool:
        return name in MODELS

    def store(self, name: str) -> DataFrame:
        if not self.location:
            raise ValueError("this warehouse has no storage location")
        path = f"{self.location}/{name}"
        if name in YEARLY:
            day, order = YEARLY[name]
            sinks.write_by_year(self[name], path, day, order)
        else:
            sinks.overwrite(self[name], path, SORTED.get(name))
        self._made[name] = sinks.read_table(self.spark, path)
        return self._made[name]
