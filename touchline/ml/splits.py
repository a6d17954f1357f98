"""Chronological splits.  The list of seasons is bounded by the calendar."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def seasons_of(df: DataFrame) -> list[int]:
    return sorted(int(r[0]) for r in df.select("season").where(F.col("season").isNotNull()).distinct().collect())


def hold_out(df: DataFrame, n: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Training rows, the rows of the last ``n`` seasons, and those seasons."""
    years = seasons_of(df)
    if len(years) <= n:
        raise ValueError("not enough distinct seasons for the requested split")
    last = years[-n:]
    return df.where(~F.col("season").isin(last)), df.where(F.col("season").isin(last)), last


@dataclass(frozen=True)
class Chronology:
    """Seasons in their roles: develop, then tune, then calibrate, then test."""

    tuning: int
    calibration: int
    test: list[int]

    def development(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("season") < self.tuning)

    def tuning_rows(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("season") == self.tuning)

    def fit_rows(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("season") <= self.tuning)

    def calibration_rows(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("season") == self.calibration)

    def test_rows(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("season").isin(self.test))

    def train_rows(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("season") <= self.calibration)


def chronology(df: DataFrame, test_seasons: int = 2) -> Chronology:
    years = seasons_of(df)
    if len(years) <= test_seasons:
        raise ValueError("not enough distinct seasons for the requested split")
    before, test = years[:-test_seasons], years[-test_seasons:]
    if len(before) < 3:
        raise ValueError("at least three seasons are needed before the test seasons")
    return Chronology(before[-2], before[-1], test)


def rolling_origin(df: DataFrame, min_train_seasons: int = 4, test_seasons: list[int] | None = None) -> DataFrame:
    """Every row once per fold it belongs to, with ``fold`` and ``role``."""
    if isinstance(min_train_seasons, bool) or not isinstance(min_train_seasons, int) or min_train_seasons < 1:
        raise ValueError("min_train_seasons must be a positive integer")
    years = seasons_of(df)
    if len(years) <= min_train_seasons:
        raise ValueError("not enough distinct seasons for rolling-origin evaluation")
    eligible = years[min_train_seasons:]
    wanted = eligible if test_seasons is None else sorted(set(test_seasons))
    if not wanted or not set(wanted) <= set(eligible):
        raise ValueError("requested test seasons are not eligible")
    roles = [(fold, season, "test" if season == fold else "train")
             for fold in wanted for season in years if season <= fold]
    table = df.sparkSession.createDataFrame(roles, "fold long, season long, role string")
    # At most seasons squared rows: bounded by the calendar.
    return df.join(F.broadcast(table), "season")
