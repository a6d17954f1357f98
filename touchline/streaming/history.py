"""Type-2 history on plain files: changed, new and vanished keys."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.streaming.incremental import existing

FROM, TO, VERSION = "valid_from", "valid_to", "_version"


@dataclass(frozen=True)
class HistorySpec:
    source: str
    key: str
    checked: tuple[str, ...]


PLAYER_PROFILES = HistorySpec("stg_players", "player_id", (
    "player_name", "current_club_id", "position", "sub_position", "agent_name",
    "market_value_in_eur", "contract_expiration_date"))
CLUB_PROFILES = HistorySpec("stg_clubs", "club_id", (
    "club_name", "domestic_competition_id", "squad_size", "average_age", "coach_name",
    "net_transfer_record"))


def first_history(current: DataFrame, spec: HistorySpec, at: datetime) -> DataFrame:
    return current.select(
        spec.key, *spec.checked, F.lit(at).cast("timestamp").alias(FROM),
        F.lit(None).cast("timestamp").alias(TO))


def next_history(history: DataFrame, current: DataFrame, spec: HistorySpec, at: datetime) -> DataFrame:
    """History after comparing its open rows with the current profile.

    One full outer join; each key yields up to two rows: the old version
    (kept or closed) and the new one.
    """
    now = F.lit(at).cast("timestamp")
    key, checked = spec.key, list(spec.checked)
    open_rows = history.where(F.col(TO).isNull()).select(
        key, F.struct(*checked).alias("old"), F.col(FROM).alias("since"))
    fresh = current.select(key, F.struct(*checked).alias("new"))
    both = open_rows.join(fresh, key, "full_outer")
    same = F.col("since").isNotNull() & F.col("new").isNotNull()
    for c in checked:
        same = same & F.col("old")[c].eqNullSafe(F.col("new")[c])

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(side)[c].alias(c) for c in checked],
                        start.cast("timestamp").alias(FROM), end.cast("timestamp").alias(TO))

    kept = F.when(F.col("since").isNotNull(),
                  version("old", F.col("since"), F.when(~same, now)))
    added = F.when(F.col("new").isNotNull() & ~same, version("new", now, F.lit(None)))
    changed = (
        both.select(key, F.explode(F.filter(F.array(kept, added), lambda v: v.isNotNull())).alias("v"))
        .select(key, "v.*")
    )
    return history.where(F.col(TO).isNotNull()).select(key, *checked, FROM, TO).unionByName(changed)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest committed version of a stored history."""
    stored = existing(spark, path)
    if stored is None:
        return None
    newest = stored.agg(F.max(VERSION).alias("v")).first()["v"]
    return stored.where(F.col(VERSION) == newest).drop(VERSION)


def update_history(current: DataFrame, spec: HistorySpec, path: str, at: datetime) -> DataFrame:
    """Write the next version beside the earlier ones and return it.

    A version becomes visible when its write commits, so readers never see a
    half-written history and no file in use is overwritten.
    """
    spark = current.sparkSession
    history = read_history(spark, path)
    number = 0
    if history is None:
        rows = first_history(current, spec, at)
    else:
        number = existing(spark, path).agg(F.max(VERSION)).first()[0] + 1
        rows = next_history(history, current, spec, at)
    rows.write.mode("overwrite").parquet(f"{path}/{VERSION}={number}")
    return read_history(spark, path)
