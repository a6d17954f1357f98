"""As-of, nearest and window-sum lookups on a merged time line.

Both sides are first reduced to at most one row per key and day, with
map-side combining.  A key's time line is then bounded by the days of the
calendar, however many rows the key has, so one linear window pass per key is
safe under any skew.  No range join and no pair of rows is ever formed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY, SIDE, EVENT = "_day", "_side", "_event"


def day_states(df: DataFrame, key: str, day: str, ranked: list[str]) -> DataFrame:
    """One struct per key and day: the row that is largest on ``ranked``.

    ``ranked`` lists every column of the state in tie-break order.
    """
    # The maximum of a single column is summed up by hash, that of a struct needs a sort.
    best = F.struct(F.max(ranked[0]).alias(ranked[0])) if len(ranked) == 1 else F.max(F.struct(*ranked))
    return (
        df.where(F.col(key).isNotNull() & F.col(day).isNotNull())
        .groupBy(key, F.col(day).alias(DAY))
        .agg(best.alias("_state"))
        .select(key, DAY, F.struct(F.col(DAY).alias("on"), "_state.*").alias(EVENT))
    )


@dataclass
class Timeline:
    """Probe rows and history rows of each key in day order."""

    rows: DataFrame
    past: WindowSpec
    future: WindowSpec
    key: str
    probe_side: int

    @property
    def is_probe(self) -> Column:
        return F.col(SIDE) == self.probe_side

    def last_event(self, field: str = EVENT) -> Column:
        return F.last(field, ignorenulls=True).over(self.past.rowsBetween(W.unboundedPreceding, 0))

    def next_event(self, field: str = EVENT) -> Column:
        return F.last(field, ignorenulls=True).over(self.future.rowsBetween(W.unboundedPreceding, 0))

    def so_far(self, agg: Column) -> Column:
        return agg.over(self.past.rowsBetween(W.unboundedPreceding, 0))

    def probes(self, **computed: Column) -> DataFrame:
        return self.rows.withColumns(computed).where(self.is_probe).drop(SIDE, EVENT)


def merge(probes: DataFrame, history: DataFrame, key: str, at: str, strict: str = "forward") -> Timeline:
    """Merge probes (one row per key and ``at``) with ``day_states`` history.

    ``strict`` names the direction that must not see the probe's own day; the
    other direction includes it.
    """
    probe_side = {"forward": 1, "backward": 0}[strict]
    asks = probes.withColumns({DAY: F.col(at), SIDE: F.lit(probe_side)})
    events = history.withColumn(SIDE, F.lit(1 - probe_side))
    return _ordered(asks.unionByName(events, allowMissingColumns=True), key, probe_side)


def merge_spread(asks: DataFrame, history: DataFrame, key: str, probes: dict[str, Column]) -> Timeline:
    """Time line of several named probe days per row of ``asks``; history on a probe's day comes before it.

    The probes are made where the rows of a key have met, so only ``asks`` are shuffled.
    """
    def spot(name: Column, day: Column, side: int) -> Column:
        return F.struct(name.alias("_name"), day.alias(DAY), F.lit(side).alias(SIDE))

    several = F.array(*[spot(F.lit(name), day, 1) for name, day in probes.items()])
    own = F.array(spot(F.lit(None).cast("string"), F.col(DAY), 0))
    met = asks.unionByName(history, allowMissingColumns=True).repartition(key)
    rows = met.select(
        *[c for c in met.columns if c != DAY], F.explode(F.when(F.col(EVENT).isNull(), several).otherwise(own)).alias("_s"))
    return _ordered(rows.select("*", "_s.*").drop("_s"), key, 1)


def _ordered(rows: DataFrame, key: str, probe_side: int) -> Timeline:
    part = W.partitionBy(key)
    return Timeline(
        rows=rows,
        past=part.orderBy(DAY, SIDE),
        # Descending order turns "first event after" into a running last, which
        # Spark evaluates in linear time.
        future=part.orderBy(F.desc(DAY), F.desc(SIDE)),
        key=key,
        probe_side=probe_side,
    )


def asof_join(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str,
              ranked: list[str], name: str = "match", direction: str = "backward",
              strict: bool = False) -> DataFrame:
    """Attach the closest earlier (or later) right row of the same key as a struct."""
    if not key:
        raise ValueError("an as-of join needs an equality key")
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction: {direction}")
    other = {"backward": "forward", "forward": "backward"}[direction]
    asks = left.where(F.col(left_day).isNotNull()).select(key, left_day).distinct()
    line = merge(asks, day_states(right, key, right_day, ranked), key, left_day,
                 strict=direction if strict else other)
    found = line.last_event() if direction == "backward" else line.next_event()
    return left.join(line.probes(**{name: found}).drop(DAY), [key, left_day], "left")


def nearest(before: Column, after: Column, target: Column, tolerance: int) -> Column:
    """Closer of two dated structs, the earlier one on a tie, within a tolerance."""
    gap_before = F.datediff(target, before["on"])
    gap_after = F.datediff(after["on"], target)
    pick = F.when(
        after.isNull() | (before.isNotNull() & (gap_before <= gap_after)), before
    ).otherwise(after)
    return F.when(F.abs(F.datediff(pick["on"], target)) <= tolerance, pick)


def nearest_within(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str,
                   ranked: list[str], offsets: dict[str, int], tolerance: int) -> DataFrame:
    """For each named offset, the right row nearest to ``left_day`` + offset days.

    All offsets share one pass; the result has one row per key and ``left_day``.
    """
    asks = left.where(F.col(left_day).isNotNull()).select(key, left_day).distinct()
    line = merge_spread(asks, day_states(right, key, right_day, ranked), key,
                        {name: F.date_add(left_day, days) for name, days in offsets.items()})
    found = line.probes(_before=line.last_event(), _after=line.next_event()).select(
        key, left_day, "_name",
        nearest(F.col("_before"), F.col("_after"), F.col(DAY), tolerance).alias("_found"),
    )
    # The window already placed each key in one partition: no further shuffle.
    return found.groupBy(key, left_day).agg(*[
        F.max(F.when(F.col("_name") == name, F.col("_found"))).alias(name) for name in offsets
    ])


def window_sums(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str,
                measures: dict[str, Column], spans: dict[str, tuple[int, int]]) -> DataFrame:
    """Sums of ``measures`` over inclusive day spans around ``left_day``.

    Each span [a, b] is the running total at day+b less the one at day+a-1, so
    a range join becomes two as-of lookups per span.
    """
    edges = sorted({e for a, b in spans.values() for e in (a - 1, b)})
    grid = (
        right.where(F.col(key).isNotNull() & F.col(right_day).isNotNull())
        .groupBy(key, F.col(right_day).alias(DAY))
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(m) for m, c in measures.items()])
        .withColumn(EVENT, F.lit(True))
    )
    asks = left.where(F.col(left_day).isNotNull()).select(key, left_day).distinct()
    line = merge_spread(asks, grid, key, {str(e): F.date_add(left_day, e) for e in edges})
    totals = line.probes(**{
        "t_" + m: F.coalesce(line.so_far(F.sum(m)), F.lit(0)) for m in measures
    })

    def at_edge(m: str, e: int) -> Column:
        return F.max(F.when(F.col("_name") == str(e), F.col("t_" + m)))

    return totals.groupBy(key, left_day).agg(*[
        (at_edge(m, b) - at_edge(m, a - 1)).alias(f"{span}_{m}")
        for span, (a, b) in spans.items() for m in measures
    ])
