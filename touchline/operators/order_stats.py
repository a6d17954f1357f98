"""Exact order statistics per group by radix selection.

Equal values of a group become one cell with a count.  A double maps to a long of the same order;
its upper 16 bits are counted first, which tells the bucket of every wanted rank.  Only cells in
such buckets go on to the next 16 bits, until after four passes the bucket is the value.  Values
are never sorted and rows are never joined: a pass sums cells, ranks at most 65,536 buckets below
each bucket wanted, and keeps the cells of a small set of (group, bucket) keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DIGIT = 16
MANTISSA, BIAS = 52, 1023


@dataclass(frozen=True)
class Want:
    """A quantile and the rule that turns it into ranks.

    linear     interpolate between the two neighbouring ranks
    higher     upper neighbour, ceil(p (n-1)) counted from zero
    discrete   least value that p of all rows don't exceed, rank ceil(p n) counted from one
    conformal  rank ceil((n+1) p) counted from one; null when it exceeds n
    """

    p: float
    rule: str = "linear"

    def position(self, n: Column) -> Column:
        if self.rule == "conformal":
            return F.ceil((n + 1) * F.lit(float(self.p))) - 1
        if self.rule == "discrete":
            return F.greatest(F.ceil(n * F.lit(float(self.p))), F.lit(1)) - 1
        spot = (n - 1) * F.lit(float(self.p))
        return F.ceil(spot).cast("double") if self.rule == "higher" else spot


def sortable(v: Column) -> Column:
    """A long for each double, in the same order: its bits, negated below zero.  NaN is the greatest."""
    a = F.abs(v)
    low, unit = F.lit(2.0 ** -1022), F.lit(2.0 ** MANTISSA)
    guess = F.floor(F.log2(F.greatest(F.least(a, F.lit(2.0 ** 1023)), low)))
    # The logarithm may round to the next power.
    e = (guess + F.when(F.pow(F.lit(2.0), guess) > a, -1).when(F.pow(F.lit(2.0), guess + 1) <= a, 1).otherwise(0)).cast("double")
    small = a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)
    # Exponent and mantissa are exact in doubles, their sum is not: add them as longs.
    normal = ((e + BIAS) * unit).cast("long") + ((a / F.pow(F.lit(2.0), e) - 1) * unit).cast("long")
    top = 2047 << MANTISSA
    bits = (F.when(F.isnan(v), F.lit(top + 1)).when(a == F.lit(float("inf")), F.lit(top))
            .when(a < low, small.cast("long")).otherwise(normal))
    return F.when(v < 0, -bits).otherwise(bits)


def order_statistics(df: DataFrame, by: list[str], value: str, wants: dict[str, Want]) -> DataFrame:
    """One row per group with ``n`` and every wanted statistic of ``value``.

    Nulls don't count; a group without values has no row, and a null in ``by`` is a group of its own.
    """
    group = F.struct(*by) if by else F.lit(0)
    data = df.where(F.col(value).isNotNull()).select(group.alias("_g"), F.col(value).cast("double").alias("_v"))
    cells = data.groupBy("_g", "_v").agg(F.count("*").alias("_c")).withColumn("_k", sortable(F.col("_v")))

    spots = [w.position(F.col("_n")) for w in wants.values()]
    ranks = [(2 * i + up, F.ceil(s) if up else F.floor(s)) for i, s in enumerate(spots) for up in (0, 1)]
    if any(w.rule == "conformal" for w in wants.values()):
        ranks.append((-1, F.lit(0)))  # keeps the group where its rank lies beyond it
    slots = F.array(*[F.struct(F.lit(slot).alias("slot"), rank.cast("long").alias("rank")) for slot, rank in ranks])
    chosen = None
    for shift in range(64 - DIGIT, -1, -DIGIT):
        sums = [F.sum("_c").alias("_c"), *([] if shift else [F.max("_v").alias("_v")])]
        digit = F.shiftright("_k", shift).alias("_p")
        if chosen is None:
            live, keys = cells.withColumn("_up", F.lit(0).cast("long")), ["_g", "_up"]
        else:
            # What a bucket is wanted for belongs to its key; the plan of the passes before stands in it once.
            live, keys = cells.withColumn("_up", F.shiftright("_k", shift + DIGIT)).join(chosen, ["_g", "_up"]), ["_g", "_up", "_n", "_slots"]
        counts = live.groupBy(*keys, digit).agg(*sums)
        bucket = W.partitionBy("_g", "_up")
        counts = counts.withColumn("_end", F.sum("_c").over(bucket.orderBy("_p")))
        if chosen is None:
            counts = counts.withColumn("_n", F.sum("_c").over(bucket)).withColumn("_slots", slots)
        start = F.col("_end") - F.col("_c")
        hit = F.filter("_slots", lambda s: (s["rank"] >= F.col("_end") - F.col("_c")) & (s["rank"] < F.col("_end")))
        hit = F.transform(hit, lambda s: F.struct(s["slot"], (s["rank"] - start).alias("rank")))
        chosen = counts.select("_g", F.col("_p").alias("_up"), "_n", hit.alias("_slots"), *([] if shift else ["_v"])).where(F.size("_slots") > 0)

    def at(slot: int) -> Column:
        return F.max(F.when(F.exists("_slots", lambda s: s["slot"] == slot), F.col("_v")))

    picks = [at(2 * i + up).alias(f"_{i}_{up}") for i in range(len(wants)) for up in (0, 1)]
    stats = chosen.groupBy("_g", "_n").agg(*picks)
    keys = [F.col("_g")[b].alias(b) for b in by]
    out = []
    for i, (name, spot) in enumerate(zip(wants, spots, strict=True)):
        part = (spot - F.floor(spot)).cast("double")
        a, b = F.col(f"_{i}_0"), F.col(f"_{i}_1")
        out.append(F.when(part == 0, a).otherwise(a * (1 - part) + b * part).alias(name))  # keeps infinity
    return stats.select(*keys, F.col("_n").alias("n"), *out)
