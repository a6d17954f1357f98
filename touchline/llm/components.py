"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Staging


def components(edges: DataFrame, staging: Staging, name: str = "stars") -> DataFrame:
    """Smallest member of the component of every node that has an edge.

    ``edges`` has long columns ``u`` and ``v`` (loops and nulls are left out).  Every node hangs
    its larger neighbours under its least neighbour (large-star), then itself and its smaller
    ones (small-star), until nothing changes.  Each round is a pair of combinable minima and of
    equi-joins; the minima are written first, so Spark sees a plain join and can split a hub like
    any skewed key, or broadcast minima that are small.  Returns ``node``, ``root``.
    """
    edges = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
             .distinct())
    edges, before, k = staging.put(f"{name}0", edges), None, 0
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before or not mark[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staging.put(f"{name}{k}up", both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = staging.put(f"{name}{k}large", large)
        least = staging.put(f"{name}{k}down", large.groupBy("u").agg(F.min("v").alias("m")))
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.union(least.select("u", F.col("m").alias("v"))).distinct()
        previous, k = f"{name}{k}", k + 1
        edges, before = staging.put(f"{name}{k}", small), mark
        staging.drop(previous, f"{previous}up", f"{previous}large", f"{previous}down")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
