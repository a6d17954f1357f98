"""Reconciliation of two frames in two levels: fingerprints of buckets, then the rows of buckets that differ.

Rows fall into ``BUCKETS`` buckets by hash.  A bucket's fingerprint is the sum of two 64-bit row
hashes and the row count, added for one side and subtracted for the other, so that one narrow
aggregate of both sides is zero where they hold the same rows.  Only rows of other buckets are
compared, and shuffled.  Tables that agree are read once, and no row of them moves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _alike(left: DataFrame, right: DataFrame, cols: list[str]) -> dict[str, str]:
    """Type in which a column is hashed, so that equal values of both sides hash alike."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    out = {}
    for c in cols:
        kinds = {a[c], b[c]}
        if len(kinds) == 1:
            out[c] = a[c]
        elif kinds & {"double", "float"}:
            out[c] = "double"
        elif all(k in ("tinyint", "smallint", "int", "bigint") or k.startswith("decimal") for k in kinds):
            out[c] = "decimal(38,9)"
        else:
            out[c] = "string"
    return out


def _hash(cols: list[str], types: dict[str, str], seed: int = 0) -> Column:
    # The hash passes over nulls, so they are told apart by flags.
    return F.xxhash64(F.lit(seed), *[F.col(c).cast(types[c]) for c in cols], *[F.col(c).isNull() for c in cols])


def _differing(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str], unlike: Column) -> tuple[DataFrame, Column]:
    """Buckets of ``keys`` whose rows differ in ``cols``, and the bucket of a row.

    Rows that meet ``unlike`` make their bucket differ whatever the other side holds.
    """
    types = _alike(left, right, cols)
    bucket = F.pmod(_hash(keys, types, 7), F.lit(BUCKETS)).cast("int")

    def side(df: DataFrame, sign: int) -> DataFrame:
        way = F.lit(sign).cast("decimal(38,0)")
        return df.select(
            bucket.alias("_bucket"), *[(_hash(cols, types, s).cast("decimal(20,0)") * way).cast("decimal(38,0)").alias(f"_h{s}") for s in (1, 2)],
            F.lit(sign).alias("_n"), unlike.alias("_unlike"))

    both = side(left, 1).union(side(right, -1)).groupBy("_bucket").agg(
        F.sum("_h1").alias("_h1"), F.sum("_h2").alias("_h2"), F.sum("_n").alias("_n"), F.max("_unlike").alias("_unlike"))
    return both.where("_h1 <> 0 or _h2 <> 0 or _n <> 0 or _unlike").select("_bucket"), bucket


def _within(df: DataFrame, buckets: DataFrame, bucket: Column) -> DataFrame:
    # At most ``BUCKETS`` numbers are sent out.
    return df.withColumn("_bucket", bucket).join(F.broadcast(buckets), "_bucket", "left_semi").drop("_bucket")


def symmetric_difference(left: DataFrame, right: DataFrame, side: str = "only_in") -> DataFrame:
    """Distinct rows present on one side only, nulls being equal."""
    cols = left.columns
    right = right.select(*cols)
    buckets, bucket = _differing(left, right, cols, cols, F.lit(False))
    tagged = _within(left, buckets, bucket).withColumn("_s", F.lit(0)).unionByName(
        _within(right, buckets, bucket).withColumn("_s", F.lit(1)))
    return (
        tagged.groupBy(*cols).agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
        .where(F.col("_lo") == F.col("_hi"))
        .select(*cols, F.when(F.col("_lo") == 0, "left").otherwise("right").alias(side))
    )


def keyed_mismatches(expected: DataFrame, actual: DataFrame, keys: list[str],
                     values: list[str]) -> DataFrame:
    """Keys that are missing on a side or whose values differ.  A null in a key is missing on both sides."""
    expected, actual = expected.select(*keys, *values), actual.select(*keys, *values)
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    buckets, bucket = _differing(expected, actual, keys, [*keys, *values], unknown)
    e = _within(expected, buckets, bucket).select(*keys, F.struct(*values).alias("_e"))
    a = _within(actual, buckets, bucket).select(*keys, F.struct(*values).alias("_a"))
    joined = e.join(a, keys, "full_outer")
    differs = reduce(
        lambda x, y: x | y,
        [~F.col("_e")[v].eqNullSafe(F.col("_a")[v]) for v in values],
        F.col("_e").isNull() | F.col("_a").isNull(),
    )
    return joined.where(differs).select(*keys)
