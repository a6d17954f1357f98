"""Column expressions shared by the plans.  All are built-in Spark functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white space that a warehouse TRIM removes.
WHITESPACE = (
    " \t\n\u000b\f\r\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

MONEY = "decimal(38,9)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(col(c), F.lit(WHITESPACE))


def null_if(c: Column | str, value) -> Column:
    return F.nullif(col(c), F.lit(value))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double division; null when the divisor is zero or null."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    return F.round(ratio(num, den) * 100, scale)


def per_90(amount: Column | str, minutes: Column | str, scale: int = 2) -> Column:
    return F.round(ratio(amount, minutes) * 90, scale)


def rounded_avg(c: Column | str, scale: int = 2) -> Column:
    return F.round(F.avg(col(c)), scale)


def fixed_avg(c: Column | str, scale: int = 2) -> Column:
    """Mean of values that carry ``scale`` decimals.

    The sum is exact, so the result does not depend on how rows are split
    between tasks or on retried tasks.
    """
    return ratio(F.sum(col(c).cast(f"decimal(18,{scale})")), F.count(col(c)))


def money_avg(c: Column | str) -> Column:
    """Mean of an exact decimal: exact sum, one double division at the end."""
    return ratio(F.sum(col(c)), F.count(col(c)))


def full_years(at: Column | date, birth: Column | str) -> Column:
    """Completed years: calendar years crossed, less one before the birthday."""
    at = F.lit(at) if isinstance(at, date) else at
    birth = col(birth)
    early = F.date_format(at, "MMdd") < F.date_format(birth, "MMdd")
    return (F.year(at) - F.year(birth) - early.cast("int")).cast("long")


def latest(value: Column | str, *order: Column | str) -> Column:
    """Value of the row with the largest order key, skipping null values."""
    value = col(value)
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*map(col, order))))


def earliest(value: Column | str, *order: Column | str) -> Column:
    value = col(value)
    return F.min_by(value, F.when(value.isNotNull(), F.struct(*map(col, order))))


def least_known(*cols: Column | str) -> Column:
    """LEAST that is null as soon as one argument is null."""
    cols = [col(c) for c in cols]
    any_null = cols[0].isNull()
    for c in cols[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.least(*cols))


def row_key(*names: str) -> Column:
    """Null-aware digest of named columns; equal rows get equal keys."""
    packed = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return F.md5(packed.cast("binary"))


def band(value: Column | str, cuts: list[tuple[float, str]], top: str, missing: str | None) -> Column:
    """Left-closed bands: the first cut above the value names it."""
    value = col(value)
    out = F.when(value.isNull(), F.lit(missing))
    for upper, label in cuts:
        out = out.when(value < F.lit(upper), F.lit(label))
    return out.otherwise(F.lit(top))


def share_known(*names: str, scale: int = 2) -> Column:
    """Percentage of the named columns that hold a value in this row."""
    known = sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0))
    return F.round(known.cast("double") / len(names) * 100, scale)
