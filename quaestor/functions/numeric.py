"""Money, rounding and guarded ratios.

Money is always ``decimal(19,2)``; it is cast *before* summing so sums are
exact.  Ratios are computed in double and rounded half-up with
``floor(x * 10^k + 0.5) / 10^k``: every step is a single IEEE operation, so
the value is reproducible on any engine, then fixed to ``decimal(p,k)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(19, 2)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast to decimal(19,2)."""
    return col(c).cast(MONEY)


def zero_money() -> Column:
    return F.lit(0).cast(MONEY)


def round_half_up(x, k: int = 2, precision: int = 18) -> Column:
    """(H11) Half-up rounding to ``k`` places, returned as decimal(precision, k)."""
    scale = float(10 ** k)
    v = F.floor(col(x).cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return v.cast(DecimalType(precision, k))


def safe_ratio(num, den, k: int = 4, multiplier: float = 1.0, precision: int = 18) -> Column:
    """(H11, D07) ``round(multiplier * num / nullif(den, 0), k)``; NULL when den is 0 or NULL."""
    d = col(den).cast("double")
    v = F.lit(float(multiplier)) * col(num).cast("double") / F.nullif(d, F.lit(0.0))
    return round_half_up(v, k, precision)


def pct(num, den, k: int = 2) -> Column:
    """Percentage ``round(100 * num / nullif(den, 0), k)``."""
    return safe_ratio(num, den, k, 100.0)


def avg_money(sum_col, count_col, k: int = 2) -> Column:
    """Average recomputed from an exact sum and a count (never an AVG of AVGs)."""
    return safe_ratio(sum_col, count_col, k)


def clamp(x, lo=None, hi=None) -> Column:
    """least/greatest caps."""
    c = col(x)
    if lo is not None:
        c = F.greatest(c, F.lit(lo))
    if hi is not None:
        c = F.least(c, F.lit(hi))
    return c


def positive_part(x) -> Column:
    """MAX(0, x) with the type of x kept."""
    return F.greatest(col(x), F.lit(0))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 integer flag (NULL counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def count_if(cond: Column) -> Column:
    return F.sum(flag(cond)).cast("bigint")


def sum_if(cond: Column, value) -> Column:
    return F.sum(F.when(cond, col(value)))


def sum_money(c) -> Column:
    """SUM of a money column, 0 when empty."""
    return F.coalesce(F.sum(money(c)), zero_money()).cast(DecimalType(38, 2))
