"""Code labels, banding and aging buckets."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaestor.functions.numeric import col


def code_label(c, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """CASE code WHEN k THEN v ... ELSE default."""
    x = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == F.lit(k), F.lit(v)) if expr is None else expr.when(x == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def band(c, edges: Sequence[tuple[float | None, object]], default=None, inclusive_upper: bool = True) -> Column:
    """Threshold banding.

    ``edges`` is a list of ``(upper_bound, label)`` in ascending order; the
    first band whose bound is >= value (or > value when inclusive_upper is
    False) wins; an upper bound of None means "no bound".  NULL stays NULL.
    """
    x = col(c)
    expr = None
    for ub, label in edges:
        if ub is None:
            cond = x.isNotNull()
        else:
            cond = (x <= F.lit(ub)) if inclusive_upper else (x < F.lit(ub))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


# Aging bucket boundaries in days overdue.
AGING_NARROW = [(30, "0-30"), (90, "31-90"), (180, "91-180"), (365, "181-365"), (None, "over 1 year")]
AGING_WIDE = [(0, "current"), (30, "1-30"), (60, "31-60"), (90, "61-90"), (180, "91-180"),
              (365, "181-365"), (None, "365+")]


def aging_bucket(days_overdue, wide: bool = False) -> Column:
    """Bucket by days overdue."""
    return band(days_overdue, AGING_WIDE if wide else AGING_NARROW)


def in_codes(c, codes: Iterable[str]) -> Column:
    return col(c).isin(list(codes))
