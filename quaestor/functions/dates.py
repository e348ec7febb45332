"""Date parts, keys, fiscal calendars and date arithmetic.

All functions return Columns; nothing here touches data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaestor.functions.numeric import col


def as_date(c) -> Column:
    return col(c).cast("date")


def date_key(c) -> Column:
    """YYYYMMDD integer key."""
    d = as_date(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month_key(c) -> Column:
    """year * 100 + month."""
    d = as_date(c)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def year_quarter_key(c) -> Column:
    """year * 10 + quarter."""
    d = as_date(c)
    return (F.year(d) * 10 + F.quarter(d)).cast("int")


def iso_year(c) -> Column:
    """(H06) ISO-8601 week-numbering year: the year of the Thursday of the week."""
    d = as_date(c)
    return F.year(F.date_add(d, 3 - F.weekday(d)))


def iso_weekday(c) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return (F.weekday(as_date(c)) + 1).cast("int")


def year_week_key(c) -> Column:
    """ISO year * 100 + ISO week."""
    d = as_date(c)
    return (iso_year(d) * 100 + F.weekofyear(d)).cast("int")


def quarter_label(c, sep: str = "Q") -> Column:
    """(H10) ``2024Q3`` (sep 'Q') or ``2024-Q3`` (sep '-Q')."""
    d = as_date(c)
    return F.concat(F.year(d).cast("string"), F.lit(sep), F.quarter(d).cast("string"))


def days_in_month(c) -> Column:
    """Days in the month."""
    return F.dayofmonth(F.last_day(as_date(c)))


def is_leap_year(c) -> Column:
    y = F.year(as_date(c))
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def days_in_year(c) -> Column:
    return F.when(is_leap_year(c), F.lit(366)).otherwise(F.lit(365))


def week_of_month(c) -> Column:
    """Week of month counting from the 1st: days 1-7 -> 1, 8-14 -> 2, ..."""
    return (F.floor((F.dayofmonth(as_date(c)) - 1) / 7) + 1).cast("int")


def month_start(c) -> Column:
    return F.trunc(as_date(c), "month")


def quarter_start(c) -> Column:
    return F.trunc(as_date(c), "quarter")


def quarter_end(c) -> Column:
    return F.date_sub(F.add_months(quarter_start(c), 3), 1)


def year_start(c) -> Column:
    return F.trunc(as_date(c), "year")


def year_end(c) -> Column:
    return F.date_sub(F.add_months(year_start(c), 12), 1)


def week_start(c) -> Column:
    """Monday of the ISO week."""
    d = as_date(c)
    return F.date_sub(d, F.weekday(d))


# ---- fiscal calendar (H09) -------------------------------------------------

def fiscal_year(c, start_month: int = 1, offset: int = 0) -> Column:
    """(H09) Fiscal year labelled by its starting calendar year, plus ``offset``.

    Start month 4 -> Apr 2024..Mar 2025 is fiscal year 2024.
    """
    d = as_date(c)
    y = F.year(d)
    fy = y if start_month == 1 else F.when(F.month(d) >= start_month, y).otherwise(y - 1)
    return (fy + F.lit(offset)).cast("int")


def fiscal_month(c, start_month: int = 1) -> Column:
    m = F.month(as_date(c))
    return (((m - F.lit(start_month) + 12) % 12) + 1).cast("int")


def fiscal_quarter(c, start_month: int = 1) -> Column:
    return (F.floor((fiscal_month(c, start_month) - 1) / 3) + 1).cast("int")


def fiscal_year_label(fy, pattern) -> Column:
    """(H09) Fill a label pattern: {YEAR}, {NEXT_YEAR}, {YEAR_SHORT}, {NEXT_YEAR_SHORT}.

    ``pattern`` may be a literal string or a column (per-country patterns).
    """
    y = col(fy)
    p = F.lit(pattern) if isinstance(pattern, str) else col(pattern)
    ys = F.lpad((y % 100).cast("string"), 2, "0")
    ny = y + 1
    nys = F.lpad((ny % 100).cast("string"), 2, "0")
    out = F.replace(p, F.lit("{NEXT_YEAR_SHORT}"), nys)
    out = F.replace(out, F.lit("{YEAR_SHORT}"), ys)
    out = F.replace(out, F.lit("{NEXT_YEAR}"), ny.cast("string"))
    out = F.replace(out, F.lit("{YEAR}"), y.cast("string"))
    return out


# ---- arithmetic (H04, H07, H08, E09) --------------------------------------

def date_diff_days(end, start, clamp_zero: bool = False) -> Column:
    """DATEDIFF in days, optionally clamped at 0."""
    v = F.datediff(as_date(end), as_date(start))
    return F.greatest(v, F.lit(0)) if clamp_zero else v


def age_years(as_of, birth) -> Column:
    """Completed years between birth and as_of."""
    return F.floor(F.months_between(as_date(as_of), as_date(birth)) / 12).cast("int")


def standardize_date(c, as_of, floor_date: str = "1900-01-01", years_ahead: int = 10) -> Column:
    """NULL when the date is unparsable, before 1900-01-01 or beyond as_of + 10y."""
    d = F.try_to_date(col(c).cast("string")) if not isinstance(c, Column) else F.try_to_date(c.cast("string"))
    hi = F.add_months(as_date(F.lit(as_of) if isinstance(as_of, str) else as_of), 12 * years_ahead)
    return F.when((d >= F.lit(floor_date).cast("date")) & (d <= hi), d)


def prior_date_key(c, unit: str, lower: str | None = None) -> Column:
    """Key of the same day one unit earlier (day/week/month/quarter/year); NULL
    when it falls before ``lower`` (the calendar's first date) (E09)."""
    d = as_date(c)
    if unit == "day":
        p = F.date_sub(d, 1)
    elif unit == "week":
        p = F.date_sub(d, 7)
    elif unit == "month":
        p = F.add_months(d, -1)
    elif unit == "quarter":
        p = F.add_months(d, -3)
    elif unit == "year":
        p = F.add_months(d, -12)
    else:
        raise ValueError(unit)
    k = date_key(p)
    if lower is not None:
        k = F.when(p >= F.lit(lower).cast("date"), k)
    return k


def due_date_after(c, months_after=1, due_day=15) -> Column:
    """Day ``due_day`` of the month ``months_after`` months after c's month,
    capped at the last day of that month (M41).  Both rules may be ints or
    per-row Columns (rules looked up per tax type or scheme)."""
    ma = F.lit(months_after) if isinstance(months_after, int) else months_after
    dd = F.lit(due_day) if isinstance(due_day, int) else due_day
    m = F.add_months(month_start(c), ma)
    return F.least(F.date_add(m, dd - 1), F.last_day(m))


def easter_sunday(year) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian algorithm) as a date."""
    y = col(year).cast("int")
    a = y % 19
    b = F.floor(y / 100)
    c = y % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = ((h + l_ - 7 * m + 114) % 31) + 1
    return F.make_date(y, month.cast("int"), day.cast("int"))


def orthodox_easter_sunday(year) -> Column:
    """Orthodox Easter (Julian computus) converted to the Gregorian calendar
    (valid 1900-2099: +13 days)."""
    y = col(year).cast("int")
    a = y % 4
    b = y % 7
    c = y % 19
    d = (19 * c + 15) % 30
    e = (2 * a + 4 * b - d + 34) % 7
    month = F.floor((d + e + 114) / 31)
    day = ((d + e + 114) % 31) + 1
    julian = F.make_date(y, month.cast("int"), day.cast("int"))
    return F.date_add(julian, 13)
