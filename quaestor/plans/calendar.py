"""Calendars, holidays, fiscal years and tax periods (I01, I02, I09, J05,
M12-M16).

A calendar is one row per day between two dates taken from the data (e.g.
the min and max business date of a fact), so it grows with the data's time
span, not its row count (36,525 rows per century): it is bounded by
construction and safe to broadcast.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaestor.functions import dates as D
from quaestor.operators.joins import expand_config
from quaestor.operators.keys import attach_scalars, bounded

# Public holidays of the daily calendar (month, day, name).
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (2, 4, "Independence Day"),
    (4, 14, "Sinhala & Tamil New Year"),
    (5, 1, "May Day"),
    (12, 25, "Christmas Day"),
]


def date_spine(df: DataFrame, lo_col: str, hi_col: str | None = None, out_col: str = "full_date") -> DataFrame:
    """Days from min(lo_col) to max(hi_col) of ``df`` (one aggregate, then a
    sequence)."""
    b = df.agg(F.min(F.col(lo_col).cast("date")).alias("lo"), F.max(F.col(hi_col or lo_col).cast("date")).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias(out_col))


def spine_between(spark, start: str, end: str, out_col: str = "full_date") -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(out_col))


def holiday_table(years: DataFrame, template: Sequence = FIXED_HOLIDAYS, year_col: str = "year",
                  observe_weekend: str | None = None) -> DataFrame:
    """Holiday dates for each year from a template.

    Template rows: (month, day, name) for fixed dates, or ("EASTER", offset,
    name) / ("ORTHODOX_EASTER", offset, name) for movable feasts.
    ``observe_weekend``: None, 'next_monday' (Sat/Sun -> Monday) or
    'nearest_weekday' (Sat -> Friday, Sun -> Monday).
    """
    rows = []
    for m, d, name in template:
        if m == "EASTER":
            dt = F.date_add(D.easter_sunday(F.col(year_col)), int(d))
        elif m == "ORTHODOX_EASTER":
            dt = F.date_add(D.orthodox_easter_sunday(F.col(year_col)), int(d))
        else:
            dt = F.make_date(F.col(year_col), F.lit(int(m)), F.lit(int(d)))
        rows.append(F.struct(dt.alias("holiday_date"), F.lit(name).alias("holiday_name")))
    out = years.select(F.explode(F.array(*rows)).alias("h")).select("h.*")
    if observe_weekend:
        wd = F.weekday("holiday_date")  # 0 = Monday .. 6 = Sunday
        if observe_weekend == "next_monday":
            obs = F.when(wd == 5, F.date_add("holiday_date", 2)).when(wd == 6, F.date_add("holiday_date", 1))
        else:
            obs = F.when(wd == 5, F.date_sub("holiday_date", 1)).when(wd == 6, F.date_add("holiday_date", 1))
        out = out.withColumn("observed_date", F.coalesce(obs, F.col("holiday_date")))
    else:
        out = out.withColumn("observed_date", F.col("holiday_date"))
    return out


def years_of(spine: DataFrame, date_col: str = "full_date") -> DataFrame:
    return spine.select(F.year(date_col).alias("year")).distinct()


def build_dim_time(spine: DataFrame, holidays: DataFrame | None = None, date_col: str = "full_date") -> DataFrame:
    """Daily calendar with 26 columns (I01): ISO week/day, fiscal = calendar,
    weekend, holiday, business day, period start/end flags."""
    if holidays is None:
        holidays = holiday_table(years_of(spine, date_col))
    h = bounded(holidays.groupBy("observed_date").agg(F.min("holiday_name").alias("holiday_name")))
    d = F.col(date_col)
    out = spine.join(h, d == F.col("observed_date"), "left").drop("observed_date")
    dow = D.iso_weekday(d)
    return out.select(
        D.date_key(d).alias("date_key"), d.alias("full_date"), F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_abbr"),
        F.weekofyear(d).alias("week_of_year"), F.dayofmonth(d).alias("day_of_month"), dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "EEE").alias("day_abbr"),
        F.year(d).alias("fiscal_year"), F.quarter(d).alias("fiscal_quarter"), F.month(d).alias("fiscal_month"),
        (dow >= 6).cast("int").alias("is_weekend"), F.col("holiday_name").isNotNull().cast("int").alias("is_holiday"),
        F.col("holiday_name"),
        ((dow < 6) & F.col("holiday_name").isNull()).cast("int").alias("is_business_day"),
        (F.dayofmonth(d) == 1).cast("int").alias("is_month_start"),
        (d == F.last_day(d)).cast("int").alias("is_month_end"),
        (d == D.quarter_start(d)).cast("int").alias("is_quarter_start"),
        (d == D.quarter_end(d)).cast("int").alias("is_quarter_end"),
        ((F.month(d) == 1) & (F.dayofmonth(d) == 1)).cast("int").alias("is_year_start"),
        ((F.month(d) == 12) & (F.dayofmonth(d) == 31)).cast("int").alias("is_year_end"))


def build_dim_date(spine: DataFrame, as_of: str, date_col: str = "full_date") -> DataFrame:
    """Generalised date dimension (I02): calendar, ISO, boundaries, fiscal
    years for Jan/Apr/Jul/Oct starts and the +1 offset, fiscal quarters and
    months, period keys, prior-period keys and relative flags at ``as_of``
    (the relative flags are what J05 refreshes daily)."""
    d = F.col(date_col)
    lower = spine.agg(F.min(date_col).alias("__lo"))
    out = attach_scalars(spine, lower)
    a = F.lit(as_of).cast("date")
    cols = [
        D.date_key(d).alias("date_key"), d.alias("full_date"), F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"), F.month(d).alias("calendar_month"),
        F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"),
        D.iso_weekday(d).alias("iso_day_of_week"), F.weekofyear(d).alias("iso_week"), D.iso_year(d).alias("iso_year"),
        D.week_of_month(d).alias("week_of_month"), D.days_in_month(d).alias("days_in_month"),
        D.days_in_year(d).alias("days_in_year"), D.is_leap_year(d).cast("int").alias("is_leap_year"),
        D.month_start(d).alias("month_start_date"), F.last_day(d).alias("month_end_date"),
        D.quarter_start(d).alias("quarter_start_date"), D.quarter_end(d).alias("quarter_end_date"),
        D.year_start(d).alias("year_start_date"), D.year_end(d).alias("year_end_date"),
        D.fiscal_year(d, 1).alias("fiscal_year_jan"), D.fiscal_year(d, 1, 1).alias("fiscal_year_jan_offset1"),
        D.fiscal_year(d, 4).alias("fiscal_year_apr"), D.fiscal_year(d, 7).alias("fiscal_year_jul"),
        D.fiscal_year(d, 10).alias("fiscal_year_oct"),
        D.fiscal_quarter(d, 1).alias("fiscal_quarter_jan"), D.fiscal_quarter(d, 4).alias("fiscal_quarter_apr"),
        D.fiscal_quarter(d, 7).alias("fiscal_quarter_jul"), D.fiscal_month(d, 1).alias("fiscal_month_jan"),
        D.fiscal_month(d, 4).alias("fiscal_month_apr"),
        D.year_month_key(d).alias("year_month_key"), D.year_quarter_key(d).alias("year_quarter_key"),
        D.year_week_key(d).alias("year_week_key"),
    ]
    lo = F.col("__lo")
    for u, p in (("day", F.date_sub(d, 1)), ("week", F.date_sub(d, 7)), ("month", F.add_months(d, -1)),
                 ("quarter", F.add_months(d, -3)), ("year", F.add_months(d, -12))):
        cols.append(F.when(p >= lo, D.date_key(p)).alias(f"prior_{u}_key"))
    cols += relative_flags(d, a)
    return out.select(*cols)


def relative_flags(d, a) -> list:
    """Flags relative to the as-of date (J05 daily refresh)."""
    return [
        (d == a).cast("int").alias("is_today"),
        (F.trunc(d, "month") == F.trunc(a, "month")).cast("int").alias("is_current_month"),
        (F.trunc(d, "quarter") == F.trunc(a, "quarter")).cast("int").alias("is_current_quarter"),
        (F.year(d) == F.year(a)).cast("int").alias("is_current_year"),
        F.datediff(d, a).alias("days_from_today"),
    ]


def refresh_relative_flags(dim_date: DataFrame, as_of: str, date_col: str = "full_date") -> DataFrame:
    """Recompute only the relative flags for a new as-of date."""
    keep = [c for c in dim_date.columns if c not in
            ("is_today", "is_current_month", "is_current_quarter", "is_current_year", "days_from_today")]
    return dim_date.select(*keep, *relative_flags(F.col(date_col), F.lit(as_of).cast("date")))


def fiscal_year_view(spine: DataFrame, countries: Sequence[Mapping], date_col: str = "full_date") -> DataFrame:
    """date x country -> fiscal year, quarter, month and label.

    ``countries`` rows: country_code, fiscal_start_month, fiscal_year_offset,
    label_pattern.  Countries are configuration (expanded per day)."""
    out = expand_config(spine, countries, "country")
    d = F.col(date_col)
    m = F.month(d)
    sm = F.col("fiscal_start_month")
    fy = F.when(m >= sm, F.year(d)).otherwise(F.year(d) - 1) + F.col("fiscal_year_offset")
    fm = ((m - sm + 12) % 12) + 1
    return out.select(D.date_key(d).alias("date_key"), d.alias("full_date"), "country_code",
                      fy.cast("int").alias("fiscal_year"), (F.floor((fm - 1) / 3) + 1).cast("int").alias("fiscal_quarter"),
                      fm.cast("int").alias("fiscal_month"),
                      D.fiscal_year_label(fy, F.col("label_pattern")).alias("fiscal_year_label"))


def business_day_index(cal: DataFrame, date_col: str = "full_date", flag_col: str = "is_business_day") -> DataFrame:
    """Cumulative business-day count up to each calendar day."""
    w = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, 0)
    return cal.select(date_col, flag_col, F.sum(flag_col).over(w).alias("business_day_index"))


def business_days_between(pairs: DataFrame, start_col: str, end_col: str, cal: DataFrame,
                          date_col: str = "full_date", flag_col: str = "is_business_day") -> DataFrame:
    """Calendar days and business days in (start, end] for each row (M14):
    difference of the cumulative index looked up at both ends (two equi-joins
    to the broadcast calendar) - no range is exploded per row."""
    idx = bounded(business_day_index(cal, date_col, flag_col))
    s = idx.select(F.col(date_col).alias("__sd"), F.col("business_day_index").alias("__si"))
    e = idx.select(F.col(date_col).alias("__ed"), F.col("business_day_index").alias("__ei"))
    out = pairs.join(s, F.col(start_col) == F.col("__sd"), "left").join(e, F.col(end_col) == F.col("__ed"), "left")
    return (out.withColumn("calendar_days", F.datediff(end_col, start_col))
            .withColumn("business_days", (F.col("__ei") - F.col("__si")).cast("int"))
            .drop("__sd", "__si", "__ed", "__ei"))


def next_business_day(targets: DataFrame, target_col: str, cal: DataFrame, date_col: str = "full_date",
                      flag_col: str = "is_business_day", strict: bool = False,
                      out_col: str = "adjusted_date") -> DataFrame:
    """First business day on/after (after, when strict) each date (M15):
    calendar -> next business day by a reverse forward-fill over the (small)
    calendar, then one equi-join."""
    w = Window.orderBy(F.col(date_col).desc()).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    nxt = cal.select(F.col(date_col).alias("__d"),
                     F.last(F.when(F.col(flag_col) == 1, F.col(date_col)), ignorenulls=True).over(w).alias(out_col))
    return targets.join(bounded(nxt), F.col(target_col) == F.col("__d"), "left").drop("__d")


def holiday_month_counts(cal: DataFrame) -> DataFrame:
    """Per month: days, weekend days, holidays, business days."""
    return cal.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("calendar_days"), F.sum("is_weekend").cast("bigint").alias("weekend_days"),
        F.sum("is_holiday").cast("bigint").alias("holidays"),
        F.sum("is_business_day").cast("bigint").alias("business_days"))


# Period schemes of the tax-period generator.
PERIOD_GRACE_DAYS = {"MONTHLY": 0, "QUARTERLY": 0, "ANNUAL": 0}


def generate_tax_periods(tax_types: DataFrame, years: DataFrame, type_col: str = "tax_type_code",
                         freq_col: str = "filing_frequency") -> DataFrame:
    """Periods per tax type x year (I09): MONTHLY (due the 15th of the next
    month), QUARTERLY (due the 15th of the month after the quarter), ANNUAL
    April-March (due 30 September after the year end)."""
    t = tax_types.select(type_col, F.upper(F.col(freq_col)).alias("frequency"))
    span = years.agg(F.min("year").alias("__y0"), F.max("year").alias("__y1"))  # one row
    ty = (attach_scalars(t, span)
          .withColumn("year", F.explode(F.sequence("__y0", "__y1"))).drop("__y0", "__y1"))
    n = F.when(F.col("frequency") == "MONTHLY", 12).when(F.col("frequency") == "QUARTERLY", 4).otherwise(1)
    p = ty.withColumn("period_number", F.explode(F.sequence(F.lit(1), n)))
    y, k = F.col("year"), F.col("period_number")
    start = (F.when(F.col("frequency") == "MONTHLY", F.make_date(y, k, F.lit(1)))
             .when(F.col("frequency") == "QUARTERLY", F.make_date(y, (k - 1) * 3 + 1, F.lit(1)))
             .otherwise(F.make_date(y, F.lit(4), F.lit(1))))
    months = F.when(F.col("frequency") == "MONTHLY", 1).when(F.col("frequency") == "QUARTERLY", 3).otherwise(12)
    p = p.withColumn("period_start_date", start)
    p = p.withColumn("period_end_date", F.date_sub(F.add_months("period_start_date", months), 1))
    due = (F.when(F.col("frequency") == "ANNUAL", F.make_date(y + 1, F.lit(9), F.lit(30)))
           .otherwise(F.date_add(F.trunc(F.add_months("period_start_date", months), "month"), 14)))
    code = (F.when(F.col("frequency") == "MONTHLY", F.format_string("%d-%02d", y, k))
            .when(F.col("frequency") == "QUARTERLY", F.format_string("%d-Q%d", y, k))
            .otherwise(F.format_string("%d/%02d", y, (y + 1) % 100)))
    return p.select(type_col, "frequency", "year", "period_number", code.alias("period_code"),
                    "period_start_date", "period_end_date", due.alias("filing_due_date"))
