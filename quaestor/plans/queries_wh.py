"""Registered queries: calendars, dimensions, merges, SCD2, data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaestor.functions.numeric import money
from quaestor.operators import checks as CHK, merge as MRG, scd as SCD
from quaestor.operators.hierarchy import walk_hierarchy
from quaestor.plans import bindings as B, calendar as CAL, dims as DIM
from quaestor.plans.catalog import register
from quaestor.plans.sqlbind import with_

_AS_OF = B.AS_OF_ORDERS

_HOL_SQL = ("(VALUES (1, 1, 'New Year''s Day'), (2, 4, 'Independence Day'), (4, 14, 'Sinhala & Tamil New Year'), "
            "(5, 1, 'May Day'), (12, 25, 'Christmas Day')) t(m, d, holiday_name)")

_SPINE_SQL = """spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date
   FROM (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders) b),
hol AS (SELECT make_date(CAST(y.year AS INTEGER), t.m, t.d) AS observed_date, MIN(t.holiday_name) AS holiday_name
   FROM (SELECT DISTINCT year(full_date) AS year FROM spine) y, """ + _HOL_SQL + """ GROUP BY 1),
cal AS (SELECT s.full_date, h.holiday_name,
   CASE WHEN isodow(s.full_date) < 6 AND h.holiday_name IS NULL THEN 1 ELSE 0 END AS is_business_day
   FROM spine s LEFT JOIN hol h ON h.observed_date = s.full_date)"""


def _spine(t):
    return CAL.date_spine(t.orders, "o_orderdate")


# ---------------------------------------------------------------- I01
@register("dim_time", "WITH " + _SPINE_SQL + """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, year(full_date) AS year,
  quarter(full_date) AS quarter, 'Q' || quarter(full_date) AS quarter_name, month(full_date) AS month,
  monthname(full_date) AS month_name, strftime(full_date, '%b') AS month_abbr, week(full_date) AS week_of_year,
  day(full_date) AS day_of_month, isodow(full_date) AS day_of_week, dayname(full_date) AS day_name,
  strftime(full_date, '%a') AS day_abbr, year(full_date) AS fiscal_year, quarter(full_date) AS fiscal_quarter,
  month(full_date) AS fiscal_month, CASE WHEN isodow(full_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN holiday_name IS NOT NULL THEN 1 ELSE 0 END AS is_holiday, holiday_name, is_business_day,
  CASE WHEN day(full_date) = 1 THEN 1 ELSE 0 END AS is_month_start,
  CASE WHEN full_date = last_day(full_date) THEN 1 ELSE 0 END AS is_month_end,
  CASE WHEN full_date = CAST(date_trunc('quarter', full_date) AS DATE) THEN 1 ELSE 0 END AS is_quarter_start,
  CASE WHEN full_date = CAST(date_trunc('quarter', full_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) THEN 1 ELSE 0 END AS is_quarter_end,
  CASE WHEN month(full_date) = 1 AND day(full_date) = 1 THEN 1 ELSE 0 END AS is_year_start,
  CASE WHEN month(full_date) = 12 AND day(full_date) = 31 THEN 1 ELSE 0 END AS is_year_end
FROM cal""")
def q_dim_time(spark, sf_dir):
    return CAL.build_dim_time(_spine(B.tables(spark, sf_dir)))


def _fy(start, offset=0):
    if start == 1:
        return f"CAST(year(full_date) + {offset} AS INTEGER)"
    return f"CAST(CASE WHEN month(full_date) >= {start} THEN year(full_date) ELSE year(full_date) - 1 END + {offset} AS INTEGER)"


def _fm(start):
    return f"CAST(((month(full_date) - {start} + 12) % 12) + 1 AS INTEGER)"


def _fq(start):
    return f"CAST(FLOOR((({_fm(start)}) - 1) / 3) + 1 AS INTEGER)"


def _prior(expr):
    return f"CASE WHEN {expr} >= lo THEN CAST(strftime({expr}, '%Y%m%d') AS INTEGER) END"


# ---------------------------------------------------------------- I02 / E09 / J05
@register("dim_date", "WITH " + _SPINE_SQL + f""",
x AS (SELECT s.full_date, m.lo FROM spine s, (SELECT MIN(full_date) AS lo FROM spine) m)
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, year(full_date) AS calendar_year,
  quarter(full_date) AS calendar_quarter, month(full_date) AS calendar_month, day(full_date) AS day_of_month,
  dayofyear(full_date) AS day_of_year, isodow(full_date) AS iso_day_of_week, week(full_date) AS iso_week,
  isoyear(full_date) AS iso_year, CAST(FLOOR((day(full_date) - 1) / 7) + 1 AS INTEGER) AS week_of_month,
  day(last_day(full_date)) AS days_in_month,
  CASE WHEN (year(full_date) % 4 = 0 AND year(full_date) % 100 <> 0) OR year(full_date) % 400 = 0 THEN 366 ELSE 365 END AS days_in_year,
  CASE WHEN (year(full_date) % 4 = 0 AND year(full_date) % 100 <> 0) OR year(full_date) % 400 = 0 THEN 1 ELSE 0 END AS is_leap_year,
  CAST(date_trunc('month', full_date) AS DATE) AS month_start_date, last_day(full_date) AS month_end_date,
  CAST(date_trunc('quarter', full_date) AS DATE) AS quarter_start_date,
  CAST(date_trunc('quarter', full_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
  CAST(date_trunc('year', full_date) AS DATE) AS year_start_date,
  CAST(date_trunc('year', full_date) + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE) AS year_end_date,
  {_fy(1)} AS fiscal_year_jan, {_fy(1, 1)} AS fiscal_year_jan_offset1, {_fy(4)} AS fiscal_year_apr,
  {_fy(7)} AS fiscal_year_jul, {_fy(10)} AS fiscal_year_oct, {_fq(1)} AS fiscal_quarter_jan,
  {_fq(4)} AS fiscal_quarter_apr, {_fq(7)} AS fiscal_quarter_jul, {_fm(1)} AS fiscal_month_jan, {_fm(4)} AS fiscal_month_apr,
  CAST(year(full_date) * 100 + month(full_date) AS INTEGER) AS year_month_key,
  CAST(year(full_date) * 10 + quarter(full_date) AS INTEGER) AS year_quarter_key,
  CAST(isoyear(full_date) * 100 + week(full_date) AS INTEGER) AS year_week_key,
  {_prior("CAST(full_date - INTERVAL 1 DAY AS DATE)")} AS prior_day_key,
  {_prior("CAST(full_date - INTERVAL 7 DAY AS DATE)")} AS prior_week_key,
  {_prior("CAST(full_date - INTERVAL 1 MONTH AS DATE)")} AS prior_month_key,
  {_prior("CAST(full_date - INTERVAL 3 MONTH AS DATE)")} AS prior_quarter_key,
  {_prior("CAST(full_date - INTERVAL 12 MONTH AS DATE)")} AS prior_year_key,
  CASE WHEN full_date = DATE '{_AS_OF}' THEN 1 ELSE 0 END AS is_today,
  CASE WHEN date_trunc('month', full_date) = date_trunc('month', DATE '{_AS_OF}') THEN 1 ELSE 0 END AS is_current_month,
  CASE WHEN date_trunc('quarter', full_date) = date_trunc('quarter', DATE '{_AS_OF}') THEN 1 ELSE 0 END AS is_current_quarter,
  CASE WHEN year(full_date) = year(DATE '{_AS_OF}') THEN 1 ELSE 0 END AS is_current_year,
  date_diff('day', DATE '{_AS_OF}', full_date) AS days_from_today
FROM x""")
def q_dim_date(spark, sf_dir):
    return CAL.build_dim_date(_spine(B.tables(spark, sf_dir)), _AS_OF)


# Country fiscal-year configuration used by the fiscal views.
COUNTRIES = [
    {"country_code": "LKA", "fiscal_start_month": 4, "fiscal_year_offset": 0, "label_pattern": "{YEAR}/{NEXT_YEAR_SHORT}"},
    {"country_code": "MLT", "fiscal_start_month": 1, "fiscal_year_offset": 1, "label_pattern": "YA {YEAR}"},
    {"country_code": "AUS", "fiscal_start_month": 7, "fiscal_year_offset": 0, "label_pattern": "FY{NEXT_YEAR}"},
    {"country_code": "USA", "fiscal_start_month": 10, "fiscal_year_offset": 0, "label_pattern": "FY {YEAR}"},
]
_COUNTRIES_SQL = "(VALUES " + ", ".join(
    f"('{c['country_code']}', {c['fiscal_start_month']}, {c['fiscal_year_offset']}, '{c['label_pattern']}')"
    for c in COUNTRIES) + ") c(country_code, sm, off, pat)"


# ---------------------------------------------------------------- M12 / C15 / H09
@register("fiscal_year_view", "WITH " + _SPINE_SQL + """,
x AS (SELECT s.full_date, c.country_code, c.pat,
        CAST(CASE WHEN month(s.full_date) >= c.sm THEN year(s.full_date) ELSE year(s.full_date) - 1 END + c.off AS INTEGER) AS fy,
        CAST(((month(s.full_date) - c.sm + 12) % 12) + 1 AS INTEGER) AS fm
      FROM spine s, """ + _COUNTRIES_SQL + """)
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, country_code, fy AS fiscal_year,
  CAST(FLOOR((fm - 1) / 3) + 1 AS INTEGER) AS fiscal_quarter, fm AS fiscal_month,
  replace(replace(replace(replace(pat, '{NEXT_YEAR_SHORT}', lpad(CAST((fy + 1) % 100 AS VARCHAR), 2, '0')),
      '{YEAR_SHORT}', lpad(CAST(fy % 100 AS VARCHAR), 2, '0')), '{NEXT_YEAR}', CAST(fy + 1 AS VARCHAR)),
      '{YEAR}', CAST(fy AS VARCHAR)) AS fiscal_year_label
FROM x""")
def q_fiscal_year_view(spark, sf_dir):
    return CAL.fiscal_year_view(_spine(B.tables(spark, sf_dir)), COUNTRIES)


# ---------------------------------------------------------------- M11 fiscal year revenue
@register("fiscal_year_revenue", with_("payments") + """,
x AS (SELECT c.country_code, c.pat, payment_amount,
        CAST(CASE WHEN month(payment_date) >= c.sm THEN year(payment_date) ELSE year(payment_date) - 1 END + c.off AS INTEGER) AS fy
      FROM payments, """ + _COUNTRIES_SQL + """)
SELECT country_code, fy AS fiscal_year,
  replace(replace(replace(replace(pat, '{NEXT_YEAR_SHORT}', lpad(CAST((fy + 1) % 100 AS VARCHAR), 2, '0')),
      '{YEAR_SHORT}', lpad(CAST(fy % 100 AS VARCHAR), 2, '0')), '{NEXT_YEAR}', CAST(fy + 1 AS VARCHAR)),
      '{YEAR}', CAST(fy AS VARCHAR)) AS fiscal_year_label,
  SUM(payment_amount) AS revenue, COUNT(*) AS payments
FROM x GROUP BY 1, 2, 3""")
def q_fiscal_year_revenue(spark, sf_dir):
    from quaestor.functions.dates import fiscal_year_label
    from quaestor.operators.joins import expand_config
    p = expand_config(B.payments(B.tables(spark, sf_dir)), COUNTRIES, "country")
    m = F.month("payment_date")
    fy = (F.when(m >= F.col("fiscal_start_month"), F.year("payment_date")).otherwise(F.year("payment_date") - 1)
          + F.col("fiscal_year_offset")).cast("int")
    return (p.withColumn("fiscal_year", fy)
            .groupBy("country_code", "fiscal_year", fiscal_year_label(F.col("fiscal_year"), F.col("label_pattern")).alias("fiscal_year_label"))
            .agg(F.sum("payment_amount").alias("revenue"), F.count(F.lit(1)).alias("payments")))


# ---------------------------------------------------------------- M13
@register("holiday_month_counts", "WITH " + _SPINE_SQL + """
SELECT year(full_date) AS year, month(full_date) AS month, COUNT(*) AS calendar_days,
  SUM(CASE WHEN isodow(full_date) >= 6 THEN 1 ELSE 0 END) AS weekend_days,
  SUM(CASE WHEN holiday_name IS NOT NULL THEN 1 ELSE 0 END) AS holidays, SUM(is_business_day) AS business_days
FROM cal GROUP BY 1, 2""")
def q_holiday_month_counts(spark, sf_dir):
    return CAL.holiday_month_counts(CAL.build_dim_time(_spine(B.tables(spark, sf_dir))))


_SPINE2_SQL = _SPINE_SQL.replace(
    "(SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders) b",
    "(SELECT MIN(period_date) AS lo, CAST(GREATEST(MAX(filing_date), MAX(due_date)) + 14 AS DATE) AS hi FROM filings) b")


def _cal2(f):
    b = f.agg(F.min("period_date").alias("lo"),
              F.date_add(F.greatest(F.max("filing_date"), F.max("due_date")), 14).alias("hi"))
    spine = b.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    return CAL.build_dim_time(spine)


# ---------------------------------------------------------------- M14
@register("business_days_to_file", with_("filings") + ", " + _SPINE2_SQL + """,
idx AS (SELECT full_date, SUM(is_business_day) OVER (ORDER BY full_date) AS bdi FROM cal)
SELECT f.return_id, f.period_date, f.filing_date, date_diff('day', f.period_date, f.filing_date) AS calendar_days,
  CAST(e.bdi - s.bdi AS INTEGER) AS business_days
FROM filings f LEFT JOIN idx s ON s.full_date = f.period_date LEFT JOIN idx e ON e.full_date = f.filing_date""")
def q_business_days_to_file(spark, sf_dir):
    f = B.filings(B.tables(spark, sf_dir))
    return CAL.business_days_between(f.select("return_id", "period_date", "filing_date"), "period_date",
                                     "filing_date", _cal2(f))


# ---------------------------------------------------------------- M15 / E03
@register("adjusted_due_dates", with_("filings") + ", " + _SPINE2_SQL + """,
nxt AS (SELECT c.full_date, MIN(b.full_date) AS adjusted_date FROM cal c
        JOIN cal b ON b.full_date >= c.full_date AND b.is_business_day = 1 AND b.full_date <= c.full_date + 14 GROUP BY 1)
SELECT f.return_id, f.due_date, n.adjusted_date
FROM filings f LEFT JOIN nxt n ON n.full_date = f.due_date""")
def q_adjusted_due_dates(spark, sf_dir):
    f = B.filings(B.tables(spark, sf_dir))
    return CAL.next_business_day(f.select("return_id", "due_date"), "due_date", _cal2(f))


# Movable-feast template (offsets in days from Easter Sunday).
MOVABLE_HOLIDAYS = [(1, 1, "New Year's Day"), ("EASTER", -2, "Good Friday"), ("EASTER", 1, "Easter Monday"),
                    ("ORTHODOX_EASTER", 0, "Orthodox Easter"), (12, 25, "Christmas Day"), (12, 26, "Boxing Day")]

_EASTER_SQL = """e AS (SELECT year, a, b, c, d, ee, f, g, h, i, k, l, m,
      make_date(year, CAST((h + l - 7 * m + 114) // 31 AS INTEGER), CAST(((h + l - 7 * m + 114) % 31) + 1 AS INTEGER)) AS easter
   FROM (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM (
     SELECT *, (32 + 2 * ee + 2 * i - h - k) % 7 AS l FROM (
       SELECT *, (19 * a + b - d - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM (
         SELECT *, (b - f + 1) // 3 AS g FROM (
           SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c, (year // 100) // 4 AS d,
                  (year // 100) % 4 AS ee, ((year // 100) + 8) // 25 AS f FROM years)))))),
o AS (SELECT year, CAST(make_date(year, CAST((d + e2 + 114) // 31 AS INTEGER), CAST(((d + e2 + 114) % 31) + 1 AS INTEGER)) + 13 AS DATE) AS orthodox
   FROM (SELECT year, d, (2 * (year % 4) + 4 * (year % 7) - d + 34) % 7 AS e2 FROM (
     SELECT year, (19 * (year % 19) + 15) % 30 AS d FROM years)))"""


# ---------------------------------------------------------------- M16
@register("holiday_calendar", """WITH years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
""" + _EASTER_SQL + """,
h AS (SELECT make_date(year, 1, 1) AS holiday_date, 'New Year''s Day' AS holiday_name FROM years
      UNION ALL SELECT CAST(e.easter - 2 AS DATE), 'Good Friday' FROM e
      UNION ALL SELECT CAST(e.easter + 1 AS DATE), 'Easter Monday' FROM e
      UNION ALL SELECT o.orthodox, 'Orthodox Easter' FROM o
      UNION ALL SELECT make_date(year, 12, 25), 'Christmas Day' FROM years
      UNION ALL SELECT make_date(year, 12, 26), 'Boxing Day' FROM years)
SELECT holiday_date, holiday_name,
  CASE WHEN isodow(holiday_date) = 6 THEN CAST(holiday_date + 2 AS DATE)
       WHEN isodow(holiday_date) = 7 THEN CAST(holiday_date + 1 AS DATE) ELSE holiday_date END AS observed_date
FROM h""")
def q_holiday_calendar(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    years = t.orders.select(F.year("o_orderdate").alias("year")).distinct()
    return CAL.holiday_table(years, MOVABLE_HOLIDAYS, observe_weekend="next_monday")


# Binding of order priorities to tax-type attributes.
TYPE_CATEGORIES = {"1-URGENT": "INCOME", "2-HIGH": "INCOME", "3-MEDIUM": "CONSUMPTION", "4-NOT SPECIFIED": "CONSUMPTION"}
TYPE_FREQUENCIES = {"1-URGENT": "MONTHLY", "2-HIGH": "MONTHLY", "3-MEDIUM": "QUARTERLY", "4-NOT SPECIFIED": "QUARTERLY"}
PROGRESSIVE_TYPES = ("1-URGENT", "2-HIGH")


def _case(col, mapping, default):
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE '{default}' END"


# ---------------------------------------------------------------- I07
@register("dim_tax_type", f"""
SELECT tax_type_code, trim(split_part(tax_type_code, '-', -1)) AS tax_type_name,
  {_case('tax_type_code', TYPE_CATEGORIES, 'OTHER')} AS tax_category,
  CASE WHEN {_case('tax_type_code', TYPE_CATEGORIES, 'OTHER')} = 'INCOME' THEN 1 ELSE 0 END AS is_direct_tax,
  CASE WHEN tax_type_code IN ('1-URGENT', '2-HIGH') THEN 'PROGRESSIVE' ELSE 'FLAT' END AS rate_type,
  {_case('tax_type_code', TYPE_FREQUENCIES, 'ANNUAL')} AS filing_frequency,
  ROW_NUMBER() OVER (ORDER BY tax_type_code) AS tax_type_key
FROM (SELECT DISTINCT o_orderpriority AS tax_type_code FROM orders WHERE o_orderpriority IS NOT NULL)""")
def q_dim_tax_type(spark, sf_dir):
    return DIM.build_dim_tax_type(B.tables(spark, sf_dir).orders, "o_orderpriority", TYPE_CATEGORIES,
                                  TYPE_FREQUENCIES, PROGRESSIVE_TYPES)


# ---------------------------------------------------------------- I09
@register("tax_periods", f"""
WITH t AS (SELECT DISTINCT o_orderpriority AS tax_type_code, {_case('o_orderpriority', TYPE_FREQUENCIES, 'ANNUAL')} AS frequency FROM orders),
y AS (SELECT CAST(unnest(range(MIN(year(o_orderdate)), MAX(year(o_orderdate)) + 1)) AS INTEGER) AS year FROM orders),
p AS (SELECT t.*, y.year, CAST(unnest(range(1, CASE frequency WHEN 'MONTHLY' THEN 12 WHEN 'QUARTERLY' THEN 4 ELSE 1 END + 1)) AS INTEGER) AS period_number FROM t, y),
q AS (SELECT *, CASE frequency WHEN 'MONTHLY' THEN make_date(year, period_number, 1)
                  WHEN 'QUARTERLY' THEN make_date(year, (period_number - 1) * 3 + 1, 1) ELSE make_date(year, 4, 1) END AS period_start_date,
               CASE frequency WHEN 'MONTHLY' THEN 1 WHEN 'QUARTERLY' THEN 3 ELSE 12 END AS months FROM p)
SELECT tax_type_code, frequency, year, period_number,
  CASE frequency WHEN 'MONTHLY' THEN printf('%d-%02d', year, period_number)
       WHEN 'QUARTERLY' THEN printf('%d-Q%d', year, period_number) ELSE printf('%d/%02d', year, (year + 1) % 100) END AS period_code,
  period_start_date, CAST(period_start_date + to_months(months) - INTERVAL 1 DAY AS DATE) AS period_end_date,
  CASE frequency WHEN 'ANNUAL' THEN make_date(year + 1, 9, 30)
       ELSE CAST(date_trunc('month', period_start_date + to_months(months)) + INTERVAL 14 DAY AS DATE) END AS filing_due_date
FROM q""")
def q_tax_periods(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    types = DIM.build_dim_tax_type(t.orders, "o_orderpriority", TYPE_CATEGORIES, TYPE_FREQUENCIES)
    years = t.orders.select(F.year("o_orderdate").alias("year"))
    return CAL.generate_tax_periods(types, years)


def _geo(t):
    return t.nation.join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"]).select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"))


# ---------------------------------------------------------------- I03 / H20 / H13
@register("dim_party", with_("party") + """
SELECT p.party_id, upper(trim(p.party_name)) AS party_name, p.segment AS party_segment, p.balance AS account_balance,
  CASE WHEN p.balance <= 0 THEN 'HIGH' WHEN p.balance <= 1000 THEN 'MEDIUM' WHEN p.balance IS NOT NULL THEN 'LOW' END AS risk_rating,
  COALESCE(n.n_name, 'Unknown') AS district_name, COALESCE(r.r_name, 'Unknown') AS region_name,
  CASE WHEN COALESCE(n.n_name, 'Unknown') = 'Unknown' AND COALESCE(r.r_name, 'Unknown') = 'Unknown' THEN 'Unknown'
       ELSE concat_ws(', ', n.n_name, r.r_name) END AS address_line,
  1 AS batch_id, ROW_NUMBER() OVER (ORDER BY p.party_id) AS party_key
FROM party p LEFT JOIN nation n ON n.n_nationkey = p.nation_key LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def q_dim_party(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return DIM.build_dim_party(B.party(t), _geo(t))


# ---------------------------------------------------------------- I04 / I06 / L19
_SCD_SQL = with_("party") + f""",
cur AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY party_id) AS BIGINT) AS surrogate_key, party_id, party_name, segment,
          DATE '2001-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to, 1 AS is_current, 1 AS version_number FROM party),
inc AS (SELECT party_id, party_name, CASE WHEN balance < 0 THEN 'DELINQUENT' ELSE segment END AS segment FROM party
        UNION ALL SELECT s_suppkey + 1000000000, s_name, 'SUPPLIER' FROM supplier),
chg AS (SELECT i.* FROM inc i JOIN cur c USING (party_id)
        WHERE c.party_name IS DISTINCT FROM i.party_name OR c.segment IS DISTINCT FROM i.segment),
fresh AS (SELECT i.*, COALESCE(c.version_number + 1, 1) AS version_number FROM
          (SELECT * FROM chg UNION ALL SELECT * FROM inc WHERE party_id NOT IN (SELECT party_id FROM cur)) i
          LEFT JOIN cur c USING (party_id)),
merged AS (
  SELECT * FROM cur WHERE party_id NOT IN (SELECT party_id FROM chg)
  UNION ALL
  SELECT surrogate_key, party_id, party_name, segment, valid_from, DATE '{_AS_OF}', 0, version_number FROM cur
   WHERE party_id IN (SELECT party_id FROM chg)
  UNION ALL
  SELECT (SELECT MAX(surrogate_key) FROM cur) + ROW_NUMBER() OVER (ORDER BY party_id), party_id, party_name, segment,
         DATE '{_AS_OF}', CAST(NULL AS DATE), 1, version_number FROM fresh)
"""


def _scd(t):
    p = B.party(t).select("party_id", "party_name", "segment", "balance")
    cur = SCD.initial_scd2(p.select("party_id", "party_name", "segment"), ["party_id"], "2001-01-01")
    cur = cur.select("surrogate_key", "party_id", "party_name", "segment", "valid_from", "valid_to", "is_current",
                     "version_number")
    inc = p.select("party_id", "party_name",
                   F.when(F.col("balance") < 0, F.lit("DELINQUENT")).otherwise(F.col("segment")).alias("segment"))
    new = t.supplier.select((F.col("s_suppkey") + 1000000000).alias("party_id"), F.col("s_name").alias("party_name"),
                            F.lit("SUPPLIER").alias("segment"))
    return SCD.scd2_merge(cur, inc.unionByName(new), ["party_id"], ["party_name", "segment"], _AS_OF)


@register("scd2_party_merge", _SCD_SQL + "SELECT * FROM merged")
def q_scd2_party_merge(spark, sf_dir):
    return _scd(B.tables(spark, sf_dir))


@register("scd2_checks", _SCD_SQL + """
SELECT 'scd2_current_open' AS check_name, COUNT(*) FILTER (WHERE is_current = 1 AND valid_to IS NOT NULL) AS rows_failed FROM merged
UNION ALL SELECT 'scd2_history_closed', COUNT(*) FILTER (WHERE is_current <> 1 AND valid_to IS NULL) FROM merged
UNION ALL SELECT 'natural_key_unique', COUNT(*) FROM (SELECT party_id FROM merged WHERE is_current = 1 GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'versions', COUNT(*) FROM merged WHERE version_number > 1""")
def q_scd2_checks(spark, sf_dir):
    m = _scd(B.tables(spark, sf_dir))
    a = CHK.check_scd2(m, "dim_party").select("check_name", "rows_failed")
    b = CHK.check_natural_keys(m, "dim_party", ["party_id"], "is_current").select("check_name", "rows_failed")
    c = m.agg(F.count_if(F.col("version_number") > 1).cast("bigint").alias("rows_failed")) \
        .select(F.lit("versions").alias("check_name"), "rows_failed")
    return a.unionByName(b).unionByName(c)


# ---------------------------------------------------------------- A08-A11
_MERGE_SQL = with_("returns") + """,
tgt AS (SELECT return_id, party_id, tax_type_code, period_date, assessed_amount, status, due_date FROM returns WHERE period_date < DATE '2000-01-01'),
src AS (SELECT return_id, party_id, tax_type_code, period_date, CAST(assessed_amount + 1 AS DECIMAL(19,2)) AS assessed_amount, 'F' AS status, due_date
        FROM returns WHERE period_date >= DATE '1999-01-01')
"""


def _merge_inputs(t):
    r = B.returns(t).select("return_id", "party_id", "tax_type_code", "period_date", "assessed_amount", "status", "due_date")
    tgt = r.where(F.col("period_date") < F.lit("2000-01-01").cast("date"))
    src = (r.where(F.col("period_date") >= F.lit("1999-01-01").cast("date"))
           .withColumn("assessed_amount", money(F.col("assessed_amount") + 1)).withColumn("status", F.lit("F")))
    return tgt, src


@register("merge_upsert", _MERGE_SQL + """
SELECT * FROM tgt WHERE return_id NOT IN (SELECT return_id FROM src) UNION ALL SELECT * FROM src""")
def q_merge_upsert(spark, sf_dir):
    tgt, src = _merge_inputs(B.tables(spark, sf_dir))
    return MRG.load_with_strategy(tgt, src, ["return_id"], "UPSERT")


@register("merge_insert_ignore", _MERGE_SQL + """
SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE return_id NOT IN (SELECT return_id FROM tgt)""")
def q_merge_insert_ignore(spark, sf_dir):
    tgt, src = _merge_inputs(B.tables(spark, sf_dir))
    return MRG.load_with_strategy(tgt, src, ["return_id"], "INSERT")


@register("merge_update", _MERGE_SQL + """
SELECT t.return_id, COALESCE(s.party_id, t.party_id) AS party_id, COALESCE(s.tax_type_code, t.tax_type_code) AS tax_type_code,
  COALESCE(s.period_date, t.period_date) AS period_date, CASE WHEN s.return_id IS NOT NULL THEN s.assessed_amount ELSE t.assessed_amount END AS assessed_amount,
  CASE WHEN s.return_id IS NOT NULL THEN s.status ELSE t.status END AS status, COALESCE(s.due_date, t.due_date) AS due_date
FROM tgt t LEFT JOIN src s ON s.return_id = t.return_id""")
def q_merge_update(spark, sf_dir):
    tgt, src = _merge_inputs(B.tables(spark, sf_dir))
    return MRG.load_with_strategy(tgt, src, ["return_id"], "UPDATE")


# ---------------------------------------------------------------- I16 / I11 hierarchy closure
@register("geography_closure", """
WITH RECURSIVE nodes AS (
  SELECT 'R' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer),
walk(descendant, ancestor, distance) AS (
  SELECT id, id, 0 FROM nodes
  UNION ALL SELECT n.id, n.parent, 1 FROM nodes n WHERE n.parent IS NOT NULL
  UNION ALL SELECT w.descendant, n.parent, w.distance + 1 FROM walk w JOIN nodes n ON n.id = w.ancestor
    WHERE w.distance >= 1 AND n.parent IS NOT NULL AND w.distance < 10 AND w.descendant <> w.ancestor)
SELECT descendant, ancestor, distance, CASE WHEN descendant = ancestor AND distance > 0 THEN 1 ELSE 0 END AS is_cycle FROM walk""")
def q_geography_closure(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    nodes = (t.region.select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("id"), F.lit(None).cast("string").alias("parent"))
             .unionByName(t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("id"),
                                          F.concat(F.lit("R"), F.col("n_regionkey")).alias("parent")))
             .unionByName(t.customer.select(F.concat(F.lit("C"), F.col("c_custkey")).alias("id"),
                                            F.concat(F.lit("N"), F.col("c_nationkey")).alias("parent"))))
    return walk_hierarchy(nodes, "id", "parent")


# ---------------------------------------------------------------- I11 geography dim
@register("dim_geography", """
SELECT CAST(r_regionkey + 1000 AS BIGINT) AS geography_key, CAST(NULL AS BIGINT) AS parent_geography_key, 1 AS hierarchy_level,
  r_name AS level_1_name, CAST(NULL AS VARCHAR) AS level_2_name, CAST(r_regionkey AS VARCHAR) AS full_path_codes,
  r_name AS full_path, 1 AS depth FROM region
UNION ALL
SELECT CAST(n_nationkey AS BIGINT), CAST(n_regionkey + 1000 AS BIGINT), 2, r_name, n_name,
  CAST(r_regionkey AS VARCHAR) || '/' || CAST(n_nationkey AS VARCHAR), concat_ws(' > ', r_name, n_name), 2
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
def q_dim_geography(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return DIM.build_dim_geography(t.region, t.nation)
