"""Registered queries: current taxpayers, registration star queries, party
identifiers, office workload, tax gap and registrations by region."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaestor.functions.strings import normalize_identifier
from quaestor.operators.windows import flag_primary
from quaestor.plans import analytics as M, bindings as B, dims as DIM
from quaestor.plans.catalog import register, sql_pct, sql_round
from quaestor.plans.queries_wh import _SCD_SQL, _geo, _scd, TYPE_CATEGORIES, TYPE_FREQUENCIES
from quaestor.plans.sqlbind import with_


def _registrations(t):
    """A registration = first return of a party for a tax type."""
    r = B.returns(t)
    return r.groupBy("party_id", "tax_type_code").agg(F.min("period_date").alias("registration_date"))


_REG_SQL = with_("returns", "party") + """,
reg AS (SELECT party_id, tax_type_code, MIN(period_date) AS registration_date FROM returns GROUP BY 1, 2)"""


# ---------------------------------------------------------------- M08
@register("current_taxpayers", _SCD_SQL + """
SELECT surrogate_key, party_id, party_name, segment, valid_from, version_number FROM merged WHERE is_current = 1""")
def q_current_taxpayers(spark, sf_dir):
    return M.current_taxpayers(_scd(B.tables(spark, sf_dir)))


# ---------------------------------------------------------------- M09
@register("registrations_by_party_type", _REG_SQL + """
SELECT p.segment AS party_type, r.tax_type_code, COUNT(*) AS registrations, COUNT(DISTINCT r.party_id) AS taxpayers
FROM reg r JOIN party p USING (party_id) GROUP BY 1, 2""")
def q_registrations_by_party_type(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    reg = _registrations(t).join(B.party(t).select("party_id", F.col("segment").alias("party_type")), "party_id")
    return M.registrations_by_type(reg)


@register("registration_trend", _REG_SQL + """
SELECT CAST(year(registration_date) * 10 + quarter(registration_date) AS INTEGER) AS year_quarter, COUNT(*) AS registrations,
  array_to_string(list_sort(list(DISTINCT tax_type_code)), ', ') AS tax_types FROM reg GROUP BY 1""")
def q_registration_trend(spark, sf_dir):
    return M.registration_trend(_registrations(B.tables(spark, sf_dir)))


# ---------------------------------------------------------------- I17 / M17 party identifiers
def _identifiers(t):
    c = t.customer
    tin = c.select(F.col("c_custkey").alias("party_id"), F.lit("TIN").alias("identifier_type"),
                   F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("identifier_value"))
    name = c.select(F.col("c_custkey").alias("party_id"), F.lit("NAME_ID").alias("identifier_type"),
                    F.regexp_replace("c_name", "#", " ").alias("identifier_value"))
    return tin.unionByName(name)


@register("bridge_party_identifier", _SCD_SQL + """,
ids AS (SELECT c_custkey AS party_id, 'TIN' AS identifier_type, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS identifier_value, 1 AS o FROM customer
        UNION ALL SELECT c_custkey, 'NAME_ID', replace(c_name, '#', ' '), 2 FROM customer),
typ AS (SELECT * FROM (VALUES ('TIN', 'Tax identification number', 1), ('NAME_ID', 'Registered name id', 0)) v(identifier_type, type_name, is_tax_id))
SELECT i.identifier_type, i.party_id, i.identifier_value, m.surrogate_key AS party_key, t.type_name, t.is_tax_id,
  upper(replace(i.identifier_value, ' ', '')) AS normalized_value,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY i.party_id ORDER BY t.is_tax_id DESC, i.o) = 1 THEN 1 ELSE 0 END AS is_primary
FROM ids i LEFT JOIN (SELECT * FROM merged WHERE is_current = 1) m USING (party_id) LEFT JOIN typ t USING (identifier_type)""")
def q_bridge_party_identifier(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    parties = _scd(t).withColumnRenamed("surrogate_key", "party_key")
    types = spark.createDataFrame([("TIN", "Tax identification number", 1), ("NAME_ID", "Registered name id", 0)],
                                  "identifier_type string, type_name string, is_tax_id int")
    b = DIM.build_bridge_party_identifier(_identifiers(t), parties, types)
    b = b.withColumn("__o", F.when(F.col("identifier_type") == "TIN", 1).otherwise(2))
    return flag_primary(b, ["party_id"], "is_tax_id", ["__o"]).drop("__o")


@register("party_identifier_lookup", """
SELECT c_custkey AS party_id, 'TIN' AS identifier_type, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS identifier_value,
  upper(replace(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), ' ', '')) AS normalized_value
FROM customer""")
def q_party_identifier_lookup(spark, sf_dir):
    ids = _identifiers(B.tables(spark, sf_dir)).withColumn("normalized_value", normalize_identifier("identifier_value"))
    return M.party_identifier_lookup(ids, "TIN")


# ---------------------------------------------------------------- M26 office workload
@register("office_workload", with_("filings", "party") + """
SELECT r.r_name AS region_name, n.n_name AS nation_name, COUNT(*) AS filings, COUNT(DISTINCT f.party_id) AS taxpayers
FROM filings f JOIN party p USING (party_id) JOIN nation n ON n.n_nationkey = p.nation_key JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY 1, 2""")
def q_office_workload(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return M.office_workload(B.filings(t), B.party(t), _geo(t))


# ---------------------------------------------------------------- M29 tax gap by category
# Estimated compliance-gap percentage per tax category.
GAP_PCT = {"INCOME": 12.5, "CONSUMPTION": 8.0, "OTHER": 5.0}


@register("tax_gap_by_category", with_("returns") + """,
cat AS (SELECT tax_type_code, CASE """ + " ".join(f"WHEN tax_type_code = '{k}' THEN '{v}'" for k, v in TYPE_CATEGORIES.items()) + """ ELSE 'OTHER' END AS tax_category
        FROM (SELECT DISTINCT o_orderpriority AS tax_type_code FROM orders)),
g AS (SELECT c.tax_category, SUM(r.assessed_amount) AS assessed_amount,
        SUM(CAST(r.assessed_amount * CASE c.tax_category """ + " ".join(f"WHEN '{k}' THEN CAST({v / 100} AS DECIMAL(7,4))" for k, v in GAP_PCT.items()) + """ END AS DECIMAL(19,2))) AS estimated_gap
      FROM returns r JOIN cat c USING (tax_type_code) GROUP BY 1)
SELECT *, """ + sql_pct("estimated_gap", "assessed_amount") + """ AS gap_rate FROM g""")
def q_tax_gap_by_category(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    types = DIM.build_dim_tax_type(t.orders, "o_orderpriority", TYPE_CATEGORIES, {})
    gap = F.create_map(*[x for k, v in GAP_PCT.items() for x in (F.lit(k), F.lit(v / 100).cast("decimal(7,4)"))])
    cats = types.select("tax_type_code", "tax_category", F.element_at(gap, F.col("tax_category")).alias("gap_rate"))
    return M.tax_gap_by_category(B.returns(t), cats)


# ---------------------------------------------------------------- M42
@register("registrations_by_region", _REG_SQL + """
SELECT rg.r_name AS region_name, COUNT(DISTINCT (r.party_id, r.tax_type_code)) AS registrations
FROM reg r JOIN party p USING (party_id) JOIN nation n ON n.n_nationkey = p.nation_key JOIN region rg ON rg.r_regionkey = n.n_regionkey
WHERE rg.r_name IN ('EUROPE', 'ASIA') GROUP BY 1""")
def q_registrations_by_region(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return M.registrations_by_region(_registrations(t), B.party(t), _geo(t), ["EUROPE", "ASIA"])


# ---------------------------------------------------------------- C06 role-playing date dimension
from quaestor.operators import joins as JN  # noqa: E402
from quaestor.plans.queries_wh import _SPINE2_SQL, _cal2, _HOL_SQL  # noqa: E402,F401


@register("filing_date_roles", with_("filings") + ", " + _SPINE2_SQL + """
SELECT f.return_id, fd.day_name AS filed_day_name, fd.is_business_day AS filed_is_business_day,
  dd.day_name AS due_day_name, dd.is_business_day AS due_is_business_day
FROM filings f
LEFT JOIN (SELECT full_date, dayname(full_date) AS day_name, is_business_day FROM cal) fd ON fd.full_date = f.filing_date
LEFT JOIN (SELECT full_date, dayname(full_date) AS day_name, is_business_day FROM cal) dd ON dd.full_date = f.due_date""")
def q_filing_date_roles(spark, sf_dir):
    f = B.filings(B.tables(spark, sf_dir))
    cal = _cal2(f)
    out = JN.join_role_playing(f.select("return_id", "filing_date", "due_date"), cal, "full_date",
                               {"filing_date": "filed_", "due_date": "due_"}, ["day_name", "is_business_day"],
                               bounded_dim=True)
    return out.select("return_id", "filed_day_name", "filed_is_business_day", "due_day_name", "due_is_business_day")


# ---------------------------------------------------------------- C05 / C18 current version + scalar subquery
@register("urgent_returns_current_party", _SCD_SQL + """,
tt AS (SELECT tax_type_code, ROW_NUMBER() OVER (ORDER BY tax_type_code) AS tax_type_key
       FROM (SELECT DISTINCT o_orderpriority AS tax_type_code FROM orders)),
r AS (SELECT o_orderkey AS return_id, o_custkey AS party_id, o_orderpriority AS tax_type_code FROM orders),
rk AS (SELECT r.*, tt.tax_type_key FROM r JOIN tt USING (tax_type_code))
SELECT rk.return_id, rk.party_id, m.segment, m.version_number
FROM rk LEFT JOIN (SELECT party_id, segment, version_number FROM merged WHERE is_current = 1) m USING (party_id)
WHERE rk.tax_type_key = (SELECT tax_type_key FROM tt WHERE tax_type_code = '1-URGENT')""")
def q_urgent_returns_current_party(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    types = DIM.build_dim_tax_type(t.orders, "o_orderpriority", TYPE_CATEGORIES, {})
    r = B.returns(t).select("return_id", "party_id", "tax_type_code").join(
        F.broadcast(types.select("tax_type_code", "tax_type_key")), "tax_type_code")
    r = JN.scalar_subquery_filter(r, "tax_type_key", types, "tax_type_code", "1-URGENT", "tax_type_key")
    dim = _scd(t).select("party_id", "segment", "version_number", "is_current")
    return JN.join_composite_current(r, dim, ["party_id"]).select("return_id", "party_id", "segment", "version_number")


# ---------------------------------------------------------------- I31 quarterly risk score snapshot
@register("fact_risk_score", with_("filings") + """,
s AS (SELECT party_id, CAST(date_trunc('quarter', period_date) AS DATE) AS quarter_start,
        """ + sql_pct("SUM(is_late)", "COUNT(*)") + """ AS risk_score FROM filings GROUP BY 1, 2),
j AS (SELECT s.*, q.risk_score AS prior_q_risk_score, y.risk_score AS prior_y_risk_score FROM s
      LEFT JOIN s q ON q.party_id = s.party_id AND CAST(q.quarter_start + INTERVAL 3 MONTH AS DATE) = s.quarter_start
      LEFT JOIN s y ON y.party_id = s.party_id AND CAST(y.quarter_start + INTERVAL 12 MONTH AS DATE) = s.quarter_start)
SELECT *, risk_score - prior_q_risk_score AS score_change_qoq, risk_score - prior_y_risk_score AS score_change_yoy,
  CASE WHEN risk_score >= 61 THEN 1 ELSE 0 END AS is_high_risk,
  CASE WHEN risk_score >= 61 AND COALESCE(prior_q_risk_score, 0) < 61 THEN 1 ELSE 0 END AS is_new_high_risk,
  CAST(risk_score - prior_q_risk_score > 0 AS INTEGER) AS is_increasing,
  CAST(risk_score - prior_q_risk_score < 0 AS INTEGER) AS is_decreasing,
  CASE WHEN prior_q_risk_score IS NULL THEN 1 ELSE 0 END AS is_first_assessment,
  CAST(risk_score - prior_q_risk_score >= 20 AS INTEGER) AS is_large_increase,
  CAST(risk_score - prior_y_risk_score < 0 AS INTEGER) AS is_improved_yoy,
  CASE WHEN risk_score = 0 THEN 1 ELSE 0 END AS is_zero_risk
FROM j""")
def q_fact_risk_score(spark, sf_dir):
    from quaestor.functions.numeric import pct
    from quaestor.plans import facts as FCT
    f = B.filings(B.tables(spark, sf_dir))
    s = f.groupBy("party_id", F.trunc("period_date", "quarter").alias("quarter_start")).agg(
        pct(F.sum("is_late"), F.count(F.lit(1))).alias("risk_score"))
    return FCT.build_fact_risk_score(s)


# ---------------------------------------------------------------- I08 tax period dimension
@register("dim_tax_period", """
WITH t AS (SELECT DISTINCT o_orderpriority AS tax_type_code, """ + " CASE " + " ".join(
    f"WHEN o_orderpriority = '{k}' THEN '{v}'" for k, v in TYPE_FREQUENCIES.items()) + """ ELSE 'ANNUAL' END AS frequency FROM orders),
tk AS (SELECT tax_type_code, ROW_NUMBER() OVER (ORDER BY tax_type_code) AS tax_type_key FROM t),
y AS (SELECT CAST(unnest(range(MIN(year(o_orderdate)), MAX(year(o_orderdate)) + 1)) AS INTEGER) AS year FROM orders),
p AS (SELECT t.*, y.year, CAST(unnest(range(1, CASE frequency WHEN 'MONTHLY' THEN 12 WHEN 'QUARTERLY' THEN 4 ELSE 1 END + 1)) AS INTEGER) AS period_number FROM t, y),
q AS (SELECT *, CASE frequency WHEN 'MONTHLY' THEN make_date(year, period_number, 1)
                  WHEN 'QUARTERLY' THEN make_date(year, (period_number - 1) * 3 + 1, 1) ELSE make_date(year, 4, 1) END AS period_start_date,
               CASE frequency WHEN 'MONTHLY' THEN 1 WHEN 'QUARTERLY' THEN 3 ELSE 12 END AS months FROM p),
r AS (SELECT tax_type_code, frequency, year, period_number, period_start_date,
        CAST(period_start_date + to_months(months) - INTERVAL 1 DAY AS DATE) AS period_end_date FROM q)
SELECT r.tax_type_code, r.frequency, r.year, r.period_number, r.period_start_date, r.period_end_date, tk.tax_type_key,
  CASE WHEN r.period_end_date < DATE '2001-08-01' THEN 'CLOSED' WHEN r.period_start_date > DATE '2001-08-01' THEN 'FUTURE' ELSE 'OPEN' END AS period_status,
  CASE WHEN r.period_end_date < DATE '2001-08-01' THEN 1 ELSE 0 END AS is_closed,
  CASE WHEN r.period_end_date >= DATE '2001-08-01' AND r.period_start_date <= DATE '2001-08-01' THEN 1 ELSE 0 END AS is_current,
  CAST(CASE WHEN r.frequency = 'MONTHLY' THEN quarter(r.period_start_date)
            WHEN r.frequency = 'QUARTERLY' AND r.period_number BETWEEN 1 AND 4 THEN r.period_number END AS INTEGER) AS period_quarter
FROM r LEFT JOIN tk USING (tax_type_code)""")
def q_dim_tax_period(spark, sf_dir):
    from quaestor.plans import calendar as CAL
    from quaestor.plans.queries_wh import TYPE_FREQUENCIES as TF
    t = B.tables(spark, sf_dir)
    types = DIM.build_dim_tax_type(t.orders, "o_orderpriority", TYPE_CATEGORIES, TF)
    years = t.orders.select(F.year("o_orderdate").alias("year"))
    periods = CAL.generate_tax_periods(types, years).drop("period_code", "filing_due_date")
    return DIM.build_dim_tax_period(periods, types, B.AS_OF_ORDERS)


# ---------------------------------------------------------------- I39 account periods (missing filings)
@register("missing_account_periods", _REG_SQL + """,
months AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', MIN(period_date)) AS DATE),
                                               CAST(date_trunc('month', MAX(period_date)) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS period_month
           FROM returns),
cand AS (SELECT r.party_id, r.tax_type_code, m.period_month FROM reg r JOIN months m ON m.period_month >= CAST(date_trunc('month', r.registration_date) AS DATE)),
have AS (SELECT DISTINCT party_id, tax_type_code, CAST(date_trunc('month', period_date) AS DATE) AS period_month FROM returns)
SELECT c.party_id, c.tax_type_code, c.period_month FROM cand c
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.party_id = c.party_id AND h.tax_type_code = c.tax_type_code AND h.period_month = c.period_month)""")
def q_missing_account_periods(spark, sf_dir):
    from quaestor.operators.keys import attach_scalars
    from quaestor.operators.ledger import open_account_periods
    t = B.tables(spark, sf_dir)
    r = B.returns(t)
    hi = r.agg(F.trunc(F.max("period_date"), "month").alias("hi_month"))
    # monthly filers: every registered account has a period each month from registration on
    accounts = attach_scalars(_registrations(t), hi).withColumn("reg_month", F.trunc("registration_date", "month"))
    existing = r.select("party_id", "tax_type_code", F.trunc("period_date", "month").alias("period_month"))
    return open_account_periods(accounts, "reg_month", "hi_month", existing,
                                ["party_id", "tax_type_code", "period_month"])


# ---------------------------------------------------------------- E17 installment split
@register("installment_split", with_("returns") + f""",
a AS (SELECT return_id, assessed_amount, CAST(ROUND(assessed_amount * CAST(0.4 AS DECIMAL(9,6)), 2) AS DECIMAL(19,2)) AS p1 FROM returns),
b AS (SELECT *, CAST(ROUND(CAST(assessed_amount - p1 AS DECIMAL(19,2)) * CAST(0.4 AS DECIMAL(9,6)), 2) AS DECIMAL(19,2)) AS p2 FROM a)
SELECT return_id, assessed_amount, 3 AS n, i AS installment_no,
  CAST(CASE i WHEN 1 THEN p1 WHEN 2 THEN p2 ELSE assessed_amount - p1 - p2 END AS DECIMAL(19,2)) AS installment_amount
FROM b, (VALUES (1), (2), (3)) s(i)""")
def q_installment_split(spark, sf_dir):
    from quaestor.operators.ledger import installment_split
    r = B.returns(B.tables(spark, sf_dir)).select("return_id", "assessed_amount", F.lit(3).alias("n"))
    return installment_split(r, "assessed_amount", "n")


# ---------------------------------------------------------------- I37 ledger postings
from quaestor.plans.queries import _ALLOC_SQL, dated_allocations, _PEN, _INT  # noqa: E402


@register("ledger_postings", with_("filings", "payments") + "," + _ALLOC_SQL.strip().replace("FROM returns", "FROM filings") + f""",
comp AS (SELECT return_id, party_id, period_date, assessed_amount AS principal,
           COALESCE({_PEN}, 0) AS penalty, COALESCE({_INT}, 0) AS interest FROM filings),
deb AS (SELECT CAST(return_id AS VARCHAR) AS source_id, party_id AS account_id, period_date AS txn_date, 'PRINCIPAL' AS charge_type_code,
          CAST(principal AS DECIMAL(19,2)) AS amount, 'DEBIT' AS txn_type FROM comp WHERE principal > 0
        UNION ALL SELECT CAST(return_id AS VARCHAR), party_id, period_date, 'PENALTY', CAST(penalty AS DECIMAL(19,2)), 'DEBIT' FROM comp WHERE penalty > 0
        UNION ALL SELECT CAST(return_id AS VARCHAR), party_id, period_date, 'INTEREST', CAST(interest AS DECIMAL(19,2)), 'DEBIT' FROM comp WHERE interest > 0),
cred AS (SELECT a.payment_id || '/' || CAST(a.return_id AS VARCHAR) AS source_id, a.party_id AS account_id, p.payment_date AS txn_date,
           'PRINCIPAL' AS charge_type_code, CAST(-a.allocated_amount AS DECIMAL(19,2)) AS amount, 'CREDIT' AS txn_type
         FROM alloc a JOIN payments p ON p.payment_id = a.payment_id WHERE a.allocated_amount > 0)
SELECT * FROM deb UNION ALL SELECT * FROM cred""")
def q_ledger_postings(spark, sf_dir):
    from quaestor.operators.ledger import ledger_postings
    from quaestor.plans import facts as FCT
    t = B.tables(spark, sf_dir)
    a = FCT.build_fact_assessment(B.filings(t)).join(B.returns(t).select("return_id", "period_date"), "return_id")
    alloc = dated_allocations(t).select(
        F.concat_ws("/", "payment_id", F.col("return_id").cast("string")).alias("allocation_id"),
        F.col("party_id").alias("account_id"), F.col("payment_date").alias("txn_date"),
        F.lit("PRINCIPAL").alias("charge_type_code"), "allocated_amount")
    out = ledger_postings(a.withColumn("source_id", F.col("return_id").cast("string")), "source_id", "party_id",
                          "period_date", {"PRINCIPAL": "assessed_tax_amount", "PENALTY": "penalty_amount",
                                          "INTEREST": "interest_amount"}, alloc)
    return out.select("source_id", "account_id", "txn_date", "charge_type_code", "amount", "txn_type")
