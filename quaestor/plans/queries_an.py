"""Registered queries: domain analytics (M-ops) and the aggregate/window
operators they exercise."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaestor.functions.numeric import money, pct
from quaestor.operators import aggregates as AGG, ledger as LED, windows as WIN
from quaestor.plans import analytics as M, bindings as B, dims as DIM, facts as FCT
from quaestor.plans.catalog import register, sql_pct, sql_ratio, sql_round
from quaestor.plans.queries import _ALLOC_SQL, _allocations
from quaestor.plans.queries_wh import _geo
from quaestor.plans.sqlbind import with_

_AS_OF = B.AS_OF_ORDERS

_RISK_SQL = f""",
rf AS (SELECT party_id, COUNT(*) AS return_count, SUM(is_late) AS late_filing_count, SUM(is_filed) AS filed_count,
          SUM(assessed_amount) AS total_assessed FROM filings GROUP BY 1),
rb AS (SELECT account_id AS party_id, SUM(amount) AS arrears FROM ledger WHERE txn_date <= DATE '{_AS_OF}' GROUP BY 1),
re AS (SELECT user_id AS party_id, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1),
risk AS (SELECT rf.party_id, rf.return_count, rf.late_filing_count, rf.total_assessed,
          CAST(COALESCE({sql_pct('rf.late_filing_count', 'rf.filed_count')}, 0) AS DECIMAL(5,2)) AS overall_risk_score,
          CAST(COALESCE(rb.arrears, 0) AS DECIMAL(38,2)) AS current_arrears_amount,
          CAST(0 AS DECIMAL(19,2)) AS audit_adjustment_history, CAST(COALESCE(re.n, 0) AS BIGINT) AS third_party_discrepancy_count,
          DATE '{_AS_OF}' AS profile_date
        FROM rf LEFT JOIN rb USING (party_id) LEFT JOIN re USING (party_id))"""


def _risk(t):
    return M.risk_profiles(B.filings(t), B.ledger(t), B.events(t), _AS_OF)


# ---------------------------------------------------------------- I28 / H13
@register("fact_risk_assessment", with_("filings", "ledger") + _RISK_SQL + f"""
SELECT party_id, CAST(strftime(profile_date, '%Y%m%d') AS INTEGER) AS assessment_date_key, overall_risk_score AS risk_score,
  CASE WHEN audit_adjustment_history > 50000 THEN 80 WHEN audit_adjustment_history > 10000 THEN 60
       WHEN audit_adjustment_history > 0 THEN 40 ELSE 15 END AS audit_history_score,
  CASE WHEN third_party_discrepancy_count > 5 THEN 75 WHEN third_party_discrepancy_count > 2 THEN 50
       WHEN third_party_discrepancy_count > 0 THEN 30 ELSE 10 END AS third_party_score,
  0 AS audit_count,
  CASE WHEN overall_risk_score > 60 OR current_arrears_amount > 50000 THEN 1 ELSE 0 END AS is_audit_candidate,
  CASE WHEN overall_risk_score >= 60 THEN 1 ELSE 0 END AS is_high_risk,
  year(profile_date) AS assessment_year, quarter(profile_date) AS assessment_quarter, 'STABLE' AS risk_trend
FROM risk""")
def q_fact_risk_assessment(spark, sf_dir):
    return FCT.build_fact_risk_assessment(_risk(B.tables(spark, sf_dir)))


# ---------------------------------------------------------------- M35 risk profile metrics
@register("risk_profile_metrics", with_("filings", "ledger") + _RISK_SQL + " SELECT * FROM risk")
def q_risk_profile_metrics(spark, sf_dir):
    return _risk(B.tables(spark, sf_dir))


# ---------------------------------------------------------------- M05 / F01 top-k (limit is the feature)
@register("top_risk_balances", with_("filings", "ledger") + _RISK_SQL + """
SELECT party_id, overall_risk_score, current_arrears_amount FROM risk WHERE current_arrears_amount > 0
ORDER BY overall_risk_score DESC, current_arrears_amount DESC, party_id LIMIT 10""")
def q_top_risk_balances(spark, sf_dir):
    from quaestor.operators.select import top_k
    r = _risk(B.tables(spark, sf_dir)).where(F.col("current_arrears_amount") > 0)
    return top_k(r.select("party_id", "overall_risk_score", "current_arrears_amount"),
                 [F.col("overall_risk_score").desc(), F.col("current_arrears_amount").desc(), F.col("party_id")], 10)


# ---------------------------------------------------------------- M04 / C11
_BAL_SQL = """,
g AS (SELECT account_id, last_day(txn_date) AS period_end,
         CAST(COALESCE(SUM(CASE WHEN amount > 0 THEN amount END), 0) AS DECIMAL(38,2)) AS debit_amount,
         CAST(COALESCE(-SUM(CASE WHEN amount < 0 THEN amount END), 0) AS DECIMAL(38,2)) AS credit_amount FROM ledger GROUP BY 1, 2),
bal AS (SELECT *, CAST(SUM(debit_amount - credit_amount) OVER (PARTITION BY account_id ORDER BY period_end ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS closing_balance FROM g)"""


@register("high_risk_taxpayers", with_("party", "filings", "ledger") + _RISK_SQL + _BAL_SQL + """,
dp AS (SELECT party_id, segment AS party_segment,
         CASE WHEN balance <= 0 THEN 'HIGH' WHEN balance <= 1000 THEN 'MEDIUM' WHEN balance IS NOT NULL THEN 'LOW' END AS risk_rating FROM party),
lat AS (SELECT account_id AS party_id, SUM(closing_balance) AS outstanding_balance, SUM(GREATEST(closing_balance, 0)) AS arrears_amount,
          MAX(CASE WHEN closing_balance > 0 THEN 1 ELSE 0 END) AS has_arrears
        FROM bal WHERE period_end = (SELECT MAX(period_end) FROM bal) GROUP BY 1)
SELECT dp.party_id, dp.party_segment, dp.risk_rating, lat.outstanding_balance, lat.arrears_amount, lat.has_arrears, risk.overall_risk_score
FROM dp LEFT JOIN lat USING (party_id) LEFT JOIN risk USING (party_id)
WHERE dp.risk_rating = 'HIGH' OR lat.has_arrears = 1 OR risk.overall_risk_score > 60""")
def q_high_risk_taxpayers(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    led = B.ledger(t).withColumn("period_end", F.last_day("txn_date"))
    bal = FCT.build_fact_account_balance(LED.account_balances(led, ["account_id"], "period_end", "amount"))
    p = DIM.build_dim_party(B.party(t), _geo(t)).select("party_id", "party_segment", "risk_rating")
    out = M.high_risk_taxpayers(p, bal, _risk(t))
    return out.select("party_id", "party_segment", "risk_rating", "outstanding_balance", "arrears_amount", "has_arrears",
                      "overall_risk_score")


# ---------------------------------------------------------------- M07 / D20
@register("segment_analysis", with_("party", "ledger") + f""",
b AS (SELECT account_id AS party_id, SUM(amount) AS balance FROM ledger WHERE txn_date <= DATE '{_AS_OF}' GROUP BY 1),
j AS (SELECT p.party_id, p.segment AS party_segment, CAST(COALESCE(b.balance, 0) AS DECIMAL(38,2)) AS balance FROM party p LEFT JOIN b USING (party_id))
SELECT party_segment, COUNT(DISTINCT party_id) AS taxpayer_count, SUM(balance) AS total_balance,
  COUNT(*) FILTER (WHERE balance > 0) AS taxpayers_with_arrears,
  {sql_ratio('SUM(balance)', 'COUNT(DISTINCT party_id)', 2)} AS avg_balance,
  {sql_pct('COUNT(*) FILTER (WHERE balance > 0)', 'COUNT(DISTINCT party_id)')} AS arrears_rate
FROM j GROUP BY 1""")
def q_segment_analysis(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    p = B.party(t).select("party_id", F.col("segment").alias("party_segment"))
    return M.segment_analysis(p, B.ledger(t), _AS_OF)


# ---------------------------------------------------------------- M31
@register("unpaid_assessments", with_("returns", "payments") + "," + _ALLOC_SQL.strip() + f""",
al AS (SELECT return_id, SUM(allocated_amount) AS allocated FROM alloc WHERE allocated_amount > 0 GROUP BY 1),
o AS (SELECT r.return_id, r.party_id, r.tax_type_code, r.due_date, r.assessed_amount,
        CAST(r.assessed_amount - COALESCE(al.allocated, 0) AS DECIMAL(19,2)) AS outstanding_amount,
        date_diff('day', r.due_date, DATE '{_AS_OF}') AS days_overdue FROM returns r LEFT JOIN al USING (return_id))
SELECT *, CASE WHEN outstanding_amount > 50000 OR days_overdue > 180 THEN 'URGENT'
               WHEN outstanding_amount > 20000 OR days_overdue > 90 THEN 'HIGH'
               WHEN days_overdue > 30 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
  CASE WHEN outstanding_amount > 100000 THEN 'HIGH_VALUE' ELSE 'STANDARD_COLLECTION' END AS case_type,
  CASE WHEN days_overdue < 30 THEN 'NOTICE' WHEN days_overdue < 60 THEN 'DEMAND'
       WHEN days_overdue < 120 THEN 'GARNISHMENT' ELSE 'LEGAL_ACTION' END AS enforcement_level
FROM o WHERE outstanding_amount > 0 AND days_overdue > 0""")
def q_unpaid_assessments(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return M.unpaid_assessments(B.returns(t), _allocations(t), _AS_OF)


# ---------------------------------------------------------------- M32
@register("overpayments", with_("returns", "payments") + """,
p AS (SELECT return_id, SUM(payment_amount) AS total_paid FROM payments GROUP BY 1)
SELECT r.return_id, r.party_id, r.assessed_amount, p.total_paid, p.total_paid - r.assessed_amount AS overpaid_amount
FROM returns r JOIN p USING (return_id) WHERE p.total_paid > r.assessed_amount""")
def q_overpayments(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return M.overpayments(B.returns(t), B.payments(t))


# ---------------------------------------------------------------- M33 (top 12 is the feature)
@register("audit_candidates_by_history", with_("returns") + """,
g AS (SELECT party_id, COUNT(*) AS return_count, SUM(assessed_amount) AS total_assessed FROM returns GROUP BY 1 HAVING COUNT(*) >= 2),
t AS (SELECT *, ROW_NUMBER() OVER (ORDER BY total_assessed DESC, party_id) AS candidate_rank FROM g)
SELECT party_id, return_count, total_assessed, candidate_rank, GREATEST(85 - 5 * (candidate_rank - 1), 40) AS risk_score
FROM t WHERE candidate_rank <= 12""")
def q_audit_candidates_by_history(spark, sf_dir):
    return M.audit_candidates_by_history(B.returns(B.tables(spark, sf_dir)))


# ---------------------------------------------------------------- M10
@register("multi_country_filing", with_("filings", "party") + f"""
, j AS (SELECT f.*, n.n_name AS country_name FROM filings f JOIN party p USING (party_id) JOIN nation n ON n.n_nationkey = p.nation_key)
SELECT country_name, tax_type_code, year(period_date) AS filing_year, COUNT(*) AS filings, SUM(is_on_time) AS on_time,
  SUM(days_late) AS total_days_late, SUM(is_late) AS late,
  {sql_pct('SUM(is_on_time)', 'COUNT(*)')} AS on_time_rate, {sql_ratio('SUM(days_late)', 'SUM(is_late)', 2)} AS avg_days_late
FROM j GROUP BY 1, 2, 3""")
def q_multi_country_filing(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return M.multi_country_filing(B.filings(t), B.party(t), t.nation)


_ASSESS_SQL = None  # assembled below from fact_assessment's SQL


def _assessments(t):
    return FCT.build_fact_assessment(B.filings(t)).join(
        B.returns(t).select("return_id", "due_date"), "return_id")


# ---------------------------------------------------------------- M20 / D12
_OUT = "CAST(assessed_amount + COALESCE({p}, 0) + COALESCE({i}, 0) - COALESCE(paid_amount, 0) AS DECIMAL(19,2))"


def _aging_sql():
    from quaestor.plans.queries import _PEN, _INT
    out = _OUT.format(p=_PEN, i=_INT)
    d = f"date_diff('day', due_date, DATE '{_AS_OF}')"
    return with_("filings") + f""",
x AS (SELECT tax_type_code, due_date, {out} AS outstanding_amount FROM filings)
SELECT tax_type_code, CASE WHEN {d} <= 30 THEN '0-30 days' WHEN {d} <= 90 THEN '31-90 days' WHEN {d} <= 180 THEN '91-180 days'
  WHEN {d} <= 365 THEN '181-365 days' ELSE 'Over 1 year' END AS aging_bucket,
  COUNT(*) AS assessment_count, SUM(outstanding_amount) AS outstanding_amount
FROM x WHERE outstanding_amount > 0 GROUP BY 1, 2"""


@register("outstanding_aging", _aging_sql())
def q_outstanding_aging(spark, sf_dir):
    return M.outstanding_aging(_assessments(B.tables(spark, sf_dir)), _AS_OF)


# ---------------------------------------------------------------- M23 / D08
@register("compliance_event_analytics", with_("party", "ev") + """,
per AS (SELECT event_type, party_id, COUNT(*) AS n FROM ev GROUP BY 1, 2),
g AS (SELECT event_type, SUM(n) AS event_count, COUNT(*) AS parties_affected, COUNT(*) FILTER (WHERE n >= 20) AS repeat_offenders FROM per GROUP BY 1)
SELECT g.*, """ + sql_pct("parties_affected", "(SELECT COUNT(*) FROM party)") + """ AS coverage_pct FROM g""")
def q_compliance_event_analytics(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return M.compliance_event_analytics(B.events(t), B.party(t))


# ---------------------------------------------------------------- D05 pivot by charge type
@register("charge_type_pivot", with_("return_lines") + """
SELECT return_id,
  COALESCE(SUM(CASE WHEN charge_type_code = 'A' THEN line_amount END), 0) AS charge_a,
  COALESCE(SUM(CASE WHEN charge_type_code = 'N' THEN line_amount END), 0) AS charge_n,
  COALESCE(SUM(CASE WHEN charge_type_code = 'R' THEN line_amount END), 0) AS charge_r
FROM return_lines GROUP BY 1""")
def q_charge_type_pivot(spark, sf_dir):
    return AGG.pivot_codes(B.return_lines(B.tables(spark, sf_dir)), ["return_id"], "charge_type_code", "line_amount",
                           ["A", "N", "R"], prefix="charge_")


# ---------------------------------------------------------------- I18 / G03 / E06 / E07 / M18
@register("bridge_charge_split", with_("return_lines") + f""",
w AS (SELECT return_id,
  SUM(CASE WHEN charge_type_code = 'A' THEN line_amount END) AS a, SUM(CASE WHEN charge_type_code = 'N' THEN line_amount END) AS n,
  SUM(CASE WHEN charge_type_code = 'R' THEN line_amount END) AS r FROM return_lines GROUP BY 1),
u AS (SELECT return_id, 'ACCEPTED' AS account_type, CAST(a AS DECIMAL(19,2)) AS amount, 0 AS o FROM w
      UNION ALL SELECT return_id, 'NONE', CAST(n AS DECIMAL(19,2)), 1 FROM w
      UNION ALL SELECT return_id, 'RETURNED', CAST(r AS DECIMAL(19,2)), 2 FROM w),
v AS (SELECT * FROM u WHERE amount IS NOT NULL AND amount > 0),
s AS (SELECT v.*, SUM(amount) OVER (PARTITION BY return_id) AS tot,
         ROW_NUMBER() OVER (PARTITION BY return_id ORDER BY amount DESC, o) AS rk FROM v)
SELECT return_id, account_type, amount, {sql_ratio('amount', 'tot', 2, 100.0)} AS allocation_pct,
  CASE WHEN rk = 1 THEN 1 ELSE 0 END AS is_primary FROM s""")
def q_bridge_charge_split(spark, sf_dir):
    w = AGG.pivot_codes(B.return_lines(B.tables(spark, sf_dir)), ["return_id"], "charge_type_code", "line_amount",
                        ["A", "N", "R"], prefix="charge_", fill_zero=False)
    return DIM.build_bridge_amount_split(w, ["return_id"], {"charge_a": "ACCEPTED", "charge_n": "NONE",
                                                            "charge_r": "RETURNED"})


# ---------------------------------------------------------------- D10 median
@register("median_assessment_by_type", with_("returns") + """
SELECT tax_type_code, percentile_cont(0.5) WITHIN GROUP (ORDER BY CAST(assessed_amount AS DOUBLE)) AS median_value FROM returns GROUP BY 1""")
def q_median_assessment_by_type(spark, sf_dir):
    return AGG.median(B.returns(B.tables(spark, sf_dir)), ["tax_type_code"], "assessed_amount")


# ---------------------------------------------------------------- D09 collected values
@register("party_tax_types", with_("returns") + """
SELECT party_id, array_to_string(list_sort(list(DISTINCT tax_type_code)), ', ') AS tax_types FROM returns GROUP BY 1""")
def q_party_tax_types(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir)).select("party_id", "tax_type_code").distinct()
    return AGG.collect_values(r, ["party_id"], "tax_type_code", "tax_types")


# ---------------------------------------------------------------- D13 count by level (rollup)
@register("taxpayers_by_region", with_("party") + """
SELECT r.r_name AS region_name, n.n_name AS nation_name, COUNT(*) AS taxpayers,
  CASE WHEN GROUPING(n.n_name) = 1 AND GROUPING(r.r_name) = 1 THEN 0 WHEN GROUPING(n.n_name) = 1 THEN 1 ELSE 2 END AS hierarchy_level
FROM party p JOIN nation n ON n.n_nationkey = p.nation_key JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY ROLLUP (r.r_name, n.n_name)""")
def q_taxpayers_by_region(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    j = B.party(t).join(F.broadcast(_geo(t)), "nation_key")
    return (j.rollup("region_name", "nation_name")
            .agg(F.count(F.lit(1)).alias("taxpayers"),
                 (F.grouping("region_name") + F.grouping("nation_name")).alias("__g"))
            .withColumn("hierarchy_level", (F.lit(2) - F.col("__g")).cast("int")).drop("__g"))


# ---------------------------------------------------------------- D15 partial states / J03
@register("event_state_summary", with_("ev") + f"""
SELECT party_id, COUNT(*) AS state_count, SUM(event_value) AS state_sum, MAX(event_value) AS state_max,
  {sql_ratio('SUM(event_value)', 'COUNT(*)', 2)} AS state_avg FROM ev GROUP BY 1""")
def q_event_state_summary(spark, sf_dir):
    e = B.events(B.tables(spark, sf_dir))
    # partial states per day merged into per-party states (the mergeable form)
    daily = AGG.partial_state(e, ["party_id", "event_date"], "event_value")
    return AGG.merge_states(daily, ["party_id"])


# ---------------------------------------------------------------- E12 percentile rank
@register("balance_percentile_by_segment", with_("party") + f"""
SELECT party_id, segment, balance, {sql_round('100.0 * PERCENT_RANK() OVER (PARTITION BY segment ORDER BY balance)', 2)} AS percentile_rank
FROM party""")
def q_balance_percentile_by_segment(spark, sf_dir):
    p = B.party(B.tables(spark, sf_dir)).select("party_id", "segment", "balance")
    return WIN.percentile_rank(p, ["segment"], "balance")


# ---------------------------------------------------------------- C08 overlap
@register("overlapping_periods", with_("returns") + """,
x AS (SELECT party_id, tax_type_code, return_id, period_date AS start_date, CAST(period_date + 30 AS DATE) AS end_date FROM returns),
y AS (SELECT *, MAX(end_date) OVER (PARTITION BY party_id, tax_type_code ORDER BY start_date, return_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_prior_end FROM x)
SELECT *, CASE WHEN start_date <= max_prior_end THEN 1 ELSE 0 END AS overlaps_previous FROM y""")
def q_overlapping_periods(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir)).select("party_id", "tax_type_code", "return_id",
                                                  F.col("period_date").alias("start_date"),
                                                  F.date_add("period_date", 30).alias("end_date"))
    return WIN.overlap_flags(r, ["party_id", "tax_type_code"], "start_date", "end_date", "return_id",
                             chunk=F.year("start_date"))


# ---------------------------------------------------------------- E20 consecutive threshold
@register("consecutive_high_months", with_("returns") + """,
m AS (SELECT party_id, CAST(year(period_date) * 12 + month(period_date) - 1 AS INTEGER) AS month_index, SUM(assessed_amount) AS amt
      FROM returns GROUP BY 1, 2),
q AS (SELECT *, month_index - ROW_NUMBER() OVER (PARTITION BY party_id ORDER BY month_index) AS island FROM m WHERE amt > 100000)
SELECT party_id, MIN(month_index) AS run_start, MAX(month_index) AS run_end, COUNT(*) AS run_length
FROM q GROUP BY party_id, island HAVING COUNT(*) >= 2""")
def q_consecutive_high_months(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    m = r.groupBy("party_id", (F.year("period_date") * 12 + F.month("period_date") - 1).cast("int").alias("month_index")) \
        .agg(F.sum("assessed_amount").alias("amt"))
    return WIN.gaps_and_islands(m, ["party_id"], "month_index", F.col("amt") > 100000, 2)


# ---------------------------------------------------------------- E04 / C07 balance change vs prior month
@register("balance_change", with_("ledger") + _BAL_SQL + """
SELECT account_id, period_end, closing_balance,
  LAG(closing_balance) OVER (PARTITION BY account_id ORDER BY period_end) AS prev_closing_balance,
  closing_balance - LAG(closing_balance) OVER (PARTITION BY account_id ORDER BY period_end) AS change,
  p.prior_closing_balance
FROM bal LEFT JOIN (SELECT account_id AS pa, CAST(period_end + INTERVAL 1 MONTH AS DATE) AS pe, closing_balance AS prior_closing_balance FROM bal) p
  ON p.pa = bal.account_id AND last_day(p.pe) = bal.period_end""")
def q_balance_change(spark, sf_dir):
    led = B.ledger(B.tables(spark, sf_dir)).withColumn("period_end", F.last_day("txn_date"))
    bal = LED.account_balances(led, ["account_id"], "period_end", "amount").select("account_id", "period_end",
                                                                                  "closing_balance")
    out = WIN.lag_change(bal, ["account_id"], "period_end", "closing_balance", "change", "prev_closing_balance")
    prev = bal.select(F.col("account_id").alias("pa"), F.last_day(F.add_months("period_end", 1)).alias("pe"),
                      F.col("closing_balance").alias("prior_closing_balance"))
    return out.join(prev, (out["account_id"] == prev["pa"]) & (out["period_end"] == prev["pe"]), "left").drop("pa", "pe")


# ---------------------------------------------------------------- M36 progressive tax
# Demonstration bracket schedule (from, to, rate %).
BRACKETS = [(0, 100000, 0.0), (100000, 250000, 6.0), (250000, 400000, 12.0), (400000, None, 18.0)]


@register("progressive_tax", with_("returns") + """
SELECT return_id, assessed_amount,
  """ + sql_round("""(GREATEST(LEAST(assessed_amount, 100000) - 0, 0) * 0.0 + GREATEST(LEAST(assessed_amount, 250000) - 100000, 0) * 6.0
       + GREATEST(LEAST(assessed_amount, 400000) - 250000, 0) * 12.0 + GREATEST(assessed_amount - 400000, 0) * 18.0) / 100""", 2, 19) + """ AS bracket_tax
FROM returns""")
def q_progressive_tax(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    return r.select("return_id", "assessed_amount", LED.progressive_tax("assessed_amount", BRACKETS).alias("bracket_tax"))


# ---------------------------------------------------------------- M38 accrue interest
RATE_PERIODS = [("1990-01-01", "2000-01-01", 12.0), ("2000-01-01", None, 9.0)]


def _interest_sql(principal, start, end):
    p1 = (f"GREATEST(date_diff('day', GREATEST({start}, DATE '1990-01-01'), LEAST({end}, DATE '2000-01-01')), 0) * "
          f"CAST({12.0 / 100.0 / 365.0!r} AS DOUBLE)")
    p2 = (f"GREATEST(date_diff('day', GREATEST({start}, DATE '2000-01-01'), {end}), 0) * "
          f"CAST({9.0 / 100.0 / 365.0!r} AS DOUBLE)")
    return sql_round(f"CAST({principal} AS DOUBLE) * ({p1} + {p2})", 2, 19)


@register("accrued_interest", with_("returns", "payments") + "," + _ALLOC_SQL.strip() + f""",
al AS (SELECT return_id, SUM(allocated_amount) AS allocated FROM alloc WHERE allocated_amount > 0 GROUP BY 1),
o AS (SELECT r.return_id, r.due_date, CAST(r.assessed_amount - COALESCE(al.allocated, 0) AS DECIMAL(19,2)) AS outstanding_amount
      FROM returns r LEFT JOIN al USING (return_id))
SELECT return_id, outstanding_amount, {_interest_sql('outstanding_amount', 'due_date', f"DATE '{_AS_OF}'")} AS accrued_interest
FROM o WHERE outstanding_amount > 0""")
def q_accrued_interest(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    u = M.unpaid_assessments(B.returns(t), _allocations(t), "9999-12-31").select("return_id", "due_date",
                                                                                 "outstanding_amount")
    return u.select("return_id", "outstanding_amount",
                    LED.accrue_interest("outstanding_amount", "due_date", F.lit(_AS_OF).cast("date"), RATE_PERIODS)
                    .alias("accrued_interest"))


# ---------------------------------------------------------------- E18 installment schedule
@register("installment_schedule", with_("returns") + f""",
p AS (SELECT return_id, assessed_amount, CAST(date_trunc('month', due_date) AS DATE) AS start_date,
        CASE WHEN assessed_amount > 300000 THEN 6 ELSE 3 END AS n FROM returns),
x AS (SELECT p.*, CAST(unnest(range(1, n + 1)) AS INTEGER) AS installment_no FROM p)
SELECT return_id, assessed_amount, start_date, n, installment_no,
  CAST(start_date + to_months(installment_no - 1) AS DATE) AS due_date,
  CAST(CASE WHEN installment_no = n THEN assessed_amount - {sql_round('CAST(assessed_amount AS DOUBLE) / n', 2, 19)} * (n - 1)
            ELSE {sql_round('CAST(assessed_amount AS DOUBLE) / n', 2, 19)} END AS DECIMAL(19,2)) AS installment_amount
FROM x""")
def q_installment_schedule(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    p = r.select("return_id", "assessed_amount", F.trunc("due_date", "month").alias("start_date"),
                 F.when(F.col("assessed_amount") > 300000, 6).otherwise(3).alias("n"))
    return LED.installment_schedule(p, "assessed_amount", "n", "start_date", 1)


# ---------------------------------------------------------------- M43 withholding measures / M37 reconciliation
@register("withholding_reconciliation", with_("payments", "returns") + """,
m AS (SELECT party_id, year(payment_date) AS tax_year, month(payment_date) AS m, SUM(payment_amount) AS monthly FROM payments GROUP BY 1, 2, 3),
y AS (SELECT party_id, tax_year, SUM(monthly) AS monthly_total, COUNT(*) AS months_reported FROM m GROUP BY 1, 2),
a AS (SELECT party_id, year(period_date) AS tax_year, SUM(assessed_amount) AS annual_liability FROM returns GROUP BY 1, 2)
SELECT COALESCE(y.party_id, a.party_id) AS party_id, COALESCE(y.tax_year, a.tax_year) AS tax_year,
  CAST(COALESCE(y.monthly_total, 0) AS DECIMAL(38,2)) AS monthly_total, COALESCE(y.months_reported, 0) AS months_reported,
  CAST(COALESCE(a.annual_liability, 0) AS DECIMAL(38,2)) AS annual_liability,
  CAST(COALESCE(a.annual_liability, 0) - COALESCE(y.monthly_total, 0) AS DECIMAL(38,2)) AS difference
FROM y FULL OUTER JOIN a ON a.party_id = y.party_id AND a.tax_year = y.tax_year""")
def q_withholding_reconciliation(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    p, r = B.payments(t), B.returns(t)
    m = p.groupBy("party_id", F.year("payment_date").alias("tax_year"), F.month("payment_date").alias("m")) \
        .agg(F.sum("payment_amount").alias("monthly"))
    y = m.groupBy("party_id", "tax_year").agg(F.sum("monthly").alias("monthly_total"),
                                              F.count(F.lit(1)).alias("months_reported"))
    a = r.groupBy("party_id", F.year("period_date").alias("tax_year")).agg(F.sum("assessed_amount").alias("annual_liability"))
    j = y.join(a, ["party_id", "tax_year"], "full_outer")
    w = "decimal(38,2)"
    return j.select("party_id", "tax_year", F.coalesce("monthly_total", F.lit(0)).cast(w).alias("monthly_total"),
                    F.coalesce("months_reported", F.lit(0)).alias("months_reported"),
                    F.coalesce("annual_liability", F.lit(0)).cast(w).alias("annual_liability"),
                    (F.coalesce("annual_liability", F.lit(0)) - F.coalesce("monthly_total", F.lit(0))).cast(w).alias("difference"))


# ---------------------------------------------------------------- M43
@register("withholding_measures", with_("return_lines") + f"""
SELECT return_id, line_number, part_id, supplier_id, line_amount AS gross_amount,
  CAST(line_amount * tax_rate AS DECIMAL(19,2)) AS benefits_amount,
  CAST(line_amount * discount AS DECIMAL(19,2)) AS deductions_amount,
  CAST(line_amount + CAST(line_amount * tax_rate AS DECIMAL(19,2)) - CAST(line_amount * discount AS DECIMAL(19,2)) AS DECIMAL(19,2)) AS taxable_amount,
  {sql_pct('CAST(line_amount * tax_rate AS DECIMAL(19,2))', 'line_amount + CAST(line_amount * tax_rate AS DECIMAL(19,2)) - CAST(line_amount * discount AS DECIMAL(19,2))')} AS effective_rate
FROM return_lines""")
def q_withholding_measures(spark, sf_dir):
    l_ = B.return_lines(B.tables(spark, sf_dir))
    b = money(F.col("line_amount") * F.col("tax_rate"))
    d = money(F.col("line_amount") * F.col("discount"))
    out = l_.select("return_id", "line_number", "part_id", "supplier_id", F.col("line_amount").alias("gross_amount"),
                    b.alias("benefits_amount"), d.alias("deductions_amount"))
    out = out.withColumn("taxable_amount", money(F.col("gross_amount") + F.col("benefits_amount") - F.col("deductions_amount")))
    return out.withColumn("effective_rate", pct("benefits_amount", "taxable_amount"))


# ---------------------------------------------------------------- M41 filing due dates
# Due-date rule per tax type (months after period end, due day).
DUE_RULES = {"1-URGENT": (1, 15), "2-HIGH": (1, 20), "3-MEDIUM": (2, 31), "4-NOT SPECIFIED": (3, 30), "5-LOW": (6, 30)}


@register("filing_due_dates", with_("returns") + """,
x AS (SELECT return_id, tax_type_code, period_date,
   CASE tax_type_code """ + " ".join(f"WHEN '{k}' THEN {v[0]}" for k, v in DUE_RULES.items()) + """ END AS months_after,
   CASE tax_type_code """ + " ".join(f"WHEN '{k}' THEN {v[1]}" for k, v in DUE_RULES.items()) + """ END AS due_day FROM returns),
y AS (SELECT *, CAST(date_trunc('month', period_date) + to_months(months_after) AS DATE) AS m FROM x)
SELECT return_id, tax_type_code, period_date, LEAST(CAST(m + (due_day - 1) AS DATE), last_day(m)) AS scheme_due_date FROM y""")
def q_filing_due_dates(spark, sf_dir):
    from quaestor.functions.dates import due_date_after
    r = B.returns(B.tables(spark, sf_dir))
    ma = F.create_map(*[x for k, v in DUE_RULES.items() for x in (F.lit(k), F.lit(v[0]))])
    dd = F.create_map(*[x for k, v in DUE_RULES.items() for x in (F.lit(k), F.lit(v[1]))])
    due = due_date_after("period_date", F.element_at(ma, F.col("tax_type_code")), F.element_at(dd, F.col("tax_type_code")))
    return r.select("return_id", "tax_type_code", "period_date", due.alias("scheme_due_date"))
