"""Registered queries: form jobs (N01-N05), allocation variants (E19, M40),
penalties (M39), monthly rollups (D16, D17), rule packs (L22-L33), JSON
columns (H14), interval membership (C09) and further analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaestor.functions.numeric import money, pct
from quaestor.functions.semistructured import json_field
from quaestor.operators import checks as CHK, dq as DQ, joins as JN, ledger as LED
from quaestor.operators.hierarchy import derive_hierarchy_level
from quaestor.plans import bindings as B, forms as FRM, snapshots as SNAP
from quaestor.plans.catalog import register, sql_pct, sql_ratio, sql_round
from quaestor.plans.sqlbind import with_

_AS_OF = B.AS_OF_ORDERS

# The demonstration form (a return with line items).
FORM_TAX_RATE = 0.15
FORM_FORMULAS = {
    "taxable_income": "GREATEST(gross_income - deductions, 0)",
    "tax_due": f"CAST(FLOOR(CAST(taxable_income AS DOUBLE) * {FORM_TAX_RATE} * 100.0 + 0.5) / 100.0 AS DECIMAL(19,2))",
    "tax_credits": "LEAST(credit_base, tax_due)",
    "tax_payable": "tax_due - tax_credits",
    "refund_claim": "CASE WHEN tax_payable < 0 THEN -tax_payable ELSE 0 END",
}


def _form(t):
    lines = B.return_lines(t)
    parent = B.returns(t).select("return_id", "party_id", "tax_type_code", "period_date", "assessed_amount", "status")
    agg = FRM.form_formulas_agg(parent, lines, "return_id", {
        "gross_income": F.sum("line_amount"),
        "deductions": F.sum(money(F.col("line_amount") * F.col("discount"))),
        "credit_base": F.sum(money(F.col("line_amount") * F.col("tax_rate"))),
        "line_count": F.count(F.lit(1)),
        "distinct_parts": F.countDistinct("part_id")})
    agg = agg.fillna(0, ["gross_income", "deductions", "credit_base", "line_count", "distinct_parts"])
    return FRM.form_formulas_row(agg, FORM_FORMULAS, ["taxable_income", "tax_credits", "tax_payable", "refund_claim"])


_FORM_SQL = with_("return_lines", "returns") + f""",
a AS (SELECT return_id, SUM(line_amount) AS gross_income, SUM(CAST(line_amount * discount AS DECIMAL(19,2))) AS deductions,
        SUM(CAST(line_amount * tax_rate AS DECIMAL(19,2))) AS credit_base, COUNT(*) AS line_count, COUNT(DISTINCT part_id) AS distinct_parts
      FROM return_lines GROUP BY 1),
f0 AS (SELECT r.return_id, r.party_id, r.tax_type_code, r.period_date, r.assessed_amount, r.status,
        COALESCE(a.gross_income, 0) AS gross_income, COALESCE(a.deductions, 0) AS deductions, COALESCE(a.credit_base, 0) AS credit_base,
        COALESCE(a.line_count, 0) AS line_count, COALESCE(a.distinct_parts, 0) AS distinct_parts
       FROM returns r LEFT JOIN a USING (return_id)),
f1 AS (SELECT *, CAST(GREATEST(gross_income - deductions, 0) AS DECIMAL(19,2)) AS taxable_income FROM f0),
f2 AS (SELECT *, CAST(FLOOR(CAST(taxable_income AS DOUBLE) * {FORM_TAX_RATE} * 100.0 + 0.5) / 100.0 AS DECIMAL(19,2)) AS tax_due FROM f1),
f3 AS (SELECT *, CAST(LEAST(credit_base, tax_due) AS DECIMAL(19,2)) AS tax_credits FROM f2),
f4 AS (SELECT *, CAST(tax_due - tax_credits AS DECIMAL(19,2)) AS tax_payable FROM f3),
form AS (SELECT *, CAST(CASE WHEN tax_payable < 0 THEN -tax_payable ELSE 0 END AS DECIMAL(19,2)) AS refund_claim FROM f4)
"""


# ---------------------------------------------------------------- N02 / N03
@register("form_formulas", _FORM_SQL + "SELECT * FROM form")
def q_form_formulas(spark, sf_dir):
    return _form(B.tables(spark, sf_dir))


# ---------------------------------------------------------------- N05
@register("form_calc_check", _FORM_SQL + """
SELECT return_id, assessed_amount, gross_income, CAST(assessed_amount - gross_income AS DECIMAL(19,2)) AS calc_difference
FROM form WHERE ABS(assessed_amount - gross_income) > 1000""")
def q_form_calc_check(spark, sf_dir):
    f = _form(B.tables(spark, sf_dir)).select("return_id", "assessed_amount", "gross_income")
    return FRM.form_calc_check(f, "assessed_amount", F.col("gross_income"), 1000)


FORM_RULES = [
    {"code": "F_RANGE_TAX", "type": "range", "field": "tax_due", "min": 0, "max": 500000},
    {"code": "F_CODE_TYPE", "type": "codelist", "field": "tax_type_code",
     "values": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]},
    {"code": "F_CMP_DED", "type": "comparison", "field": "deductions", "expression": "deductions <= gross_income"},
    {"code": "F_COND_LINES", "type": "conditional", "field": "line_count",
     "expression": "CASE WHEN status = 'F' THEN line_count > 0 ELSE TRUE END", "severity": "WARNING", "action": "FLAG"},
    {"code": "F_XF_PAYABLE", "type": "cross_field", "field": "tax_payable", "expression": "tax_payable = tax_due - tax_credits"},
    {"code": "F_DATE_PERIOD", "type": "date_logic", "field": "period_date",
     "expression": f"period_date <= DATE'{_AS_OF}'"},
    {"code": "F_UNIQUE_RETURN", "type": "uniqueness", "fields": ["return_id"]},
    {"code": "F_PATTERN_STATUS", "type": "pattern", "field": "status", "pattern": "[FO]$", "severity": "WARNING",
     "action": "FLAG"},
]


# ---------------------------------------------------------------- N01
@register("form_rule_outcomes", _FORM_SQL + f"""
SELECT rule_code, rule_type, severity, action, COUNT(*) AS violation_count FROM (
  SELECT 'F_RANGE_TAX' AS rule_code, 'RANGE' AS rule_type, 'ERROR' AS severity, 'REJECT' AS action FROM form WHERE tax_due < 0 OR tax_due > 500000
  UNION ALL SELECT 'F_CODE_TYPE', 'ALLOWED_VALUES', 'ERROR', 'REJECT' FROM form WHERE tax_type_code NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
  UNION ALL SELECT 'F_CMP_DED', 'CUSTOM', 'ERROR', 'REJECT' FROM form WHERE NOT COALESCE(deductions <= gross_income, TRUE)
  UNION ALL SELECT 'F_COND_LINES', 'CUSTOM', 'WARNING', 'FLAG' FROM form WHERE NOT COALESCE(CASE WHEN status = 'F' THEN line_count > 0 ELSE TRUE END, TRUE)
  UNION ALL SELECT 'F_XF_PAYABLE', 'CUSTOM', 'ERROR', 'REJECT' FROM form WHERE NOT COALESCE(tax_payable = tax_due - tax_credits, TRUE)
  UNION ALL SELECT 'F_DATE_PERIOD', 'CUSTOM', 'ERROR', 'REJECT' FROM form WHERE NOT COALESCE(period_date <= DATE '{_AS_OF}', TRUE)
  UNION ALL SELECT 'F_UNIQUE_RETURN', 'UNIQUE', 'ERROR', 'REJECT' FROM form WHERE return_id IN (SELECT return_id FROM form GROUP BY 1 HAVING COUNT(*) > 1)
  UNION ALL SELECT 'F_PATTERN_STATUS', 'PATTERN', 'WARNING', 'FLAG' FROM form WHERE status IS NOT NULL AND NOT regexp_matches(status, '^(?:[FO]$)')
) v GROUP BY 1, 2, 3, 4""")
def q_form_rule_outcomes(spark, sf_dir):
    ann = FRM.form_rules(_form(B.tables(spark, sf_dir)), FORM_RULES, _AS_OF)
    return DQ.rule_outcomes(ann, []).drop("rows_affected")


# ---------------------------------------------------------------- N04 conditional sums per member
@register("form_conditional_sums", with_("return_lines") + """
SELECT return_id,
  COALESCE(SUM(CASE WHEN line_status = 'O' THEN line_amount END), 0) AS sum_o,
  COALESCE(SUM(CASE WHEN line_status = 'F' THEN line_amount END), 0) AS sum_f
FROM return_lines GROUP BY 1""")
def q_form_conditional_sums(spark, sf_dir):
    return FRM.form_formula_conditional_sum(B.return_lines(B.tables(spark, sf_dir)), "return_id", "line_amount",
                                            "line_status", ["O", "F"])


# ---------------------------------------------------------------- E19 loss utilization (FIFO)
_LOSS_SQL = with_("returns") + """,
m AS (SELECT party_id, CAST(date_trunc('month', period_date) AS DATE) AS period_month,
        SUM(CASE WHEN status = 'F' THEN assessed_amount ELSE 0 END) AS profit,
        SUM(CASE WHEN status = 'P' THEN assessed_amount ELSE 0 END) AS loss FROM returns GROUP BY 1, 2),
l AS (SELECT party_id, period_month AS loss_period, loss AS amt,
        SUM(loss) OVER (PARTITION BY party_id ORDER BY period_month ROWS UNBOUNDED PRECEDING) AS e FROM m WHERE loss > 0),
p AS (SELECT party_id, period_month AS profit_period, profit AS amt,
        SUM(profit) OVER (PARTITION BY party_id ORDER BY period_month ROWS UNBOUNDED PRECEDING) AS e FROM m WHERE profit > 0)
SELECT l.party_id, l.loss_period, p.profit_period,
  CAST(LEAST(l.e, p.e) - GREATEST(l.e - l.amt, p.e - p.amt) AS DECIMAL(19,2)) AS allocated_amount
FROM l JOIN p ON l.party_id = p.party_id AND l.e - l.amt < p.e AND p.e - p.amt < l.e
WHERE CAST(LEAST(l.e, p.e) - GREATEST(l.e - l.amt, p.e - p.amt) AS DECIMAL(19,2)) > 0"""


@register("loss_utilization", _LOSS_SQL)
def q_loss_utilization(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    m = r.groupBy("party_id", F.trunc("period_date", "month").alias("period_month")).agg(
        F.sum(F.when(F.col("status") == "F", F.col("assessed_amount")).otherwise(F.lit(0))).alias("profit"),
        F.sum(F.when(F.col("status") == "P", F.col("assessed_amount")).otherwise(F.lit(0))).alias("loss"))
    losses = m.select("party_id", F.col("period_month").alias("loss_period"), "loss")
    profits = m.select("party_id", F.col("period_month").alias("profit_period"), "profit")
    # Losses (supply) are used oldest first against later profits (demand).
    return LED.allocate(profits, losses, ["party_id"], "profit_period", ["profit_period"], "profit",
                        "loss_period", ["loss_period"], "loss").select("party_id", "loss_period", "profit_period",
                                                                       "allocated_amount")


# ---------------------------------------------------------------- M40 refund offset
@register("refund_offsets", with_("returns", "payments") + """,
pay AS (SELECT return_id, SUM(payment_amount) AS paid FROM payments GROUP BY 1),
bal AS (SELECT r.party_id, r.return_id, r.due_date, CAST(r.assessed_amount - COALESCE(p.paid, 0) AS DECIMAL(19,2)) AS balance
        FROM returns r LEFT JOIN pay p USING (return_id)),
ref AS (SELECT party_id, return_id AS refund_id, -balance AS amt,
          SUM(-balance) OVER (PARTITION BY party_id ORDER BY due_date, return_id ROWS UNBOUNDED PRECEDING) AS e FROM bal WHERE balance < 0),
debt AS (SELECT party_id, return_id AS debt_id, balance AS amt,
          SUM(balance) OVER (PARTITION BY party_id ORDER BY due_date, return_id ROWS UNBOUNDED PRECEDING) AS e FROM bal WHERE balance > 0)
SELECT d.party_id, d.debt_id, r.refund_id, CAST(LEAST(d.e, r.e) - GREATEST(d.e - d.amt, r.e - r.amt) AS DECIMAL(19,2)) AS offset_amount
FROM debt d JOIN ref r ON d.party_id = r.party_id AND d.e - d.amt < r.e AND r.e - r.amt < d.e
WHERE LEAST(d.e, r.e) - GREATEST(d.e - d.amt, r.e - r.amt) > 0""")
def q_refund_offsets(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    paid = B.payments(t).groupBy("return_id").agg(F.sum("payment_amount").alias("paid"))
    bal = B.returns(t).join(paid, "return_id", "left").select(
        "party_id", "return_id", "due_date",
        money(F.col("assessed_amount") - F.coalesce(F.col("paid"), F.lit(0))).alias("balance"))
    refunds = bal.where(F.col("balance") < 0).select("party_id", F.col("return_id").alias("refund_id"), "due_date",
                                                     (-F.col("balance")).alias("amount"))
    debts = bal.where(F.col("balance") > 0).select("party_id", F.col("return_id").alias("debt_id"), "due_date",
                                                   F.col("balance").alias("amount"))
    out = LED.allocate(debts, refunds, ["party_id"], "debt_id", ["due_date"], "amount", "refund_id", ["due_date"], "amount")
    return out.withColumnRenamed("allocated_amount", "offset_amount")


# ---------------------------------------------------------------- M39 penalties by method
# Penalty method per tax type (method, fixed amount, rate).
PENALTY_METHODS = {"1-URGENT": ("PCT_OF_TAX", 0, 5.0), "2-HIGH": ("FIXED", 500, 0.0), "3-MEDIUM": ("DAILY", 0, 10.0),
                   "4-NOT SPECIFIED": ("PROGRESSIVE", 0, 2.0), "5-LOW": ("PCT_OF_TURNOVER", 0, 0.5)}


def _pen_case(i):
    return "CASE tax_type_code " + " ".join(f"WHEN '{k}' THEN {repr(v[i]) if isinstance(v[i], str) else v[i]}"
                                            for k, v in PENALTY_METHODS.items()) + " END"


@register("penalty_assessment", with_("filings") + f""",
x AS (SELECT return_id, tax_type_code, assessed_amount, COALESCE(declared_amount, 0) AS turnover, COALESCE(days_late, 0) AS days_late,
        {_pen_case(0).replace('"', "'")} AS method, {_pen_case(1)} AS fixed_amt, {_pen_case(2)} AS rate FROM filings WHERE is_late = 1),
y AS (SELECT *, CASE method WHEN 'FIXED' THEN CAST(fixed_amt AS DOUBLE)
        WHEN 'PCT_OF_TAX' THEN CAST(assessed_amount AS DOUBLE) * rate / 100
        WHEN 'PCT_OF_TURNOVER' THEN CAST(turnover AS DOUBLE) * rate / 100
        WHEN 'DAILY' THEN days_late * rate
        WHEN 'PROGRESSIVE' THEN CAST(assessed_amount AS DOUBLE) * rate / 100 * LEAST(CEIL(days_late / 30), 3)
             + CAST(assessed_amount AS DOUBLE) * rate / 50 * GREATEST(CEIL(days_late / 30) - 3, 0) END AS base FROM x)
SELECT return_id, tax_type_code, method, days_late,
  {sql_round('LEAST(GREATEST(base, 100.0), 100000.0) * (1 - 10.0 / 100)', 2, 19)} AS penalty_amount FROM y""")
def q_penalty_assessment(spark, sf_dir):
    f = B.filings(B.tables(spark, sf_dir)).where(F.col("is_late") == 1)
    m = lambda i: F.create_map(*[x for k, v in PENALTY_METHODS.items() for x in (F.lit(k), F.lit(v[i]))])
    x = f.select("return_id", "tax_type_code", "assessed_amount",
                 F.coalesce(F.col("declared_amount"), F.lit(0)).alias("turnover"),
                 F.coalesce(F.col("days_late"), F.lit(0)).alias("days_late"),
                 F.element_at(m(0), F.col("tax_type_code")).alias("method"),
                 F.element_at(m(1), F.col("tax_type_code")).alias("fixed_amt"),
                 F.element_at(m(2), F.col("tax_type_code")).alias("rate"))
    pen = LED.assess_penalty(F.col("method"), F.col("assessed_amount"), F.col("turnover"), F.col("days_late"),
                             F.col("fixed_amt"), F.col("rate"), F.lit(100.0), F.lit(100000.0), F.lit(10.0))
    return x.select("return_id", "tax_type_code", "method", "days_late", pen.alias("penalty_amount"))


# ---------------------------------------------------------------- D16 / D17 monthly rollups
@register("monthly_revenue_rollup", with_("filings", "payments") + f""",
f AS (SELECT tax_type_code, CAST(year(period_date) * 100 + month(period_date) AS INTEGER) AS year_month,
        COUNT(*) AS filings_count, COUNT(DISTINCT party_id) AS filing_taxpayers, SUM(assessed_amount) AS assessed_amount,
        SUM(is_on_time) AS on_time_filings, SUM(is_late) AS late_filings
      FROM filings GROUP BY 1, 2),
p AS (SELECT tax_type_code, CAST(year(payment_date) * 100 + month(payment_date) AS INTEGER) AS year_month,
        COUNT(*) AS payments_count, SUM(payment_amount) AS collected_amount FROM payments GROUP BY 1, 2)
SELECT COALESCE(f.tax_type_code, p.tax_type_code) AS tax_type_code, COALESCE(f.year_month, p.year_month) AS year_month,
  COALESCE(filings_count, 0) AS filings_count, COALESCE(filing_taxpayers, 0) AS filing_taxpayers,
  COALESCE(assessed_amount, 0) AS assessed_amount, COALESCE(on_time_filings, 0) AS on_time_filings,
  COALESCE(late_filings, 0) AS late_filings, COALESCE(payments_count, 0) AS payments_count,
  COALESCE(collected_amount, 0) AS collected_amount,
  {sql_pct('COALESCE(on_time_filings, 0)', 'COALESCE(filings_count, 0)')} AS compliance_rate
FROM f FULL OUTER JOIN p ON f.tax_type_code = p.tax_type_code AND f.year_month = p.year_month""")
def q_monthly_revenue_rollup(spark, sf_dir):
    from quaestor.functions.dates import year_month_key
    t = B.tables(spark, sf_dir)
    f = B.filings(t).groupBy("tax_type_code", year_month_key("period_date").alias("year_month")).agg(
        F.count(F.lit(1)).alias("filings_count"), F.countDistinct("party_id").alias("filing_taxpayers"),
        F.sum("assessed_amount").alias("assessed_amount"), F.sum("is_on_time").cast("bigint").alias("on_time_filings"),
        F.sum("is_late").cast("bigint").alias("late_filings"))
    p = B.payments(t).groupBy("tax_type_code", year_month_key("payment_date").alias("year_month")).agg(
        F.count(F.lit(1)).alias("payments_count"), F.sum("payment_amount").alias("collected_amount"))
    out = SNAP.monthly_rollup({"filings": f, "payments": p}, ["tax_type_code", "year_month"])
    return out.withColumn("compliance_rate", pct("on_time_filings", "filings_count"))


# ---------------------------------------------------------------- L22-L32 rule pack over the warehouse
def _pack(t):
    f, rl = B.filings(t), B.return_lines(t)
    led = B.ledger(t).withColumn("period_end", F.last_day("txn_date"))
    bal = LED.account_balances(led, ["account_id"], "period_end", "amount")
    fr = {"filings": f, "lines": rl, "balances": bal, "returns": B.returns(t)}
    rules = [
        {"code": "Q1_NEG_AMOUNT", "table": "returns", "build": lambda x: CHK.rule_predicate(x["returns"], "assessed_amount < 0")},
        {"code": "Q2_ONE_LINE", "table": "lines", "severity": "WARNING",
         "build": lambda x: CHK.rule_at_most_one(x["lines"], ["return_id", "line_number"])},
        {"code": "Q5_LINES_SUM", "table": "filings", "severity": "WARNING",
         "build": lambda x: CHK.rule_sum_reconciles(x["returns"], x["lines"], "return_id", "assessed_amount",
                                                    "line_amount", 0.01)},
        {"code": "Q7_UNFILED_SLA", "table": "filings", "severity": "WARNING",
         "build": lambda x: CHK.rule_timeliness(x["filings"].where("is_filed = 0"), "due_date", _AS_OF, 90)},
        {"code": "Q9_MIN_LINES", "table": "filings", "severity": "WARNING",
         "build": lambda x: CHK.rule_completeness(x["returns"], x["lines"], "return_id", 1)},
        {"code": "L29_BALANCE_EQ", "table": "balances",
         "build": lambda x: CHK.balance_equation(x["balances"], "opening_balance", "debit_amount", "credit_amount",
                                                 "closing_balance")},
        {"code": "Q4_TYPE_MATCH", "table": "filings",
         "build": lambda x: CHK.rule_cross_table(x["filings"].select("return_id", "tax_type_code"),
                                                 x["returns"].select("return_id", F.col("tax_type_code").alias("t2")),
                                                 "return_id", F.col("tax_type_code") != F.col("t2"))},
    ]
    return CHK.run_rule_pack(rules, fr)


@register("warehouse_rule_pack", with_("filings", "return_lines", "ledger") + f""",
g AS (SELECT account_id, last_day(txn_date) AS period_end,
        CAST(COALESCE(SUM(CASE WHEN amount > 0 THEN amount END), 0) AS DECIMAL(38,2)) AS d,
        CAST(COALESCE(-SUM(CASE WHEN amount < 0 THEN amount END), 0) AS DECIMAL(38,2)) AS c FROM ledger GROUP BY 1, 2),
bal AS (SELECT *, SUM(d - c) OVER (PARTITION BY account_id ORDER BY period_end ROWS UNBOUNDED PRECEDING) AS closing FROM g),
lt AS (SELECT return_id, SUM(line_amount) AS s, COUNT(*) AS n FROM return_lines GROUP BY 1),
counts AS (
  SELECT 'Q1_NEG_AMOUNT' AS rule_code, 'returns' AS table_name, 'ERROR' AS severity, (SELECT COUNT(*) FROM returns WHERE assessed_amount < 0) AS n
  UNION ALL SELECT 'Q2_ONE_LINE', 'lines', 'WARNING', (SELECT COUNT(*) FROM (SELECT return_id, line_number FROM return_lines GROUP BY 1, 2 HAVING COUNT(*) > 1))
  UNION ALL SELECT 'Q5_LINES_SUM', 'filings', 'WARNING', (SELECT COUNT(*) FROM returns r LEFT JOIN lt USING (return_id) WHERE ABS(r.assessed_amount - COALESCE(lt.s, 0)) > 0.01)
  UNION ALL SELECT 'Q7_UNFILED_SLA', 'filings', 'WARNING', (SELECT COUNT(*) FROM filings WHERE is_filed = 0 AND date_diff('day', due_date, DATE '{_AS_OF}') > 90)
  UNION ALL SELECT 'Q9_MIN_LINES', 'filings', 'WARNING', (SELECT COUNT(*) FROM returns r LEFT JOIN lt USING (return_id) WHERE COALESCE(lt.n, 0) < 1)
  UNION ALL SELECT 'L29_BALANCE_EQ', 'balances', 'ERROR', (SELECT COUNT(*) FROM bal WHERE ABS(closing - ((closing - (d - c)) + d - c)) > 0.01)
  UNION ALL SELECT 'Q4_TYPE_MATCH', 'filings', 'ERROR', (SELECT COUNT(*) FROM filings f JOIN returns r USING (return_id) WHERE f.tax_type_code <> r.tax_type_code))
SELECT rule_code, table_name, severity, n AS violation_count,
  CASE WHEN n = 0 THEN 'PASS' WHEN severity IN ('ERROR', 'CRITICAL') THEN 'FAIL' ELSE 'WARNING' END AS status FROM counts""")
def q_warehouse_rule_pack(spark, sf_dir):
    return _pack(B.tables(spark, sf_dir))


# ---------------------------------------------------------------- L33 configuration report
@register("configuration_report", """
SELECT * FROM (VALUES ('tax_types', (SELECT COUNT(DISTINCT o_orderpriority) FROM orders)),
                      ('regions', (SELECT COUNT(*) FROM region)),
                      ('nations_with_region', (SELECT COUNT(*) FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)),
                      ('parties', (SELECT COUNT(*) FROM customer))) v(config_item, row_count)
""".replace("SELECT * FROM (VALUES", "SELECT config_item, CAST(row_count AS BIGINT) AS row_count, CASE WHEN row_count >= 1 THEN 'PASS' ELSE 'FAIL' END AS status FROM (VALUES"))
def q_configuration_report(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    items = {"tax_types": lambda fr: fr["orders"].select("o_orderpriority").distinct(),
             "regions": lambda fr: fr["region"],
             "nations_with_region": lambda fr: fr["nation"].join(fr["region"], fr["nation"]["n_regionkey"] == fr["region"]["r_regionkey"]),
             "parties": lambda fr: fr["customer"]}
    return CHK.configuration_report(items, {"orders": t.orders, "region": t.region, "nation": t.nation,
                                            "customer": t.customer})


# ---------------------------------------------------------------- H14 JSON props
@register("event_props_summary", """
SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS k_bucket, COUNT(*) AS events,
  SUM(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS k_total
FROM events GROUP BY 1, 2""")
def q_event_props_summary(spark, sf_dir):
    e = B.tables(spark, sf_dir).events
    k = json_field("props", "$.k", "int")
    return e.groupBy("event_type", (k % 10).alias("k_bucket")).agg(F.count(F.lit(1)).alias("events"),
                                                                  F.sum(k).alias("k_total"))


# ---------------------------------------------------------------- C09 interval membership (fiscal years)
@register("returns_by_fiscal_year", with_("returns") + """,
fy AS (SELECT CAST(y AS INTEGER) AS fiscal_year, make_date(CAST(y AS INTEGER), 4, 1) AS fy_start, make_date(CAST(y AS INTEGER) + 1, 3, 31) AS fy_end
       FROM (SELECT unnest(range(MIN(year(period_date)) - 1, MAX(year(period_date)) + 1)) AS y FROM returns))
SELECT fy.fiscal_year, COUNT(*) AS returns, SUM(r.assessed_amount) AS assessed_amount
FROM returns r LEFT JOIN fy ON r.period_date BETWEEN fy.fy_start AND fy.fy_end GROUP BY 1""")
def q_returns_by_fiscal_year(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    span = r.agg((F.min(F.year("period_date")) - 1).alias("y0"), F.max(F.year("period_date")).alias("y1"))
    fy = (span.select(F.explode(F.sequence("y0", "y1")).alias("fiscal_year"))
          .select("fiscal_year", F.make_date("fiscal_year", F.lit(4), F.lit(1)).alias("fy_start"),
                  F.make_date(F.col("fiscal_year") + 1, F.lit(3), F.lit(31)).alias("fy_end")))
    j = JN.join_interval_membership(r, "period_date", fy, "fy_start", "fy_end", ["fiscal_year"])
    return j.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("returns"), F.sum("assessed_amount").alias("assessed_amount"))


# ---------------------------------------------------------------- I15 hierarchy levels
@register("geography_levels", """
WITH nodes AS (SELECT 'R' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer)
SELECT n.id, n.parent, CASE WHEN EXISTS (SELECT 1 FROM nodes c WHERE c.parent = n.id) THEN 1 ELSE 0 END AS is_parent,
  CASE WHEN n.parent IS NULL THEN 1 WHEN n.parent IN (SELECT id FROM nodes WHERE parent IS NULL) THEN 2 ELSE 3 END AS hierarchy_level
FROM nodes n""")
def q_geography_levels(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    nodes = (t.region.select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("id"), F.lit(None).cast("string").alias("parent"))
             .unionByName(t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("id"),
                                          F.concat(F.lit("R"), F.col("n_regionkey")).alias("parent")))
             .unionByName(t.customer.select(F.concat(F.lit("C"), F.col("c_custkey")).alias("id"),
                                            F.concat(F.lit("N"), F.col("c_nationkey")).alias("parent"))))
    return derive_hierarchy_level(nodes, "id", "parent")


# ---------------------------------------------------------------- M19 balance analytics
@register("credit_and_writeoff", with_("ledger") + f""",
b AS (SELECT account_id, SUM(amount) AS balance, MAX(txn_date) FILTER (WHERE txn_type = 'PAYMENT') AS last_payment
      FROM ledger WHERE txn_date <= DATE '{_AS_OF}' GROUP BY 1)
SELECT account_id, CAST(balance AS DECIMAL(38,2)) AS balance, last_payment,
  CASE WHEN balance < 0 THEN 'CREDIT_BALANCE'
       WHEN balance > 0 AND (last_payment IS NULL OR date_diff('day', last_payment, DATE '{_AS_OF}') > 365) THEN 'WRITEOFF_CANDIDATE'
       WHEN balance > 0 THEN 'ARREARS' ELSE 'ZERO' END AS balance_class
FROM b""")
def q_credit_and_writeoff(spark, sf_dir):
    led = B.ledger(B.tables(spark, sf_dir)).where(F.col("txn_date") <= F.lit(_AS_OF).cast("date"))
    b = led.groupBy("account_id").agg(F.sum("amount").cast("decimal(38,2)").alias("balance"),
                                      F.max(F.when(F.col("txn_type") == "PAYMENT", F.col("txn_date"))).alias("last_payment"))
    stale = F.col("last_payment").isNull() | (F.datediff(F.lit(_AS_OF).cast("date"), "last_payment") > 365)
    cls = (F.when(F.col("balance") < 0, "CREDIT_BALANCE").when((F.col("balance") > 0) & stale, "WRITEOFF_CANDIDATE")
           .when(F.col("balance") > 0, "ARREARS").otherwise("ZERO"))
    return b.withColumn("balance_class", cls)


# ---------------------------------------------------------------- M21 payment analytics
@register("payment_timeliness", with_("payments", "returns") + f""",
j AS (SELECT p.tax_type_code, p.payment_amount, CASE WHEN p.payment_date <= r.due_date THEN 1 ELSE 0 END AS on_time
      FROM payments p JOIN returns r USING (return_id))
SELECT tax_type_code, COUNT(*) AS payments, SUM(on_time) AS on_time_payments, {sql_pct('SUM(on_time)', 'COUNT(*)')} AS on_time_rate,
  SUM(CASE WHEN on_time = 1 THEN payment_amount ELSE 0 END) AS on_time_amount
FROM j GROUP BY 1""")
def q_payment_timeliness(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    j = B.payments(t).join(B.returns(t).select("return_id", "due_date"), "return_id")
    j = j.withColumn("on_time", (F.col("payment_date") <= F.col("due_date")).cast("int"))
    return (j.groupBy("tax_type_code").agg(F.count(F.lit(1)).alias("payments"),
                                           F.sum("on_time").cast("bigint").alias("on_time_payments"),
                                           F.sum(F.when(F.col("on_time") == 1, F.col("payment_amount")).otherwise(F.lit(0)))
                                           .alias("on_time_amount"))
            .withColumn("on_time_rate", pct("on_time_payments", "payments")))


# ---------------------------------------------------------------- M25 filing analytics by segment
@register("declared_by_segment", with_("filings", "party") + f"""
SELECT p.segment, f.tax_type_code, COUNT(*) AS filings, SUM(COALESCE(f.declared_amount, 0)) AS declared_amount,
  {sql_ratio('SUM(COALESCE(f.declared_amount, 0))', 'COUNT(*)', 2)} AS avg_declared
FROM filings f JOIN party p USING (party_id) GROUP BY 1, 2""")
def q_declared_by_segment(spark, sf_dir):
    from quaestor.functions.numeric import avg_money
    t = B.tables(spark, sf_dir)
    j = B.filings(t).join(B.party(t).select("party_id", "segment"), "party_id")
    return (j.groupBy("segment", "tax_type_code").agg(F.count(F.lit(1)).alias("filings"),
                                                      F.sum(F.coalesce(F.col("declared_amount"), F.lit(0))).alias("declared_amount"))
            .withColumn("avg_declared", avg_money("declared_amount", "filings")))


# ---------------------------------------------------------------- M22 risk migration matrix
@register("risk_migration", with_("filings") + f""",
y AS (SELECT party_id, year(period_date) AS yr, {sql_pct('SUM(is_late)', 'SUM(is_filed)')} AS score FROM filings
      WHERE year(period_date) IN (1999, 2000) GROUP BY 1, 2),
b AS (SELECT party_id, yr, CASE WHEN score IS NULL THEN 'NONE' WHEN score <= 30 THEN 'LOW' WHEN score <= 60 THEN 'MEDIUM' ELSE 'HIGH' END AS band FROM y),
m AS (SELECT a.party_id, a.band AS from_band, c.band AS to_band FROM b a JOIN b c ON a.party_id = c.party_id AND a.yr = 1999 AND c.yr = 2000)
SELECT from_band, to_band, COUNT(*) AS parties FROM m GROUP BY 1, 2""")
def q_risk_migration(spark, sf_dir):
    from quaestor.functions.codes import band
    f = B.filings(B.tables(spark, sf_dir)).where(F.year("period_date").isin(1999, 2000))
    y = f.groupBy("party_id", F.year("period_date").alias("yr")).agg(pct(F.sum("is_late"), F.sum("is_filed")).alias("score"))
    b = y.withColumn("band", F.coalesce(band("score", [(30, "LOW"), (60, "MEDIUM"), (None, "HIGH")]), F.lit("NONE")))
    a = b.where("yr = 1999").select("party_id", F.col("band").alias("from_band"))
    c = b.where("yr = 2000").select("party_id", F.col("band").alias("to_band"))
    return a.join(c, "party_id").groupBy("from_band", "to_band").agg(F.count(F.lit(1)).alias("parties"))


# ---------------------------------------------------------------- M27 tax period queries
@register("current_tax_periods", f"""
WITH t AS (SELECT DISTINCT o_orderpriority AS tax_type_code FROM orders)
SELECT tax_type_code, CAST(date_trunc('month', DATE '{_AS_OF}') AS DATE) AS period_start_date, last_day(DATE '{_AS_OF}') AS period_end_date,
  CAST(date_trunc('month', DATE '{_AS_OF}') + INTERVAL 1 MONTH + INTERVAL 14 DAY AS DATE) AS filing_due_date,
  date_diff('day', DATE '{_AS_OF}', CAST(date_trunc('month', DATE '{_AS_OF}') + INTERVAL 1 MONTH + INTERVAL 14 DAY AS DATE)) AS days_to_deadline
FROM t""")
def q_current_tax_periods(spark, sf_dir):
    from quaestor.plans import calendar as CAL, dims as DIM
    from quaestor.plans.queries_wh import TYPE_CATEGORIES
    t = B.tables(spark, sf_dir)
    types = DIM.build_dim_tax_type(t.orders, "o_orderpriority", TYPE_CATEGORIES, {})  # every type monthly
    types = types.withColumn("filing_frequency", F.lit("MONTHLY"))
    years = t.orders.select(F.year("o_orderdate").alias("year"))
    p = CAL.generate_tax_periods(types, years)
    a = F.lit(_AS_OF).cast("date")
    cur = p.where((F.col("period_start_date") <= a) & (F.col("period_end_date") >= a))
    return cur.select("tax_type_code", "period_start_date", "period_end_date", "filing_due_date",
                      F.datediff("filing_due_date", a).alias("days_to_deadline"))


# ---------------------------------------------------------------- L32 rule pack from YAML (Appendix A as data)
@register("yaml_rule_pack", with_("returns", "return_lines", "filings", "party") + f""",
lt AS (SELECT return_id, SUM(line_amount) AS s, COUNT(*) AS n FROM return_lines GROUP BY 1),
per AS (SELECT party_id, tax_type_code, return_id, period_date AS start_date, CAST(period_date + 30 AS DATE) AS end_date,
          MAX(CAST(period_date + 30 AS DATE)) OVER (PARTITION BY party_id, tax_type_code ORDER BY period_date, return_id
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mpe FROM returns),
counts AS (
  SELECT 'BR_RET_001' AS rule_code, 'returns' AS table_name, 'ERROR' AS severity, (SELECT COUNT(*) FROM returns WHERE assessed_amount < 0) AS n
  UNION ALL SELECT 'BR_RET_002', 'return_lines', 'WARNING', (SELECT COUNT(*) FROM (SELECT 1 FROM return_lines GROUP BY return_id, line_number HAVING COUNT(*) > 1))
  UNION ALL SELECT 'BR_RET_003', 'returns', 'ERROR', (SELECT COUNT(*) FROM returns r WHERE party_id IS NOT NULL AND party_id NOT IN (SELECT party_id FROM party WHERE party_id IS NOT NULL))
  UNION ALL SELECT 'BR_RET_004', 'returns', 'WARNING', (SELECT COUNT(*) FROM returns r LEFT JOIN lt USING (return_id) WHERE ABS(r.assessed_amount - COALESCE(lt.s, 0)) > 0.01)
  UNION ALL SELECT 'BR_RET_005', 'periods', 'WARNING', (SELECT COUNT(*) FROM per WHERE mpe IS NOT NULL AND start_date <= mpe)
  UNION ALL SELECT 'BR_RET_006', 'filings', 'WARNING', (SELECT COUNT(*) FROM filings WHERE is_filed = 0 AND date_diff('day', due_date, DATE '{_AS_OF}') > 90)
  UNION ALL SELECT 'BR_RET_007', 'returns', 'ERROR', (SELECT COUNT(*) FROM returns WHERE tax_type_code IS NOT NULL AND NOT regexp_matches(tax_type_code, '^(?:[1-5]-[A-Z ]+)$'))
  UNION ALL SELECT 'BR_RET_008', 'returns', 'WARNING', (SELECT COUNT(*) FROM returns r LEFT JOIN lt USING (return_id) WHERE COALESCE(lt.n, 0) < 1))
SELECT rule_code, table_name, severity, n AS violation_count,
  CASE WHEN n = 0 THEN 'PASS' WHEN severity IN ('ERROR', 'CRITICAL') THEN 'FAIL' ELSE 'WARNING' END AS status FROM counts""")
def q_yaml_rule_pack(spark, sf_dir):
    from quaestor.operators.rulepack import load_pack, run_pack
    t = B.tables(spark, sf_dir)
    r = B.returns(t)
    frames = {"returns": r, "return_lines": B.return_lines(t), "filings": B.filings(t), "party": B.party(t),
              "periods": r.select("party_id", "tax_type_code", "return_id", F.col("period_date").alias("start_date"),
                                  F.date_add("period_date", 30).alias("end_date"))}
    return run_pack(load_pack("warehouse_rules"), frames, _AS_OF)
