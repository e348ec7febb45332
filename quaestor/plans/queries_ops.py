"""Registered queries that call one everyday operator each: scans, filters,
joins, aggregates, set operations, key resolution and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaestor.functions.dates import age_years, date_diff_days
from quaestor.operators import aggregates as AGG, checks as CHK, joins as JOIN, select as SEL
from quaestor.operators.keys import resolve_dimension_key, resolve_optional_key, unresolved_rows
from quaestor.operators.windows import row_number_per_group
from quaestor.plans import bindings as B
from quaestor.plans.catalog import register, sql_ratio
from quaestor.plans.sqlbind import with_
from quaestor.sources import scan as SCAN

_CUT = "1996-01-01"


# ---------------------------------------------------------------- A01 / A02 / A04 scans
@register("scan_urgent_returns", with_("returns") + """
SELECT return_id, party_id, due_date FROM returns WHERE tax_type_code = '1-URGENT'""")
def q_scan(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    return SCAN.scan_table(r, where="tax_type_code = '1-URGENT'").select("return_id", "party_id", "due_date")


@register("scan_returns_after", with_("returns") + f"""
SELECT return_id, period_date FROM returns WHERE period_date > DATE '{_CUT}'""")
def q_scan_incremental(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    return SCAN.scan_incremental(r, "period_date", F.lit(_CUT).cast("date"), ["return_id", "period_date"])


@register("open_return_count", with_("returns") + " SELECT COUNT(*) AS row_count FROM returns WHERE status = 'O'")
def q_row_count(spark, sf_dir):
    return SCAN.row_count(B.returns(B.tables(spark, sf_dir)), "status = 'O'")


# ---------------------------------------------------------------- B11 filter / G04 distinct
@register("distinct_open_types", with_("returns") + """
SELECT DISTINCT tax_type_code, status FROM returns WHERE status <> 'F'""")
def q_distinct(spark, sf_dir):
    return JOIN.distinct_rows(SEL.filter_source(B.returns(B.tables(spark, sf_dir)), "status <> 'F'"), ["tax_type_code", "status"])


# ---------------------------------------------------------------- C01 / C02 equi joins
@register("returns_with_party", with_("returns", "party") + """
SELECT r.return_id, p.party_id, p.segment, p.balance FROM returns r JOIN party p USING (party_id)""")
def q_join_inner(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return JOIN.join_inner(B.returns(t).select("return_id", "party_id"), B.party(t).select("party_id", "segment", "balance"), "party_id")


@register("parties_with_returns", with_("returns", "party") + """,
n AS (SELECT party_id, COUNT(*) AS return_count FROM returns GROUP BY 1)
SELECT p.party_id, n.return_count FROM party p LEFT JOIN n USING (party_id)""")
def q_join_left(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    n = B.returns(t).groupBy("party_id").agg(F.count(F.lit(1)).alias("return_count"))
    return JOIN.join_inner(B.party(t).select("party_id"), n, "party_id", "left")


# ---------------------------------------------------------------- C03 / C04 key resolution
_KEYS = """,
seg AS (SELECT segment, ROW_NUMBER() OVER (ORDER BY segment) - 1 AS segment_key FROM (SELECT DISTINCT segment FROM party))"""


def _segments(t):
    from quaestor.operators.keys import sequential_key
    return sequential_key(B.party(t).select("segment").distinct(), ["segment"], "segment_key", offset=-1)


@register("party_segment_keys", with_("party") + _KEYS + """
SELECT p.party_id, s.segment_key FROM party p JOIN seg s USING (segment) WHERE s.segment_key <> 0""")
def q_resolve_key(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return resolve_dimension_key(B.party(t).select("party_id", "segment"), _segments(t), {"segment": "segment"},
                                 "segment_key").select("party_id", "segment_key")


@register("party_segment_unresolved", with_("party") + _KEYS + """
SELECT p.party_id, p.segment FROM party p JOIN seg s USING (segment) WHERE s.segment_key = 0""")
def q_unresolved(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return unresolved_rows(B.party(t).select("party_id", "segment"), _segments(t), {"segment": "segment"}, "segment_key")


@register("party_segment_optional", with_("party") + _KEYS + """
SELECT p.party_id, COALESCE(NULLIF(s.segment_key, 0), -1) AS segment_key FROM party p JOIN seg s USING (segment)""")
def q_optional_key(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    j = JOIN.join_inner(B.party(t).select("party_id", "segment"), _segments(t), "segment")
    out = resolve_optional_key(j.withColumn("unknown", F.lit(-1).cast("long")), "segment_key", "unknown")
    return out.select("party_id", "segment_key")


# ---------------------------------------------------------------- D03 / D04 / D08
@register("distinct_parties_by_type", with_("returns") + """
SELECT tax_type_code, COUNT(DISTINCT party_id) AS parties FROM returns GROUP BY 1""")
def q_count_distinct(spark, sf_dir):
    return AGG.count_distinct(B.returns(B.tables(spark, sf_dir)), ["tax_type_code"], {"parties": "party_id"})


@register("status_sums_by_type", with_("returns") + """
SELECT tax_type_code, SUM(CASE WHEN status = 'O' THEN assessed_amount ELSE 0 END) AS open_amount,
  CAST(SUM(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS final_count FROM returns GROUP BY 1""")
def q_conditional_sums(spark, sf_dir):
    s = F.col("status")
    return AGG.conditional_sums(B.returns(B.tables(spark, sf_dir)), ["tax_type_code"],
                                {"open_amount": (s == "O", "assessed_amount"), "final_count": (s == "F", None)})


# ---------------------------------------------------------------- E02 row number per group
@register("return_line_sequence", with_("return_lines") + """
SELECT return_id, payment_amount, ROW_NUMBER() OVER (PARTITION BY return_id ORDER BY payment_amount, ship_date, part_id, supplier_id, line_number) AS line_seq
FROM return_lines""")
def q_line_sequence(spark, sf_dir):
    lines = B.return_lines(B.tables(spark, sf_dir))
    out = row_number_per_group(lines, ["return_id"], ["payment_amount", "ship_date", "part_id", "supplier_id", "line_number"])
    return out.select("return_id", "payment_amount", "line_seq")


# ---------------------------------------------------------------- G01 / G02 / G05 set operations
@register("return_and_party_ids", with_("returns", "party") + """
SELECT party_id FROM returns UNION ALL SELECT party_id FROM party""")
def q_union_all(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return JOIN.union_all(B.returns(t).select("party_id"), B.party(t).select("party_id"))


@register("known_party_ids", with_("returns", "party") + """
SELECT party_id FROM returns UNION SELECT party_id FROM party""")
def q_union_distinct(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return JOIN.union_distinct(B.returns(t).select("party_id"), B.party(t).select("party_id"))


@register("dated_sources", with_("returns", "payments") + """
SELECT party_id, period_date AS on_date, 'RETURN' AS source_type FROM returns
UNION ALL SELECT party_id, payment_date, 'PAYMENT' FROM payments""")
def q_union_sources(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return JOIN.union_sources({"RETURN": B.returns(t).select("party_id", F.col("period_date").alias("on_date")),
                               "PAYMENT": B.payments(t).select("party_id", F.col("payment_date").alias("on_date"))})


# ---------------------------------------------------------------- H07 / H08
@register("return_ages", with_("returns") + """
SELECT return_id, CAST(date_diff('day', period_date, due_date) AS INTEGER) AS days_to_due,
  CAST(date_sub('year', period_date, DATE '2010-06-30') AS INTEGER) AS age FROM returns""")
def q_ages(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    return r.select("return_id", date_diff_days("due_date", "period_date").cast("int").alias("days_to_due"),
                    age_years(F.lit("2010-06-30").cast("date"), "period_date").cast("int").alias("age"))


# ---------------------------------------------------------------- D01 / D02 / D08 summaries
_SUMMARY = """COUNT(*) AS row_count, SUM(assessed_amount) AS total, MIN(assessed_amount) AS min_value,
  MAX(assessed_amount) AS max_value, """ + sql_ratio("SUM(assessed_amount)", "COUNT(*)", 2) + " AS avg_value"


@register("assessment_summary_by_status", with_("returns") + f"""
SELECT status, tax_type_code, {_SUMMARY} FROM returns GROUP BY 1, 2 HAVING COUNT(*) > 100""")
def q_group_summary(spark, sf_dir):
    s = AGG.group_summary(B.returns(B.tables(spark, sf_dir)), ["status", "tax_type_code"], "assessed_amount")
    return AGG.having(s, "row_count > 100")


@register("assessment_summary", with_("returns") + f" SELECT {_SUMMARY} FROM returns")
def q_global_summary(spark, sf_dir):
    return AGG.global_summary(B.returns(B.tables(spark, sf_dir)), "assessed_amount")


# ---------------------------------------------------------------- L30 / L31 reconciliation
@register("unreconciled_returns", with_("returns", "payments") + """,
p AS (SELECT return_id, SUM(payment_amount) AS total_paid FROM payments GROUP BY 1)
SELECT r.return_id, r.assessed_amount - COALESCE(p.total_paid, 0) AS balance
FROM returns r LEFT JOIN p USING (return_id) WHERE r.assessed_amount <> COALESCE(p.total_paid, 0)""")
def q_reconcile(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    out = CHK.reconcile_facts(B.returns(t), B.payments(t), "return_id", "assessed_amount", "payment_amount")
    return out.select("return_id", "balance")


@register("double_entry_gaps", with_("filings", "ledger") + """,
d AS (SELECT account_id AS party_id, SUM(CASE WHEN amount > 0 THEN amount END) AS debit_total FROM ledger GROUP BY 1),
e AS (SELECT party_id, SUM(assessed_amount) AS expected FROM filings WHERE is_late = 1 GROUP BY 1)
SELECT COALESCE(d.party_id, e.party_id) AS party_id FROM d FULL JOIN e ON d.party_id = e.party_id
WHERE ABS(COALESCE(d.debit_total, 0) - COALESCE(e.expected, 0)) > 0.01""")
def q_double_entry(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    expected = (B.filings(t).where("is_late = 1").groupBy("party_id")
                .agg(F.sum("assessed_amount").alias("expected")))
    led = B.ledger(t).withColumnRenamed("account_id", "party_id")
    return CHK.double_entry_check(led, expected, "party_id", "amount", "expected").select("party_id")
