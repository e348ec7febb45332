"""Registered queries: the remaining facts (registration, collection, refund,
objection, customs) and operators that no other query runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quaestor.functions.codes import code_label
from quaestor.functions.dates import date_key, year_month_key
from quaestor.functions.numeric import money
from quaestor.operators import aggregates as AGG
from quaestor.operators import checks as CHK
from quaestor.operators import joins as JN
from quaestor.operators import keys as KEYS
from quaestor.operators import ranges as RNG
from quaestor.operators import scd as SCD
from quaestor.operators import select as SEL
from quaestor.operators import windows as WIN
from quaestor.plans import analytics as M
from quaestor.plans import bindings as B
from quaestor.plans import facts as FCT
from quaestor.plans import snapshots as SNAP
from quaestor.plans.catalog import register, sql_pct, sql_ratio
from quaestor.plans.queries import _AS_OF, _SNAPS
from quaestor.plans.sqlbind import with_
from quaestor.sources import sinks as SINK
from quaestor.streaming.incremental import scratch

_KEY = "CAST(strftime({}, '%Y%m%d') AS INTEGER)".format


# ---------------------------------------------------------------- I19 registrations
@register("fact_registration", with_("returns") + f"""
SELECT party_id, tax_type_code, {_KEY("MIN(period_date)")} AS registration_date_key, 7 AS processing_days, 1 AS is_approved
FROM returns WHERE status <> 'P' GROUP BY 1, 2""")
def q_fact_registration(spark, sf_dir):
    """A party registers for a type with its first return; pending ones have no date."""
    r = B.returns(B.tables(spark, sf_dir))
    accounts = r.groupBy("party_id", "tax_type_code").agg(
        F.min(F.when(F.col("status") != "P", F.col("period_date"))).alias("registration_date"))
    return FCT.build_fact_registration(accounts)


# ---------------------------------------------------------------- I24 collection
@register("fact_collection", with_("returns", "payments") + f""",
c AS (SELECT return_id AS case_id, party_id AS account_id, due_date AS opened, assessed_amount AS debt FROM returns WHERE status = 'O'),
a AS (SELECT p.payment_id AS action_id, p.return_id AS case_id, p.payment_amount AS collected,
        CASE p.charge_type_code WHEN 'R' THEN 'GARNISHMENT' WHEN 'A' THEN 'NOTICE' ELSE 'LEGAL_ACTION' END AS t FROM payments p),
d AS (SELECT party_id AS account_id, MIN(due_date) AS due FROM returns GROUP BY 1)
SELECT action_id, c.case_id, c.account_id, t AS action_type_code, date_diff('day', opened, DATE '{_AS_OF}') AS days_since_opened, due AS debt_due_date,
  collected AS amount_collected, CASE WHEN debt > 0 THEN {sql_ratio("collected", "debt", 4)} ELSE 0 END AS effectiveness_ratio,
  CASE WHEN collected > 0 THEN 1 ELSE 0 END AS is_successful, CASE WHEN t IN ({", ".join(f"'{x}'" for x in FCT.ESCALATED_ACTIONS)}) THEN 1 ELSE 0 END AS is_escalated
FROM a JOIN c ON c.case_id = a.case_id LEFT JOIN d ON d.account_id = c.account_id""")
def q_fact_collection(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    r = B.returns(t)
    cases = r.where("status = 'O'").select(F.col("return_id").alias("case_id"), F.col("party_id").alias("account_id"),
                                           F.col("due_date").alias("case_opened_date"), F.col("assessed_amount").alias("current_debt_amount"))
    actions = B.payments(t).select(F.col("payment_id").alias("action_id"), F.col("return_id").alias("case_id"),
                                   F.col("payment_amount").alias("action_collected"),
                                   code_label("charge_type_code", {"R": "GARNISHMENT", "A": "NOTICE"}, "LEGAL_ACTION").alias("action_type_code"))
    due = r.select(F.col("party_id").alias("account_id"), "due_date")
    return FCT.build_fact_collection(actions, cases, due, _AS_OF)


# ---------------------------------------------------------------- I25 refunds
@register("fact_refund", with_("filings") + f""",
x AS (SELECT return_id, party_id, due_date AS claim, CAST(paid_amount - assessed_amount AS DECIMAL(19,2)) AS gross,
        CAST(CASE WHEN is_late = 1 THEN CAST(paid_amount - assessed_amount AS DECIMAL(19,2)) * 0.5 ELSE 0 END AS DECIMAL(19,2)) AS off,
        CASE WHEN status <> 'O' THEN CAST(due_date + 14 AS DATE) END AS approved, CASE WHEN status = 'F' THEN CAST(due_date + 30 AS DATE) END AS refunded
      FROM filings WHERE paid_amount > assessed_amount)
SELECT return_id AS refund_id, party_id, {_KEY("claim")} AS claim_date_key, gross AS gross_refund_amount, off AS offset_amount,
  CAST(gross - off AS DECIMAL(20,2)) AS net_refund_amount, CASE WHEN approved IS NULL THEN 0 ELSE 1 END AS is_approved,
  CASE WHEN refunded IS NULL THEN 0 ELSE 1 END AS is_disbursed, CASE WHEN off > 0 THEN 1 ELSE 0 END AS is_offset,
  COALESCE(date_diff('day', claim, refunded), 0) AS processing_days, date_diff('day', claim, approved) AS approval_days
FROM x""")
def q_fact_refund(spark, sf_dir):
    f = B.filings(B.tables(spark, sf_dir)).where("paid_amount > assessed_amount")
    gross = F.col("paid_amount") - F.col("assessed_amount")
    return FCT.build_fact_refund(f.select(
        F.col("return_id").alias("refund_id"), "party_id", F.col("due_date").alias("claim_date"), money(gross).alias("gross_refund_amount"),
        F.when(F.col("is_late") == 1, money(gross * F.lit("0.5").cast("decimal(2,1)"))).otherwise(money(F.lit(0))).alias("offset_amount"),
        F.when(F.col("status") != "O", F.date_add("due_date", 14)).alias("approval_date"),
        F.when(F.col("status") == "F", F.date_add("due_date", 30)).alias("refund_date")))


# ---------------------------------------------------------------- I27 objections
@register("fact_objection", with_("filings") + f"""
SELECT return_id AS objection_case_id, party_id, {_KEY("filing_date")} AS filing_date_key, CASE WHEN status = 'O' THEN 0 ELSE 1 END AS is_resolved,
  CASE WHEN status = 'F' AND line_count < 3 THEN 1 ELSE 0 END AS is_upheld, CASE WHEN status = 'F' AND line_count >= 3 THEN 1 ELSE 0 END AS is_reduced,
  CASE WHEN status = 'P' THEN 1 ELSE 0 END AS is_cancelled, CASE WHEN line_count > 5 THEN 1 ELSE 0 END AS is_appealed,
  CASE WHEN status <> 'O' THEN date_diff('day', filing_date, last_ship_date) END AS resolution_days, assessed_amount AS amount_disputed,
  COALESCE(CASE WHEN status = 'F' THEN CAST(declared_amount AS DECIMAL(19,2)) END, 0) AS resolved_amount
FROM filings WHERE is_late = 1""")
def q_fact_objection(spark, sf_dir):
    f = B.filings(B.tables(spark, sf_dir)).where("is_late = 1")
    return FCT.build_fact_objection(f.select(
        F.col("return_id").alias("objection_case_id"), "party_id", "filing_date",
        F.when(F.col("status") != "O", F.col("last_ship_date")).alias("decision_date"),
        F.when(F.col("status") == "P", "cancelled").when(F.col("status") == "F", F.when(F.col("line_count") < 3, "upheld").otherwise("reduced"))
        .alias("decision_outcome_code"), (F.col("line_count") > 5).alias("appeal_filed"), F.col("assessed_amount").alias("amount_disputed"),
        F.when(F.col("status") == "F", F.col("declared_amount")).alias("amount_adjusted")))


# ---------------------------------------------------------------- I32, M24, H12, C16 customs
def _declarations(t):
    """Lines as customs declarations of the supplier's country; the origin is
    missing for some."""
    s = t.supplier.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_nationkey").alias("dispatch_country"))
    lines = B.return_lines(t).join(s, "supplier_id")
    return lines.select(
        F.concat_ws("-", "return_id", "line_number", "part_id", "supplier_id", F.date_format("ship_date", "yyyyMMdd")).alias("declaration_id"),
        F.col("charge_type_code").alias("flow"), (F.col("line_number") % 7).cast("string").alias("transport_mode"), "line_amount",
        F.col("line_amount").alias("customs_value"), (F.col("line_amount") * F.col("tax_rate")).cast("decimal(19,2)").alias("duty_amount"),
        F.when(F.col("discount") > 0.05, F.lit("PREF")).alias("preference_code"),
        F.when(F.col("part_id") % 3 > 0, F.col("part_id") % 25).alias("origin_country"), "dispatch_country",
        F.col("discount"), F.col("tax_rate"))


_DECL_SQL = """
decl AS (SELECT concat_ws('-', l.return_id, l.line_number, l.part_id, l.supplier_id, strftime(l.ship_date, '%Y%m%d')) AS declaration_id,
    l.charge_type_code AS flow, CAST(l.line_number % 7 AS VARCHAR) AS transport_mode, l.line_amount AS customs_value, l.discount, l.tax_rate,
    CAST(l.line_amount * l.tax_rate AS DECIMAL(19,2)) AS duty_amount, CASE WHEN l.discount > 0.05 THEN 'PREF' END AS preference_code,
    CASE WHEN l.part_id % 3 > 0 THEN l.part_id % 25 END AS origin_country, s_nationkey AS dispatch_country
  FROM return_lines l JOIN supplier ON s_suppkey = l.supplier_id)"""


@register("customs_analytics", with_("return_lines") + "," + _DECL_SQL.strip() + f""",
g AS (SELECT flow, CASE transport_mode WHEN '1' THEN 'SEA' WHEN '2' THEN 'RAIL' WHEN '3' THEN 'ROAD' WHEN '4' THEN 'AIR' WHEN '5' THEN 'POST' ELSE 'OTHER' END AS transport,
    COUNT(*) AS declarations, SUM(customs_value) AS customs_value, SUM(duty_amount) AS duty_revenue, median(CAST(customs_value AS DOUBLE)) AS median_value,
    COUNT(preference_code) AS pref FROM decl GROUP BY 1, 2)
SELECT flow, transport, declarations, customs_value, duty_revenue, median_value, {sql_pct("pref", "declarations")} AS preference_rate FROM g""")
def q_customs_analytics(spark, sf_dir):
    return M.customs_analytics(_declarations(B.tables(spark, sf_dir)))


@register("fact_customs", with_("return_lines") + "," + _DECL_SQL.strip() + """
SELECT declaration_id, flow, customs_value, origin_country, dispatch_country, n.n_name AS origin_name,
  CAST(duty_amount AS DECIMAL(38,2)) AS duty_import, CAST(CAST(customs_value * discount AS DECIMAL(19,2)) AS DECIMAL(38,2)) AS duty_excise
FROM decl LEFT JOIN nation n ON n.n_nationkey = COALESCE(origin_country, dispatch_country)""")
def q_fact_customs(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    d = _declarations(t)
    duties = d.select("declaration_id", F.explode(F.array(
        F.struct(F.lit("IMPORT").alias("duty_code"), F.col("duty_amount")),
        F.struct(F.lit("EXCISE").alias("duty_code"), (F.col("customs_value") * F.col("discount")).cast("decimal(19,2)").alias("duty_amount")))).alias("x")
    ).select("declaration_id", "x.*")
    out = FCT.build_fact_customs(d, duties, ["IMPORT", "EXCISE"])
    out = out.withColumnsRenamed({c: c.lower() for c in out.columns})
    nations = t.nation.select(F.col("n_nationkey").alias("__n"), F.col("n_name").alias("origin_name"))
    named = JN.join_coalesced_key(out, nations, ["origin_country", "dispatch_country"], "__n")
    return named.select("declaration_id", "flow", "customs_value", "origin_country", "dispatch_country", "origin_name",
                        F.col("duty_import").cast("decimal(38,2)").alias("duty_import"), F.col("duty_excise").cast("decimal(38,2)").alias("duty_excise"))


# ---------------------------------------------------------------- M06, M34 on the audit snapshot
@register("audit_effectiveness", with_("filings") + f""",
a AS (SELECT tax_type_code, year(first_ship_date) AS year, COUNT(*) AS total_audits, SUM(assessed_amount) AS total_assessed,
        SUM(CAST(paid_amount AS DECIMAL(19,2))) AS total_collected, SUM(date_diff('day', first_ship_date, last_ship_date)) AS days
      FROM filings WHERE status = 'F' AND first_ship_date IS NOT NULL GROUP BY 1, 2)
SELECT tax_type_code, CAST(year AS INTEGER) AS year, total_audits, total_assessed, total_collected,
  {sql_pct("total_collected", "total_assessed")} AS collection_rate, {sql_ratio("days", "total_audits", 2)} AS avg_audit_days FROM a""")
def q_audit_effectiveness(spark, sf_dir):
    f = B.filings(B.tables(spark, sf_dir)).where("first_ship_date is not null")
    return M.audit_effectiveness(f.select(
        "tax_type_code", F.col("first_ship_date").alias("start_date"), F.col("last_ship_date").alias("completion_date"), "assessed_amount",
        F.col("paid_amount").alias("collected_amount"), (F.col("status") == "F").cast("int").alias("is_completed")))


@register("objection_candidates", with_("filings") + """
SELECT return_id AS audit_case_id, party_id, 'FINALIZED' AS case_status_code, is_on_time AS taxpayer_agreed, assessed_amount AS total_amount_assessed
FROM filings WHERE status = 'F' AND is_on_time = 0 AND assessed_amount > 0""")
def q_objection_candidates(spark, sf_dir):
    f = B.filings(B.tables(spark, sf_dir))
    return M.objection_candidates(f.select(
        F.col("return_id").alias("audit_case_id"), "party_id", F.when(F.col("status") == "F", "FINALIZED").otherwise("OPEN").alias("case_status_code"),
        F.col("is_on_time").alias("taxpayer_agreed"), F.col("assessed_amount").alias("total_amount_assessed")))


# ---------------------------------------------------------------- B19, B23 versions
@register("party_versions_at_date", with_("returns") + """,
v AS (SELECT party_id, status, period_date AS valid_from, lead(period_date) OVER (PARTITION BY party_id ORDER BY period_date, return_id) AS valid_to, return_id FROM returns)
SELECT party_id, return_id, status, valid_from, valid_to, CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END AS is_current
FROM v WHERE valid_from <= DATE '1998-06-30' AND (valid_to IS NULL OR valid_to > DATE '1998-06-30')""")
def q_party_versions_at_date(spark, sf_dir):
    return SCD.point_in_time(_versions(spark, sf_dir), "1998-06-30")


def _versions(spark, sf_dir):
    """A party's status from return to return."""
    r = B.returns(B.tables(spark, sf_dir)).select("party_id", "return_id", "status", F.col("period_date").alias("valid_from"))
    nxt = RNG.cut(r, ["party_id"], [F.col("valid_from").desc(), F.col("return_id").desc()])
    out = RNG.filled(nxt, ["party_id"], {"valid_to": "valid_from"}, inclusive=False).drop(RNG.AT, RNG.PART)
    return out.withColumn("is_current", F.col("valid_to").isNull().cast("int"))


@register("current_party_status", with_("returns") + """,
v AS (SELECT party_id, status, period_date AS valid_from, lead(period_date) OVER (PARTITION BY party_id ORDER BY period_date, return_id) AS valid_to, return_id FROM returns)
SELECT party_id, return_id, status, valid_from FROM v WHERE valid_to IS NULL""")
def q_current_party_status(spark, sf_dir):
    return SEL.current_rows(_versions(spark, sf_dir)).select("party_id", "return_id", "status", "valid_from")


# ---------------------------------------------------------------- B21, B22, C17 codes by country and language
@register("effective_market_codes", """
SELECT c_mktsegment AS code, c_nationkey AS country, n, specific FROM (
  SELECT c_mktsegment, c_nationkey, COUNT(*) AS n, 1 AS specific FROM customer WHERE c_nationkey = 7 AND c_mktsegment < 'F' GROUP BY 1, 2
  UNION ALL SELECT c_mktsegment, NULL, COUNT(*), 0 FROM customer WHERE c_mktsegment >= 'F' GROUP BY 1)""")
def q_effective_market_codes(spark, sf_dir):
    """Country 7 has rows of its own for some codes, all others are universal."""
    c = B.tables(spark, sf_dir).customer
    spec = (c.where("c_nationkey is not null and c_mktsegment < 'F'").groupBy(F.col("c_mktsegment").alias("code"), F.col("c_nationkey").alias("country"))
            .agg(F.count(F.lit(1)).alias("n")).withColumn("specific", F.lit(1)))
    univ = (c.groupBy(F.col("c_mktsegment").alias("code")).agg(F.count(F.lit(1)).alias("n"))
            .select("code", F.lit(None).cast(spec.schema["country"].dataType).alias("country"), "n", F.lit(0).alias("specific")))
    return SEL.effective_code_lookup(spec.unionByName(univ), "code", "country", 7, tiebreak=["country"])


@register("localized_nations", """
SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'mt:' || n_name WHEN n_nationkey % 3 = 0 THEN 'en:' || n_name END AS label FROM nation""")
def q_localized_nations(spark, sf_dir):
    n = B.tables(spark, sf_dir).nation.select("n_nationkey", "n_name")
    tr = n.select(F.col("n_nationkey").alias("entity"), F.lit("name").alias("attribute_name"), F.explode(F.array(
        F.when(F.col("n_nationkey") % 2 == 0, F.lit("mt")), F.when(F.col("n_nationkey") % 3 == 0, F.lit("en")))).alias("language_code"), "n_name")
    tr = tr.where("language_code is not null").withColumn("translated_value", F.concat_ws(":", "language_code", "n_name"))
    return SEL.localized_value(n, tr.drop("n_name"), {"n_nationkey": "entity"}, "name", "mt")


@register("universal_or_specific_rates", with_("party") + """,
ref AS (SELECT DISTINCT segment, nation_key AS country, 1 AS kind FROM party WHERE nation_key < 5 AND segment < 'F'
        UNION ALL SELECT DISTINCT segment, NULL, 0 FROM party)
SELECT p.party_id, p.segment, p.nation_key AS country, r.kind FROM party p JOIN ref r ON r.segment = p.segment AND (r.country = p.nation_key OR r.country IS NULL)""")
def q_universal_or_specific_rates(spark, sf_dir):
    p = B.party(B.tables(spark, sf_dir)).select("party_id", "segment", F.col("nation_key").alias("country"))
    spec = p.where("country < 5 and segment < 'F'").select("segment", "country", F.lit(1).alias("kind")).distinct()
    univ = p.select("segment", F.lit(None).cast(spec.schema["country"].dataType).alias("country"), F.lit(0).alias("kind")).distinct()
    return JN.join_universal_or_specific(p, spec.unionByName(univ), ["segment"], "country").select("party_id", "segment", "country", "kind")


# ---------------------------------------------------------------- E03, E08, E09, D18, D19, F03, L17
@register("first_return_day_after_due", with_("returns") + """,
d AS (SELECT DISTINCT period_date FROM returns WHERE status = 'P')
SELECT r.return_id, r.due_date, (SELECT MIN(d.period_date) FROM d WHERE d.period_date >= r.due_date) AS next_day FROM returns r""")
def q_first_return_day_after_due(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    return WIN.first_on_or_after(r.select("return_id", "due_date"), "due_date", r.where("status = 'P'"), "period_date", "next_day")


@register("linked_periods", with_("returns") + """,
p AS (SELECT tax_type_code, CAST(date_trunc('month', period_date) AS DATE) AS period_start, MIN(return_id) AS period_key FROM returns GROUP BY 1, 2)
SELECT a.tax_type_code, a.period_start, a.period_key, lag(a.period_key) OVER (PARTITION BY a.tax_type_code ORDER BY a.period_start) AS prior_period_key,
  b.period_key AS same_period_prior_year_key
FROM p a LEFT JOIN p b ON b.tax_type_code = a.tax_type_code AND b.period_start = CAST(a.period_start - INTERVAL 12 MONTH AS DATE)""")
def q_linked_periods(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir))
    p = r.groupBy("tax_type_code", F.trunc("period_date", "month").alias("period_start")).agg(F.min("return_id").alias("period_key"))
    return WIN.link_prior_periods(p, ["tax_type_code"], "period_start", "period_key")


@register("party_activity_span", with_("payments") + """
SELECT party_id, MIN(payment_date) AS min_date, MAX(payment_date) AS max_date, COUNT(*) AS row_count FROM payments GROUP BY 1""")
def q_party_activity_span(spark, sf_dir):
    return AGG.min_max_span(B.payments(B.tables(spark, sf_dir)), ["party_id"], "payment_date")


@register("paid_ratio_by_type", with_("filings") + f""",
g AS (SELECT tax_type_code, SUM(CAST(paid_amount AS DECIMAL(19,2))) AS sum_paid_amount, SUM(assessed_amount) AS sum_assessed_amount FROM filings GROUP BY 1)
SELECT tax_type_code, sum_paid_amount, sum_assessed_amount, {sql_pct("sum_paid_amount", "sum_assessed_amount")} AS ratio_pct FROM g""")
def q_paid_ratio_by_type(spark, sf_dir):
    return AGG.ratio_recompute(B.filings(B.tables(spark, sf_dir)), ["tax_type_code"], "paid_amount", "assessed_amount")


@register("parties_in_report_order", with_("party") + "SELECT party_id, segment, balance FROM party")
def q_parties_in_report_order(spark, sf_dir):
    p = B.party(B.tables(spark, sf_dir)).select("party_id", "segment", "balance")
    return SEL.ordered_output(p, [("segment", "asc"), ("balance", "desc"), ("party_id", "asc")])


@register("identifier_lengths", with_("party") + """,
x AS (SELECT COUNT(*) FILTER (WHERE length(party_name) NOT IN (9, 10, 12)) AS bad, COUNT(*) AS n FROM party)
SELECT 'length_party_name' AS check_name, 'party' AS table_name, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS rows_checked,
  bad AS rows_failed, CAST(NULL AS VARCHAR) AS details FROM x""")
def q_identifier_lengths(spark, sf_dir):
    return CHK.check_identifier_length(B.party(B.tables(spark, sf_dir)), "party", "party_name")


# ---------------------------------------------------------------- A06, A07, A12, A13, A17, D21 tables written and read again
@register("staged_and_appended_returns", with_("returns") + """
SELECT return_id, party_id, status, period_date, CAST(year(period_date) * 100 + month(period_date) AS INTEGER) AS ym FROM returns WHERE period_date >= DATE '1997-01-01'""")
def q_staged_and_appended_returns(spark, sf_dir):
    """Truncate and load, append, refresh a fact by month and purge what is older."""
    root = scratch(spark, f"staging-{uuid.uuid4().hex[:8]}")
    r = B.returns(B.tables(spark, sf_dir)).select("return_id", "party_id", "status", "period_date")
    SINK.write_staging(r.where("status = 'F'"), f"{root}/staging")
    SINK.write_staging(r.where("status = 'O'"), f"{root}/staging")  # truncates the first
    SINK.append_staging(r.where("status <> 'O'"), f"{root}/staging")
    SINK.write_partitioned_fact(spark.read.schema(r.schema).parquet(f"{root}/staging"), f"{root}/fact", "period_date", ["party_id"])
    kept = SINK.purge_staging(spark.read.parquet(f"{root}/fact"), "period_date", "1997-12-31", 364)
    SINK.full_refresh(kept, f"{root}/target")
    return spark.read.parquet(f"{root}/target")


# ---------------------------------------------------------------- I29 cases, amounts by kind and risk of a taxpayer
def _grid_join(name, source, date, cols):
    """A measure set per party and snapshot, by comparing every fact with every snapshot."""
    return (f"{name} AS (SELECT g.party_id, g.snapshot_date, {cols} FROM grid g LEFT JOIN ({source}) x "
            f"ON x.party_id = g.party_id AND x.{date} <= g.snapshot_date GROUP BY 1, 2)")


_KIND = "CASE WHEN status = 'F' THEN 'SELF' WHEN status = 'P' THEN 'AUDIT' ELSE 'AMENDED' END"
_RATING = "CASE WHEN assessed_amount > 250000 THEN 'HIGH' WHEN assessed_amount > 100000 THEN 'MEDIUM' ELSE 'LOW' END"


@register("taxpayer_cases", with_("party", "returns", "filings", "payments", "ledger") + "," + _SNAPS + ",\n" + ",\n".join([
    "grid AS (SELECT p.party_id, s.snapshot_date FROM party p, snaps s)",
    _grid_join("a", f"SELECT *, {_KIND} AS kind FROM returns", "period_date",
               "COUNT(x.return_id) AS total_assessments, COALESCE(SUM(x.assessed_amount), 0) AS assessed_amount, "
               "COALESCE(SUM(CASE WHEN kind = 'SELF' THEN x.assessed_amount END), 0) AS self_assessed_amount, "
               "COALESCE(SUM(CASE WHEN kind = 'AUDIT' THEN x.assessed_amount END), 0) AS admin_assessed_amount"),
    _grid_join("u", "SELECT * FROM returns WHERE tax_type_code = '1-URGENT'", "period_date",
               "COUNT(x.return_id) AS audit_cases_count, COALESCE(SUM(CASE WHEN x.status <> 'F' THEN 1 END), 0) AS active"),
    _grid_join("c", "SELECT p.*, r.status FROM payments p JOIN returns r USING (return_id) WHERE r.status = 'O'", "payment_date",
               "COUNT(x.payment_id) AS collection_actions_count, COALESCE(SUM(CASE WHEN x.charge_type_code = 'R' THEN 1 END), 0) AS active"),
    _grid_join("o", "SELECT * FROM filings WHERE is_late = 1", "filing_date", "COALESCE(SUM(CASE WHEN x.status = 'O' THEN 1 END), 0) AS active"),
    _grid_join("b", "SELECT account_id AS party_id, txn_date, amount FROM ledger", "txn_date", "CAST(COALESCE(SUM(x.amount), 0) AS DECIMAL(38,2)) AS bal"),
    f"k AS (SELECT party_id, arg_max({_RATING}, {{'d': period_date, 'r': return_id}}) AS rating FROM returns GROUP BY 1)"]) + """
SELECT party_id, snapshot_date, CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER) AS snapshot_date_key, total_assessments, audit_cases_count,
  collection_actions_count, CAST(assessed_amount AS DECIMAL(38,2)) AS assessed_amount, CAST(self_assessed_amount AS DECIMAL(38,2)) AS self_assessed_amount,
  CAST(admin_assessed_amount AS DECIMAL(38,2)) AS admin_assessed_amount, bal AS outstanding_balance, GREATEST(bal, 0) AS arrears_amount,
  GREATEST(-bal, 0) AS credit_balance, CASE WHEN u.active > 0 THEN 1 ELSE 0 END AS has_active_audit,
  CASE WHEN c.active > 0 THEN 1 ELSE 0 END AS has_active_collection, CASE WHEN o.active > 0 THEN 1 ELSE 0 END AS has_active_objection,
  COALESCE(rating, 'UNKNOWN') AS current_risk_rating
FROM a JOIN u USING (party_id, snapshot_date) JOIN c USING (party_id, snapshot_date) JOIN o USING (party_id, snapshot_date)
  JOIN b USING (party_id, snapshot_date) LEFT JOIN k USING (party_id)""")
def q_taxpayer_cases(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    r, p = B.returns(t), B.payments(t)
    kind = F.when(F.col("status") == "F", "SELF").when(F.col("status") == "P", "AUDIT").otherwise("AMENDED")
    assessed = r.select("party_id", F.col("period_date").alias("assessment_date"), "assessed_amount", kind.alias("assessment_type_code"))
    audits = r.where("tax_type_code = '1-URGENT'").select("party_id", F.col("period_date").alias("selection_date"),
                                                          (F.col("status") != "F").cast("int").alias("is_active"))
    open_ = r.where("status = 'O'").select("return_id")
    collections = p.join(open_, "return_id", "left_semi").select("party_id", F.col("payment_date").alias("action_date"),
                                                                 (F.col("charge_type_code") == "R").cast("int").alias("is_active"))
    objections = B.filings(t).where("is_late = 1").select("party_id", "filing_date", (F.col("status") == "O").cast("int").alias("is_active"))
    risks = r.select("party_id", F.col("period_date").alias("assessment_date"), F.col("return_id").alias("tiebreak"), F.expr(_RATING).alias("risk_rating"))
    return SNAP.build_taxpayer_cases(B.party(t), _AS_OF, assessed, audits, collections, objections, risks,
                                     B.ledger(t).withColumnRenamed("account_id", "party_id"))


# ---------------------------------------------------------------- C03, C04, I21 dimension keys and measures of assessments
@register("assessment_keys_and_measures", with_("filings", "party") + """,
pk AS (SELECT party_id, CAST(ROW_NUMBER() OVER (ORDER BY party_id) AS BIGINT) AS party_key FROM party),
tk AS (SELECT tax_type_code, CAST(ROW_NUMBER() OVER (ORDER BY tax_type_code) AS BIGINT) AS tax_type_key FROM (SELECT DISTINCT tax_type_code FROM returns)),
mk AS (SELECT ym, CAST(ROW_NUMBER() OVER (ORDER BY ym) AS BIGINT) AS tax_period_key FROM (
  SELECT DISTINCT CAST(year(period_date) * 100 + month(period_date) AS INTEGER) AS ym FROM returns WHERE tax_type_code <> '5-LOW'))
SELECT return_id, party_key, tax_type_key, COALESCE(tax_period_key, 0) AS tax_period_key,
  """ + _KEY("period_date") + """ AS assessment_date_key, """ + _KEY("COALESCE(filing_date, period_date)") + """ AS filing_date_key, assessed_amount AS assessed_tax_amount,
  CAST(CASE WHEN assessed_amount > 0 THEN assessed_amount * 10 ELSE 0 END AS DECIMAL(19,2)) AS tax_base_amount,
  CAST(NULLIF(declared_amount, 0) AS DECIMAL(19,2)) AS declared_tax_amount, date_diff('day', filing_date, last_ship_date) AS processing_days
FROM filings f JOIN pk USING (party_id) JOIN tk USING (tax_type_code)
LEFT JOIN mk ON mk.ym = CAST(year(period_date) * 100 + month(period_date) AS INTEGER)""")
def q_assessment_keys_and_measures(spark, sf_dir):
    """Rows without a party or type are dropped, an unknown period is key 0, a
    return that was not filed has the assessment's date in that role."""
    t = B.tables(spark, sf_dir)
    r = B.returns(t)
    ym = year_month_key("period_date")
    parties = KEYS.sequential_key(B.party(t).select("party_id"), ["party_id"], "party_key")
    types = KEYS.sequential_key(r.select("tax_type_code").distinct(), ["tax_type_code"], "tax_type_key")
    months = KEYS.sequential_key(r.where("tax_type_code != '5-LOW'").select(ym.alias("ym")).distinct(), ["ym"], "tax_period_key")
    f = B.filings(t).withColumn("ym", ym)
    f = KEYS.resolve_dimension_key(f, parties, {"party_id": "party_id"}, "party_key")
    f = KEYS.resolve_dimension_key(f, types, {"tax_type_code": "tax_type_code"}, "tax_type_key")
    f = KEYS.resolve_dimension_key(f, months, {"ym": "ym"}, "tax_period_key", on_missing="unknown", unknown_key=0)
    f = f.withColumn("assessment_date_key", date_key("period_date")).withColumn("filing_date_key", date_key("filing_date"))
    f = KEYS.resolve_optional_key(f, "filing_date_key", "assessment_date_key")
    assessed = F.col("assessed_amount")
    return f.select("return_id", "party_key", "tax_type_key", F.col("tax_period_key").cast("long").alias("tax_period_key"), "assessment_date_key", "filing_date_key",
                    assessed.alias("assessed_tax_amount"),
                    F.when(assessed > 0, assessed * FCT.TAX_BASE_MULTIPLIER).otherwise(F.lit(0)).cast("decimal(19,2)").alias("tax_base_amount"),
                    F.nullif(F.col("declared_amount"), F.lit(0)).cast("decimal(19,2)").alias("declared_tax_amount"),
                    F.datediff("last_ship_date", "filing_date").alias("processing_days"))
