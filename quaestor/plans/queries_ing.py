"""Registered queries: ingestion (mapping, staging, incremental), data
quality, warehouse checks, identifiers, joins, and the streaming loads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quaestor.functions import identifiers as ID
from quaestor.functions.numeric import money
from quaestor.operators import checks as CHK, dq as DQ, joins as JN, mapping as MAP, select as SEL
from quaestor.operators.keys import attach_scalars
from quaestor.plans import bindings as B, calendar as CAL, dims as DIM
from quaestor.plans.catalog import register, sql_pct
from quaestor.plans.queries_wh import TYPE_CATEGORIES, TYPE_FREQUENCIES, _spine
from quaestor.plans.sqlbind import with_
from quaestor.sources import scan as SC

_AS_OF = B.AS_OF_ORDERS

# Code map of the ingestion example (market segment -> party class).
SEGMENT_CODES = {"AUTOMOBILE": "AUTO", "BUILDING": "CONSTRUCTION", "FURNITURE": "RETAIL", "MACHINERY": "INDUSTRY"}

CUSTOMER_MAPPING = [
    {"source_column": "c_custkey", "target_column": "party_id", "data_type": "BIGINT", "is_key": True},
    {"source_column": "c_name", "target_column": "party_name", "transformation_type": "EXPRESSION",
     "expression": "UPPER(TRIM({source_column}))", "data_type": "VARCHAR"},
    {"source_column": "c_mktsegment", "target_column": "party_class", "transformation_type": "LOOKUP",
     "lookup": SEGMENT_CODES, "fallback": "OTHER"},
    {"source_column": "c_nationkey", "target_column": "nation_name", "transformation_type": "LOOKUP_TABLE",
     "lookup_table": "nation", "lookup_key": "n_nationkey", "lookup_value": "n_name"},
    {"source_column": "c_acctbal", "target_column": "balance", "data_type": "DECIMAL"},
    {"source_column": "c_phone", "target_column": "phone", "default": "UNKNOWN"},
    {"source_column": "c_name", "target_column": "name_id", "transformation_type": "FUNCTION",
     "function": "clean_identifier"},
]


# ---------------------------------------------------------------- B01-B10, B12, B13
@register("ingest_customer_mapping", """
SELECT CAST(c.c_custkey AS BIGINT) AS party_id, CAST(upper(trim(c.c_name)) AS VARCHAR) AS party_name,
  CASE WHEN c.c_mktsegment IS NULL THEN NULL ELSE COALESCE(""" + "CASE c.c_mktsegment " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_CODES.items()) + """ END, 'OTHER') END AS party_class,
  n.n_name AS nation_name, CAST(c.c_acctbal AS DECIMAL(19,2)) AS balance, 'UNKNOWN' AS phone,
  upper(trim(regexp_replace(c.c_name, '[^0-9A-Za-z]', '', 'g'))) AS name_id, 0 AS error_count,
  concat_ws(':', CAST(c.c_custkey AS BIGINT)) AS _row_id
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def q_ingest_customer_mapping(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    src = t.customer.withColumn("c_phone", F.lit(None).cast("string"))
    mapped = MAP.apply_mapping(src, CUSTOMER_MAPPING, {"nation": t.nation}, bounded_lookups=("nation",))
    out = mapped.withColumn("error_count", F.size("_errors")).drop("_errors")
    return MAP.with_row_identifier(out, ["party_id"])


# ---------------------------------------------------------------- B14 staging model
ORDER_STAGE_MAPPING = [
    {"source_column": "o_orderkey", "target_column": "return_id", "data_type": "BIGINT"},
    {"source_column": "o_custkey", "target_column": "party_id", "data_type": "BIGINT"},
    {"source_column": "o_orderpriority", "target_column": "tax_type_code", "data_type": "VARCHAR"},
    {"source_column": "o_totalprice", "target_column": "assessed_amount", "data_type": "DECIMAL"},
]


@register("stage_incremental_orders", """
SELECT CAST(o_orderkey AS BIGINT) AS return_id, CAST(o_custkey AS BIGINT) AS party_id, CAST(o_orderpriority AS VARCHAR) AS tax_type_code,
  CAST(o_totalprice AS DECIMAL(19,2)) AS assessed_amount, o_orderdate,
  md5(concat_ws('|', COALESCE(CAST(CAST(o_orderkey AS BIGINT) AS VARCHAR), '_null_'))) AS _surrogate_key,
  TIMESTAMP '2001-08-02 00:00:00' AS _loaded_at, 'erp' AS _source_database, 'orders' AS _source_table
FROM orders WHERE o_orderdate > TIMESTAMP '2000-12-31 00:00:00' AND o_orderkey IS NOT NULL""")
def q_stage_incremental_orders(spark, sf_dir):
    o = B.tables(spark, sf_dir).orders
    out = MAP.stage_incremental(o, "o_orderdate", "2000-12-31 00:00:00", ORDER_STAGE_MAPPING, ["o_orderkey"],
                                "erp", "orders", "2001-08-02 00:00:00")
    return out.withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp_ntz"))


# ---------------------------------------------------------------- B15 intermediate typed model
@register("intermediate_orders", f"""
SELECT CAST(CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1900-01-01' AND CAST(o_orderdate AS DATE) <= CAST(DATE '{_AS_OF}' + INTERVAL 120 MONTH AS DATE)
            THEN CAST(o_orderdate AS DATE) END AS DATE) AS o_orderdate,
  upper(trim(o_orderpriority)) AS o_orderpriority, upper(trim(o_orderstatus)) AS o_orderstatus,
  COALESCE(o_totalprice, 0) AS o_totalprice,
  upper(trim(regexp_replace(CAST(o_custkey AS VARCHAR), '[^0-9A-Za-z]', '', 'g'))) AS o_custkey,
  md5(concat_ws('|', COALESCE(CAST(o_orderkey AS VARCHAR), '_null_'))) AS _record_key
FROM orders""")
def q_intermediate_orders(spark, sf_dir):
    o = B.tables(spark, sf_dir).orders
    fields = [("o_orderdate", "DATE"), ("o_orderpriority", "CODE"), ("o_orderstatus", "CODE"),
              ("o_totalprice", "CURRENCY"), ("o_custkey", "TIN"), ("o_orderkey", "INTEGER")]
    out = MAP.transform_by_data_type(o, fields, _AS_OF, record_key=["o_orderkey"])
    return out.drop("_transformed_at", "o_orderkey")


# ---------------------------------------------------------------- A02 / A03 / B16 incremental with lookback
@register("incremental_orders_lookback", """
WITH wm AS (SELECT MAX(o_orderdate) AS hw FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00')
SELECT o_orderkey, o_custkey, o_orderdate FROM orders, wm WHERE o_orderdate > hw - INTERVAL 24 HOUR""")
def q_incremental_orders_lookback(spark, sf_dir):
    o = B.tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    hw = SC.high_watermark(o.where(F.col("o_orderdate") < F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")),
                           "o_orderdate", "__hw")
    j = attach_scalars(o, hw)
    return j.where(F.col("o_orderdate") > F.col("__hw") - F.expr("INTERVAL 24 HOURS")).drop("__hw")


# ---------------------------------------------------------------- A05 profile
def _profile_sql(table, cols):
    parts = []
    for c, t in cols:
        parts.append(f"""SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,
  COUNT(DISTINCT {c}) AS distinct_count, CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value,
  CAST(MAX(length(CAST({c} AS VARCHAR))) AS INTEGER) AS max_length,
  CASE WHEN COUNT(DISTINCT {c}) = COUNT(*) AND COUNT(*) FILTER (WHERE {c} IS NULL) = 0 THEN 1 ELSE 0 END AS is_key_candidate,
  COUNT(*) AS row_count FROM {table}""")
    return "\nUNION ALL\n".join(parts)


@register("profile_orders", _profile_sql("orders", [("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                                                    ("o_orderstatus", "string"), ("o_orderpriority", "string")]))
def q_profile_orders(spark, sf_dir):
    o = B.tables(spark, sf_dir).orders
    return SC.profile_table(o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


# ---------------------------------------------------------------- L01-L10 rule engine over return lines
LINE_RULES = [
    {"rule_code": "DQ_NN_FLAG", "rule_type": "NOT_NULL", "columns": ["l_returnflag"]},
    {"rule_code": "DQ_PAT_STATUS", "rule_type": "PATTERN", "columns": ["l_linestatus"], "params": {"pattern": "[OF]$"}},
    {"rule_code": "DQ_RNG_DISC", "rule_type": "RANGE", "columns": ["l_discount"], "params": {"min": 0, "max": 0.08},
     "severity": "WARNING", "action": "FLAG"},
    {"rule_code": "DQ_LEN_FLAG", "rule_type": "LENGTH", "columns": ["l_returnflag"], "params": {"min": 1, "max": 1}},
    {"rule_code": "DQ_DATE_SHIP", "rule_type": "DATE_RANGE", "columns": ["l_shipdate"],
     "params": {"min": "1995-01-01", "max": "CURRENT_DATE"}, "severity": "WARNING", "action": "FLAG"},
    {"rule_code": "DQ_VAL_FLAG", "rule_type": "ALLOWED_VALUES", "columns": ["l_returnflag"], "params": {"values": ["A", "N"]},
     "severity": "CRITICAL"},
    {"rule_code": "DQ_UNQ_LINE", "rule_type": "UNIQUE", "columns": ["l_orderkey", "l_linenumber"]},
    {"rule_code": "DQ_REF_PART", "rule_type": "REFERENTIAL", "columns": ["l_partkey"],
     "params": {"reference": "part", "reference_column": "p_partkey"}},
    {"rule_code": "DQ_CUSTOM_QTY", "rule_type": "CUSTOM", "columns": ["l_quantity"], "params": {"expression": "l_quantity <= 49"},
     "severity": "WARNING", "action": "FLAG"},
]

_VIOL_SQL = f"""WITH dup AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1),
v AS (
 SELECT l.*, 'DQ_NN_FLAG' AS rule_code, 'NOT_NULL' AS rule_type, 'ERROR' AS severity, 'REJECT' AS action, 'l_returnflag' AS column_name, l_returnflag AS value FROM lineitem l WHERE l_returnflag IS NULL OR trim(l_returnflag) = ''
 UNION ALL SELECT l.*, 'DQ_PAT_STATUS', 'PATTERN', 'ERROR', 'REJECT', 'l_linestatus', l_linestatus FROM lineitem l WHERE l_linestatus IS NOT NULL AND NOT regexp_matches(l_linestatus, '^(?:[OF]$)')
 UNION ALL SELECT l.*, 'DQ_RNG_DISC', 'RANGE', 'WARNING', 'FLAG', 'l_discount', CAST(l_discount AS VARCHAR) FROM lineitem l WHERE l_discount IS NOT NULL AND (l_discount < 0 OR l_discount > 0.08)
 UNION ALL SELECT l.*, 'DQ_LEN_FLAG', 'LENGTH', 'ERROR', 'REJECT', 'l_returnflag', l_returnflag FROM lineitem l WHERE l_returnflag IS NOT NULL AND (length(l_returnflag) < 1 OR length(l_returnflag) > 1)
 UNION ALL SELECT l.*, 'DQ_DATE_SHIP', 'DATE_RANGE', 'WARNING', 'FLAG', 'l_shipdate', CAST(l_shipdate AS VARCHAR) FROM lineitem l WHERE l_shipdate IS NOT NULL AND (CAST(l_shipdate AS DATE) < DATE '1995-01-01' OR CAST(l_shipdate AS DATE) > DATE '{_AS_OF}')
 UNION ALL SELECT l.*, 'DQ_VAL_FLAG', 'ALLOWED_VALUES', 'CRITICAL', 'REJECT', 'l_returnflag', l_returnflag FROM lineitem l WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N')
 UNION ALL SELECT l.*, 'DQ_UNQ_LINE', 'UNIQUE', 'ERROR', 'REJECT', 'l_orderkey,l_linenumber', CAST(l.l_orderkey AS VARCHAR) || ':' || CAST(l.l_linenumber AS VARCHAR) FROM lineitem l JOIN dup USING (l_orderkey, l_linenumber)
 UNION ALL SELECT l.*, 'DQ_REF_PART', 'REFERENTIAL', 'ERROR', 'REJECT', 'l_partkey', CAST(l_partkey AS VARCHAR) FROM lineitem l WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
 UNION ALL SELECT l.*, 'DQ_CUSTOM_QTY', 'CUSTOM', 'WARNING', 'FLAG', 'l_quantity', CAST(l_quantity AS VARCHAR) FROM lineitem l WHERE NOT COALESCE(l_quantity <= 49, TRUE))
"""


def _annotated(t):
    return DQ.apply_rules(t.lineitem, LINE_RULES, _AS_OF, {"part": t.part})


@register("dq_rule_outcomes", _VIOL_SQL + """
SELECT rule_code, rule_type, severity, action, COUNT(*) AS violation_count FROM v GROUP BY 1, 2, 3, 4""")
def q_dq_rule_outcomes(spark, sf_dir):
    return DQ.rule_outcomes(_annotated(B.tables(spark, sf_dir)), LINE_RULES).drop("rows_affected")


@register("dq_violation_log", _VIOL_SQL + """
SELECT 'run-1' AS execution_id, 'lineitem' AS table_name, CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS row_id,
  rule_code, rule_type, severity, action, column_name, value, rule_type || ' check failed' AS message FROM v""")
def q_dq_violation_log(spark, sf_dir):
    return DQ.violation_log(_annotated(B.tables(spark, sf_dir)), ["l_orderkey", "l_linenumber"], "run-1", "lineitem")


@register("dq_error_budget", _VIOL_SQL + """,
rej AS (SELECT COUNT(*) AS n FROM lineitem l WHERE EXISTS (SELECT 1 FROM v WHERE v.severity IN ('ERROR', 'CRITICAL') AND v.action = 'REJECT'
          AND v.l_orderkey = l.l_orderkey AND v.l_linenumber = l.l_linenumber AND v.l_partkey = l.l_partkey AND v.l_suppkey = l.l_suppkey
          AND v.l_quantity = l.l_quantity AND v.l_extendedprice = l.l_extendedprice AND v.l_discount = l.l_discount AND v.l_tax = l.l_tax
          AND v.l_returnflag = l.l_returnflag AND v.l_linestatus = l.l_linestatus AND v.l_shipdate = l.l_shipdate))
SELECT (SELECT COUNT(*) FROM lineitem) AS total_rows, rej.n AS rejected_rows,
  """ + sql_pct("rej.n", "(SELECT COUNT(*) FROM lineitem)") + """ AS reject_pct,
  CASE WHEN """ + sql_pct("rej.n", "(SELECT COUNT(*) FROM lineitem)") + """ > 5 THEN 'FAIL' ELSE 'PASS' END AS status FROM rej""")
def q_dq_error_budget(spark, sf_dir):
    return DQ.error_budget(_annotated(B.tables(spark, sf_dir)), 5.0)


@register("dq_valid_rows", _VIOL_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.l_orderkey = l.l_orderkey AND v.l_linenumber = l.l_linenumber AND v.l_partkey = l.l_partkey
                  AND v.l_suppkey = l.l_suppkey AND v.l_shipdate = l.l_shipdate AND v.l_extendedprice = l.l_extendedprice
                  AND v.l_quantity = l.l_quantity AND v.l_discount = l.l_discount AND v.l_tax = l.l_tax
                  AND v.l_returnflag = l.l_returnflag AND v.l_linestatus = l.l_linestatus
                  AND v.severity IN ('ERROR', 'CRITICAL') AND v.action = 'REJECT')""")
def q_dq_valid_rows(spark, sf_dir):
    return DQ.valid_rows(_annotated(B.tables(spark, sf_dir))).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# ---------------------------------------------------------------- L13-L21 warehouse check pack
@register("warehouse_validation", with_("filings", "party", "return_lines") + f""",
chk AS (
 SELECT 'row_count' AS check_name, 'fact_filing' AS table_name,
   CASE WHEN ABS((SELECT COUNT(*) FROM filings) - (SELECT COUNT(*) FROM orders)) = 0 THEN 'PASS'
        WHEN ABS((SELECT COUNT(*) FROM filings) - (SELECT COUNT(*) FROM orders)) <= 1 THEN 'WARNING' ELSE 'FAIL' END AS status,
   (SELECT COUNT(*) FROM filings) AS rows_checked, ABS((SELECT COUNT(*) FROM filings) - (SELECT COUNT(*) FROM orders)) AS rows_failed
 UNION ALL SELECT 'fk_party_id', 'fact_filing', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n, n FROM
   (SELECT COUNT(*) AS n FROM filings f WHERE party_id IS NOT NULL AND party_id <> 0 AND NOT EXISTS (SELECT 1 FROM party p WHERE p.party_id = f.party_id))
 UNION ALL SELECT 'natural_key_unique', 'return_lines', CASE WHEN d = 0 THEN 'PASS' ELSE 'FAIL' END, r, d FROM
   (SELECT COUNT(*) AS d, COALESCE(SUM(n), 0) AS r FROM (SELECT return_id, line_number, COUNT(*) AS n FROM return_lines GROUP BY 1, 2 HAVING COUNT(*) > 1))
 UNION ALL SELECT 'mandatory_party_name', 'dim_party', CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END, c, m FROM
   (SELECT COUNT(*) AS c, COUNT(*) FILTER (WHERE party_name IS NULL OR trim(party_name) = '') AS m FROM party)
 UNION ALL SELECT 'mandatory_segment', 'dim_party', CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END, c, m FROM
   (SELECT COUNT(*) AS c, COUNT(*) FILTER (WHERE segment IS NULL OR trim(segment) = '') AS m FROM party)
 UNION ALL SELECT 'range_discount', 'return_lines', CASE WHEN b = 0 THEN 'PASS' ELSE 'FAIL' END, c, b FROM
   (SELECT COUNT(*) AS c, COUNT(*) FILTER (WHERE discount * 100 < 0 OR discount * 100 > 100) AS b FROM return_lines)
 UNION ALL SELECT 'date_coverage_period_date', 'fact_filing', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n, n FROM
   (SELECT COUNT(*) AS n FROM filings WHERE period_date IS NOT NULL AND period_date NOT IN
     (SELECT CAST(unnest(generate_series(CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) FROM orders)))
SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) FILTER (WHERE status = 'FAIL') AS failed,
  COUNT(*) FILTER (WHERE status = 'WARNING') AS warnings, {sql_pct("COUNT(*) FILTER (WHERE status = 'PASS')", 'COUNT(*)')} AS pass_rate,
  CASE WHEN COUNT(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASSED' ELSE 'FAILED' END AS verdict
FROM chk""")
def q_warehouse_validation(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    f, p, rl = B.filings(t), B.party(t), B.return_lines(t)
    lines_pct = rl.withColumn("discount_pct", F.col("discount") * 100)
    res = (CHK.check_row_counts(t.orders, f, "fact_filing")
           .unionByName(CHK.check_foreign_keys(f, "fact_filing", {"party_id": (p, "party_id")}))
           .unionByName(CHK.check_natural_keys(rl, "return_lines", ["return_id", "line_number"]))
           .unionByName(CHK.check_mandatory(p, "dim_party", ["party_name", "segment"]))
           .unionByName(CHK.check_score_range(lines_pct, "return_lines", "discount_pct"))
           .unionByName(CHK.check_date_coverage(f, "fact_filing", "period_date", _spine(t), "full_date")))
    return CHK.validation_report(res)


# ---------------------------------------------------------------- H18 / H19 identifier checks
@register("identifier_checks", """
WITH x AS (SELECT c_custkey AS party_id, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS tin FROM customer),
d AS (SELECT *, list_transform(string_split(reverse(tin), ''), lambda ch: CAST(ch AS INTEGER)) AS rd FROM x)
SELECT party_id, tin, regexp_matches(tin, '^\\d{9}$') AS tin_valid,
  (len(rd) > 1 AND list_sum(list_transform(rd, lambda v, i: CASE WHEN i % 2 = 0 THEN (CASE WHEN v * 2 > 9 THEN v * 2 - 9 ELSE v * 2 END) ELSE v END)) % 10 = 0) AS luhn_valid,
  (len(rd) > 1 AND rd[1] = CASE WHEN (11 - list_sum(list_transform(rd[2:], lambda v, i: v * (i + 1))) % 11) % 11 = 10 THEN 0
                             ELSE (11 - list_sum(list_transform(rd[2:], lambda v, i: v * (i + 1))) % 11) % 11 END) AS mod11_valid
FROM d""")
def q_identifier_checks(spark, sf_dir):
    c = B.tables(spark, sf_dir).customer
    x = c.select(F.col("c_custkey").alias("party_id"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("tin"))
    return x.select("party_id", "tin", ID.valid_tin("tin").alias("tin_valid"), ID.luhn_valid("tin").alias("luhn_valid"),
                    ID.mod11_valid("tin").alias("mod11_valid"))


# ---------------------------------------------------------------- C13 / C12 / C19
@register("returns_without_lines", with_("returns", "return_lines") + """
SELECT r.return_id, r.party_id, r.assessed_amount FROM returns r WHERE NOT EXISTS (SELECT 1 FROM return_lines l WHERE l.return_id = r.return_id)""")
def q_returns_without_lines(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    return JN.join_anti(B.returns(t).select("return_id", "party_id", "assessed_amount"),
                        B.return_lines(t).select("return_id"), "return_id")


@register("party_return_stats", with_("party", "returns") + """
SELECT p.party_id, COALESCE(r.return_count, 0) AS return_count, COALESCE(r.total_assessed, 0) AS total_assessed, r.first_period
FROM party p LEFT JOIN (SELECT party_id, COUNT(*) AS return_count, SUM(assessed_amount) AS total_assessed, MIN(period_date) AS first_period
                        FROM returns GROUP BY 1) r USING (party_id)
WHERE EXISTS (SELECT 1 FROM returns x WHERE x.party_id = p.party_id)""")
def q_party_return_stats(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    r = B.returns(t)
    p = JN.join_semi(B.party(t).select("party_id"), r.select("party_id"), "party_id")
    return JN.correlated_aggregate(p, r, "party_id", "party_id",
                                   {"return_count": F.count(F.lit(1)), "total_assessed": F.sum("assessed_amount"),
                                    "first_period": F.min("period_date")}, ["return_count", "total_assessed"])


# ---------------------------------------------------------------- C14 anti join over code lists
@register("unregistered_tax_types", with_("returns") + """,
lst AS (SELECT party_id, array_to_string(list_sort(list(DISTINCT tax_type_code)), ',') AS codes FROM returns GROUP BY 1),
ex AS (SELECT party_id, trim(unnest(string_split(codes, ','))) AS code FROM lst)
SELECT party_id, code FROM ex WHERE code <> '' AND code NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')""")
def q_unregistered_tax_types(spark, sf_dir):
    from quaestor.operators.aggregates import collect_values
    t = B.tables(spark, sf_dir)
    r = B.returns(t).select("party_id", "tax_type_code").distinct()
    lst = collect_values(r, ["party_id"], "tax_type_code", "codes", ",")
    types = DIM.build_dim_tax_type(t.orders, "o_orderpriority", TYPE_CATEGORIES, TYPE_FREQUENCIES)
    active = types.where(F.col("filing_frequency") != "ANNUAL")
    return JN.join_anti_array(lst, "codes", "party_id", active, "tax_type_code")


# ---------------------------------------------------------------- B17 status mapping via seed
@register("return_status_mapping", """
SELECT o_orderkey AS return_id, COALESCE(CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OPEN' END, 'UNKNOWN') AS status
FROM orders""")
def q_return_status_mapping(spark, sf_dir):
    o = B.tables(spark, sf_dir).orders
    seed = spark.createDataFrame([("F", "FINAL"), ("O", "OPEN")], "source_code string, target_code string")
    out = MAP.map_status_code(o.select(F.col("o_orderkey").alias("return_id"), F.col("o_orderstatus").alias("status")),
                              "status", seed)
    return out


# ---------------------------------------------------------------- B20 expiring within
@register("returns_due_soon", with_("returns") + f"""
SELECT return_id, due_date, date_diff('day', DATE '{_AS_OF}', due_date) AS days_until_expiry FROM returns
WHERE due_date BETWEEN DATE '{_AS_OF}' AND CAST(DATE '{_AS_OF}' + 45 AS DATE)""")
def q_returns_due_soon(spark, sf_dir):
    r = B.returns(B.tables(spark, sf_dir)).select("return_id", "due_date")
    return SEL.expiring_within(r, "due_date", _AS_OF, 45)


# ---------------------------------------------------------------- B24 whole-word search
@register("part_name_search", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)\\bring\\b')""")
def q_part_name_search(spark, sf_dir):
    return SEL.text_search(B.tables(spark, sf_dir).part.select("p_partkey", "p_name"), "p_name", "ring")


# ---------------------------------------------------------------- B25 eligibility
SCHEMES = [("SMALL_BUSINESS", 1000.0), ("STANDARD", 5000.0)]


@register("scheme_eligibility", with_("party") + """
SELECT p.party_id, p.balance, s.scheme_code, CAST(s.threshold AS DECIMAL(19,2)) AS threshold,
  CASE WHEN p.balance <= s.threshold THEN 'ELIGIBLE' ELSE 'NOT_ELIGIBLE' END AS eligibility
FROM party p, (VALUES ('SMALL_BUSINESS', 1000.0), ('STANDARD', 5000.0)) s(scheme_code, threshold)""")
def q_scheme_eligibility(spark, sf_dir):
    p = B.party(B.tables(spark, sf_dir)).select("party_id", "balance")
    return SEL.eligibility_check(p, "balance", SCHEMES)


# ---------------------------------------------------------------- J01 streaming upsert (batch twin = the table)
@register("stream_upsert_returns", with_("returns") + """
SELECT return_id, party_id, tax_type_code, period_date, assessed_amount, status FROM returns""")
def q_stream_upsert_returns(spark, sf_dir):
    from quaestor.streaming.incremental import incremental_upsert_stream, scratch
    t = B.tables(spark, sf_dir)
    schema = t.orders.schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
           .select(F.col("o_orderkey").alias("return_id"), F.col("o_custkey").alias("party_id"),
                   F.col("o_orderpriority").alias("tax_type_code"), F.col("o_orderdate").cast("date").alias("period_date"),
                   money("o_totalprice").alias("assessed_amount"), F.col("o_orderstatus").alias("status")))
    root = scratch(spark, f"stream-upsert-{uuid.uuid4().hex[:8]}")
    q, versions = incremental_upsert_stream(spark, src, f"{root}/target", ["return_id"], ["period_date"],
                                            checkpoint=f"{root}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(versions[-1])


# ---------------------------------------------------------------- J03 streaming running summary
@register("stream_event_summary", with_("ev") + """
SELECT party_id, COUNT(*) AS state_count, SUM(event_value) AS state_sum, MAX(event_value) AS state_max,
  CAST(FLOOR(CAST(SUM(event_value) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0.0) * 100.0 + 0.5) / 100.0 AS DECIMAL(18,2)) AS state_avg
FROM ev GROUP BY 1""")
def q_stream_event_summary(spark, sf_dir):
    from quaestor.streaming.incremental import read_summary, running_summary_stream, scratch
    t = B.tables(spark, sf_dir)
    src = (spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
           .select(F.col("user_id").alias("party_id"), money("value").alias("event_value")))
    root = scratch(spark, f"stream-summary-{uuid.uuid4().hex[:8]}")
    q = running_summary_stream(spark, src, ["party_id"], "event_value", f"{root}/target", checkpoint=f"{root}/ckpt")
    q.awaitTermination()
    return read_summary(spark, f"{root}/target", ["party_id"])


# ---------------------------------------------------------------- J06 freshness
@register("source_freshness", """
SELECT event_type, MAX(ts) AS last_loaded_at,
  CAST(FLOOR((epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(MAX(ts))) / 3600) AS BIGINT) AS hours_since_load,
  CASE WHEN FLOOR((epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(MAX(ts))) / 3600) > 48 THEN 'ERROR'
       WHEN FLOOR((epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(MAX(ts))) / 3600) > 24 THEN 'WARN' ELSE 'OK' END AS freshness_status
FROM events GROUP BY 1""")
def q_source_freshness(spark, sf_dir):
    from quaestor.streaming.incremental import freshness_check
    e = B.tables(spark, sf_dir).events
    return freshness_check(e, "ts", "2024-01-31 00:00:00", source_col="event_type")
