"""Registered queries over time: priority allocation, open-item aging, as-of
joins, growing periods, merged registration histories, deep hierarchies."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quaestor.functions.numeric import money
from quaestor.operators import hierarchy as H
from quaestor.operators import joins as JN
from quaestor.operators import ledger as LED
from quaestor.operators import merge as MRG
from quaestor.operators import ranges as RNG
from quaestor.plans import bindings as B
from quaestor.plans import dims as DIM
from quaestor.plans import facts as FCT
from quaestor.plans import snapshots as SNAP
from quaestor.plans.catalog import register
from quaestor.plans.queries import _ALLOC_SQL, _AS_OF, _INT, _PEN, dated_allocations
from quaestor.plans.sqlbind import with_
from quaestor.sources import scan as SCAN
from quaestor.streaming import incremental as ST

# Charges in the order in which a payment settles them.
CHARGE_RANKS = [("INTEREST", "interest_amount"), ("PENALTY", "penalty_amount"), ("PRINCIPAL_TAX", "assessed_amount")]


def priority_allocations(t):
    """Payments of a party over its open charges, interest first, then
    penalties, then tax, the oldest period first within each."""
    _, pen, intr = LED.penalty_interest("assessed_amount", "due_date", "filing_date")
    assessed = B.filings(t).select("party_id", "return_id", "due_date", "assessed_amount", pen.alias("penalty_amount"),
                                   intr.alias("interest_amount"))
    charges = LED.unpivot_charges(assessed, CHARGE_RANKS, ["party_id", "return_id", "due_date"])
    return LED.allocate(charges, B.payments(t), ["party_id"], ["return_id", "charge_type_code", "charge_rank"],
                        ["charge_rank", "due_date", "return_id"], "amount", "payment_id", ["payment_date"], "payment_amount",
                        sequence_col="allocation_sequence")


@register("payment_allocation_priority", with_("filings", "payments") + f""",
a AS (SELECT party_id, return_id, due_date, assessed_amount, COALESCE({_PEN}, 0) AS penalty_amount, COALESCE({_INT}, 0) AS interest_amount FROM filings),
c AS (SELECT party_id, return_id, due_date, 'INTEREST' AS charge_type_code, 1 AS charge_rank, CAST(interest_amount AS DECIMAL(19,2)) AS amt FROM a
      UNION ALL SELECT party_id, return_id, due_date, 'PENALTY', 2, CAST(penalty_amount AS DECIMAL(19,2)) FROM a
      UNION ALL SELECT party_id, return_id, due_date, 'PRINCIPAL_TAX', 3, assessed_amount FROM a),
d AS (SELECT *, SUM(amt) OVER (PARTITION BY party_id ORDER BY charge_rank, due_date, return_id ROWS UNBOUNDED PRECEDING) AS dend FROM c WHERE amt > 0),
s AS (SELECT party_id, payment_id, payment_amount AS amt,
        SUM(payment_amount) OVER (PARTITION BY party_id ORDER BY payment_date, payment_id ROWS UNBOUNDED PRECEDING) AS send
      FROM payments WHERE payment_amount > 0),
x AS (SELECT d.*, s.payment_id, CAST(LEAST(d.dend, s.send) - GREATEST(d.dend - d.amt, s.send - s.amt) AS DECIMAL(19,2)) AS allocated_amount
      FROM d JOIN s ON d.party_id = s.party_id AND d.dend - d.amt < s.send AND s.send - s.amt < d.dend)
SELECT party_id, payment_id, return_id, charge_type_code, charge_rank, allocated_amount,
  CAST(ROW_NUMBER() OVER (PARTITION BY party_id, payment_id ORDER BY charge_rank, due_date, return_id) AS INTEGER) AS allocation_sequence
FROM x WHERE allocated_amount > 0""")
def q_payment_allocation_priority(spark, sf_dir):
    return priority_allocations(B.tables(spark, sf_dir))


# ---------------------------------------------------------------- I30 aging of open items
_STARTS = {"current_amount": None, "overdue_1_30_days": 1, "overdue_31_60_days": 31, "overdue_61_90_days": 61,
           "overdue_91_180_days": 91, "overdue_181_365_days": 181, "overdue_over_365_days": 366}
_DAYS = [d for d in _STARTS.values() if d]
_SIZES = ",\n".join(
    f"  CAST(SUM(CASE WHEN date_diff('day', due_date, month_end) BETWEEN {lo} AND {hi} THEN amt ELSE 0 END) AS DECIMAL(38,2)) AS {n}"
    for n, lo, hi in zip(_STARTS, [-100000, *_DAYS], [*(d - 1 for d in _DAYS), 1000000]))


@register("account_aging_snapshot", with_("returns", "payments") + "," + _ALLOC_SQL.strip() + f""",
items AS (SELECT return_id, party_id AS account_id, period_date AS posted, due_date, assessed_amount AS amt FROM returns WHERE assessed_amount > 0),
paid AS (SELECT i.return_id, i.account_id, GREATEST(i.posted, p.payment_date) AS posted, i.due_date, CAST(-a.allocated_amount AS DECIMAL(19,2)) AS amt
         FROM alloc a JOIN items i USING (return_id) JOIN payments p ON p.payment_id = a.payment_id WHERE a.allocated_amount > 0),
signed AS (SELECT * FROM items UNION ALL SELECT * FROM paid),
months AS (
  SELECT DISTINCT account_id, last_day(day) AS month_end FROM (
    SELECT account_id, posted AS day FROM signed
    UNION ALL SELECT account_id, CAST(due_date + n AS DATE) FROM items, (VALUES {", ".join(f"({d})" for d in _DAYS)}) v(n) WHERE due_date + n > posted)
  WHERE day <= DATE '{_AS_OF}'),
g AS (
  SELECT m.account_id, m.month_end, SUM(s.amt) AS debit,
         SUM(CASE WHEN last_day(s.posted) < m.month_end THEN s.amt ELSE 0 END) AS opening,
{_SIZES.replace("due_date", "s.due_date").replace("month_end)", "LEAST(m.month_end, DATE '" + _AS_OF + "'))")}
  FROM months m JOIN signed s ON s.account_id = m.account_id AND s.posted <= LEAST(m.month_end, DATE '{_AS_OF}') GROUP BY 1, 2)
SELECT account_id, month_end, CAST(strftime(month_end, '%Y%m%d') AS INTEGER) AS snapshot_date_key, {", ".join(_STARTS)},
       CAST(debit AS DECIMAL(38,2)) AS debit_balance, CAST(opening AS DECIMAL(38,2)) AS opening_balance,
       CASE WHEN debit > 0 THEN 1 ELSE 0 END AS has_debit_balance
FROM g""")
def q_account_aging_snapshot(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    items = B.returns(t).where(F.col("assessed_amount") > 0).select(
        F.col("return_id").alias("item_id"), F.col("party_id").alias("account_id"), F.col("period_date").alias("posted_date"), "due_date",
        F.col("assessed_amount").alias("amount"))
    alloc = dated_allocations(t).select(F.col("return_id").alias("item_id"), F.col("payment_date").alias("paid_date"), "allocated_amount")
    return SNAP.build_open_item_aging(items, alloc, _AS_OF)


# ---------------------------------------------------------------- C10 as-of join, a date per row
@register("last_payment_before_due", with_("returns", "payments") + """,
x AS (SELECT r.return_id, r.party_id, r.due_date, max({'d': p.payment_date, 'i': p.payment_id, 'a': p.payment_amount}) AS m
      FROM returns r LEFT JOIN payments p ON p.party_id = r.party_id AND p.payment_date <= r.due_date GROUP BY 1, 2, 3)
SELECT return_id, party_id, due_date, m.d AS payment_date, m.i AS payment_id, m.a AS payment_amount FROM x""")
def q_last_payment_before_due(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    r = B.returns(t).select("return_id", "party_id", "due_date")
    p = B.payments(t).select("party_id", "payment_date", "payment_id", "payment_amount")
    return RNG.join_as_of(r, p, ["party_id"], "due_date", "payment_date", ["payment_date", "payment_id", "payment_amount"], ["payment_id"])


# ---------------------------------------------------------------- C09 periods that grow with the data
@register("payments_in_campaigns", with_("returns", "payments") + """,
c AS (SELECT tax_type_code, CAST(date_trunc('month', period_date) AS DATE) AS campaign_month, MIN(period_date) AS c_start,
        CASE WHEN year(MIN(period_date)) >= 2001 THEN NULL ELSE CAST(MAX(due_date) + 30 AS DATE) END AS c_end FROM returns GROUP BY 1, 2)
SELECT p.tax_type_code, c.campaign_month, COUNT(*) AS payment_count, SUM(p.payment_amount) AS payment_amount
FROM payments p LEFT JOIN c ON c.tax_type_code = p.tax_type_code AND p.payment_date >= c.c_start AND (c.c_end IS NULL OR p.payment_date <= c.c_end)
GROUP BY 1, 2""")
def q_payments_in_campaigns(spark, sf_dir):
    """Campaigns of a tax type and month overlap; those of the last year are open."""
    t = B.tables(spark, sf_dir)
    month = F.trunc("period_date", "month")
    c = (B.returns(t).groupBy("tax_type_code", month.alias("campaign_month"))
         .agg(F.min("period_date").alias("c_start"), F.date_add(F.max("due_date"), 30).alias("c_end"))
         .withColumn("c_end", F.when(F.year("c_start") < 2001, F.col("c_end"))))
    p = B.payments(t).select("tax_type_code", "payment_date", "payment_amount")
    j = JN.join_growing_intervals(p, "payment_date", c, "c_start", "c_end", ["campaign_month"], on=["tax_type_code"])
    return j.groupBy("tax_type_code", "campaign_month").agg(F.count(F.lit(1)).alias("payment_count"),
                                                            F.sum("payment_amount").alias("payment_amount"))


# ---------------------------------------------------------------- I14 registrations from five sources
_REG_SQL = """
tax_account AS (SELECT party_id, period_date AS s, CAST(period_date + 120 AS DATE) AS e, status AS v FROM returns),
vat AS (SELECT party_id, period_date AS s, due_date AS e, tax_type_code AS v FROM returns WHERE tax_type_code < '4'),
eori AS (SELECT party_id, payment_date AS s, CAST(payment_date + 40 AS DATE) AS e, charge_type_code AS v FROM payments WHERE line_number = 1),
gaming AS (SELECT party_id, payment_date AS s, CAST(payment_date + 10 * line_number AS DATE) AS e, line_status AS v FROM payments WHERE line_number > 4),
corporate AS (SELECT party_id, MIN(period_date) AS s, CAST(NULL AS DATE) AS e, 'CORP' AS v FROM returns WHERE status = 'P' GROUP BY 1)"""
_REG = {"tax_account": "account_status", "vat": "vat_scheme", "eori": "eori_status", "gaming": "gaming_status", "corporate": "corporate_type"}


@register("dim_registration", with_("returns", "payments") + "," + _REG_SQL.strip() + """,
recs AS (""" + " UNION ALL ".join(f"SELECT party_id, '{n}' AS src, s, e, v FROM {n}" for n in _REG) + """),
days AS (SELECT DISTINCT party_id, day FROM (SELECT party_id, s AS day FROM recs UNION ALL SELECT party_id, CAST(e + 1 AS DATE) FROM recs WHERE e IS NOT NULL)),
now AS (SELECT d.party_id, d.day, r.src, max({'s': r.s, 'v': r.v, 'open': r.e IS NULL, 'e': r.e}) AS m
        FROM days d JOIN recs r ON r.party_id = d.party_id AND r.s <= d.day GROUP BY 1, 2, 3),
st AS (SELECT d.party_id, d.day, """ + ", ".join(
    f"max(CASE WHEN n.src = '{n}' AND (n.m.e IS NULL OR n.m.e >= d.day) THEN n.m.v END) AS {c}" for n, c in _REG.items()) + """
       FROM days d LEFT JOIN now n ON n.party_id = d.party_id AND n.day = d.day GROUP BY 1, 2),
ch AS (SELECT *, concat_ws('|', """ + ", ".join(f"coalesce({c}, '~')" for c in _REG.values()) + """) AS state FROM st),
ch2 AS (SELECT * FROM (SELECT *, lag(state) OVER (PARTITION BY party_id ORDER BY day) AS prev FROM ch) WHERE prev IS NULL OR prev <> state),
ver AS (SELECT *, lead(day) OVER (PARTITION BY party_id ORDER BY day) AS nxt FROM ch2)
SELECT party_id, CAST(ROW_NUMBER() OVER (PARTITION BY party_id ORDER BY day) AS INTEGER) AS version_no, day AS valid_from, CAST(nxt - 1 AS DATE) AS valid_to,
  """ + ", ".join(_REG.values()) + ",\n  " + ", ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END AS has_{n}" for n, c in _REG.items()) + """,
  CASE WHEN nxt IS NULL THEN 1 ELSE 0 END AS is_current
FROM ver WHERE state <> '~|~|~|~|~'""")
def q_dim_registration(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    r, p = B.returns(t), B.payments(t)
    span = lambda df, s, e, v: df.select("party_id", F.col(s).alias("valid_from"), e.alias("valid_to"), v)
    sources = {
        "tax_account": span(r, "period_date", F.date_add("period_date", 120), F.col("status").alias("account_status")),
        "vat": span(r.where(F.col("tax_type_code") < "4"), "period_date", F.col("due_date"), F.col("tax_type_code").alias("vat_scheme")),
        "eori": span(p.where("line_number = 1"), "payment_date", F.date_add("payment_date", 40), F.col("charge_type_code").alias("eori_status")),
        "gaming": span(p.where("line_number > 4"), "payment_date", F.expr("date_add(payment_date, cast(10 * line_number as int))"),
                       F.col("line_status").alias("gaming_status")),
        "corporate": span(r.where("status = 'P'").groupBy("party_id").agg(F.min("period_date").alias("period_date")), "period_date",
                          F.lit(None).cast("date"), F.lit("CORP").alias("corporate_type"))}
    return DIM.build_registration_history(sources, ["party_id"], {n: [c] for n, c in _REG.items()})


# ---------------------------------------------------------------- I16 / I11 hierarchies of any depth
@register("party_chain_closure", with_("returns") + """,
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tax_type_code, period_date ORDER BY return_id) AS n FROM returns)
SELECT a.return_id AS descendant, b.return_id AS ancestor, CAST(a.n - b.n AS INTEGER) AS distance, 0 AS is_cycle
FROM o a JOIN o b ON a.tax_type_code = b.tax_type_code AND a.period_date = b.period_date AND b.n <= a.n""")
def q_party_chain_closure(spark, sf_dir):
    """Each return refers to the one before it of the same type and day: chains
    of different depth, all ancestors of all."""
    r = B.returns(B.tables(spark, sf_dir)).select("return_id", "tax_type_code", "period_date")
    order = RNG.cut(r, ["tax_type_code", "period_date"], ["return_id"])
    before = RNG.filled(order, ["tax_type_code", "period_date"], {"parent": "return_id"}, inclusive=False)
    return H.walk_hierarchy(before.select("return_id", "parent"), "return_id", "parent")


@register("geography_flat", """
SELECT CAST('C' || c_custkey AS VARCHAR) AS id, r_name AS level_1, n_name AS level_2, c_name AS level_3, 3 AS depth,
       concat_ws(' > ', r_name, n_name, c_name) AS full_path, 0 AS levels_cut
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'N' || n_nationkey, r_name, n_name, NULL, 2, concat_ws(' > ', r_name, n_name), 0 FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'R' || r_regionkey, r_name, NULL, NULL, 1, r_name, 0 FROM region""")
def q_geography_flat(spark, sf_dir):
    t = B.tables(spark, sf_dir)
    nodes = (t.region.select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("id"), F.lit(None).cast("string").alias("parent"),
                             F.col("r_name").alias("name"))
             .unionByName(t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("id"),
                                          F.concat(F.lit("R"), F.col("n_regionkey")).alias("parent"), F.col("n_name").alias("name")))
             .unionByName(t.customer.select(F.concat(F.lit("C"), F.col("c_custkey")).alias("id"),
                                            F.concat(F.lit("N"), F.col("c_nationkey")).alias("parent"), F.col("c_name").alias("name"))))
    return H.flatten_levels(H.walk_hierarchy(nodes, "id", "parent"), nodes, "id", "name", max_levels=3)


# ---------------------------------------------------------------- I26 audits as an accumulating snapshot
def _audit_loads(t):
    """Three loads of audit cases (urgent returns): planned, begun, closed."""
    r = B.filings(t).where("tax_type_code = '1-URGENT'")
    none = lambda c: F.lit(None).cast(c)
    cols = lambda df, at, **c: df.select(
        F.col("return_id").alias("audit_case_id"), "party_id", "tax_type_code",
        *[c.get(m, none("date")).alias(m) for m in FCT.AUDIT_MILESTONES], F.lit(at).alias("loaded_at"),
        *[c.get(x, none(k)).alias(x) for x, k in (("audit_period_from", "date"), ("audit_period_to", "date"), ("case_status_code", "string"),
                                                  ("selection_method_code", "string"), ("adjustment_amount", "decimal(19,2)"),
                                                  ("penalty_amount", "decimal(19,2)"), ("interest_amount", "decimal(19,2)"),
                                                  ("objection_filed", "boolean"))])
    planned = cols(r, 1, assignment_date=F.col("period_date"), notification_date=F.date_add("period_date", 5),
                   planned_start_date=F.date_add("period_date", 10), planned_completion_date=F.date_add("period_date", 40),
                   audit_period_from=F.add_months("period_date", -24), audit_period_to=F.col("period_date"), case_status_code=F.lit("PLANNED"),
                   selection_method_code=F.when(F.col("assessed_amount") > 200000, "RISK_BASED").otherwise("RANDOM"))
    begun = cols(r.where("first_ship_date is not null"), 2, actual_start_date=F.col("first_ship_date"), case_status_code=F.lit("IN_PROGRESS"))
    closed = cols(r.where("first_ship_date is not null and status = 'F'"), 3, actual_completion_date=F.col("last_ship_date"),
                  case_status_code=F.lit("FINALIZED"),
                  adjustment_amount=F.greatest(F.col("assessed_amount") - F.col("declared_amount"), F.lit(0)).cast("decimal(19,2)"),
                  objection_filed=F.col("is_late") == 1)
    return planned, begun, closed


@register("fact_audit", with_("filings") + """,
f AS (SELECT return_id, COUNT(*) AS n FROM return_lines WHERE charge_type_code = 'R' GROUP BY 1),
c AS (SELECT *, first_ship_date IS NOT NULL AND status = 'F' AS closed,
        CAST(CASE WHEN first_ship_date IS NOT NULL AND status = 'F' THEN GREATEST(assessed_amount - declared_amount, 0) ELSE 0 END AS DECIMAL(19,2)) AS adj
      FROM filings WHERE tax_type_code = '1-URGENT')
SELECT c.return_id AS audit_case_id, party_id, tax_type_code,
  CAST(strftime(COALESCE(first_ship_date, period_date), '%Y%m%d') AS INTEGER) AS date_key,
  CAST(strftime(COALESCE(first_ship_date, period_date), '%Y%m%d') AS INTEGER) AS start_date_key,
  CAST(strftime(period_date + 40, '%Y%m%d') AS INTEGER) AS planned_completion_date_key,
  CASE WHEN closed THEN CAST(strftime(last_ship_date, '%Y%m%d') AS INTEGER) END AS actual_completion_date_key,
  CASE WHEN closed THEN CAST(strftime(last_ship_date, '%Y%m%d') AS INTEGER) END AS report_issue_date_key,
  period_date AS selection_date, CAST(period_date + 5 AS DATE) AS notification_date, adj AS assessed_amount,
  CAST(0 AS DECIMAL(19,2)) AS penalties_assessed, CAST(0 AS DECIMAL(19,2)) AS interest_assessed, adj AS total_amount, 1 AS audit_count,
  COALESCE(f.n, 0) AS findings_count, 3 AS tax_periods_covered,
  CASE WHEN closed THEN date_diff('day', first_ship_date, last_ship_date) END AS duration_days, 30 AS planned_duration_days,
  CASE WHEN assessed_amount > 200000 THEN 1 ELSE 0 END AS is_risk_based, CASE WHEN closed THEN 1 ELSE 0 END AS is_completed,
  CASE WHEN adj > 0 THEN 1 ELSE 0 END AS has_findings, CASE WHEN closed AND is_late = 1 THEN 1 ELSE 0 END AS is_appealed,
  CASE WHEN closed THEN 'FINALIZED' WHEN first_ship_date IS NOT NULL THEN 'IN_PROGRESS' ELSE 'PLANNED' END AS audit_status
FROM c LEFT JOIN f ON f.return_id = c.return_id""")
def q_fact_audit(spark, sf_dir):
    """Closing comes first, then planning, then field work: the order of loads
    does not matter."""
    t = B.tables(spark, sf_dir)
    planned, begun, closed = _audit_loads(t)
    keys = ["audit_case_id", "party_id", "tax_type_code"]
    cases = MRG.accumulate_milestones(closed, planned, keys, FCT.AUDIT_MILESTONES, "loaded_at")
    cases = MRG.accumulate_milestones(cases, begun, keys, FCT.AUDIT_MILESTONES, "loaded_at")
    findings = B.return_lines(t).where("charge_type_code = 'R'").select(F.col("return_id").alias("audit_case_id"))
    return FCT.build_fact_audit_snapshot(cases, findings)


# ---------------------------------------------------------------- A05 profiles that merge over loads
@register("profile_order_loads", """
SELECT * FROM (""" + " UNION ALL ".join(f"""
  SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, {lo} AS min_number, {hi} AS max_number,
    MIN(CAST({c} AS VARCHAR)) AS min_text, MAX(CAST({c} AS VARCHAR)) AS max_text, 1 AS distinct_in_bound, {q} AS quantiles_in_bound FROM orders"""
    for c, lo, hi, q in (("o_orderkey", "CAST(MIN(o_orderkey) AS DOUBLE)", "CAST(MAX(o_orderkey) AS DOUBLE)", 1),
                         ("o_custkey", "CAST(MIN(o_custkey) AS DOUBLE)", "CAST(MAX(o_custkey) AS DOUBLE)", 1),
                         ("o_orderstatus", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS INTEGER)"),
                         ("o_orderpriority", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS INTEGER)"))) + ")")
def q_profile_order_loads(spark, sf_dir):
    """Profiles of the loads of each year, stored, merged on reading and held
    against exact counts and ranks of the whole table."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    o = B.tables(spark, sf_dir).orders
    early = F.year("o_orderdate") < 1998
    stored = RNG.written(SCAN.profile_load(o.where(early), cols).unionByName(SCAN.profile_load(o.where(~early), cols)))
    p = SCAN.read_profile(SCAN.merge_profiles(stored))
    exact = SCAN.profile_table(o, cols).select("column_name", F.col("distinct_count").alias("exact"))
    both = p.join(exact, "column_name")
    quantiles = [("p25", 0.25), ("median", 0.5), ("p75", 0.75)]
    at = {r.column_name: r for r in p.where("median is not null").select("column_name", "p25", "median", "p75").collect()}  # a row a column
    ranks = o.agg(*[F.avg((F.col(c) <= F.lit(at[c][q])).cast("double")).alias(f"{c}_{q}") for c in cols[:2] for q, _ in quantiles])
    # half a rank wide: equal values share theirs
    fits = lambda c: F.when(sum(((F.col(f"{c}_{q}") >= x - SCAN.RANK_ERROR) & (F.col(f"{c}_{q}") <= x + SCAN.RANK_ERROR)).cast("int")
                                for q, x in quantiles) == len(quantiles), 1).otherwise(0)
    told = ranks.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), fits(c).alias("quantiles_in_bound"))
                                            for c in cols[:2]])).alias("r")).select("r.*")
    return both.join(told, "column_name", "left").select(
        "column_name", "row_count", "null_count", "min_number", "max_number", "min_text", "max_text",
        (F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.col("exact") * SCAN.DISTINCT_ERROR + 1).cast("int").alias("distinct_in_bound"),
        "quantiles_in_bound")


# ---------------------------------------------------------------- J01, J02, J04 in several batches
@register("stream_upsert_buckets", with_("returns") + """
SELECT return_id, party_id, status, assessed_amount, 2 AS version FROM returns""")
def q_stream_upsert_buckets(spark, sf_dir):
    """First versions, then newer ones, then older ones that come late."""
    root = ST.scratch(spark, f"stream-buckets-{uuid.uuid4().hex[:8]}")
    r = B.returns(B.tables(spark, sf_dir)).select("return_id", "party_id", "status", "assessed_amount")
    first = r.select("return_id", "party_id", F.lit("?").alias("status"), F.lit(0).cast("decimal(19,2)").alias("assessed_amount"),
                     F.lit(1).alias("version"))
    second = r.withColumn("version", F.lit(2))
    loads = [first.where("return_id % 3 > 0").unionByName(second.where("return_id % 3 = 0")), second.where("return_id % 3 > 0"),
             first.where("return_id % 2 = 0")]
    for i, load in enumerate(loads):
        load.write.parquet(f"{root}/in/load{i}")
        stream = ST.file_stream(spark, f"{root}/in/*", second.schema)
        ST.bucketed_upsert_stream(spark, stream, f"{root}/target", ["return_id"], ["version"], buckets=16,
                                  checkpoint=f"{root}/ckpt").awaitTermination()
    return ST.read_buckets(spark, f"{root}/target")


def _event_loads(spark, sf_dir, root):
    """Events in the order of time in three loads: the second repeats the last
    12 hours of the first, the third brings rows of weeks ago under new ids."""
    e = B.tables(spark, sf_dir).events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", money("value").alias("amount"))
    cuts = ["1970-01-01", "2024-01-11", "2024-01-21", "2100-01-01"]
    at = lambda c: F.lit(c).cast("timestamp")
    parts = [e.where((F.col("ts") >= at(a)) & (F.col("ts") < at(b))) for a, b in zip(cuts, cuts[1:])]
    again = parts[0].where(F.col("ts") >= at(cuts[1]) - F.expr("interval 12 hours"))
    late = parts[0].where(F.col("ts") < at("2024-01-06")).withColumn("event_id", F.col("event_id") + 10**12)
    return e.schema, [parts[0], parts[1].unionByName(again), parts[2].unionByName(late)]


@register("stream_events_once", """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type, CAST(value AS DECIMAL(19,2)) AS amount FROM events""")
def q_stream_events_once(spark, sf_dir):
    """Each load is a run of its own that goes on from the checkpoint."""
    root = ST.scratch(spark, f"stream-once-{uuid.uuid4().hex[:8]}")
    schema, loads = _event_loads(spark, sf_dir, root)
    for i, load in enumerate(loads):
        load.write.parquet(f"{root}/in/load{i}")
        ST.deduplicated_stream(ST.file_stream(spark, f"{root}/in/*", schema), "ts", ["event_id"], f"{root}/out", f"{root}/ckpt",
                               "24 hours").awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_monthly_totals", """
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, event_type, COUNT(*) AS row_count, SUM(CAST(value AS DECIMAL(19,2))) AS total
FROM events GROUP BY 1, 2""")
def q_stream_monthly_totals(spark, sf_dir):
    """J04 over the loads without repeated rows; a day is told when the
    watermark has passed it, so a mark two months later ends the last one."""
    root = ST.scratch(spark, f"stream-months-{uuid.uuid4().hex[:8]}")
    schema, loads = _event_loads(spark, sf_dir, root)
    loads[1] = loads[1].where(F.col("ts") >= F.lit("2024-01-11").cast("timestamp"))
    end = loads[2].agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("long").alias("event_id"),
                                                       (F.col("ts") + F.expr("interval 60 days")).alias("ts"),
                                                       F.lit("end").alias("event_type"), F.lit(0).cast("decimal(19,2)").alias("amount"))
    for i, load in enumerate([*loads, end]):
        load.write.parquet(f"{root}/in/load{i}")
        stream = ST.file_stream(spark, f"{root}/in/*", schema)
        ST.monthly_rollup_stream(stream, "ts", ["event_type"], "amount", f"{root}/out", f"{root}/ckpt", watermark="2 days").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return ST.monthly_totals(out, ["event_type"])
