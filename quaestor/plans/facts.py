"""Fact builders.

Each builder is one DataFrame plan: pre-aggregated children joined to the
parent (no fan-out), dimension keys resolved, derived flags and measures.
Inputs use the column names documented per builder; ``bindings`` produces
them from the test tables, ``operators.mapping`` from real source tables.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaestor.functions.dates import date_key, year_month_key
from quaestor.functions.numeric import MONEY, money, safe_ratio
from quaestor.functions.codes import band
from quaestor.operators.ledger import penalty_interest
from quaestor.operators.windows import repeat_event_flag

# Codes that drive the fact flags.
ELECTRONIC_FILING_METHODS = ("E_PORTAL", "WEB_SERVICE")
ELECTRONIC_PAYMENT_METHODS = ("E_PORTAL", "DIRECT_DEBIT", "BANK_TRANSFER")
ESCALATED_ACTIONS = ("GARNISHMENT", "LEGAL_ACTION")
ASSESSMENT_TYPES = ("SELF", "ADMINISTRATIVE", "AUDIT", "BEST_JUDGMENT", "AMENDED")
TAX_BASE_MULTIPLIER = 10
HIGH_RISK_SCORE = 60
AUDIT_CANDIDATE_SCORE = 60
AUDIT_CANDIDATE_ARREARS = 50000


def build_fact_filing(filings: DataFrame, accepted_status: str = "F", method_col: str | None = None) -> DataFrame:
    """One row per return.  Input columns: return_id, party_id,
    tax_type_code, period_date, due_date, filing_date, declared_amount (sum of
    lines, pre-aggregated), last_ship_date (assessment date), status,
    is_late, days_late."""
    declared = F.coalesce(F.col("declared_amount"), F.lit(0).cast(MONEY)).cast(MONEY)
    method = F.col(method_col) if method_col else F.lit(None).cast("string")
    return filings.select(
        "return_id", "party_id", "tax_type_code",
        year_month_key("period_date").alias("period_key"),
        date_key("filing_date").alias("filing_date_key"), date_key("due_date").alias("due_date_key"),
        declared.alias("declared_amount"),
        F.when(declared > 0, declared * TAX_BASE_MULTIPLIER).otherwise(F.lit(0)).cast(MONEY).alias("tax_base_amount"),
        F.datediff("last_ship_date", "filing_date").alias("processing_days"),
        F.col("is_late").cast("int").alias("is_late"), F.coalesce("days_late", F.lit(0)).alias("days_late"),
        method.isin(*ELECTRONIC_FILING_METHODS).cast("int").alias("is_electronic") if method_col
        else F.lit(0).alias("is_electronic"),
        (declared == 0).cast("int").alias("is_nil_return"),
        (F.col("status") == accepted_status).cast("int").alias("is_auto_accepted"),
        F.col("is_filed").cast("int").alias("is_filed"))


def build_fact_assessment(returns: DataFrame, filings: DataFrame | None = None, type_col: str | None = None) -> DataFrame:
    """I21 + I35 + M30: assessments with penalty and interest from lateness,
    total due, type flags, final and refund flags.  Input: return_id,
    party_id, tax_type_code, period_date, due_date, assessed_amount, status,
    filing_date, paid_amount."""
    df = returns
    months, pen, intr = penalty_interest("assessed_amount", "due_date", "filing_date")
    t = F.col(type_col) if type_col else F.lit("SELF")
    total = (money("assessed_amount") + pen + intr).cast(MONEY)
    paid = F.coalesce(F.col("paid_amount"), F.lit(0).cast(MONEY)).cast(MONEY)
    out = df.select(
        "return_id", "party_id", "tax_type_code", date_key("period_date").alias("assessment_date_key"),
        money("assessed_amount").alias("assessed_tax_amount"), F.coalesce(months, F.lit(0)).alias("late_months"),
        F.coalesce(pen, F.lit(0).cast(MONEY)).alias("penalty_amount"),
        F.coalesce(intr, F.lit(0).cast(MONEY)).alias("interest_amount"),
        paid.alias("amount_paid"), t.alias("assessment_type_code"), F.col("status"))
    out = out.withColumn("total_due_amount", (F.col("assessed_tax_amount") + F.col("penalty_amount")
                                              + F.col("interest_amount")).cast(MONEY))
    out = out.withColumn("outstanding_amount", (F.col("total_due_amount") - F.col("amount_paid")).cast(MONEY))
    for code in ASSESSMENT_TYPES:
        out = out.withColumn(f"is_{code.lower()}", (F.col("assessment_type_code") == code).cast("int"))
    return (out.withColumn("is_final", (F.col("status") == "F").cast("int"))
            .withColumn("is_refund", (F.col("outstanding_amount") < 0).cast("int")))


def build_fact_payment(payments: DataFrame, allocations: DataFrame, method_col: str | None = None) -> DataFrame:
    """I22 + I36: per payment, allocation count and sum (pre-aggregated),
    unallocated remainder, partial / overpayment / electronic flags.
    payments: payment_id, party_id, payment_date, payment_amount;
    allocations: payment_id, allocated_amount."""
    a = allocations.groupBy("payment_id").agg(F.count(F.lit(1)).alias("allocation_count"),
                                              F.sum("allocated_amount").alias("allocated_amount"))
    return _payment_measures(payments.join(a, "payment_id", "left"), method_col)


def settled_payments(allocations: DataFrame, method_col: str | None = None) -> DataFrame:
    """The same from allocations that keep their supply (``allocate``) and carry
    the payment's columns: no join.  For payments of which each has its own id."""
    carried = ["payment_id", "party_id", "payment_date", "payment_amount", *([method_col] if method_col else [])]
    out = allocations.groupBy("party_id", *[c for c in carried if c != "party_id"]).agg(
        F.count_if(F.col("allocated_amount") > 0).alias("allocation_count"), F.sum("allocated_amount").alias("allocated_amount"))
    return _payment_measures(out, method_col)


def _payment_measures(out: DataFrame, method_col: str | None) -> DataFrame:
    alloc = F.coalesce(F.col("allocated_amount"), F.lit(0)).cast(MONEY)
    cnt = F.coalesce(F.col("allocation_count"), F.lit(0))
    method = F.col(method_col) if method_col else F.lit(None).cast("string")
    return out.select(
        "payment_id", "party_id", date_key("payment_date").alias("payment_date_key"),
        money("payment_amount").alias("payment_amount"), cnt.alias("allocation_count"),
        alloc.alias("allocated_amount"),
        (money("payment_amount") - alloc).cast(MONEY).alias("unallocated_amount"),
        (cnt > 1).cast("int").alias("is_partial"),
        ((money("payment_amount") - alloc) > 0).cast("int").alias("is_overpayment"),
        method.isin(*ELECTRONIC_PAYMENT_METHODS).cast("int").alias("is_electronic") if method_col
        else F.lit(0).alias("is_electronic"))


def build_fact_account_balance(balances: DataFrame) -> DataFrame:
    """Snapshot at period end with net activity, arrears = max(closing, 0)
    and arrears / credit / zero flags.  Input: account_id, period_end,
    opening_balance, debit_amount, credit_amount, closing_balance."""
    c = F.col("closing_balance")
    return balances.select(
        "account_id", date_key("period_end").alias("snapshot_date_key"), "period_end",
        "opening_balance", "debit_amount", "credit_amount",
        (F.col("debit_amount") - F.col("credit_amount")).alias("net_activity"), "closing_balance",
        F.greatest(c, F.lit(0)).alias("arrears_amount"),
        (c > 0).cast("int").alias("is_in_arrears"), (c < 0).cast("int").alias("is_in_credit"),
        (c == 0).cast("int").alias("is_zero_balance"))


def build_fact_collection(actions: DataFrame, cases: DataFrame, due_dates: DataFrame, as_of: str) -> DataFrame:
    """Action x case x account; days since opened; debt due = MIN due
    date of the account (pre-aggregated); effectiveness = collected / debt
    (0 when debt <= 0) rounded to 4; successful and escalated flags."""
    due = due_dates.groupBy("account_id").agg(F.min("due_date").alias("debt_due_date"))
    j = actions.join(cases, "case_id").join(due, "account_id", "left")
    debt = money("current_debt_amount")
    eff = F.when(debt > 0, safe_ratio("action_collected", "current_debt_amount", 4)).otherwise(F.lit(0).cast("decimal(18,4)"))
    return j.select(
        "action_id", "case_id", "account_id", "action_type_code",
        F.datediff(F.lit(as_of).cast("date"), "case_opened_date").alias("days_since_opened"),
        "debt_due_date", money("action_collected").alias("amount_collected"), eff.alias("effectiveness_ratio"),
        (money("action_collected") > 0).cast("int").alias("is_successful"),
        F.col("action_type_code").isin(*ESCALATED_ACTIONS).cast("int").alias("is_escalated"))


def build_fact_risk_assessment(profiles: DataFrame, audits: DataFrame | None = None,
                               high_risk: int = HIGH_RISK_SCORE) -> DataFrame:
    """Banded audit-history and third-party scores, audit count
    (pre-aggregated), candidate flag (score > 60 or arrears > 50,000), high
    risk (>= threshold), year and quarter, trend STABLE.  Input: party_id,
    overall_risk_score, current_arrears_amount, audit_adjustment_history,
    third_party_discrepancy_count, profile_date."""
    out = profiles
    if audits is not None:
        a = audits.groupBy("party_id").agg(F.count(F.lit(1)).alias("audit_count"))
        out = out.join(a, "party_id", "left")
    else:
        out = out.withColumn("audit_count", F.lit(0))
    score = F.col("overall_risk_score")
    return out.select(
        "party_id", date_key("profile_date").alias("assessment_date_key"), score.alias("risk_score"),
        # Limits and scores of the risk rules; NULL scores lowest.
        band("audit_adjustment_history", [(0, 15), (10000, 40), (50000, 60), (None, 80)], 15).alias("audit_history_score"),
        band("third_party_discrepancy_count", [(0, 10), (2, 30), (5, 50), (None, 75)], 10).alias("third_party_score"),
        F.coalesce("audit_count", F.lit(0)).alias("audit_count"),
        ((score > AUDIT_CANDIDATE_SCORE) | (money("current_arrears_amount") > AUDIT_CANDIDATE_ARREARS)).cast("int")
        .alias("is_audit_candidate"),
        (score >= high_risk).cast("int").alias("is_high_risk"),
        F.year("profile_date").alias("assessment_year"), F.quarter("profile_date").alias("assessment_quarter"),
        F.lit("STABLE").alias("risk_trend"))


def build_fact_compliance_event(events: DataFrame, ts_col: str = "event_ts", id_col: str = "event_id") -> DataFrame:
    """Factless event fact, event_count = 1, repeat flag per (party,
    event type)."""
    out = repeat_event_flag(events, ["party_id", "event_type"], ts_col, id_col)
    return out.select(id_col, "party_id", "event_type", date_key(ts_col).alias("event_date_key"),
                      F.lit(1).alias("event_count"), "is_repeat")


def derive_filing_measures(df: DataFrame) -> DataFrame:
    """taxable = gross - deductions; payable = liability - credits -
    withheld; VAT net = output - input."""
    return (df.withColumn("taxable_income", money("gross_income") - money("deductions"))
            .withColumn("tax_payable", money("tax_liability") - money("tax_credits") - money("tax_withheld"))
            .withColumn("vat_net", money("output_vat") - money("input_vat")))


def derive_payment_measures(df: DataFrame) -> DataFrame:
    """unallocated = payment - tax - penalty - interest."""
    return df.withColumn("unallocated_amount", money("payment_amount") - money("tax_paid") - money("penalty_paid")
                         - money("interest_paid"))


def build_fact_registration(accounts: DataFrame, processing_days: int = 7) -> DataFrame:
    """Active accounts with party/type/date keys; rows missing a key are
    dropped; constants processing_days and approved."""
    a = accounts.where(F.col("party_id").isNotNull() & F.col("tax_type_code").isNotNull()
                       & F.col("registration_date").isNotNull())
    return a.select("party_id", "tax_type_code", date_key("registration_date").alias("registration_date_key"),
                    F.lit(processing_days).alias("processing_days"), F.lit(1).alias("is_approved"))


def build_fact_audit(cases: DataFrame, findings: DataFrame) -> DataFrame:
    """I26 accumulating snapshot: primary date = actual start else assignment,
    date roles, findings count (pre-aggregated), durations, periods covered =
    year span + 1, agreed/objection flags."""
    f = findings.groupBy("audit_case_id").agg(F.count(F.lit(1)).alias("findings_count"),
                                              F.sum(money("tax_adjustment")).alias("findings_adjustment"))
    j = cases.join(f, "audit_case_id", "left")
    primary = F.coalesce("actual_start_date", "assignment_date")
    return j.select(
        "audit_case_id", "party_id", date_key(primary).alias("primary_date_key"),
        date_key("assignment_date").alias("assignment_date_key"), date_key("actual_start_date").alias("start_date_key"),
        date_key("actual_completion_date").alias("completion_date_key"),
        F.coalesce("findings_count", F.lit(0)).alias("findings_count"),
        F.datediff("actual_completion_date", "actual_start_date").alias("audit_duration_days"),
        (F.year("audit_period_to") - F.year("audit_period_from") + 1).alias("periods_covered"),
        money("total_amount_assessed").alias("total_amount_assessed"),
        F.col("taxpayer_agreed").cast("int").alias("is_agreed"), F.col("objection_filed").cast("int").alias("is_objected"))


#: Date roles of an audit case, in the order of its life.
AUDIT_MILESTONES = ["assignment_date", "notification_date", "planned_start_date", "actual_start_date", "planned_completion_date",
                    "actual_completion_date"]
# Selection method and final statuses.
RISK_BASED, COMPLETED = "RISK_BASED", ("FINALIZED", "CLOSED")


def build_fact_audit_snapshot(cases: DataFrame, findings: DataFrame) -> DataFrame:
    """I26 in full: one row per audit case with its five date roles (the start
    role falls back to the primary date, the report is issued on completion),
    amounts, durations, periods covered and flags.

    cases: as ``merge.accumulate_milestones`` gives them (audit_case_id,
    party_id, tax_type_code, AUDIT_MILESTONES, audit_period_from/to,
    case_status_code, selection_method_code, adjustment_amount, penalty_amount,
    interest_amount, objection_filed); findings: audit_case_id."""
    f = findings.groupBy("audit_case_id").agg(F.count(F.lit(1)).alias("findings_count"))
    j = cases.join(f, "audit_case_id", "left")
    primary = F.coalesce("actual_start_date", "assignment_date")
    amount = lambda c: F.coalesce(money(c), F.lit(0).cast(MONEY)).cast(MONEY)
    return j.select(
        "audit_case_id", "party_id", "tax_type_code", date_key(primary).alias("date_key"),
        date_key(primary).alias("start_date_key"),
        date_key("planned_completion_date").alias("planned_completion_date_key"),
        date_key("actual_completion_date").alias("actual_completion_date_key"),
        date_key("actual_completion_date").alias("report_issue_date_key"),
        F.col("assignment_date").alias("selection_date"), "notification_date",
        amount("adjustment_amount").alias("assessed_amount"), amount("penalty_amount").alias("penalties_assessed"),
        amount("interest_amount").alias("interest_assessed"),
        (amount("adjustment_amount") + amount("penalty_amount") + amount("interest_amount")).cast(MONEY).alias("total_amount"),
        F.lit(1).alias("audit_count"), F.coalesce("findings_count", F.lit(0)).cast("long").alias("findings_count"),
        (F.year("audit_period_to") - F.year("audit_period_from") + 1).alias("tax_periods_covered"),
        F.datediff("actual_completion_date", "actual_start_date").alias("duration_days"),
        F.datediff("planned_completion_date", "planned_start_date").alias("planned_duration_days"),
        F.coalesce((F.col("selection_method_code") == RISK_BASED).cast("int"), F.lit(0)).alias("is_risk_based"),
        F.coalesce(F.col("case_status_code").isin(*COMPLETED).cast("int"), F.lit(0)).alias("is_completed"),
        F.coalesce((F.col("adjustment_amount") > 0).cast("int"), F.lit(0)).alias("has_findings"),
        F.coalesce(F.col("objection_filed").cast("int"), F.lit(0)).alias("is_appealed"),
        F.col("case_status_code").alias("audit_status"))


def build_fact_objection(objections: DataFrame) -> DataFrame:
    """Outcome flags (0 without an outcome), resolution days, resolved
    amount (the adjusted amount, 0 when NULL)."""
    o = F.upper(F.col("decision_outcome_code"))
    return objections.select(
        "objection_case_id", "party_id", date_key("filing_date").alias("filing_date_key"),
        F.col("decision_date").isNotNull().cast("int").alias("is_resolved"),
        *[F.coalesce((o == x).cast("int"), F.lit(0)).alias(f"is_{x.lower()}") for x in ("UPHELD", "REDUCED", "CANCELLED")],
        F.col("appeal_filed").cast("int").alias("is_appealed"),
        F.datediff("decision_date", "filing_date").alias("resolution_days"),
        money("amount_disputed").alias("amount_disputed"),
        F.coalesce(money("amount_adjusted"), F.lit(0).cast("decimal(19,2)")).alias("resolved_amount"))


def build_fact_refund(refunds: DataFrame) -> DataFrame:
    """Approved / disbursed / offset flags, processing and approval days
    (processing NULL -> 0)."""
    return refunds.select(
        "refund_id", "party_id", date_key("claim_date").alias("claim_date_key"),
        money("gross_refund_amount").alias("gross_refund_amount"), money("offset_amount").alias("offset_amount"),
        (money("gross_refund_amount") - money("offset_amount")).alias("net_refund_amount"),
        F.col("approval_date").isNotNull().cast("int").alias("is_approved"),
        F.col("refund_date").isNotNull().cast("int").alias("is_disbursed"),
        (money("offset_amount") > 0).cast("int").alias("is_offset"),
        F.coalesce(F.datediff("refund_date", "claim_date"), F.lit(0)).alias("processing_days"),
        F.datediff("approval_date", "claim_date").alias("approval_days"))


def build_fact_customs(headers: DataFrame, duties: DataFrame, duty_codes: Sequence[str]) -> DataFrame:
    """I32: declaration header + duty pivot (one conditional sum per duty
    code, pre-aggregated per declaration)."""
    from quaestor.operators.aggregates import pivot_codes
    p = pivot_codes(duties, ["declaration_id"], "duty_code", "duty_amount", duty_codes, prefix="duty_")
    return headers.join(p, "declaration_id", "left")


def build_fact_risk_score(scores: DataFrame, high: float = 61.0) -> DataFrame:
    """Quarterly risk-score snapshot with change from the prior quarter
    and from the same quarter a year ago (gap-aware equi-joins on the shifted
    quarter, not LAG) and derived flags.  scores: party_id, quarter_start,
    risk_score."""
    from quaestor.operators.windows import shifted_join
    s = shifted_join(scores, ["party_id"], "quarter_start", 3, ["risk_score"], "prior_q_")
    s = shifted_join(s, ["party_id"], "quarter_start", 12, ["risk_score"], "prior_y_")
    d_q = F.col("risk_score") - F.col("prior_q_risk_score")
    d_y = F.col("risk_score") - F.col("prior_y_risk_score")
    return (s.withColumn("score_change_qoq", d_q).withColumn("score_change_yoy", d_y)
            .withColumn("is_high_risk", (F.col("risk_score") >= high).cast("int"))
            .withColumn("is_new_high_risk", ((F.col("risk_score") >= high)
                                             & (F.coalesce(F.col("prior_q_risk_score"), F.lit(0)) < high)).cast("int"))
            .withColumn("is_increasing", (d_q > 0).cast("int"))
            .withColumn("is_decreasing", (d_q < 0).cast("int"))
            .withColumn("is_first_assessment", F.col("prior_q_risk_score").isNull().cast("int"))
            .withColumn("is_large_increase", (d_q >= 20).cast("int"))
            .withColumn("is_improved_yoy", (d_y < 0).cast("int"))
            .withColumn("is_zero_risk", (F.col("risk_score") == 0).cast("int")))
