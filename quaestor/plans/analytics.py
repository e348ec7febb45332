"""Domain analytics (M01-M43): compositions of the operators over warehouse
facts.  Inputs are DataFrames with the documented columns; the binding to the
test tables lives in ``plans.queries``."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaestor.functions.dates import year_quarter_key
from quaestor.operators.aggregates import median
from quaestor.functions.numeric import MONEY, count_if, money, pct, safe_ratio, avg_money


def filing_compliance_summary(filings: DataFrame, type_col: str = "tax_type_code",
                              date_col: str = "period_date") -> DataFrame:
    """Filings, on-time, late, not filed and compliance rate by tax type x quarter.

    Input: one row per return with is_filed / is_on_time / is_late flags and days_late.
    """
    g = filings.groupBy(F.col(type_col).alias("tax_type_code"), year_quarter_key(date_col).alias("year_quarter"))
    out = g.agg(F.count(F.lit(1)).alias("filings"),
                F.sum("is_filed").cast("bigint").alias("filed"),
                F.sum("is_on_time").cast("bigint").alias("on_time"),
                F.sum("is_late").cast("bigint").alias("late"),
                F.sum("days_late").cast("bigint").alias("total_days_late"))
    return (out.withColumn("not_filed", F.col("filings") - F.col("filed"))
            .withColumn("compliance_rate", pct("on_time", "filings"))
            .withColumn("avg_days_late", safe_ratio("total_days_late", "late", 2)))


# ---------------------------------------------------------------- risk / balances

def risk_profiles(filings: DataFrame, ledger: DataFrame, events: DataFrame | None, as_of: str) -> DataFrame:
    """Per party risk profile (input of I28 / M04 / M05 / M35): overall score =
    share of late filings among filed returns (0-100), arrears = ledger
    balance at as_of, third-party discrepancies = 'error' events."""
    f = filings.groupBy("party_id").agg(F.count(F.lit(1)).alias("return_count"),
                                        F.sum("is_late").cast("bigint").alias("late_filing_count"),
                                        F.sum("is_filed").cast("bigint").alias("filed_count"),
                                        F.sum("assessed_amount").alias("total_assessed"))
    a = F.lit(as_of).cast("date")
    b = ledger.where(F.col("txn_date") <= a).groupBy(F.col("account_id").alias("party_id")).agg(
        F.sum("amount").alias("current_arrears_amount"))
    out = f.join(b, "party_id", "left")
    if events is not None:
        e = events.where(F.col("event_type") == "error").groupBy("party_id").agg(
            F.count(F.lit(1)).alias("third_party_discrepancy_count"))
        out = out.join(e, "party_id", "left")
    else:
        out = out.withColumn("third_party_discrepancy_count", F.lit(0))
    return out.select(
        "party_id", "return_count", "late_filing_count", "total_assessed",
        F.coalesce(pct("late_filing_count", "filed_count"), F.lit(0).cast("decimal(18,2)")).cast("decimal(5,2)")
        .alias("overall_risk_score"),
        F.coalesce(F.col("current_arrears_amount"), F.lit(0)).cast("decimal(38,2)").alias("current_arrears_amount"),
        F.lit(0).cast(MONEY).alias("audit_adjustment_history"),
        F.coalesce(F.col("third_party_discrepancy_count"), F.lit(0)).cast("bigint").alias("third_party_discrepancy_count"),
        a.alias("profile_date"))


def high_risk_taxpayers(parties: DataFrame, balances: DataFrame, risk: DataFrame, threshold: float = 60) -> DataFrame:
    """Parties with a HIGH risk rating, arrears at the table's latest
    snapshot (C11), or a risk score above the threshold."""
    from quaestor.operators.windows import global_latest
    latest = global_latest(balances, "period_end").groupBy(F.col("account_id").alias("party_id")).agg(
        F.sum("closing_balance").alias("outstanding_balance"), F.sum("arrears_amount").alias("arrears_amount"),
        F.max("is_in_arrears").alias("has_arrears"))
    j = parties.join(latest, "party_id", "left").join(risk.select("party_id", "overall_risk_score"), "party_id", "left")
    return j.where((F.col("risk_rating") == "HIGH") | (F.col("has_arrears") == 1) | (F.col("overall_risk_score") > threshold))


def segment_analysis(parties: DataFrame, ledger: DataFrame, as_of: str) -> DataFrame:
    """Taxpayers, balance (semi-additive: each account's balance at
    as_of, then summed across the segment), average, arrears count and rate."""
    a = F.lit(as_of).cast("date")
    bal = ledger.where(F.col("txn_date") <= a).groupBy(F.col("account_id").alias("party_id")).agg(
        F.sum("amount").alias("balance"))
    j = parties.join(bal, "party_id", "left").withColumn("balance", F.coalesce("balance", F.lit(0)).cast("decimal(38,2)"))
    g = j.groupBy("party_segment").agg(F.countDistinct("party_id").alias("taxpayer_count"),
                                       F.sum("balance").alias("total_balance"),
                                       F.count_if(F.col("balance") > 0).alias("taxpayers_with_arrears"))
    return (g.withColumn("avg_balance", avg_money("total_balance", "taxpayer_count"))
            .withColumn("arrears_rate", pct("taxpayers_with_arrears", "taxpayer_count")))


def unpaid_assessments(returns: DataFrame, allocations: DataFrame, as_of: str) -> DataFrame:
    """outstanding = assessed - allocated, days overdue at as_of, and the
    collection classification (priority by amount or days, case type by amount,
    enforcement by days)."""
    al = allocations.groupBy("return_id").agg(F.sum("allocated_amount").alias("allocated"))
    j = returns.join(al, "return_id", "left")
    out = j.select("return_id", "party_id", "tax_type_code", "due_date", money("assessed_amount").alias("assessed_amount"),
                   (money("assessed_amount") - F.coalesce(F.col("allocated"), F.lit(0))).cast(MONEY).alias("outstanding_amount"),
                   F.datediff(F.lit(as_of).cast("date"), "due_date").alias("days_overdue"))
    out = out.where((F.col("outstanding_amount") > 0) & (F.col("days_overdue") > 0))
    amount, days = F.col("outstanding_amount"), F.col("days_overdue")
    # Limits and labels of the collection rules.
    return (out.withColumn("priority", F.when((amount > 50000) | (days > 180), "URGENT")
                           .when((amount > 20000) | (days > 90), "HIGH").when(days > 30, "MEDIUM").otherwise("LOW"))
            .withColumn("case_type", F.when(amount > 100000, "HIGH_VALUE").otherwise("STANDARD_COLLECTION"))
            .withColumn("enforcement_level", F.when(days < 30, "NOTICE").when(days < 60, "DEMAND")
                        .when(days < 120, "GARNISHMENT").otherwise("LEGAL_ACTION")))


def overpayments(returns: DataFrame, payments: DataFrame) -> DataFrame:
    """Returns whose payments exceed the assessed amount."""
    p = payments.groupBy("return_id").agg(F.sum("payment_amount").alias("total_paid"))
    j = returns.join(p, "return_id")
    return (j.where(F.col("total_paid") > F.col("assessed_amount"))
            .select("return_id", "party_id", "assessed_amount", "total_paid",
                    (F.col("total_paid") - F.col("assessed_amount")).alias("overpaid_amount")))


def audit_candidates_by_history(returns: DataFrame, min_returns: int = 2, k: int = 12) -> DataFrame:
    """Parties with >= min_returns, ranked by total assessed, top k,
    stepped score 85 - 5 x (rank - 1) floored at 40."""
    from quaestor.operators.select import top_k
    g = returns.groupBy("party_id").agg(F.count(F.lit(1)).alias("return_count"),
                                        F.sum("assessed_amount").alias("total_assessed"))
    g = g.where(F.col("return_count") >= min_returns)
    top = top_k(g, [F.col("total_assessed").desc(), F.col("party_id").asc()], k)
    from pyspark.sql import Window
    w = Window.orderBy(F.col("total_assessed").desc(), F.col("party_id").asc())  # k rows only
    top = top.withColumn("candidate_rank", F.row_number().over(w))
    return top.withColumn("risk_score", F.greatest(F.lit(85) - 5 * (F.col("candidate_rank") - 1), F.lit(40)))


def multi_country_filing(filings: DataFrame, parties: DataFrame, nations: DataFrame) -> DataFrame:
    """Counts, on-time, average days late by country x tax type x year."""
    j = filings.join(parties.select("party_id", "nation_key"), "party_id").join(
        F.broadcast(nations.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("country_name"))),
        "nation_key")
    g = j.groupBy("country_name", "tax_type_code", F.year("period_date").alias("filing_year")).agg(
        F.count(F.lit(1)).alias("filings"), F.sum("is_on_time").cast("bigint").alias("on_time"),
        F.sum("days_late").cast("bigint").alias("total_days_late"), F.sum("is_late").cast("bigint").alias("late"))
    return g.withColumn("on_time_rate", pct("on_time", "filings")).withColumn(
        "avg_days_late", safe_ratio("total_days_late", "late", 2))


def outstanding_aging(assessments: DataFrame, as_of: str) -> DataFrame:
    """Aging of unpaid assessments by tax type."""
    from quaestor.functions.codes import band
    d = F.datediff(F.lit(as_of).cast("date"), "due_date")
    b = band(d, [(30, "0-30 days"), (90, "31-90 days"), (180, "91-180 days"), (365, "181-365 days"),
                 (None, "Over 1 year")])
    return (assessments.where(F.col("outstanding_amount") > 0)
            .groupBy("tax_type_code", b.alias("aging_bucket"))
            .agg(F.count(F.lit(1)).alias("assessment_count"), F.sum("outstanding_amount").alias("outstanding_amount")))


def compliance_event_analytics(events: DataFrame, parties: DataFrame, repeat_threshold: int = 20) -> DataFrame:
    """Per event type: events, parties affected, coverage % of all
    parties, repeat offenders (parties with >= threshold events of the type)."""
    per = events.groupBy("event_type", "party_id").agg(F.count(F.lit(1)).alias("n"))
    total = parties.agg(F.count(F.lit(1)).alias("__parties"))
    g = per.groupBy("event_type").agg(F.sum("n").cast("bigint").alias("event_count"),
                                      F.count(F.lit(1)).alias("parties_affected"),
                                      F.count_if(F.col("n") >= repeat_threshold).alias("repeat_offenders"))
    from quaestor.operators.keys import attach_scalars
    return attach_scalars(g, total).withColumn("coverage_pct", pct("parties_affected", "__parties")).drop("__parties")


def audit_effectiveness(audits: DataFrame) -> DataFrame:
    """Completed audits per tax type and year: assessed vs collected,
    collection rate and average duration.  audits: tax_type_code,
    start_date, completion_date, assessed_amount, collected_amount, is_completed."""
    a = audits.where(F.col("is_completed") == 1)
    g = a.groupBy("tax_type_code", F.year("start_date").alias("year")).agg(
        F.count(F.lit(1)).alias("total_audits"), F.sum(money("assessed_amount")).alias("total_assessed"),
        F.sum(money("collected_amount")).alias("total_collected"),
        F.sum(F.datediff("completion_date", "start_date")).alias("__days"))
    return (g.withColumn("collection_rate", pct("total_collected", "total_assessed"))
            .withColumn("avg_audit_days", safe_ratio("__days", "total_audits", 2)).drop("__days"))


def current_taxpayers(dim_party: DataFrame, current_col: str = "is_current") -> DataFrame:
    """Current-version projection of a versioned party dimension."""
    return dim_party.where(F.col(current_col) == 1).drop(current_col, "valid_to")


def registrations_by_type(registrations: DataFrame, type_col: str = "party_type") -> DataFrame:
    """Registrations by party type and tax type with distinct taxpayers."""
    return registrations.groupBy(type_col, "tax_type_code").agg(
        F.count(F.lit(1)).alias("registrations"), F.countDistinct("party_id").alias("taxpayers"))


def registration_trend(registrations: DataFrame, date_col: str = "registration_date") -> DataFrame:
    """Registrations by quarter with the tax types seen (bounded list)."""
    return registrations.groupBy(year_quarter_key(date_col).alias("year_quarter")).agg(
        F.count(F.lit(1)).alias("registrations"),
        F.array_join(F.array_sort(F.collect_set("tax_type_code")), ", ").alias("tax_types"))


def office_workload(filings: DataFrame, parties: DataFrame, places: DataFrame) -> DataFrame:
    """Filings handled per office (nation) and region."""
    j = filings.join(parties.select("party_id", "nation_key"), "party_id").join(F.broadcast(places), "nation_key")
    return j.groupBy("region_name", "nation_name").agg(F.count(F.lit(1)).alias("filings"),
                                                       F.countDistinct("party_id").alias("taxpayers"))


def tax_gap_by_category(assessments: DataFrame, categories: DataFrame, gap_rate_col: str = "gap_rate") -> DataFrame:
    """Estimated gap = assessed tax x gap % / 100 by risk/tax category
    (``gap_rate_col`` holds the fraction as an exact decimal)."""
    j = assessments.join(F.broadcast(categories), "tax_type_code")
    g = j.groupBy("tax_category").agg(F.sum(money("assessed_amount")).alias("assessed_amount"),
                                      F.sum(money(money("assessed_amount") * F.col(gap_rate_col))).alias("estimated_gap"))
    return g.withColumn("gap_rate", pct("estimated_gap", "assessed_amount"))


def registrations_by_region(registrations: DataFrame, parties: DataFrame, places: DataFrame,
                            region_filter: Sequence[str] | None = None) -> DataFrame:
    """Distinct registrations per region, optionally only some regions."""
    j = registrations.join(parties.select("party_id", "nation_key"), "party_id").join(F.broadcast(places), "nation_key")
    if region_filter:
        j = j.where(F.col("region_name").isin(*region_filter))
    return j.groupBy("region_name").agg(F.countDistinct("party_id", "tax_type_code").alias("registrations"))


def party_identifier_lookup(bridge: DataFrame, id_type: str | None = None, value: str | None = None) -> DataFrame:
    """Identifiers of parties, filtered by type and/or normalised value;
    ``is_primary`` marks the primary tax id per party."""
    out = bridge
    if id_type:
        out = out.where(F.col("identifier_type") == id_type)
    if value:
        out = out.where(F.col("normalized_value") == F.upper(F.replace(F.lit(value), F.lit(" "), F.lit(""))))
    return out


def customs_analytics(declarations: DataFrame) -> DataFrame:
    """Per trade flow and transport mode: declarations, customs value,
    duty revenue, median value (D10), preference rate; transport mode labels
    (H12); origin falls back to dispatch country (C16)."""
    from quaestor.functions.codes import code_label
    mode = code_label("transport_mode", {"1": "SEA", "2": "RAIL", "3": "ROAD", "4": "AIR", "5": "POST"}, "OTHER")
    d = declarations.withColumn("transport", mode).withColumn(
        "origin_country", F.coalesce("origin_country", "dispatch_country"))
    g = (d.groupBy("flow", "transport").agg(
        F.count(F.lit(1)).alias("declarations"), F.sum(money("customs_value")).alias("customs_value"),
        F.sum(money("duty_amount")).alias("duty_revenue"),
        F.count_if(F.col("preference_code").isNotNull()).alias("__pref"))
        .withColumn("preference_rate", pct("__pref", "declarations")).drop("__pref"))
    # the median by counts of values: no task sorts a whole flow
    mid = median(d, ["flow", "transport"], "customs_value", "median_value").withColumnsRenamed({"flow": "__f", "transport": "__t"})
    return g.join(mid, F.col("flow").eqNullSafe(F.col("__f")) & F.col("transport").eqNullSafe(F.col("__t"))).drop("__f", "__t")


def tax_scheme_views(schemes: DataFrame, as_of: str) -> DataFrame:
    """Active schemes at as_of with a scheme-type label and default flag."""
    from quaestor.functions.codes import code_label
    a = F.lit(as_of).cast("date")
    act = schemes.where((F.col("valid_from") <= a) & (F.col("valid_to").isNull() | (F.col("valid_to") > a)))
    return act.withColumn("scheme_type_label", code_label("scheme_type", {"STD": "Standard", "SME": "Small business",
                                                                          "FLAT": "Flat rate", "EXEMPT": "Exempt"},
                                                          "Other"))


def objection_candidates(audits: DataFrame) -> DataFrame:
    """Finalised audits not agreed by the taxpayer with an amount > 0,
    largest first."""
    return (audits.where((F.col("case_status_code") == "FINALIZED") & (F.col("taxpayer_agreed") == 0)
                         & (money("total_amount_assessed") > 0))
            .orderBy(F.col("total_amount_assessed").desc(), F.col("audit_case_id")))
