"""Snapshots and pre-aggregates.

Cumulative "as of snapshot" measures are computed without joining every
fact row to every snapshot: a row is assigned to the first snapshot on or
after its date (its month end, floored at the oldest snapshot), aggregated
per (party, snapshot), and the few snapshots of each party are then
prefix-summed.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quaestor.functions.codes import aging_bucket
from quaestor.functions.dates import date_key
from quaestor.functions.numeric import MONEY, money, pct, round_half_up
from quaestor.operators.ranges import cut, largest_key, running_sums, written
from quaestor.operators.windows import running_agg, running_aggs

WIDE = DecimalType(38, 2)


def month_end_snapshots(as_of: str, count: int = 6) -> list[Column]:
    """The ``count`` latest month ends on or before ``as_of`` (newest first)."""
    a = F.lit(as_of).cast("date")
    latest = F.when(F.last_day(a) == a, a).otherwise(F.last_day(F.add_months(a, -1)))
    return [F.last_day(F.add_months(latest, -k)) for k in range(count)]


def snapshot_bucket(date_col: str, oldest: Column) -> Column:
    """First month-end snapshot on/after the date, floored at the oldest."""
    return F.greatest(F.last_day(F.col(date_col)), oldest)


def _bucketed(df: DataFrame, date_col: str, snaps: list[Column], aggs: Sequence[Column]) -> DataFrame:
    oldest, newest = snaps[-1], snaps[0]
    src = df.where(F.last_day(F.col(date_col)) <= newest)
    return src.groupBy("party_id", snapshot_bucket(date_col, oldest).alias("snapshot_date")).agg(*aggs)


def build_taxpayer_activity(parties: DataFrame, filings: DataFrame, payments: DataFrame, ledger: DataFrame,
                            as_of: str, snapshots: int = 6, compliant_threshold: float = 80.0) -> DataFrame:
    """Party x month-end snapshot with cumulative filings, on-time filings,
    assessed amount, payments, paid amount, amount paid on time, balance as of
    the snapshot, filing rate (filings on time), payment rate (amount paid on
    time; both 0 without any), overall = mean of both, compliant >= threshold.

    filings: party_id, period_date, is_on_time, assessed_amount;
    payments: party_id, payment_date, due_date, payment_amount;
    ledger: account_id (= party_id), txn_date, amount.
    """
    snaps = month_end_snapshots(as_of, snapshots)
    grid = parties.select("party_id").withColumn("snapshot_date", F.explode(F.array(*snaps)))
    f = _bucketed(filings, "period_date", snaps, [F.count(F.lit(1)).alias("f_n"),
                                                   F.sum("is_on_time").alias("f_on_time"),
                                                   F.sum(money("assessed_amount")).alias("f_assessed")])
    p = _bucketed(payments, "payment_date", snaps, [F.count(F.lit(1)).alias("p_n"),
                                                     F.sum(money("payment_amount")).alias("p_amount"),
                                                     F.sum(F.when(F.col("payment_date") <= F.col("due_date"),
                                                                  money("payment_amount"))).alias("p_on_time")])
    led = _bucketed(ledger.withColumnRenamed("account_id", "party_id"), "txn_date", snaps,
                    [F.sum(money("amount")).alias("b_net")])
    g = grid.join(f, ["party_id", "snapshot_date"], "left").join(p, ["party_id", "snapshot_date"], "left") \
        .join(led, ["party_id", "snapshot_date"], "left")
    measures = (("f_n", "filings_count", "bigint"), ("f_on_time", "on_time_filings", "bigint"),
                ("f_assessed", "assessed_amount", WIDE), ("p_n", "payments_count", "bigint"),
                ("p_amount", "paid_amount", WIDE), ("p_on_time", "on_time_paid_amount", WIDE), ("b_net", "balance_amount", WIDE))
    # all cumulative measures in one window pass over the (few) snapshots of a party
    g = running_aggs(g, ["party_id"], [F.col("snapshot_date")],
                     {out: (F.coalesce(F.col(c), F.lit(0)), "sum") for c, out, _ in measures})
    for _, out, t in measures:
        g = g.withColumn(out, F.col(out).cast(t))
    g = g.drop("f_n", "f_on_time", "f_assessed", "p_n", "p_amount", "p_on_time", "b_net")
    zero = F.lit(0).cast("decimal(18,2)")
    g = (g.withColumn("filing_rate", F.coalesce(pct("on_time_filings", "filings_count"), zero))
         .withColumn("payment_rate", F.coalesce(pct("on_time_paid_amount", "paid_amount"), zero)))
    overall = round_half_up((F.col("filing_rate").cast("double") + F.col("payment_rate").cast("double")) / 2, 2)
    return (g.withColumn("overall_compliance", overall)
            .withColumn("is_compliant", (F.col("overall_compliance") >= compliant_threshold).cast("int"))
            .withColumn("snapshot_date_key", date_key("snapshot_date")))


def build_taxpayer_cases(parties: DataFrame, as_of: str, assessments: DataFrame, audits: DataFrame, collections: DataFrame,
                         objections: DataFrame, risks: DataFrame, balances: DataFrame, snapshots: int = 6) -> DataFrame:
    """I29, the measures beside filings and payments: party x month-end with
    what stood on or before it.

    assessments: party_id, assessment_date, assessed_amount, assessment_type_code
    (SELF; ADMINISTRATIVE and AUDIT are the authority's own); audits: party_id,
    selection_date, is_active; collections: party_id, action_date, is_active;
    objections: party_id, filing_date, is_active (each 0/1); balances: party_id,
    txn_date, amount (debits +); risks: party_id, assessment_date, risk_rating
    and tiebreak (the latest rating of a party holds for all its snapshots,
    UNKNOWN without one).  Facts are summed per party and snapshot first, so a
    party costs its few snapshots whatever number of facts it has."""
    snaps = month_end_snapshots(as_of, snapshots)
    grid = parties.select("party_id").withColumn("snapshot_date", F.explode(F.array(*snaps)))
    amount = money("assessed_amount")
    kind = F.col("assessment_type_code")
    parts = [
        (assessments, "assessment_date", {"total_assessments": F.count(F.lit(1)), "assessed_amount": F.sum(amount),
                                          "self_assessed_amount": F.sum(F.when(kind == "SELF", amount)),
                                          "admin_assessed_amount": F.sum(F.when(kind.isin("ADMINISTRATIVE", "AUDIT"), amount))}),
        (audits, "selection_date", {"audit_cases_count": F.count(F.lit(1)), "__audits": F.sum("is_active")}),
        (collections, "action_date", {"collection_actions_count": F.count(F.lit(1)), "__collections": F.sum("is_active")}),
        (objections, "filing_date", {"__objections": F.sum("is_active")}),
        (balances, "txn_date", {"outstanding_balance": F.sum(money("amount"))})]
    names: list[str] = []
    for df, date, measures in parts:
        names += measures
        grid = grid.join(_bucketed(df, date, snaps, [v.alias(f"__in_{n}") for n, v in measures.items()]), ["party_id", "snapshot_date"], "left")
    run = running_aggs(grid, ["party_id"], [F.col("snapshot_date")],
                       {n: (F.coalesce(F.col(f"__in_{n}"), F.lit(0)), "sum") for n in names})
    rating = risks.groupBy("party_id").agg(F.max_by("risk_rating", F.struct("assessment_date", "tiebreak")).alias("current_risk_rating"))
    out = run.join(rating, "party_id", "left")
    counts = [c for c in names if c.endswith("count") or c.startswith("total_")]
    sums = [c for c in names if c.endswith("amount")]
    balance = F.col("outstanding_balance").cast(WIDE)
    zero = F.lit(0).cast(WIDE)
    return out.select("party_id", "snapshot_date", date_key("snapshot_date").alias("snapshot_date_key"),
                      *[F.col(c).cast("long").alias(c) for c in counts], *[F.col(c).cast(WIDE).alias(c) for c in sums],
                      balance.alias("outstanding_balance"), F.greatest(balance, zero).alias("arrears_amount"),
                      F.greatest((-balance).cast(WIDE), zero).alias("credit_balance"),
                      *[(F.col(f"__{x}s") > 0).cast("int").alias(f"has_active_{x}") for x in ("audit", "collection", "objection")],
                      F.coalesce("current_risk_rating", F.lit("UNKNOWN")).alias("current_risk_rating"))


def build_account_snapshot(ledger: DataFrame, as_of: str, amount: str = "amount") -> DataFrame:
    """Per account and month: opening, activity by transaction type,
    closing, and aging of the positive debits still open at month end (debits
    older than 30/90/180/365 days).  ledger: account_id, txn_date, txn_type,
    amount (debits +, credits -)."""
    m = ledger.withColumn("month_end", F.last_day("txn_date"))
    g = m.groupBy("account_id", "month_end").agg(
        F.coalesce(F.sum(F.when(F.col("txn_type") == "ASSESSMENT", money(amount))), F.lit(0).cast(MONEY)).cast(WIDE)
        .alias("assessed_in_period"),
        F.coalesce(-F.sum(F.when(F.col("txn_type") == "PAYMENT", money(amount))), F.lit(0).cast(MONEY)).cast(WIDE)
        .alias("paid_in_period"),
        F.count(F.lit(1)).alias("transaction_count"))
    g = g.withColumn("__net", F.col("assessed_in_period") - F.col("paid_in_period"))
    g = running_agg(g, ["account_id"], [F.col("month_end")], "__net", "closing_balance", "sum")
    g = g.withColumn("closing_balance", F.col("closing_balance").cast(WIDE))
    return (g.withColumn("opening_balance", (F.col("closing_balance") - F.col("__net")).cast(WIDE)).drop("__net")
            .withColumn("snapshot_date_key", date_key("month_end"))
            .withColumn("aging_bucket", F.when(F.col("closing_balance") > 0,
                                               aging_bucket(F.datediff(F.lit(as_of).cast("date"), "month_end"), True))))


def monthly_rollup(facts: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """D16/D17 style: full-outer merge of per-fact monthly aggregates.  Each
    input is already grouped on ``keys``; missing measures become 0."""
    out = None
    for _, df in facts.items():
        out = df if out is None else out.join(df, list(keys), "full_outer")
    measures = [c for c in out.columns if c not in keys]
    return out.fillna(0, measures)


# Buckets of open items and the first day overdue of each.
AGING_BUCKETS = [("current_amount", None), ("overdue_1_30_days", 1), ("overdue_31_60_days", 31), ("overdue_61_90_days", 61),
                 ("overdue_91_180_days", 91), ("overdue_181_365_days", 181), ("overdue_over_365_days", 366)]


def build_open_item_aging(items: DataFrame, allocations: DataFrame, as_of: str, hot_rows: int = 1_000_000) -> DataFrame:
    """Open items per account and month end by days overdue.

    items: item_id, account_id, posted_date, due_date, amount (> 0);
    allocations: item_id, paid_date, allocated_amount.  An item stands in one
    bucket a day; it enters the first on its posting date and moves on at fixed
    days after it is due.  A payment takes its amount out of the item from its
    date on (not before the posting), so it is an item of its own with the sign
    turned.  What enters or leaves a bucket is a signed event; events are summed
    by month first and then run up per account: no item meets the months in which
    nothing happens to it.  While no account has more than ``hot_rows`` postings
    and payments, events are made and summed behind one shuffle by account; else
    events are shuffled by month and run up over range cuts.  Amounts are exact
    cents (long), as in ``allocate``.

    A row per account and month (up to ``as_of``) in which an item is posted,
    paid or moves on: the seven buckets, debit_balance (their sum by another
    way: posted less paid), opening_balance and has_debit_balance.
    """
    cents = lambda c: (money(c) * 100).cast("long")
    posted = items.select("item_id", "account_id", "due_date", F.col("posted_date").alias("__from"), cents("amount").alias("__amt"))
    paid = (items.select("item_id", "account_id", "due_date", "posted_date")
            .join(allocations.select("item_id", "paid_date", "allocated_amount"), "item_id")
            .select("item_id", "account_id", "due_date", F.greatest("paid_date", "posted_date").alias("__from"),
                    (-cents("allocated_amount")).alias("__amt")))
    signed = written(posted.unionByName(paid).select("account_id", "due_date", "__from", "__amt"))
    hot = largest_key(signed, ["account_id"]) > hot_rows
    if not hot:
        signed = signed.repartition("account_id")
    names = [n for n, _ in AGING_BUCKETS]
    # the day on which each bucket begins for an item; the first has begun when the item comes
    starts = [F.col("__from") if d is None else F.date_add("due_date", d) for _, d in AGING_BUCKETS]
    moves = []
    for i in range(len(names)):
        enters = F.greatest(starts[i], F.col("__from"))
        here = F.lit(True) if i + 1 == len(names) else starts[i + 1] > F.col("__from")  # not over before it comes
        moves.append(F.when(here, F.struct(enters.alias("day"), F.lit(i).alias("into"))))
    events = (signed.withColumn("__m", F.explode(F.array_compact(F.array(*moves))))
              .where(F.col("__m.day") <= F.lit(as_of).cast("date")))
    first = (F.col("__m.into") == 0) | (starts_of(starts, F.col("__m.into")) <= F.col("__from"))
    by_month = events.groupBy("account_id", F.last_day("__m.day").alias("month_end")).agg(
        *[F.sum(F.when(F.col("__m.into") == i, F.col("__amt"))
                .when((F.col("__m.into") == i + 1) & ~first, -F.col("__amt")).otherwise(F.lit(0))).alias(f"__{n}")
          for i, n in enumerate(names)],
        F.sum(F.when(first, F.col("__amt")).otherwise(F.lit(0))).alias("__net"))
    sums = {**{n: f"__{n}" for n in names}, "debit_balance": "__net"}
    if hot:
        run = running_sums(cut(by_month, ["account_id"], ["month_end"]), ["account_id"], sums)
    else:
        upto = Window.partitionBy("account_id").orderBy("month_end").rowsBetween(Window.unboundedPreceding, 0)
        run = by_month.select("*", *[F.coalesce(F.sum(v).over(upto), F.lit(0)).alias(n) for n, v in sums.items()])
    wide = lambda c: (c.cast("decimal(20,0)") / 100).cast(WIDE)
    return run.select("account_id", "month_end", date_key("month_end").alias("snapshot_date_key"),
                      *[wide(F.col(n)).alias(n) for n in names], wide(F.col("debit_balance")).alias("debit_balance"),
                      wide(F.col("debit_balance") - F.col("__net")).alias("opening_balance"),
                      (F.col("debit_balance") > 0).cast("int").alias("has_debit_balance"))


def starts_of(starts, i):
    """The one of ``starts`` with number ``i``."""
    return F.element_at(F.array(*starts), i + 1)
