"""Ledger, allocation and tax arithmetic (E14, E16-E19, I37-I39, M30, M36,
M38-M40).

Allocation (payments over liabilities, losses over profits, refunds over
debts) is the intersection of two running sums per account: demand i covers
[D_i - d_i, D_i), supply j covers [S_j - s_j, S_j) and receives
max(0, min(ends) - max(starts)).  Overlapping pairs are found by a single
ordered scan over the union of interval starts (no pairwise join), so the
cost is linear in the rows of an account.  Where an account is hot, sums and
scan run over range cuts (``ranges``), so it is many tasks.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quaestor.functions.numeric import MONEY, money, round_half_up
from quaestor.operators.ranges import AT, PART, cut, filled, largest_key, running_sums, written
from quaestor.operators.windows import running_agg

WIDE = DecimalType(38, 2)


def running_balance(ledger: DataFrame, account_cols: Sequence[str], order_cols: Sequence[str], amount: str,
                    out_col: str = "balance_after", chunk: Column | str | None = None) -> DataFrame:
    """Balance after each transaction (E14): ordered running sum per account
    (debits +, credits -), chunked by month when ``chunk`` is given."""
    out = running_agg(ledger, account_cols, [F.col(c) for c in order_cols], money(amount), out_col, "sum", chunk=chunk)
    return out.withColumn(out_col, F.col(out_col).cast(WIDE))


def allocate(demand: DataFrame, supply: DataFrame, keys: Sequence[str], demand_id: str | Sequence[str], demand_order: Sequence,
             demand_amount: str, supply_id: str | Sequence[str], supply_order: Sequence, supply_amount: str,
             sequence_col: str | None = None, chunk_width: float | None = None, demand_chunk: Column | None = None,
             supply_chunk: Column | None = None, hot_rows: int = 1_000_000, keep_supply: bool = False,
             stored: bool = False) -> DataFrame:
    """Allocation of supply over demand per key.

    Returns one row per (keys, demand_id, supply_id) with ``allocated_amount``
    > 0.  ``demand_order`` sets the priority (e.g. charge rank, then oldest
    period), ``supply_order`` the order supplies are consumed; the ids end both.
    ``sequence_col`` numbers the allocations of a supply in priority order.

    Each side is read once.  While no account has more than ``hot_rows`` rows,
    sums and scan are windows over one shuffle by account; else both are cut
    into ranges of equal size (``ranges``), so a hot account is spread over as
    many tasks as it has ranges.  The result is the same.  (The chunk parameters
    of earlier calls are accepted; neither form needs them.)

    With ``keep_supply`` each supply has one row more where its first cent meets
    no demand: demand ids NULL, amount 0.  ``stored`` says that both sides are
    cheap to read again, so they are not written first.
    """
    keys = list(keys)
    dids, sids = ([x] if isinstance(x, str) else list(x) for x in (demand_id, supply_id))
    # Positions are exact integer cents (long): running sums and struct
    # comparisons stay on compact longs instead of 38-digit decimals.
    cents = lambda c: (money(c) * 100).cast("long")

    def side(df, kind, ids, order, amount, name):
        order = [F.col(c) if isinstance(c, str) else c for c in order]
        return df.select(*keys, F.lit(kind).alias("__kind"), cents(amount).alias("__amt"), F.struct(*ids).alias(name),
                         *[c.alias(f"{name}_{i}") for i, c in enumerate(order)]).where(F.col("__amt") > 0)

    both = side(demand, 0, dids, demand_order, demand_amount, "__d").unionByName(
        side(supply, 1, sids, supply_order, supply_amount, "__s"), allowMissingColumns=True)
    order = ["__kind", *[c for c in both.columns if c.startswith(("__d_", "__s_"))], "__d", "__s"]
    if not stored:
        both = written(both)  # the sources are read once, whatever looks at their rows again
    hot = largest_key(both, keys) > hot_rows

    def interval(name):
        return F.when(F.col(name).isNotNull(), F.struct((F.col("__end") - F.col("__amt")).alias("p"), F.col(name).alias("id"),
                                                        F.col("__end").alias("e"))).alias(name)

    if hot:
        ends = running_sums(cut(both, keys, order), [*keys, "__kind"], {"__end": "__amt"})
    else:  # an account fits a task: one shuffle serves the sums and the scan
        so_far = Window.partitionBy(*keys, "__kind").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        ends = both.repartition(*keys).withColumn("__end", F.sum("__amt").over(so_far))
    # One row per interval start; demand rows sort before supply rows at the same position.
    starts = ends.select(*keys, "__kind", (F.col("__end") - F.col("__amt")).alias("__pos"), interval("__d"), interval("__s"))
    if hot:
        points = filled(cut(starts, keys, ["__pos", "__kind"]), keys, {"__cd": "__d", "__cs": "__s"})
    else:
        upto = Window.partitionBy(*keys).orderBy("__pos", "__kind").rowsBetween(Window.unboundedPreceding, 0)
        points = starts.select("*", *[F.last(c, ignorenulls=True).over(upto).alias(n) for n, c in (("__cd", "__d"), ("__cs", "__s"))],
                               F.lit(0).alias(PART), F.row_number().over(upto).alias(AT))
    # Each overlapping (demand, supply) pair is current at exactly one start
    # row (the later of the two starts), so no de-duplication is needed.
    shared = F.least(F.col("__cd.e"), F.col("__cs.e")) - F.greatest(F.col("__cd.p"), F.col("__cs.p"))
    meets = F.col("__cd").isNotNull() & F.col("__cs").isNotNull() & (shared > 0)
    points = (points.withColumn("__c", F.when(meets, shared).otherwise(F.lit(0)))
              .where((F.col("__c") > 0) | (F.col("__kind") == 1) if keep_supply else F.col("__c") > 0)
              .select(*keys, AT, PART, F.when(F.col("__c") > 0, F.col("__cd.id")).alias("__d"), F.col("__cs.id").alias("__s"), "__c"))
    if sequence_col and hot:  # a supply's allocations are neighbours in the order of positions
        points = running_sums(written(points), [*keys, "__s"], {sequence_col: F.lit(1)})
    elif sequence_col:
        points = points.withColumn(sequence_col, F.row_number().over(Window.partitionBy(*keys, "__s").orderBy(AT)))
    return points.select(*keys, *[F.col("__d")[c].alias(c) for c in dids], *[F.col("__s")[c].alias(c) for c in sids],
                         (F.col("__c").cast("decimal(20,0)") / 100).cast(MONEY).alias("allocated_amount"),
                         *([F.col(sequence_col).cast("int").alias(sequence_col)] if sequence_col else []))


def unpivot_charges(assessments: DataFrame, ranks: Sequence[tuple[str, str]], carry: Sequence[str]) -> DataFrame:
    """One row per open charge of an assessment: ``carry`` columns,
    charge_type_code, charge_rank (place in ``ranks``, pairs of code and amount
    column, first paid first) and amount (E16 demand)."""
    each = F.explode(F.array(*[F.struct(F.lit(code).alias("charge_type_code"), F.lit(i + 1).alias("charge_rank"),
                                        money(c).alias("amount")) for i, (code, c) in enumerate(ranks)]))
    return assessments.select(*carry, each.alias("__c")).select(*carry, "__c.*").where(F.col("amount") > 0)


def allocation_summary(supply: DataFrame, allocations: DataFrame, keys: Sequence[str], supply_id: str,
                       supply_amount: str) -> DataFrame:
    """Per supply: allocated total, allocation count, excess (to credit)."""
    a = allocations.groupBy(*keys, supply_id).agg(F.sum("allocated_amount").alias("allocated_total"),
                                                  F.count(F.lit(1)).alias("allocation_count"))
    out = supply.join(a, [*keys, supply_id], "left")
    return (out.withColumn("allocated_total", F.coalesce(F.col("allocated_total"), F.lit(0).cast(WIDE)))
            .withColumn("allocation_count", F.coalesce(F.col("allocation_count"), F.lit(0)))
            .withColumn("excess_amount", (money(supply_amount) - F.col("allocated_total")).cast(WIDE)))


def installment_split(df: DataFrame, amount: str, n_col: str, share: float = 0.4,
                      out_amount: str = "installment_amount") -> DataFrame:
    """Partial payments: each installment pays ``share`` of what remains,
    rounded half-up to cents and taken off before the next; the last one pays
    the remainder (E17), so the parts sum to the amount.  Decimal throughout."""
    part_of = F.lit(str(share)).cast(DecimalType(9, 6))
    start = F.struct(money(amount).alias("left"), F.array().cast("array<decimal(19,2)>").alias("parts"))

    def pay(state, _):
        part = F.round(state["left"] * part_of, 2).cast(MONEY)
        return F.struct((state["left"] - part).cast(MONEY).alias("left"),
                        F.array_append(state["parts"], part).alias("parts"))

    n = F.col(n_col)
    before_last = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    paid = F.aggregate(before_last, start, pay, lambda s: F.array_append(s["parts"], s["left"]))
    return (df.select("*", F.posexplode(paid).alias("installment_no", out_amount))
            .withColumn("installment_no", F.col("installment_no") + 1))


def installment_schedule(plans: DataFrame, total: str, n_col: str, start_col: str, months_between: int | str = 1,
                         out_due: str = "due_date", out_amount: str = "installment_amount") -> DataFrame:
    """One row per installment; equal parts rounded to cents, the last row
    takes the remainder so the schedule sums to the plan total (E18)."""
    step = F.lit(months_between) if isinstance(months_between, int) else F.col(months_between)
    out = plans.withColumn("installment_no", F.explode(F.sequence(F.lit(1), F.col(n_col))))
    base = round_half_up(money(total).cast("double") / F.col(n_col), 2, 19)
    last = money(total) - base * (F.col(n_col) - 1)
    return (out.withColumn(out_due, F.add_months(F.col(start_col), (F.col("installment_no") - 1) * step))
            .withColumn(out_amount, F.when(F.col("installment_no") == F.col(n_col), last).otherwise(base).cast(MONEY)))


def progressive_tax(income, brackets: Sequence[tuple[float, float | None, float]]) -> Column:
    """Tax over a bracket schedule (M36): sum over brackets of
    max(0, min(x, to) - from) * rate/100.  The schedule is configuration, so
    the sum is one projection expression (no join)."""
    x = money(income)
    terms = []
    for lo, hi, rate in brackets:
        top = x if hi is None else F.least(x, F.lit(hi).cast(MONEY))
        terms.append(F.greatest(top - F.lit(lo).cast(MONEY), F.lit(0).cast(MONEY)) * F.lit(rate).cast(DecimalType(7, 4)))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return round_half_up(total / F.lit(100), 2, 19)


def accrue_interest(principal, start, end, rate_periods: Sequence[tuple[str, str | None, float]],
                    cap_pct: float | None = None, compound: bool = False) -> Column:
    """Interest = principal x annual_rate/365 x days overdue, split over rate
    validity periods (M38).  ``rate_periods`` = (from, to-exclusive or None,
    annual %).  With ``compound`` the daily factors multiply (exp(sum(log))).
    ``cap_pct`` caps interest at a % of principal."""
    s, e = F.col(start).cast("date") if isinstance(start, str) else start, F.col(end).cast("date") if isinstance(end, str) else end
    p = money(principal)
    simple = None
    log_growth = None
    for lo, hi, rate in rate_periods:
        a = F.greatest(s, F.lit(lo).cast("date"))
        b = e if hi is None else F.least(e, F.lit(hi).cast("date"))
        days = F.greatest(F.datediff(b, a), F.lit(0))
        part = days * F.lit(rate / 100.0 / 365.0)
        simple = part if simple is None else simple + part
        lg = days * F.lit(math.log1p(rate / 100.0 / 365.0))
        log_growth = lg if log_growth is None else log_growth + lg
    factor = (F.exp(log_growth) - 1) if compound else simple
    interest = p.cast("double") * factor
    if cap_pct is not None:
        interest = F.least(interest, p.cast("double") * F.lit(cap_pct / 100.0))
    return round_half_up(interest, 2, 19)


def penalty_interest(amount, due, paid, penalty_rate_pm: float = 2.0, penalty_cap_pct: float = 50.0,
                     interest_rate_pm: float = 1.0) -> tuple[Column, Column, Column]:
    """Late months = days//30 + 1 when paid after due, else 0; penalty 2 % per
    month capped at 50 %; interest 1 % per month; each rounded to cents (M30)."""
    d = F.datediff(F.col(paid).cast("date") if isinstance(paid, str) else paid,
                   F.col(due).cast("date") if isinstance(due, str) else due)
    months = F.when(d > 0, F.floor(d / 30) + 1).otherwise(F.lit(0))
    a = money(amount).cast("double")
    pen = round_half_up(a * F.least(months * F.lit(penalty_rate_pm / 100.0), F.lit(penalty_cap_pct / 100.0)), 2, 19)
    intr = round_half_up(a * months * F.lit(interest_rate_pm / 100.0), 2, 19)
    return months.cast("int"), pen, intr


def assess_penalty(method: Column, tax: Column, turnover: Column, days_late: Column, fixed: Column, rate: Column,
                   min_amt: Column | None = None, max_amt: Column | None = None,
                   discount_pct: Column | None = None) -> Column:
    """Penalty by method (M39): FIXED, PCT_OF_TAX, PCT_OF_TURNOVER, DAILY,
    PROGRESSIVE (rate per started month, doubling after 3); then min/max and a
    discount."""
    m = F.upper(method)
    base = (F.when(m == "FIXED", fixed.cast("double"))
            .when(m == "PCT_OF_TAX", tax.cast("double") * rate / 100)
            .when(m == "PCT_OF_TURNOVER", turnover.cast("double") * rate / 100)
            .when(m == "DAILY", days_late * rate)
            .when(m == "PROGRESSIVE", tax.cast("double") * rate / 100 *
                  F.least(F.ceil(days_late / 30), F.lit(3)) + tax.cast("double") * rate / 50 *
                  F.greatest(F.ceil(days_late / 30) - 3, F.lit(0))))
    if min_amt is not None:
        base = F.greatest(base, min_amt.cast("double"))
    if max_amt is not None:
        base = F.least(base, max_amt.cast("double"))
    if discount_pct is not None:
        base = base * (1 - F.coalesce(discount_pct, F.lit(0)) / 100)
    return round_half_up(base, 2, 19)


def ledger_postings(assessments: DataFrame, id_col: str, account_col: str, date_col: str,
                    components: dict, allocations: DataFrame | None = None, alloc_cols: dict | None = None) -> DataFrame:
    """Assessment -> one debit per positive component (I37); allocations ->
    credits.  ``components`` maps charge type -> amount column."""
    stack = F.explode(F.array(*[F.struct(F.lit(ct).alias("charge_type_code"), money(c).alias("amount"))
                                for ct, c in components.items()]))
    deb = (assessments.select(F.col(id_col).alias("source_id"), F.col(account_col).alias("account_id"),
                              F.col(date_col).alias("txn_date"), stack.alias("c"))
           .select("source_id", "account_id", "txn_date", "c.charge_type_code", "c.amount")
           .where(F.col("amount") > 0)
           .withColumn("txn_type", F.lit("DEBIT")))
    if allocations is None:
        return deb
    ac = alloc_cols or {}
    cred = allocations.select(F.col(ac.get("id", "allocation_id")).alias("source_id"),
                              F.col(ac.get("account", "account_id")).alias("account_id"),
                              F.col(ac.get("date", "txn_date")).alias("txn_date"),
                              F.col(ac.get("charge", "charge_type_code")).alias("charge_type_code"),
                              (-money(ac.get("amount", "allocated_amount"))).cast(MONEY).alias("amount"),
                              F.lit("CREDIT").alias("txn_type"))
    return deb.unionByName(cred)


def account_balances(ledger: DataFrame, keys: Sequence[str], period_col: str, amount: str) -> DataFrame:
    """Per account/period/charge: debits, credits, opening (= previous
    closing), closing = opening + debits - credits (I38, I23).  One grouped
    aggregate, then a running sum over the few periods of each key."""
    g = ledger.groupBy(*keys, period_col).agg(
        F.coalesce(F.sum(F.when(money(amount) > 0, money(amount))), F.lit(0).cast(MONEY)).cast(WIDE).alias("debit_amount"),
        F.coalesce(-F.sum(F.when(money(amount) < 0, money(amount))), F.lit(0).cast(MONEY)).cast(WIDE).alias("credit_amount"))
    g = g.withColumn("__net", F.col("debit_amount") - F.col("credit_amount"))
    g = running_agg(g, keys, [F.col(period_col)], "__net", "closing_balance", "sum")
    return (g.withColumn("closing_balance", F.col("closing_balance").cast(WIDE))
            .withColumn("opening_balance", (F.col("closing_balance") - F.col("__net")).cast(WIDE)).drop("__net"))


def create_account_periods(accounts: DataFrame, periods: DataFrame, existing: DataFrame,
                           match_cols: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    """One account-period row for every active account of the period's tax
    type and frequency, where not present yet (I39): equi-join + anti-join."""
    cand = accounts.join(periods, list(match_cols))
    return cand.join(existing.select(*key_cols), list(key_cols), "left_anti")


def open_account_periods(accounts: DataFrame, start_col: str, end_col: str, existing: DataFrame,
                         key_cols: Sequence[str], period_col: str = "period_month",
                         step: str = "INTERVAL 1 MONTH") -> DataFrame:
    """I39 for a continuous calendar: each account's periods from its start to
    ``end_col`` minus those that already exist.  An account meets the array of
    its periods (as long as the calendar at most) and makes the missing ones
    there by ``explode``: only accounts and existing periods are shuffled."""
    keys = list(key_cols)
    acct_keys = [k for k in keys if k != period_col]
    whole = F.sequence(F.col(start_col), F.col(end_col), F.expr(step))
    of = accounts.select(whole.alias("__all")).schema["__all"].dataType.elementType
    have = (existing.select(*acct_keys, F.col(period_col).cast(of).alias("__have")).where(F.col("__have").isNotNull()).distinct()
            .groupBy(*acct_keys).agg(F.collect_list("__have").alias("__have")))
    missing = F.when(F.col("__have").isNull(), F.col("__all")).otherwise(F.array_except("__all", "__have"))
    return (accounts.select(*acct_keys, whole.alias("__all")).join(have, acct_keys, "left")
            .select(*acct_keys, F.explode(missing).alias(period_col)))
