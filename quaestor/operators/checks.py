"""Warehouse checks and rule packs.

Every check returns rows of ``CHECK_SCHEMA`` (check, table, status, counts);
a pack is the ``unionByName`` of its checks, so one action evaluates all of
them.  Each check is a single aggregate or anti-join over the tables.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaestor.functions.numeric import money, pct
from quaestor.functions.strings import is_blank
from quaestor.operators.keys import attach_scalars


def _result(agg_df: DataFrame, check: str, table: str, failed: Column, checked: Column,
            status: Column | None = None, details: Column | None = None) -> DataFrame:
    st = status if status is not None else F.when(failed == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
    return agg_df.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                         st.alias("status"), checked.cast("bigint").alias("rows_checked"),
                         failed.cast("bigint").alias("rows_failed"),
                         (details if details is not None else F.lit(None).cast("string")).alias("details"))


def check_row_counts(source: DataFrame, target: DataFrame, name: str, ratio: float = 1.0,
                     fixed: int | None = None) -> DataFrame:
    """L2 vs L3 count: expected = source x ratio (or fixed); PASS equal,
    WARNING within +/-1, FAIL otherwise (L13)."""
    s = source.agg(F.count(F.lit(1)).alias("src"))
    t = target.agg(F.count(F.lit(1)).alias("tgt"))
    j = attach_scalars(s, t)
    exp = F.lit(fixed) if fixed is not None else F.round(F.col("src") * F.lit(ratio)).cast("bigint")
    diff = F.abs(F.col("tgt") - exp)
    st = F.when(diff == 0, "PASS").when(diff <= 1, "WARNING").otherwise("FAIL")
    return _result(j, "row_count", name, diff, F.col("tgt"), st,
                   F.concat(F.lit("expected="), exp.cast("string"), F.lit(" actual="), F.col("tgt").cast("string")))


def check_foreign_keys(fact: DataFrame, fact_name: str, fks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Orphans per fact key; key 0 (placeholder) is exempt."""
    outs = []
    for fk, (dim, dk) in fks.items():
        keys = dim.select(F.col(dk).alias("__k")).distinct()
        orphans = fact.where(F.col(fk).isNotNull() & (F.col(fk) != 0)).join(keys, F.col(fk) == F.col("__k"), "left_anti")
        a = orphans.agg(F.count(F.lit(1)).alias("n"))
        outs.append(_result(a, f"fk_{fk}", fact_name, F.col("n"), F.col("n")))
    return _union(outs)


def check_natural_keys(df: DataFrame, name: str, keys: Sequence[str], current_col: str | None = None) -> DataFrame:
    """Duplicate natural keys, current rows only for SCD2."""
    src = df.where(F.col(current_col) == 1) if current_col else df
    d = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    a = d.agg(F.count(F.lit(1)).alias("dups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return _result(a, "natural_key_unique", name, F.col("dups"), F.col("rows"))


def check_mandatory(df: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    """NULL/empty per mandatory column, one aggregate for all columns."""
    a = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(is_blank(c)).alias(f"m_{c}") for c in cols])
    outs = [_result(a, f"mandatory_{c}", name, F.col(f"m_{c}"), F.col("__rows")) for c in cols]
    return _union(outs)


def check_identifier_length(df: DataFrame, name: str, col: str, lengths: Sequence[int] = (9, 10, 12),
                            current_col: str | None = None) -> DataFrame:
    """Identifier length in the allowed set."""
    src = df.where(F.col(current_col) == 1) if current_col else df
    a = src.agg(F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col(col).isNotNull() & ~F.length(F.col(col)).isin(*lengths)).alias("bad"))
    return _result(a, f"length_{col}", name, F.col("bad"), F.col("rows"))


def check_score_range(df: DataFrame, name: str, col: str, lo: float = 0, hi: float = 100) -> DataFrame:
    """lo <= score <= hi."""
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if((F.col(col) < lo) | (F.col(col) > hi)).alias("bad"))
    return _result(a, f"range_{col}", name, F.col("bad"), F.col("rows"))


def check_scd2(df: DataFrame, name: str, current_col: str = "is_current", valid_to: str = "valid_to") -> DataFrame:
    """current <=> open end; historical <=> closed end."""
    cur_closed = (F.col(current_col) == 1) & F.col(valid_to).isNotNull()
    hist_open = (F.col(current_col) != 1) & F.col(valid_to).isNull()
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(cur_closed).alias("c1"), F.count_if(hist_open).alias("c2"))
    return _union([_result(a, "scd2_current_open", name, F.col("c1"), F.col("rows")),
                   _result(a, "scd2_history_closed", name, F.col("c2"), F.col("rows"))])


def check_date_coverage(fact: DataFrame, name: str, date_col: str, calendar: DataFrame, cal_col: str) -> DataFrame:
    """Fact dates exist in the calendar."""
    cal = calendar.select(F.col(cal_col).alias("__d"))
    miss = fact.where(F.col(date_col).isNotNull()).join(cal, F.col(date_col) == F.col("__d"), "left_anti")
    a = miss.agg(F.count(F.lit(1)).alias("n"))
    return _result(a, f"date_coverage_{date_col}", name, F.col("n"), F.col("n"))


def validation_report(results: DataFrame) -> DataFrame:
    """Totals per status, pass rate and verdict."""
    s = results.agg(F.count(F.lit(1)).alias("total_checks"),
                    F.count_if(F.col("status") == "PASS").alias("passed"),
                    F.count_if(F.col("status") == "FAIL").alias("failed"),
                    F.count_if(F.col("status") == "WARNING").alias("warnings"))
    return (s.withColumn("pass_rate", pct("passed", "total_checks"))
            .withColumn("verdict", F.when(F.col("failed") == 0, F.lit("PASSED")).otherwise(F.lit("FAILED"))))


# ---- rule shapes (L22-L31): each returns the offending rows ----------------

def rule_predicate(df: DataFrame, violation: str | Column) -> DataFrame:
    """Rows matching the violation predicate."""
    return df.where(F.expr(violation) if isinstance(violation, str) else violation)


def rule_at_most_one(df: DataFrame, group_cols: Sequence[str], where: str | Column | None = None,
                     exactly: bool = False, max_count: int = 1) -> DataFrame:
    """Groups with more than one row (or not exactly one)."""
    src = rule_predicate(df, where) if where is not None else df
    g = src.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("row_count"))
    return g.where((F.col("row_count") != 1) if exactly else (F.col("row_count") > max_count))


def rule_cross_table(left: DataFrame, right: DataFrame, on, mismatch: Column) -> DataFrame:
    """Joined rows whose attributes disagree."""
    return left.join(right, on).where(mismatch)


def rule_sum_reconciles(parent: DataFrame, child: DataFrame, key: str, parent_amount: str, child_amount: str,
                        tolerance: float = 0.01) -> DataFrame:
    """Parents whose amount differs from the sum of children by more than the
    tolerance (Q5, L25)."""
    s = child.groupBy(key).agg(F.sum(money(child_amount)).alias("children_total"))
    j = parent.join(s, key, "left").withColumn("children_total", F.coalesce("children_total", F.lit(0)))
    return j.withColumn("difference", money(parent_amount) - F.col("children_total")) \
            .where(F.abs(F.col("difference")) > F.lit(tolerance))


def rule_no_overlap(df: DataFrame, group_cols: Sequence[str], start: str, end: str, id_col: str,
                    check_gaps: bool = False, chunk: Column | str | None = None) -> DataFrame:
    """Intervals that overlap an earlier interval of their group, or (with
    ``check_gaps``) start more than one day after every earlier interval
    ended (Q6, L26).  Compared with the running maximum of the earlier ends
    - the neighbour test of the rule, never every pair - and chunkable (e.g.
    by start year) so a hot group is not sorted in one task."""
    from quaestor.operators.windows import prior_ends
    out = prior_ends(df, group_cols, start, end, id_col, chunk)
    open_before = F.coalesce(F.col("__open"), F.lit(0)) > 0
    bad = open_before | (F.col("max_prior_end").isNotNull() & (F.col(start) <= F.col("max_prior_end")))
    if check_gaps:
        bad = bad | (F.col("max_prior_end").isNotNull() & (F.col(start) > F.date_add(F.col("max_prior_end"), 1)))
    return out.where(bad).drop("__open")


def rule_timeliness(df: DataFrame, date_col: str, as_of, sla_days: int, where: str | Column | None = None) -> DataFrame:
    """Age since the date exceeds the SLA at as_of."""
    src = rule_predicate(df, where) if where is not None else df
    age = F.datediff(F.lit(as_of).cast("date"), F.col(date_col).cast("date"))
    return src.withColumn("age_days", age).where(F.col("age_days") > sla_days)


def rule_completeness(parent: DataFrame, child: DataFrame, key: str, min_children: int = 1,
                      seq_col: str | None = None) -> DataFrame:
    """Parents with too few children, or whose max sequence differs from the
    child count (Q9, L28)."""
    aggs = [F.count(F.lit(1)).alias("child_count")]
    if seq_col:
        aggs.append(F.max(seq_col).alias("max_seq"))
    c = child.groupBy(key).agg(*aggs)
    j = parent.select(key).join(c, key, "left").withColumn("child_count", F.coalesce("child_count", F.lit(0)))
    bad = F.col("child_count") < min_children
    if seq_col:
        bad = bad | (F.col("max_seq") != F.col("child_count"))
    return j.where(bad)


def balance_equation(df: DataFrame, opening: str, debit: str, credit: str, closing: str,
                     tolerance: float = 0.01) -> DataFrame:
    """closing = opening + debits - credits within tolerance."""
    diff = money(closing) - (money(opening) + money(debit) - money(credit))
    return df.withColumn("difference", diff).where(F.abs(F.col("difference")) > F.lit(tolerance))


def reconcile_facts(assessments: DataFrame, payments: DataFrame, key: str, due: str, paid: str) -> DataFrame:
    """Assessments whose due amount minus payments is not zero."""
    p = payments.groupBy(key).agg(F.sum(money(paid)).alias("total_paid"))
    j = assessments.join(p, key, "left").withColumn("total_paid", F.coalesce("total_paid", F.lit(0)))
    return j.withColumn("balance", money(due) - F.col("total_paid")).where(F.col("balance") != 0)


def double_entry_check(ledger: DataFrame, expected: DataFrame, key: str, amount: str, expected_amount: str,
                       tolerance: float = 0.01) -> DataFrame:
    """Debits per key vs expected revenue."""
    d = ledger.groupBy(key).agg(F.sum(F.when(money(amount) > 0, money(amount))).alias("debit_total"))
    j = expected.join(d, key, "full_outer").fillna(0, ["debit_total"])
    return j.where(F.abs(F.coalesce(F.col("debit_total"), F.lit(0)) - F.coalesce(money(expected_amount), F.lit(0)))
                   > F.lit(tolerance))


def run_rule_pack(rules: Sequence[Mapping], frames: Mapping[str, DataFrame]) -> DataFrame:
    """Execute a named set of rules (L32).  Each rule: ``code``, ``severity``,
    ``table`` and a callable ``build(frames) -> offending rows`` (expected 0
    rows).  Result: one row per rule with its violation count and status."""
    outs = []
    for r in rules:
        bad = r["build"](frames)
        a = bad.agg(F.count(F.lit(1)).alias("n"))
        st = F.when(F.col("n") == 0, F.lit("PASS")).otherwise(
            F.lit("FAIL") if r.get("severity", "ERROR") in ("ERROR", "CRITICAL") else F.lit("WARNING"))
        outs.append(a.select(F.lit(r["code"]).alias("rule_code"), F.lit(r.get("table", "")).alias("table_name"),
                             F.lit(r.get("severity", "ERROR")).alias("severity"),
                             F.col("n").cast("bigint").alias("violation_count"), st.alias("status")))
    return _union(outs)


def configuration_report(items: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]],
                         frames: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """PASS/FAIL per required configuration item: the item's frame must have
    at least ``min_rows`` rows (L33)."""
    outs = []
    for name, build in items.items():
        a = build(frames).agg(F.count(F.lit(1)).alias("n"))
        outs.append(a.select(F.lit(name).alias("config_item"), F.col("n").cast("bigint").alias("row_count"),
                             F.when(F.col("n") >= min_rows, "PASS").otherwise("FAIL").alias("status")))
    return _union(outs)


def _union(dfs):
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
