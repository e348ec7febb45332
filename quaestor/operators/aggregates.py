"""Aggregations.

All of them are ``groupBy().agg()`` plans, so Spark runs a partial
(map-side) aggregate in every task before the shuffle: a key holding a third
of the rows is combined locally and ships one row per task.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaestor.functions.numeric import MONEY, count_if, money, pct, safe_ratio, avg_money
from quaestor.functions.codes import aging_bucket


def group_summary(df: DataFrame, keys: Sequence[str], value: str, prefix: str = "") -> DataFrame:
    """COUNT, SUM, AVG, MIN, MAX of ``value`` by ``keys`` (D01); global when
    keys is empty (D02).  AVG is recomputed from the exact sum."""
    v = money(value)
    aggs = [F.count(F.lit(1)).alias(f"{prefix}row_count"), F.sum(v).alias(f"{prefix}total"),
            F.min(v).alias(f"{prefix}min_value"), F.max(v).alias(f"{prefix}max_value")]
    out = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return out.withColumn(f"{prefix}avg_value", avg_money(f"{prefix}total", f"{prefix}row_count"))


def global_summary(df: DataFrame, value: str, prefix: str = "") -> DataFrame:
    return group_summary(df, [], value, prefix)


def count_distinct(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], exact: bool = True) -> DataFrame:
    """COUNT(DISTINCT c) for several columns per group (D03).  ``exact=False``
    uses HLL++ sketches (no extra shuffle per column)."""
    fn = F.countDistinct if exact else F.approx_count_distinct
    aggs = [fn(F.col(c)).alias(a) for a, c in cols.items()]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def conditional_sums(df: DataFrame, keys: Sequence[str], conds: Mapping[str, tuple[Column, str | None]]) -> DataFrame:
    """SUM(CASE WHEN cond THEN value) / COUNT(CASE WHEN cond) per group.

    ``conds`` maps output name -> (condition, value column or None for a count).
    """
    aggs = []
    for name, (cond, value) in conds.items():
        if value is None:
            aggs.append(count_if(cond).alias(name))
        else:
            aggs.append(F.coalesce(F.sum(F.when(cond, money(value))), F.lit(0).cast(MONEY)).alias(name))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def pivot_codes(df: DataFrame, keys: Sequence[str], code_col: str, value: str, codes: Sequence[str],
                agg: str = "sum", prefix: str = "", fill_zero: bool = True) -> DataFrame:
    """Fixed pivot of a value by a code list (D05, D06 with agg='max').

    Written as one conditional aggregate per code (not ``pivot()``): the code
    list is known, so no distinct-values pass is needed and the result schema
    is stable even when a code is absent.
    """
    fn = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[agg]
    aggs = []
    for code in codes:
        name = f"{prefix}{code}".lower().replace(" ", "_").replace("-", "_")
        v = F.when(F.col(code_col) == F.lit(code), money(value) if agg != "count" else F.lit(1))
        a = fn(v)
        if fill_zero and agg in ("sum", "count"):
            a = F.coalesce(a, F.lit(0).cast(MONEY) if agg == "sum" else F.lit(0))
        aggs.append(a.alias(name))
    return df.groupBy(*keys).agg(*aggs)


def rate(num, den, k: int = 2) -> Column:
    """ROUND(100 * a / NULLIF(b, 0), k)."""
    return pct(num, den, k)


def having(agg_df: DataFrame, cond: Column | str) -> DataFrame:
    """Filter on aggregates."""
    return agg_df.where(F.expr(cond) if isinstance(cond, str) else cond)


def collect_values(df: DataFrame, keys: Sequence[str], value: Column | str, alias: str = "values",
                   sep: str | None = ", ") -> DataFrame:
    """GROUP_CONCAT / groupArray, sorted for determinism.

    Only for groups with a bounded number of members (versions of a key,
    codes of a type); the list is built per group in one task.
    """
    v = F.col(value) if isinstance(value, str) else value
    arr = F.array_sort(F.collect_list(v))
    return df.groupBy(*keys).agg((F.array_join(arr, sep) if sep is not None else arr).alias(alias))


def median(df: DataFrame, keys: Sequence[str], value: str, alias: str = "median_value",
           step: float = 1000.0) -> DataFrame:
    """PERCENTILE_CONT(0.5) WITHIN GROUP (D10), exact.

    Counts per distinct value get running totals inside value ranges of width
    ``step`` plus the totals of the lower ranges, so no task sorts a whole
    group; the median lies where the running total passes half.  ``step`` is a
    matter of speed only.  NULL values are ignored; a group of them has NULL."""
    from quaestor.operators.windows import running_agg
    v = F.col(value).cast("double")
    counts = df.where(v.isNotNull()).groupBy(*keys, v.alias("__value")).agg(F.count(F.lit(1)).alias("__c"))
    cum = running_agg(counts, keys, ["__value"], "__c", "__cum", chunk=F.floor(F.col("__value") / step))
    sizes = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.count(v).alias("__n"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    both = sizes.join(cum, on, "left")
    lo = F.min(F.when(2 * F.col("__cum") >= F.col("__n"), F.col("__value")))
    hi = F.min(F.when(2 * F.col("__cum") > F.col("__n"), F.col("__value")))
    return both.groupBy(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)]).agg((0.5 * lo + 0.5 * hi).alias(alias))


def yoy_compare(df: DataFrame, date_col: str, value: str, this_year: int, group: Sequence[str] = ()) -> DataFrame:
    """This year vs last year per calendar month with growth %."""
    d = F.col(date_col)
    y, m = F.year(d), F.month(d)
    out = (df.where(y.isin(this_year, this_year - 1))
           .groupBy(*group, m.alias("month"))
           .agg(F.coalesce(F.sum(F.when(y == this_year, money(value))), F.lit(0).cast(MONEY)).alias("current_year"),
                F.coalesce(F.sum(F.when(y == this_year - 1, money(value))), F.lit(0).cast(MONEY)).alias("previous_year")))
    return out.withColumn("growth_pct", pct(F.col("current_year") - F.col("previous_year"), "previous_year"))


def aging_summary(df: DataFrame, keys: Sequence[str], days_col: str, amount: str, wide: bool = False) -> DataFrame:
    """Bucket by days overdue then sum."""
    return (df.withColumn("aging_bucket", aging_bucket(days_col, wide))
            .groupBy(*keys, "aging_bucket")
            .agg(F.count(F.lit(1)).alias("item_count"), F.sum(money(amount)).alias("amount")))


def min_max_span(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """MIN/MAX date per group."""
    return df.groupBy(*keys).agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                                 F.count(F.lit(1)).alias("row_count"))


def ratio_recompute(df: DataFrame, keys: Sequence[str], num: str, den: str, alias: str = "ratio_pct") -> DataFrame:
    """Non-additive ratio from summed parts, never summed itself."""
    return (df.groupBy(*keys).agg(F.sum(money(num)).alias(f"sum_{num}"), F.sum(money(den)).alias(f"sum_{den}"))
            .withColumn(alias, pct(f"sum_{num}", f"sum_{den}")))


def semi_additive_last(df: DataFrame, entity_keys: Sequence[str], time_col: str, value: str,
                       group_keys: Sequence[str] = (), alias: str = "closing_total") -> DataFrame:
    """Semi-additive balance: LAST value across time per entity, then SUM across
    the other dimensions (D20).  ``max_by`` is an aggregate, so it is partially
    combined per task."""
    last = df.groupBy(*entity_keys, *[g for g in group_keys if g not in entity_keys]).agg(
        F.max_by(money(value), F.struct(F.col(time_col), *[F.col(k) for k in entity_keys])).alias("__last"))
    return last.groupBy(*group_keys).agg(F.sum("__last").alias(alias), F.count(F.lit(1)).alias("entity_count"))


def partial_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mergeable state per key: count, sum, max (D15).  AVG derived on read."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("state_count"), F.sum(money(value)).alias("state_sum"),
                                 F.max(money(value)).alias("state_max"))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge partial states (several loads or stream batches) and derive AVG."""
    out = states.groupBy(*keys).agg(F.sum("state_count").alias("state_count"),
                                    F.sum("state_sum").alias("state_sum"), F.max("state_max").alias("state_max"))
    return out.withColumn("state_avg", safe_ratio("state_sum", "state_count", 2))


def run_summary(run_log: DataFrame, dq_log: DataFrame | None = None) -> DataFrame:
    """Per mapping: runs, successful runs, average run seconds, rows
    extracted / rejected / loaded; with the DQ log, violations per mapping."""
    secs = F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")
    out = run_log.groupBy("mapping_code").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "SUCCESS").alias("successful_runs"),
        F.sum(secs).alias("__secs"), F.sum("rows_extracted").alias("rows_extracted"),
        F.sum("rows_rejected").alias("rows_rejected"), F.sum("rows_loaded").alias("rows_loaded"))
    out = out.withColumn("avg_run_seconds", safe_ratio("__secs", "runs", 2)).drop("__secs")
    if dq_log is not None:
        v = dq_log.groupBy("mapping_code").agg(F.count(F.lit(1)).alias("violations"))
        out = out.join(v, "mapping_code", "left").fillna(0, ["violations"])
    return out
