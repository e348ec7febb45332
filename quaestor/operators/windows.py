"""Window and temporal operators.

Skew.  A plain ``Window.partitionBy(account)`` sorts every row of an account
in one task; an account holding a third of the table would then run in one
task.  ``running_agg`` therefore takes an optional *chunk* (a coarse, order-
monotonic expression such as the month): rows are scanned inside
(partition, chunk), chunk totals are prefix-combined over the (few) chunks of
each partition, and the two are added.  Per-group "first/latest/flag" style
operators are written as aggregates (partial aggregation per task) joined
back, never as windows over the whole group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaestor.functions.numeric import col, money, round_half_up
from quaestor.functions.dates import date_key
from quaestor.operators.keys import attach_scalars

_AGG = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def _combine(fn: str, prior: Column, local: Column) -> Column:
    if fn in ("sum", "count"):
        return F.coalesce(prior, F.lit(0)) + F.coalesce(local, F.lit(0))
    if fn == "max":
        return F.greatest(prior, local)
    return F.least(prior, local)


def _join_chunks(rows: DataFrame, prior: DataFrame, on: Sequence[str]) -> DataFrame:
    """Chunk prefixes back to their rows; NULL keys and chunks match too."""
    p = prior.select(*[F.col(c).alias(f"__on{i}") for i, c in enumerate(on)],
                     *[c for c in prior.columns if c not in on])
    cond = [F.col(c).eqNullSafe(F.col(f"__on{i}")) for i, c in enumerate(on)]
    return rows.join(p, cond, "inner").drop(*[f"__on{i}" for i in range(len(on))])


def running_agg(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence, value, out_col: str,
                fn: str = "sum", inclusive: bool = True, chunk: Column | str | None = None) -> DataFrame:
    """Running SUM/MAX/MIN/COUNT of ``value`` per partition in ``order_cols``
    order (E05, E14, E21 and the building block of E16/E19/E20/C08).

    ``inclusive=False`` excludes the current row.  ``chunk`` must be
    non-decreasing in the order (e.g. the month of the order date); with it a
    hot partition is processed as many (partition, chunk) window partitions.
    """
    agg = _AGG[fn]
    v = col(value)
    frame_end = 0 if inclusive else -1
    if chunk is None:
        w = Window.partitionBy(*partition_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
        return df.withColumn(out_col, agg(v).over(w))
    d = df.withColumn("__chunk", col(chunk)).withColumn("__v", v)
    wl = Window.partitionBy(*partition_cols, "__chunk").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
    d = d.withColumn("__local", agg("__v").over(wl))
    totals = d.groupBy(*partition_cols, "__chunk").agg(agg("__v").alias("__tot"))
    wc = Window.partitionBy(*partition_cols).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    prior = totals.select(*partition_cols, "__chunk", agg("__tot").over(wc).alias("__prior"))
    out = _join_chunks(d, prior, [*partition_cols, "__chunk"])
    return (out.withColumn(out_col, _combine(fn, F.col("__prior"), F.col("__local")))
            .drop("__chunk", "__v", "__local", "__prior"))


def running_aggs(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence,
                 specs: dict, inclusive: bool = True, chunk: Column | str | None = None) -> DataFrame:
    """Several running aggregates over the same partition/order in one pass:
    ``specs`` maps output column -> (value, fn).  With ``chunk`` the local
    window, the chunk-total aggregate, the prefix window and the join are
    each done once for all outputs."""
    frame_end = 0 if inclusive else -1
    if chunk is None:
        w = Window.partitionBy(*partition_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
        return df.select("*", *[_AGG[fn](col(v)).over(w).alias(out) for out, (v, fn) in specs.items()])
    names = list(specs)
    d = df.withColumn("__chunk", col(chunk))
    for i, out in enumerate(names):
        d = d.withColumn(f"__v{i}", col(specs[out][0]))
    wl = Window.partitionBy(*partition_cols, "__chunk").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
    d = d.select("*", *[_AGG[specs[o][1]](f"__v{i}").over(wl).alias(f"__l{i}") for i, o in enumerate(names)])
    totals = d.groupBy(*partition_cols, "__chunk").agg(*[_AGG[specs[o][1]](f"__v{i}").alias(f"__t{i}")
                                                         for i, o in enumerate(names)])
    wc = Window.partitionBy(*partition_cols).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    prior = totals.select(*partition_cols, "__chunk", *[_AGG[specs[o][1]](f"__t{i}").over(wc).alias(f"__p{i}")
                                                        for i, o in enumerate(names)])
    out = _join_chunks(d, prior, [*partition_cols, "__chunk"])
    out = out.select("*", *[_combine(specs[o][1], F.col(f"__p{i}"), F.col(f"__l{i}")).alias(o) for i, o in enumerate(names)])
    return out.drop("__chunk", *[f"__{k}{i}" for i in range(len(names)) for k in ("v", "l", "p")])


def row_number_per_group(df: DataFrame, keys: Sequence[str], order_cols: Sequence, out_col: str = "line_seq",
                         chunk: Column | str | None = None) -> DataFrame:
    """Line sequence per parent (E02).  With ``chunk`` it is a chunked running
    count, so a parent with a huge number of lines is numbered by many tasks."""
    if chunk is None:
        return df.withColumn(out_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)))
    return running_agg(df, keys, order_cols, F.lit(1), out_col, "count", chunk=chunk)


def first_on_or_after(targets: DataFrame, target_col: str, candidates: DataFrame, cand_col: str,
                      out_col: str = "adjusted_date", strict: bool = False) -> DataFrame:
    """First candidate date on/after (after, when strict) each target date.

    The candidate calendar is small (one row per day) and is turned into a
    date -> next-candidate map with a reverse forward-fill over all calendar
    days, then equi-joined: no range join, no per-row search.
    """
    lo_hi = targets.agg(F.min(target_col).alias("lo"), F.max(target_col).alias("hi"))
    cands = candidates.select(F.col(cand_col).alias("__c")).distinct()
    bounds = attach_scalars(lo_hi, cands.agg(F.max("__c").alias("cmax")))
    days = bounds.select(F.explode(F.sequence(F.col("lo"), F.greatest(F.col("hi"), F.col("cmax")))).alias("__d"))
    cal = days.join(cands, days["__d"] == cands["__c"], "left")
    w = Window.orderBy(F.col("__d").desc()).rowsBetween(Window.unboundedPreceding, 0 if not strict else -1)
    nxt = cal.select("__d", F.last("__c", ignorenulls=True).over(w).alias(out_col))
    return targets.join(nxt, targets[target_col] == nxt["__d"], "left").drop("__d")


def lag_change(df: DataFrame, keys: Sequence[str], order_col: str, value: str, out_col: str = "change",
               prev_col: str | None = None) -> DataFrame:
    """value - LAG(value) by snapshot (E04, E13 with closing -> opening).

    Input is a periodic snapshot (one row per key and period), so a key's
    window holds its periods only, not its transactions."""
    w = Window.partitionBy(*keys).orderBy(order_col)
    out = df.withColumn(prev_col or f"prev_{value}", F.lag(value).over(w))
    return out.withColumn(out_col, F.col(value) - F.col(prev_col or f"prev_{value}"))


def share_of_total(df: DataFrame, parent_keys: Sequence[str], amount: str, out_col: str = "share_pct",
                   k: int = 2) -> DataFrame:
    """amount / SUM(amount) per parent as a percentage (E06).  The parent total
    is an aggregate (partially combined) joined back on the parent key."""
    tot = df.groupBy(*parent_keys).agg(F.sum(money(amount)).alias("__tot"))
    out = _join_chunks(df, tot, list(parent_keys))  # rows without a parent key share a total too
    v = F.lit(100.0) * F.col(amount).cast("double") / F.nullif(F.col("__tot").cast("double"), F.lit(0.0))
    return out.withColumn(out_col, round_half_up(v, k)).drop("__tot")


def flag_primary(df: DataFrame, parent_keys: Sequence[str], amount: str, tiebreak: Sequence[str],
                 out_col: str = "is_primary") -> DataFrame:
    """is_primary = 1 on the highest amount per parent, ties by smallest tiebreak."""
    pk = list(parent_keys)
    best = df.groupBy(*pk).agg(F.max(F.struct(F.col(amount), *[(-F.col(t)).alias(t) for t in tiebreak])).alias("__b"))
    out = _join_chunks(df, best, pk)  # rows without a parent key have a primary too
    is_best = (F.col(amount) == F.col(f"__b.{amount}"))
    for t in tiebreak:
        is_best = is_best & (-F.col(t) == F.col(f"__b.{t}"))
    return out.withColumn(out_col, F.when(is_best, 1).otherwise(0)).drop("__b")


def repeat_event_flag(df: DataFrame, keys: Sequence[str], ts_col: str, id_col: str,
                      out_col: str = "is_repeat") -> DataFrame:
    """1 when the same (party, event type) occurred before (E10): the first
    occurrence per key is an aggregate ``min(struct(ts, id))``."""
    first = df.groupBy(*keys).agg(F.min(F.struct(F.col(ts_col).alias("t"), F.col(id_col).alias("i"))).alias("__f"))
    out = df.join(first, list(keys), "left")
    is_first = (F.col(ts_col) == F.col("__f.t")) & (F.col(id_col) == F.col("__f.i"))
    return out.withColumn(out_col, F.when(is_first, 0).otherwise(1)).drop("__f")


def shifted_join(cur: DataFrame, keys: Sequence[str], period_col: str, shift_months: int, value_cols: Sequence[str],
                 prefix: str = "prior_") -> DataFrame:
    """Join each row to the same key ``shift_months`` earlier.

    Gap-aware: a missing prior period gives NULL, unlike LAG.  The prior side
    is a projection of the same frame, so its key columns are renamed before
    the equi-join (a self-join on shared attributes would be ambiguous)."""
    prev = cur.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                      F.add_months(F.col(period_col), shift_months).alias("__p"),
                      *[F.col(v).alias(prefix + v) for v in value_cols])
    cond = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)] + [F.col(period_col) == F.col("__p")]
    return cur.join(prev, cond, "left").drop(*[f"__k{i}" for i in range(len(keys))], "__p")


def percentile_rank(df: DataFrame, partition_cols: Sequence[str], score: str, out_col: str = "percentile_rank",
                    k: int = 2, step: float = 100.0) -> DataFrame:
    """100 * percent_rank() of ``score`` per partition.

    Ranks come from counts per distinct score, summed inside score ranges of
    width ``step`` (a matter of speed only) plus the totals of the lower
    ranges, so no task sorts a whole partition.
    percent_rank = (#rows with smaller score) / (n - 1).
    """
    pc = list(partition_cols)
    cnt = df.groupBy(*pc, score).agg(F.count(F.lit(1)).alias("__n"))
    below = running_agg(cnt, pc, [score], "__n", "__below", inclusive=False,
                        chunk=F.floor(F.col(score).cast("double") / step))
    totals = df.groupBy(*pc).agg(F.count(F.lit(1)).alias("__total"))
    ranks = _join_chunks(below.select(*pc, score, "__below"), totals, pc)
    out = df.join(ranks, [*pc, score], "left")
    v = F.when(F.col("__total") > 1, F.lit(100.0) * F.col("__below") / (F.col("__total") - 1)).otherwise(F.lit(0.0))
    return out.withColumn(out_col, round_half_up(v, k)).drop("__below", "__total")


def latest_as_of(df: DataFrame, keys: Sequence[str], ts_col: str, as_of, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest row on or before ``as_of`` per key (C10, E15) via ``max(struct)``."""
    from quaestor.operators.merge import latest_per_key
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return latest_per_key(df.where(F.col(ts_col) <= a), keys, [ts_col, *tiebreak])


def global_latest(df: DataFrame, date_col: str) -> DataFrame:
    """Rows at the table's max date (C11): a one-row aggregate broadcast back."""
    m = df.agg(F.max(date_col).alias("__m"))
    return df.join(F.broadcast(m), F.col(date_col) == F.col("__m")).drop("__m")


def overlap_flags(df: DataFrame, group_cols: Sequence[str], start: str, end: str, id_col: str,
                  chunk: Column | str | None = None, out_col: str = "overlaps_previous") -> DataFrame:
    """Interval overlap inside a group without pairs.

    Both ends belong to an interval and a NULL end is open: a row overlaps an
    earlier row (by start, id) iff its start is not after the running max of
    the earlier ends, or one of them is open.  Linear; no self-join.
    """
    out = prior_ends(df, group_cols, start, end, id_col, chunk)
    return (out.withColumn(out_col, F.when((F.col(start) <= F.col("max_prior_end")) | (F.col("__open") > 0), 1)
                           .otherwise(0)).drop("__open"))


def prior_ends(df: DataFrame, group_cols: Sequence[str], start: str, end: str, id_col: str,
               chunk: Column | str | None = None) -> DataFrame:
    """``max_prior_end`` and the number of open intervals (``__open``) among the
    earlier intervals of the group."""
    return running_aggs(df, group_cols, [F.col(start), F.col(id_col)],
                        {"max_prior_end": (F.col(end), "max"),
                         "__open": (F.col(end).isNull().cast("int"), "sum")}, inclusive=False, chunk=chunk)


def gaps_and_islands(df: DataFrame, keys: Sequence[str], period_index: str, cond: Column,
                     min_length: int, out_col: str = "run_length", chunk: Column | str | None = None) -> DataFrame:
    """Runs of consecutive periods meeting ``cond`` of length >= min_length.

    island id = period_index - (running count of qualifying periods)."""
    q = df.where(cond)
    q = running_agg(q, keys, [F.col(period_index)], F.lit(1), "__rc", "count", chunk=chunk)
    q = q.withColumn("__island", F.col(period_index) - F.col("__rc"))
    runs = q.groupBy(*keys, "__island").agg(F.min(period_index).alias("run_start"), F.max(period_index).alias("run_end"),
                                            F.count(F.lit(1)).alias(out_col))
    return runs.where(F.col(out_col) >= min_length).drop("__island")


def prior_period_keys(df: DataFrame, date_col: str, lower: str | None = None) -> DataFrame:
    """prior day/week/month/quarter/year date keys."""
    from quaestor.functions.dates import prior_date_key
    out = df
    for u in ("day", "week", "month", "quarter", "year"):
        out = out.withColumn(f"prior_{u}_key", prior_date_key(date_col, u, lower))
    return out


def cumulative_mtd(daily: DataFrame, date_col: str, amount: str, group: Sequence[str] = (),
                   out_col: str = "mtd_amount") -> DataFrame:
    """Running sum within month over daily sums (E05): SUM(SUM()) OVER."""
    d = daily.groupBy(*group, F.col(date_col).alias(date_col)).agg(F.sum(money(amount)).alias("daily_amount"))
    d = d.withColumn("__y", F.year(date_col)).withColumn("__m", F.month(date_col))
    out = running_agg(d, [*group, "__y", "__m"], [F.col(date_col)], "daily_amount", out_col, "sum")
    return out.drop("__y", "__m")


def year_to_date(df: DataFrame, keys: Sequence[str], period_col: str, values: Sequence[str]) -> DataFrame:
    """Year-to-date sums per key and year (E21), chunked by month."""
    out = df.withColumn("__year", F.year(period_col))
    for v in values:
        out = running_agg(out, [*keys, "__year"], [F.col(period_col)], money(v), f"ytd_{v}", "sum",
                          chunk=F.month(period_col))
    return out.drop("__year")


def link_prior_periods(periods: DataFrame, group_cols: Sequence[str], start_col: str, key_col: str) -> DataFrame:
    """prior period key (previous start in the same series), same period prior
    year (start - 12 months) (E08).  Period tables are small per series."""
    w = Window.partitionBy(*group_cols).orderBy(start_col)
    out = periods.withColumn("prior_period_key", F.lag(key_col).over(w))
    prev = periods.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group_cols)],
                          F.add_months(F.col(start_col), 12).alias("__s"),
                          F.col(key_col).alias("same_period_prior_year_key"))
    cond = [F.col(g) == F.col(f"__g{i}") for i, g in enumerate(group_cols)] + [F.col(start_col) == F.col("__s")]
    return out.join(prev, cond, "left").drop(*[f"__g{i}" for i in range(len(group_cols))], "__s")


__all__ = [n for n in dir() if not n.startswith("_")] + ["date_key"]
