"""Running values over range cuts: skew-safe without calendars.

``cut`` sorts rows by (keys, order) into ranges of about equal size and writes
them once to the shared checkpoint folder, each row with the number of its
range.  A key may stand in many ranges, so one that holds a third of the rows is
a third of the ranges, whatever its dates are.  Running values are computed
inside (key, range) and what earlier ranges of the same key add is carried in.
A range begins with at most one key that the range before it ended with, so the
carried values are at most one row a range: bounded, hence broadcast.

Behind E16, E19, M40 (allocation), C10 (as-of join), I14 (timeline merge) and
I30 (aging sweep).
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaestor.operators.keys import bounded
from quaestor.session import checkpoint_dir

PART, AT = "__part", "__at"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def largest_key(rows: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the key that has most."""
    return rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def cut(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """``df`` with range number ``__part`` and place ``__at`` (both grow with
    keys and order).  ``order`` must make the rows of a key distinct where later
    results depend on their order."""
    by = [*[F.col(k) for k in keys], *[F.col(c) if isinstance(c, str) else c for c in order]]
    return written(df.repartitionByRange(*by).sortWithinPartitions(*by)
                   .withColumn(AT, F.monotonically_increasing_id())
                   .withColumn(PART, F.shiftright(AT, 33).cast("int")))


def _carried(rows: DataFrame, keys: Sequence[str], totals: Mapping[str, Column], over) -> DataFrame:
    """Per key and range, what the key's earlier ranges add; only for ranges
    that a key continues in, one row a range."""
    names = list(totals)
    t = rows.groupBy(*keys, PART).agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    first = F.min(PART).over(Window.partitionBy(*keys))
    return (t.select(*keys, PART, *[over(n).over(before).alias(n) for n in names], first.alias("__first"))
            .where(F.col(PART) > F.col("__first"))
            .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(PART).alias("__kp"), *names))


def _with_carried(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] + [F.col(PART) == F.col("__kp")]
    return rows.join(bounded(carried), on, "left").drop("__kp", *[f"__k{i}" for i in range(len(keys))])


def running_sums(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, Column | str]) -> DataFrame:
    """Inclusive running sums per key of rows that ``cut`` made: output column
    -> value.  ``keys`` may be finer than those of the cut if rows that share
    them are neighbours."""
    local = Window.partitionBy(*keys, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    value = {n: (F.col(v) if isinstance(v, str) else v) for n, v in sums.items()}
    carried = _carried(rows, keys, {f"__c_{n}": F.sum(v) for n, v in value.items()}, F.sum)
    out = _with_carried(rows.select("*", *[F.sum(v).over(local).alias(f"__l_{n}") for n, v in value.items()]), carried, keys)
    return (out.select("*", *[(F.coalesce(F.col(f"__l_{n}"), F.lit(0)) + F.coalesce(F.col(f"__c_{n}"), F.lit(0))).alias(n) for n in sums])
            .drop(*[f"__{k}_{n}" for n in sums for k in "lc"]))


def filled(rows: DataFrame, keys: Sequence[str], values: Mapping[str, Column | str], inclusive: bool = True) -> DataFrame:
    """The last non-null value per key up to each row (or before it): output
    column -> value, for rows that ``cut`` made."""
    local = Window.partitionBy(*keys, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    value = {n: (F.col(v) if isinstance(v, str) else v) for n, v in values.items()}
    latest = {f"__c_{n}": F.max_by(v, F.when(v.isNotNull(), F.col(AT))) for n, v in value.items()}
    carried = _carried(rows, keys, latest, lambda n: F.last(n, ignorenulls=True))
    out = _with_carried(rows.select("*", *[F.last(v, ignorenulls=True).over(local).alias(f"__l_{n}") for n, v in value.items()]),
                        carried, keys)
    return (out.select("*", *[F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}")).alias(n) for n in values])
            .drop(*[f"__{k}_{n}" for n in values for k in "lc"]))


def join_as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str, cols: Sequence[str],
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Each row of ``left`` with ``cols`` of the key's latest ``right`` row on or
    before the row's own date (C10); NULL where there is none.

    Both sides are one sequence of dates per key and the right rows are filled
    forward, so there is no range join; equal dates are ordered by
    ``tiebreak``, the last one counts.  Rows with a NULL date match nothing.
    """
    none = [F.lit(None).cast(right.schema[c].dataType).alias(f"__t{i}") for i, c in enumerate(tiebreak)]
    told = right.where(F.col(right_date).isNotNull()).select(
        *keys, F.col(right_date).alias("__date"), F.lit(0).alias("__kind"), *[F.col(c).alias(f"__t{i}") for i, c in enumerate(tiebreak)],
        F.struct(*cols).alias("__right"))
    asked = left.select(*keys, F.col(left_date).alias("__date"), F.lit(1).alias("__kind"), *none,
                        F.struct(*[F.col(c) for c in left.columns]).alias("__left"))
    rows = cut(told.unionByName(asked, allowMissingColumns=True), keys,
               ["__date", "__kind", *[f"__t{i}" for i in range(len(tiebreak))]])
    out = filled(rows, keys, {"__found": "__right"}).where("__kind = 1")
    found = F.when(F.col("__date").isNotNull(), F.col("__found"))
    return out.select(*[F.col("__left")[c].alias(c) for c in left.columns], *[found[c].alias(c) for c in cols])


def merge_timelines(sources: Mapping[str, DataFrame], keys: Sequence[str], start: str, end: str,
                    values: Mapping[str, Sequence[str]], tiebreak: Sequence[str] = (), hot_rows: int = 1_000_000) -> DataFrame:
    """One history of versions from several histories of the same keys.

    sources: name -> frame with keys, ``start``, ``end`` (last valid day, NULL =
    open) and the columns ``values[name]``.  At any day a source says what its
    record with the latest start on or before that day says, while that is
    valid (equal starts: the last by ``tiebreak``, then by values).  The
    timeline is cut at every start and the day after every end, records are
    carried forward over the cuts, and neighbours that say the same are one
    version.  Days on which no source has a valid record belong to no version.
    While no key has more than ``hot_rows`` starts and ends, all this is windows
    over one shuffle by key; else days and states are cut into ranges.

    Returns keys, version_no, valid_from, valid_to (NULL = open), the value
    columns, and has_<source> 0/1.  Records with a NULL start take no part, nor
    those that end before they start.
    """
    names = list(sources)
    parts = []
    for name in names:
        s = sources[name].where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start))))
        record = F.struct(F.col(start).alias("s"), F.array(*[F.col(c).cast("string") for c in tiebreak]).alias("t"),
                          F.struct(*values[name]).alias("v"), F.col(end).alias("e"))
        parts.append(s.select(*keys, F.col(start).alias("__date"), record.alias(f"__r_{name}")))
        parts.append(s.where(F.col(end).isNotNull()).select(*keys, F.date_add(end, 1).alias("__date")))  # the marks of all ends
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    rows = written(rows)  # the sources are read once, whatever looks at their rows again
    hot = largest_key(rows, keys) > hot_rows
    if not hot:
        rows = rows.repartition(*keys)
    # one row a day on which anything starts or ends; the latest of equal starts
    days = rows.groupBy(*keys, "__date").agg(*[F.max(f"__r_{n}").alias(f"__r_{n}") for n in names])
    now = [F.when(F.col(f"__s_{n}.e").isNull() | (F.col(f"__s_{n}.e") >= F.col("__date")), F.col(f"__s_{n}.v")).alias(n) for n in names]
    some = reduce(or_, [F.col("__state")[n].isNotNull() for n in names])
    shown = lambda df: df.select(
        *keys, F.col("version_no").cast("int").alias("version_no"), F.col("__date").alias("valid_from"), "valid_to",
        *[F.col("__state")[n][c].alias(c) for n in names for c in values[n]],
        *[F.col("__state")[n].isNotNull().cast("int").alias(f"has_{n}") for n in names])
    if not hot:  # a key fits a task: one shuffle serves all steps
        by_date = Window.partitionBy(*keys).orderBy("__date")
        upto = by_date.rowsBetween(Window.unboundedPreceding, 0)
        at = days.select(*keys, "__date", *[F.last(f"__r_{n}", ignorenulls=True).over(upto).alias(f"__s_{n}") for n in names])
        moved = at.select(*keys, "__date", F.struct(*now).alias("__state")).withColumn("__before", F.lag("__state").over(by_date))
        changes = moved.where("__before is null or not (__state <=> __before)").drop("__before")
        return shown(changes.select("*", F.sum(some.cast("int")).over(upto).alias("version_no"),
                                    F.date_sub(F.lead("__date").over(by_date), 1).alias("valid_to")).where(some))
    at = filled(cut(days, keys, ["__date"]), keys, {f"__s_{n}": f"__r_{n}" for n in names})
    state = written(at.select(*keys, "__date", AT, PART, F.struct(*now).alias("__state")))
    moved = filled(state, keys, {"__before": "__state"}, inclusive=False)
    changes = moved.where("__before is null or not (__state <=> __before)")
    # gaps are changes too, but no versions
    numbered = written(running_sums(changes, keys, {"__n": F.lit(1), "version_no": some.cast("int")})
                       .select(*keys, "__date", "__state", "__n", "version_no"))
    after = numbered.select(*[F.col(k).alias(f"__a{i}") for i, k in enumerate(keys)], (F.col("__n") - 1).alias("__an"),
                            F.date_sub("__date", 1).alias("valid_to"))
    on = [F.col(k).eqNullSafe(F.col(f"__a{i}")) for i, k in enumerate(keys)] + [F.col("__n") == F.col("__an")]
    return shown(numbered.where(some).join(after, on, "left"))
