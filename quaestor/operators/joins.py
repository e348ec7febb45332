"""Join patterns.

Physical strategy is Catalyst/AQE's business: frames bounded by construction
(code lists, calendars, one-row aggregates) get a broadcast hint via
``keys.bounded``; frames that grow with the data are left to AQE, which
switches to a broadcast only when the runtime size is under the threshold and
splits skewed partitions of sort-merge joins.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaestor.functions.numeric import MONEY, money
from quaestor.functions.semistructured import split_codes
from quaestor.operators.keys import bounded


def join_inner(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi join (C01, C02 with how='left')."""
    return left.join(right, on, how)


def join_composite_current(fact: DataFrame, dim: DataFrame, keys: Sequence[str], current_col: str = "is_current",
                           how: str = "left") -> DataFrame:
    """Multi-column join to the current row of a versioned dimension."""
    return fact.join(dim.where(F.col(current_col) == 1).drop(current_col), list(keys), how)


def join_role_playing(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
                      attrs: Sequence[str], bounded_dim: bool = False) -> DataFrame:
    """The same dimension joined once per role (C06): ``roles`` maps fact key
    column -> output prefix; dimension attributes come out prefixed.  Set
    ``bounded_dim`` for dimensions bounded by construction (calendars,
    countries) to broadcast them."""
    out = fact
    for fk, prefix in roles.items():
        d = dim.select(F.col(dim_key).alias(f"__{prefix}k"), *[F.col(a).alias(f"{prefix}{a}") for a in attrs])
        if bounded_dim:
            d = bounded(d)
        out = out.join(d, out[fk] == d[f"__{prefix}k"], "left").drop(f"__{prefix}k")
    return out


def join_interval_membership(df: DataFrame, date_col: str, periods: DataFrame, start: str, end: str,
                             cols: Sequence[str]) -> DataFrame:
    """date BETWEEN start AND end against a small period table (C09).  The
    period table is bounded (fiscal years), so it is broadcast and the range
    condition runs inside each task."""
    p = bounded(periods.select(F.col(start).alias("__ps"), F.col(end).alias("__pe"), *cols))
    return df.join(p, (F.col(date_col) >= F.col("__ps")) & (F.col(date_col) <= F.col("__pe")), "left") \
        .drop("__ps", "__pe")


def join_growing_intervals(df: DataFrame, date_col: str, periods: DataFrame, start: str, end: str, cols: Sequence[str],
                           on: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """date BETWEEN start AND end against periods that grow with the data
    (C09): both sides are cut into bins of ``width`` days (about the mean length
    of a period by default) and joined on the bin and the columns ``on``, then
    checked exactly.  One row per match, and one with NULLs for a row without.

    Periods may overlap; a NULL end is open and reaches the last bin that
    ``df`` has, a NULL start matches nothing.  A row has one bin, so there is
    one shuffle of it, and Spark can split a bin that holds many rows.
    """
    p = periods.where(F.col(start).isNotNull()).select(*on, F.col(start).alias("__ps"), F.col(end).alias("__pe"), *cols)
    last = df.agg(F.max(date_col).alias("d")).first().d
    if last is None:  # no dates, no matches
        return df.select("*", *[F.lit(None).cast(periods.schema[c].dataType).alias(c) for c in cols])
    p = p.withColumn("__to", F.least(F.coalesce("__pe", F.lit(last)), F.lit(last))).where("__to >= __ps")
    if width is None:
        mean = p.agg(F.avg(F.datediff("__to", "__ps")).alias("w")).first().w
        width = max(1, int(mean or 0) + 1)

    def bin_of(c):
        return F.floor(F.unix_date(c) / F.lit(width)).cast("long")

    cut = p.withColumn("__bin", F.explode(F.sequence(bin_of(F.col("__ps")), bin_of(F.col("__to"))))).drop("__to")
    cut = cut.withColumnsRenamed({c: f"__on{i}" for i, c in enumerate(on)}).hint("merge")
    rows = df.withColumn("__row_bin", bin_of(F.col(date_col).cast("date")))
    cond = [F.col("__row_bin") == F.col("__bin"), F.col(date_col) >= F.col("__ps"),
            F.col("__pe").isNull() | (F.col(date_col) <= F.col("__pe")), *[F.col(c) == F.col(f"__on{i}") for i, c in enumerate(on)]]
    return rows.join(cut, cond, "left").drop("__bin", "__row_bin", "__ps", "__pe", *[f"__on{i}" for i in range(len(on))])


def join_semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """EXISTS (C12)."""
    return left.join(right, on, "left_semi")


def join_anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """NOT EXISTS / LEFT JOIN ... IS NULL (C13); free of the NOT IN NULL trap."""
    return left.join(right, on, "left_anti")


def join_anti_array(df: DataFrame, codes_col: str, id_col: str, ref: DataFrame, ref_code: str,
                    ref_owner: str | None = None, sep: str = ",") -> DataFrame:
    """Rows whose comma-separated codes include one with no matching reference
    row (C14): explode + anti join, returning the offending (row, code)."""
    ex = df.select(F.col(id_col), F.explode(split_codes(codes_col, sep)).alias("code"))
    r = ref.select(F.col(ref_code).alias("code"), *([F.col(ref_owner).alias(id_col)] if ref_owner else [])).distinct()
    on = ["code", id_col] if ref_owner else ["code"]
    return ex.join(r, on, "left_anti")


def expand_config(df: DataFrame, values: Sequence[Mapping[str, object]], name: str = "cfg") -> DataFrame:
    """Row x configuration list (C15, e.g. date x country, account x open
    year): the list is configuration, expanded by ``explode`` of a literal
    array inside each task, never a cross join of two tables."""
    arr = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in values])
    keys = list(values[0].keys()) if values else []
    return df.withColumn(f"__{name}", F.explode(arr)).select("*", *[F.col(f"__{name}.{k}").alias(k) for k in keys]) \
        .drop(f"__{name}")


def join_coalesced_key(fact: DataFrame, dim: DataFrame, fact_cols: Sequence[str], dim_key: str, how: str = "left") -> DataFrame:
    """Join on COALESCE(a, b)."""
    return fact.withColumn("__ck", F.coalesce(*[F.col(c) for c in fact_cols])) \
        .join(dim, F.col("__ck") == dim[dim_key], how).drop("__ck")


def join_null_safe(left: DataFrame, right: DataFrame, pairs: Mapping[str, str], how: str = "left") -> DataFrame:
    """Null-safe equality join (C16): NULL matches NULL."""
    cond = None
    for lc, rc in pairs.items():
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


def join_universal_or_specific(df: DataFrame, ref: DataFrame, keys: Sequence[str], country_col: str,
                               ref_country_col: str | None = None) -> DataFrame:
    """``a.country = r.country OR r.country IS NULL`` (C17) as two equi joins
    and a union, so neither side becomes a nested loop."""
    rc = ref_country_col or country_col
    spec = ref.where(F.col(rc).isNotNull())
    univ = ref.where(F.col(rc).isNull()).drop(rc)
    a = df.join(spec.withColumnRenamed(rc, country_col) if rc != country_col else spec, [*keys, country_col])
    b = df.join(univ, list(keys))
    return a.unionByName(b, allowMissingColumns=True)


def scalar_subquery_filter(df: DataFrame, col: str, dim: DataFrame, dim_code_col: str, code: str,
                           dim_key: str) -> DataFrame:
    """``col = (SELECT key FROM dim WHERE code = ..)`` (C18): broadcast of the
    one-row result."""
    k = dim.where(F.col(dim_code_col) == code).select(F.col(dim_key).alias("__k"))
    return df.join(F.broadcast(k), F.col(col) == F.col("__k"), "left_semi")


def correlated_aggregate(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                         aggs: Mapping[str, Column], zero_fill: Sequence[str] = ()) -> DataFrame:
    """Per-row COUNT/SUM/MIN over a child table (C19, D14): pre-aggregate the
    child on its key (partial aggregation), left join, COALESCE(.., 0)."""
    ca = child.groupBy(F.col(child_key).alias("__ck")).agg(*[v.alias(k) for k, v in aggs.items()])
    out = parent.join(ca, parent[parent_key] == ca["__ck"], "left").drop("__ck")
    for c in zero_fill:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out


def line_total(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, value: str,
               out_col: str = "line_total") -> DataFrame:
    """COALESCE(SUM(child numeric), 0) per parent."""
    return correlated_aggregate(parent, child, parent_key, child_key,
                                {out_col: F.coalesce(F.sum(money(value)), F.lit(0).cast(MONEY))}, [out_col])


# ---- set operations (G01-G05) --------------------------------------------

def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """UNION (G02)."""
    return union_all(*dfs).distinct()


def unpivot_amounts(df: DataFrame, id_cols: Sequence[str], amount_cols: Mapping[str, str],
                    key_name: str = "account_type", value_name: str = "amount") -> DataFrame:
    """Wide amount columns -> one row per non-null positive amount with its
    code (G03)."""
    arr = F.array(*[F.struct(F.lit(code).alias(key_name), money(c).alias(value_name))
                    for c, code in amount_cols.items()])
    return (df.select(*id_cols, F.explode(arr).alias("__u"))
            .select(*id_cols, f"__u.{key_name}", f"__u.{value_name}")
            .where(F.col(value_name).isNotNull() & (F.col(value_name) > 0)))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SELECT DISTINCT."""
    return df.select(*cols).distinct()


def union_sources(sources: Mapping[str, DataFrame], tag_col: str = "source_type") -> DataFrame:
    """One frame from several sources with a type tag."""
    out = None
    for tag, d in sources.items():
        t = d.withColumn(tag_col, F.lit(tag))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out
