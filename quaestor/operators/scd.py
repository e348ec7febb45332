"""Slowly changing dimension type 2 (I04) and version helpers.

The merge is one full-outer join of current rows against the incoming
snapshot on the natural key; every joined row emits 0, 1 or 2 output rows
(kept / expired + new version / new member) through one ``explode``, so the
whole merge is a single shuffle.  New surrogate keys continue after the
current maximum, numbered in natural-key order without a global sort.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaestor.operators.keys import attach_scalars, sequential_key

OPEN_END = None  # valid_to of a current version is NULL (open)


def scd2_merge(current: DataFrame, incoming: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               as_of: str, key_col: str = "surrogate_key", valid_from: str = "valid_from",
               valid_to: str = "valid_to", is_current: str = "is_current",
               version: str = "version_number") -> DataFrame:
    """SCD type 2 merge (I04): the full new dimension after applying
    ``incoming`` as of ``as_of``.

    * new natural key -> version 1, valid from as_of
    * tracked attributes changed -> old version closed (is_current 0,
      valid_to as_of) and a new version (version + 1) opened
    * unchanged (column by column, NULL equal to NULL), or absent from the
      snapshot -> row kept as is
    * historical (closed) rows -> kept as is
    """
    keys = list(keys)
    attrs = [c for c in incoming.columns if c not in keys]
    meta = [key_col, valid_from, valid_to, is_current, version]
    dim_cols = current.columns
    asof = F.lit(as_of).cast("date")

    hist = current.where(F.col(is_current) != 1)
    cur = current.where(F.col(is_current) == 1)

    c = cur.select(*keys, F.struct(*[F.col(x) for x in dim_cols]).alias("__c"))
    # one incoming row a key: of several, the largest by its attributes
    i = incoming.groupBy(*keys).agg(F.max(F.struct(*[F.col(x) for x in attrs])).alias("__i"))
    j = c.join(i, keys, "full_outer")

    def row(kind: str):
        if kind == "keep":
            vals = {x: F.col(f"__c.{x}") for x in dim_cols}
            vals["__new"] = F.lit(False)
        elif kind == "expire":
            vals = {x: F.col(f"__c.{x}") for x in dim_cols}
            vals[is_current] = F.lit(0)
            vals[valid_to] = asof
            vals["__new"] = F.lit(False)
        else:  # new version or new member
            vals = {x: F.col(f"__c.{x}") for x in dim_cols}
            for k in keys:
                vals[k] = F.col(k)
            for a in attrs:
                vals[a] = F.col(f"__i.{a}")
            vals[key_col] = F.lit(None)
            vals[valid_from] = asof
            vals[valid_to] = F.lit(OPEN_END)
            vals[is_current] = F.lit(1)
            vals[version] = F.coalesce(F.col(f"__c.{version}") + 1, F.lit(1))
            vals["__new"] = F.lit(True)
        return F.struct(*[vals[x].cast(current.schema[x].dataType).alias(x) for x in dim_cols],
                        vals["__new"].alias("__new"))

    has_c, has_i = F.col("__c").isNotNull(), F.col("__i").isNotNull()
    same = F.lit(True)
    for x in tracked:
        same = same & F.col(f"__c.{x}").eqNullSafe(F.col(f"__i.{x}"))
    changed = has_c & has_i & ~same
    emitted = (F.when(changed, F.array(row("expire"), row("new")))
               .when(has_c, F.array(row("keep")))
               .otherwise(F.array(row("new"))))
    out = j.select(F.explode(emitted).alias("r")).select("r.*")

    kept = out.where(~F.col("__new")).drop("__new")
    fresh = out.where(F.col("__new")).drop("__new", key_col)
    max_key = current.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("__max"))
    fresh = sequential_key(attach_scalars(fresh, max_key), keys, key_col, offset=F.col("__max"))
    fresh = fresh.drop("__max").withColumn(key_col, F.col(key_col).cast(current.schema[key_col].dataType))
    return hist.unionByName(kept).unionByName(fresh.select(*dim_cols))


def initial_scd2(incoming: DataFrame, keys: Sequence[str], as_of: str, key_col: str = "surrogate_key",
                 start_key: int = 0) -> DataFrame:
    """First SCD2 load (I04): every row version 1, current, open ended."""
    out = (incoming.withColumn("valid_from", F.lit(as_of).cast("date"))
           .withColumn("valid_to", F.lit(None).cast("date"))
           .withColumn("is_current", F.lit(1))
           .withColumn("version_number", F.lit(1)))
    return sequential_key(out, keys, key_col, offset=start_key)


def point_in_time(dim: DataFrame, on_date, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Version valid on a date: valid_from <= d AND (valid_to IS NULL OR valid_to > d)."""
    d = F.lit(on_date).cast("date") if isinstance(on_date, str) else on_date
    return dim.where((F.col(valid_from) <= d) & (F.col(valid_to).isNull() | (F.col(valid_to) > d)))
