"""Keyed merges into a target table.

There is no MERGE-capable table format here, so a merge is a plan that
produces the *whole new table*; the caller writes it to a new path and swaps
(never reading and overwriting one path in a single plan).  Each merge costs
one shuffle of target and source on the key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols``.

    Implemented as an aggregate of ``max(struct(order, row))`` so a hot key is
    pre-combined inside every task (partial aggregation) instead of being sorted
    in one window partition.  Without ``order_cols`` the greatest full row wins,
    which is deterministic.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = list(order_cols or [])
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(c) for c in others]).alias("__row"))
    out = df.groupBy(*keys).agg(F.max(packed).alias("__m"))
    return out.select(*keys, *[F.col(f"__m.__row.{c}").alias(c) for c in others]).select(*df.columns)


def earliest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = list(order_cols or [])
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(c) for c in others]).alias("__row"))
    out = df.groupBy(*keys).agg(F.min(packed).alias("__m"))
    return out.select(*keys, *[F.col(f"__m.__row.{c}").alias(c) for c in others]).select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order_cols: Sequence[str] | None = None) -> DataFrame:
    """INSERT ... ON DUPLICATE KEY UPDATE (A08, I05 = SCD1).

    The latest source row per key replaces the target row; other target rows
    stay.  Source columns missing from the target are ignored; target columns
    missing from the source keep their target value.
    """
    keys = list(keys)
    src = latest_per_key(source.select(*[c for c in source.columns if c in target.columns]), keys, order_cols)
    missing = [c for c in target.columns if c not in src.columns]
    if missing:
        carry = target.select(*keys, *missing)
        src = src.join(carry, keys, "left")
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src.select(*target.columns))


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order_cols: Sequence[str] | None = None) -> DataFrame:
    """Insert only keys not yet present; duplicates inside the batch collapse
    to the first row in ``order_cols`` order (A09)."""
    keys = list(keys)
    src = earliest_per_key(source.select(*target.columns), keys, order_cols)
    new = src.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def update_existing(target: DataFrame, source: DataFrame, keys: Sequence[str],
                    order_cols: Sequence[str] | None = None) -> DataFrame:
    """Update matched keys only; unmatched source rows are ignored (A10)."""
    keys = list(keys)
    if not keys:
        raise ValueError("update_existing needs key columns")
    upd_cols = [c for c in source.columns if c in target.columns and c not in keys]
    src = latest_per_key(source.select(*keys, *upd_cols), keys, order_cols)
    s = src.select(*keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__s_{c}") for c in upd_cols])
    j = target.join(s, keys, "left")
    return j.select(*[F.when(F.col("__hit"), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)
                      if c in upd_cols else F.col(c) for c in target.columns])


def load_with_strategy(target: DataFrame, source: DataFrame, keys: Sequence[str] | None,
                       strategy: str = "UPSERT", order_cols: Sequence[str] | None = None) -> DataFrame:
    """Dispatch UPSERT / INSERT / UPDATE; no keys + UPSERT degrades to a plain
    INSERT (append) (A11)."""
    s = strategy.upper()
    if not keys:
        if s == "UPDATE":
            raise ValueError("UPDATE needs key columns")
        return target.unionByName(source.select(*target.columns))
    if s == "UPSERT":
        return upsert(target, source, keys, order_cols)
    if s == "INSERT":
        return insert_ignore(target, source, keys, order_cols)
    if s == "UPDATE":
        return update_existing(target, source, keys, order_cols)
    raise ValueError(strategy)


def accumulate_milestones(rows: DataFrame, load: DataFrame, keys: Sequence[str], milestones: Sequence[str],
                          loaded_at: str) -> DataFrame:
    """Accumulating snapshot (I26): ``load`` fills the milestones of the rows
    that are there and adds new ones.

    A milestone keeps its earliest date and is never emptied by a load that
    lacks it; every other column is that of the key's latest load that has a
    value in it.  Both are commutative and associative, so loads may come in any
    order and may come twice.  ``loaded_at`` (not NULL) of the result is kept
    per column in ``__at`` for later loads, so pass results on as they are.
    """
    keys, milestones = list(keys), list(milestones)
    others = [c for c in load.columns if c not in (*keys, *milestones, loaded_at, "__at")]

    def dated(df: DataFrame) -> DataFrame:
        if "__at" in df.columns:
            return df
        return df.withColumn("__at", F.struct(*[F.when(F.col(c).isNotNull(), F.col(loaded_at)).alias(c) for c in others]))

    both = dated(rows).unionByName(dated(load))
    # the latest load's value; of equal loads the greater
    best = {c: F.max(F.when(F.col(c).isNotNull(), F.struct(F.col("__at")[c].alias("at"), F.col(c).alias("v")))).alias(f"__{c}") for c in others}
    out = both.groupBy(*keys).agg(*[F.min(m).alias(m) for m in milestones], F.max(loaded_at).alias(loaded_at), *best.values())
    return out.select(*keys, *milestones, loaded_at, *[F.col(f"__{c}.v").alias(c) for c in others],
                      F.struct(*[F.col(f"__{c}.at").alias(c) for c in others]).alias("__at"))
