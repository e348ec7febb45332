"""Surrogate keys and dimension-key resolution.

``sequential_key`` numbers rows 1..n in a total order without funnelling
the table through one task: rows are range-partitioned on the order
columns, numbered inside each partition, and shifted by the running total of
the partition sizes (a table with one row per partition).  The numbered rows
are checkpointed before the sizes are taken.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaestor.functions.hashing import surrogate_hash
from quaestor.session import checkpoint_dir


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast hint for a frame whose size is bounded by construction
    (code lists, calendars, band tables, one row per partition).  Frames that
    grow with the data are left to AQE and ``autoBroadcastJoinThreshold``."""
    return F.broadcast(df)


def sequential_key(df: DataFrame, order_cols: Sequence[str], key_col: str = "key",
                   offset: int | Column = 0) -> DataFrame:
    """Dense 1-based position in ``order_cols`` order plus ``offset``.

    ``order_cols`` must be unique for a deterministic result.  ``offset`` may
    be a Column from a one-row frame joined in beforehand (e.g. max key).

    Rows are ranged and numbered once; a reliable checkpoint in the shared
    folder holds them with the number of their range, so the range sizes and
    the rows come from the same layout whatever is re-planned or recomputed.
    """
    off = F.lit(offset) if isinstance(offset, int) else offset
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__rn", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("__pid").cast("long"), 33) + 1)
              .checkpoint())
    sizes = ranged.groupBy("__pid").agg(F.max("__rn").alias("__n"))
    starts = sizes.select(
        "__pid",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__start"))
    return (ranged.join(bounded(starts), "__pid")  # one row a range
            .withColumn(key_col, (F.col("__start") + F.col("__rn") + off).cast("long"))
            .drop("__pid", "__rn", "__start"))


def hashed_key(df: DataFrame, cols: Sequence[str], key_col: str = "key", kind: str = "md5") -> DataFrame:
    """Stateless surrogate key from the natural key (fact tables at scale)."""
    k = surrogate_hash(*cols) if kind == "md5" else F.xxhash64(*[F.col(c) for c in cols])
    return df.withColumn(key_col, k)


def resolve_dimension_key(fact: DataFrame, dim: DataFrame, on: dict, key_col: str, alias: str | None = None,
                          on_missing: str = "drop", unknown_key: int = -1,
                          broadcast_dim: bool = False) -> DataFrame:
    """Natural key -> surrogate key.

    ``on`` maps fact columns to dimension columns.  Rows without a match, or
    whose matched key is 0/NULL, are dropped (``on_missing='drop'``), given
    ``unknown_key`` (``'unknown'``), or kept with NULL (``'null'``).
    """
    alias = alias or key_col
    d = dim.select(*[F.col(dc).alias(f"__d_{i}") for i, dc in enumerate(on.values())],
                   F.col(key_col).alias(alias))
    if broadcast_dim:
        d = bounded(d)
    cond = [fact[fc] == d[f"__d_{i}"] for i, fc in enumerate(on.keys())]
    how = "inner" if on_missing == "drop" else "left"
    out = fact.join(d, cond, how).drop(*[f"__d_{i}" for i in range(len(on))])
    bad = F.col(alias).isNull() | (F.col(alias) == 0)
    if on_missing == "drop":
        return out.where(~bad)
    if on_missing == "unknown":
        return out.withColumn(alias, F.when(bad, F.lit(unknown_key)).otherwise(F.col(alias)))
    return out.withColumn(alias, F.when(~bad, F.col(alias)))


def unresolved_rows(fact: DataFrame, dim: DataFrame, on: dict, key_col: str,
                    broadcast_dim: bool = False) -> DataFrame:
    """Rows that ``resolve_dimension_key(on_missing='drop')`` removes, kept as
    a DQ output."""
    d = dim.where(F.col(key_col).isNotNull() & (F.col(key_col) != 0)).select(
        *[F.col(dc).alias(f"__d_{i}") for i, dc in enumerate(on.values())])
    if broadcast_dim:
        d = bounded(d)
    cond = [fact[fc] == d[f"__d_{i}"] for i, fc in enumerate(on.keys())]
    return fact.join(d, cond, "left_anti")


def resolve_optional_key(df: DataFrame, key_col: str, default_col: str | None = None) -> DataFrame:
    """Nullable role-played key: missing -> NULL, or -> the primary key."""
    k = F.col(key_col)
    k = F.when(k.isNotNull() & (k != 0), k)
    if default_col:
        k = F.coalesce(k, F.col(default_col))
    return df.withColumn(key_col, k)


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (max key, date bounds, totals)
    to every row: a broadcast of exactly one row, evaluated inside each task."""
    return df.join(F.broadcast(one_row), how="inner")
