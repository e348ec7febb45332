"""Declarative column mapping.

A mapping configuration becomes one ``select`` (plus left joins for table
lookups), so Catalyst sees the whole ingestion transform and prunes/pushes
through it.  Cast failures are not silently kept: the target gets NULL and
the row carries an ``_errors`` entry (B12), which the DQ split routes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaestor.functions.hashing import row_identifier, surrogate_hash
from quaestor.functions.strings import clean_identifier
from quaestor.functions.dates import standardize_date
from quaestor.operators.keys import bounded

ERROR_T = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("value", T.StringType()),
                        T.StructField("message", T.StringType())])

# Named column functions for transformation type FUNCTION (K01).  Users add
# their own with ``register_transform``.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "clean_identifier": clean_identifier,
    "upper_trim": lambda c: F.upper(F.trim(c)),
    "lower_trim": lambda c: F.lower(F.trim(c)),
    "blank_to_null": lambda c: F.when(F.trim(c) != "", c),
}


def register_transform(name: str, fn: Callable[[Column], Column]) -> None:
    """Register a Column -> Column function usable as transformation FUNCTION."""
    TRANSFORMS[name] = fn


@dataclass
class ColumnMapping:
    source_column: str | None
    target_column: str
    transformation_type: str = "DIRECT"
    expression: str | None = None
    lookup: Mapping[str, str] | None = None
    fallback: str | None = None
    lookup_table: str | None = None
    lookup_key: str | None = None
    lookup_value: str | None = None
    function: str | None = None
    default: object = None
    data_type: str | None = None
    is_key: bool = False


def _mk(m) -> ColumnMapping:
    return m if isinstance(m, ColumnMapping) else ColumnMapping(**m)


def cast_to_type(c: Column, data_type: str | None) -> Column:
    """Target typing (B09) with ``try_cast``: a failed cast gives NULL."""
    if not data_type:
        return c
    t = data_type.upper().split("(")[0].strip()
    if t in ("INT", "INTEGER", "SMALLINT", "TINYINT"):
        return c.try_cast("int")
    if t in ("BIGINT", "LONG"):
        return c.try_cast("bigint")
    if t in ("FLOAT", "DOUBLE", "REAL"):
        return c.try_cast("double")
    if t in ("DECIMAL", "NUMERIC", "CURRENCY", "MONEY"):
        return c.try_cast(T.DecimalType(19, 2))
    if t in ("PERCENTAGE",):
        return c.try_cast(T.DecimalType(5, 2))
    if t in ("DATE",):
        return F.coalesce(c.try_cast("date"), F.try_to_date(c.cast("string")))
    if t in ("DATETIME", "TIMESTAMP"):
        return c.try_cast("timestamp")
    if t in ("BOOLEAN", "BOOL", "BIT"):
        s = F.upper(F.trim(c.cast("string")))
        return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(s.isin("TRUE", "1", "Y", "YES"))
    return c.cast("string")


def map_lookup(c: Column, mapping: Mapping[str, str], fallback: str | None = None) -> Column:
    """Inline code map (B04): NULL stays NULL, unmatched -> fallback (or NULL)."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    hit = F.element_at(m, c.cast("string")) if mapping else F.lit(None).cast("string")
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(hit, F.lit(fallback).cast("string")))


def apply_mapping(df: DataFrame, mappings: Sequence, lookup_tables: Mapping[str, DataFrame] | None = None,
                  bounded_lookups: Sequence[str] = (), track_errors: bool = True, passthrough: Sequence[str] = ()) -> DataFrame:
    """Source rows -> target columns.

    Order per column: transformation - DIRECT (B02), EXPRESSION over
    ``{source_column}`` (B03), LOOKUP inline map (B04), LOOKUP_TABLE (B05)
    and LOOKUP_QUERY (B06) as left joins to a lookup frame, FUNCTION from the
    registry (B07, K01); unknown types fall back to DIRECT - then default
    when NULL (B08), then cast (B09).  Output: mapped
    target columns (B10), ``passthrough`` columns and ``_errors``.

    Only lookup tables named in ``bounded_lookups`` (code lists, reference
    tables) are broadcast; key-resolution lookups against tables that grow
    with the data (e.g. TIN -> party) are left to AQE.
    """
    ms = [_mk(m) for m in mappings]
    src = df
    for i, m in enumerate(ms):
        tt = m.transformation_type.upper()
        if tt in ("LOOKUP_TABLE", "LOOKUP_QUERY") and lookup_tables and m.lookup_table in lookup_tables:
            lk = lookup_tables[m.lookup_table].select(F.col(m.lookup_key).alias(f"__lk{i}"),
                                                      F.col(m.lookup_value).alias(f"__lv{i}"))
            lk = lk.dropDuplicates([f"__lk{i}"])
            if m.lookup_table in bounded_lookups:
                lk = bounded(lk)
            src = src.join(lk, F.col(m.source_column) == F.col(f"__lk{i}"), "left")
    outs, errs = [], []
    for i, m in enumerate(ms):
        tt = m.transformation_type.upper()
        s = F.col(m.source_column) if m.source_column else F.lit(None)
        if tt == "EXPRESSION" and m.expression:
            c = F.expr(m.expression.replace("{source_column}", f"`{m.source_column}`"))
        elif tt == "LOOKUP" and m.lookup is not None:
            c = map_lookup(s, m.lookup, m.fallback)
        elif tt in ("LOOKUP_TABLE", "LOOKUP_QUERY") and lookup_tables and m.lookup_table in lookup_tables:
            c = F.col(f"__lv{i}")
            if m.fallback is not None:
                c = F.when(s.isNotNull(), F.coalesce(c, F.lit(m.fallback)))
        elif tt == "FUNCTION" and m.function in TRANSFORMS:
            c = TRANSFORMS[m.function](s)
        else:
            c = s
        if m.default not in (None, "", 0, False):
            c = F.coalesce(c, F.lit(m.default))
        typed = cast_to_type(c, m.data_type)
        outs.append(typed.alias(m.target_column))
        if track_errors and m.data_type:
            errs.append(F.when(c.isNotNull() & typed.isNull(),
                               F.struct(F.lit(m.target_column).alias("column_name"), c.cast("string").alias("value"),
                                        F.lit(f"cannot cast to {m.data_type}").alias("message"))))
    cols = [F.col(p) for p in passthrough] + outs
    if track_errors:
        cols.append(F.filter(F.array(*errs), lambda e: e.isNotNull()).alias("_errors") if errs
                    else F.lit(None).cast(T.ArrayType(ERROR_T)).alias("_errors"))
    return src.select(*cols)


def error_rows(mapped: DataFrame) -> DataFrame:
    """Rows whose transform failed."""
    return mapped.where(F.size(F.coalesce(F.col("_errors"), F.array())) > 0)


def good_rows(mapped: DataFrame) -> DataFrame:
    return mapped.where(F.size(F.coalesce(F.col("_errors"), F.array())) == 0).drop("_errors")


def with_row_identifier(df: DataFrame, key_cols: Sequence[str] | None = None, out_col: str = "_row_id") -> DataFrame:
    """Row id = key columns joined by ':' (fallback: first three columns)."""
    keys = list(key_cols) if key_cols else df.columns[:3]
    return df.withColumn(out_col, row_identifier(*keys))


def stage_incremental(df: DataFrame, ts_col: str, watermark, mappings: Sequence, key_cols: Sequence[str],
                      source_database: str, source_table: str, loaded_at) -> DataFrame:
    """Staging model (B14): rows newer than the staged watermark (default
    1900-01-01), cast + rename, md5 surrogate key over up to three key
    columns, NULL-key filter, source metadata columns."""
    wm = F.lit(watermark or "1900-01-01").cast("timestamp")
    src = df.where(F.col(ts_col) > wm).where(F.col(key_cols[0]).isNotNull())
    mapped = apply_mapping(src, mappings, track_errors=False, passthrough=[ts_col])
    keys = [_mk(m).target_column for m in mappings if _mk(m).source_column in key_cols][:3] or list(key_cols)[:3]
    return (mapped.withColumn("_surrogate_key", surrogate_hash(*keys))
            .withColumn("_loaded_at", F.lit(loaded_at).cast("timestamp"))
            .withColumn("_source_database", F.lit(source_database))
            .withColumn("_source_table", F.lit(source_table)))


def transform_by_data_type(df: DataFrame, fields: Sequence[tuple[str, str]], as_of, record_key: Sequence[str] = (),
                           audit_ts=None) -> DataFrame:
    """Intermediate model (B15): per declared data type TIN clean, STRING
    trim, DATE standardise, CODE upper-trim, EMAIL lower-trim, numeric NULL ->
    0, BOOLEAN NULL -> false; record key and audit column."""
    outs = []
    for name, dt in fields:
        t = dt.upper()
        c = F.col(name)
        if t == "TIN":
            e = clean_identifier(c)
        elif t in ("STRING", "TEXT"):
            e = F.trim(c)
        elif t in ("DATE", "DATETIME"):
            e = standardize_date(c, as_of)
        elif t == "CODE":
            e = F.upper(F.trim(c))
        elif t == "EMAIL":
            e = F.lower(F.trim(c))
        elif t in ("DECIMAL", "CURRENCY", "INTEGER", "PERCENTAGE"):
            e = F.coalesce(c, F.lit(0))
        elif t == "BOOLEAN":
            e = F.coalesce(c.cast("boolean"), F.lit(False))
        else:
            e = c
        outs.append(e.alias(name))
    out = df.select(*outs)
    if record_key:
        out = out.withColumn("_record_key", surrogate_hash(*record_key))
    return out.withColumn("_transformed_at", F.lit(audit_ts or as_of).cast("timestamp"))


def incremental_filter_lookback(df: DataFrame, ts_col: str, watermark, lookback_hours: int = 24) -> DataFrame:
    """ts > watermark - lookback (B16); idempotent with a keyed merge."""
    wm = F.coalesce(F.lit(watermark).cast("timestamp"), F.lit("1900-01-01").cast("timestamp"))
    return df.where(F.col(ts_col) > wm - F.expr(f"INTERVAL {int(lookback_hours)} HOURS"))


def map_status_code(df: DataFrame, column: str, seed: DataFrame, source_col: str = "source_code",
                    target_col: str = "target_code", out_col: str | None = None) -> DataFrame:
    """Seed-table code mapping, unmatched -> 'UNKNOWN' (B17).  Seeds are code
    lists (bounded) and are broadcast."""
    s = bounded(seed.select(F.col(source_col).alias("__sc"), F.col(target_col).alias("__tc")).dropDuplicates(["__sc"]))
    out = df.join(s, F.col(column) == F.col("__sc"), "left")
    return out.withColumn(out_col or column, F.coalesce(F.col("__tc"), F.lit("UNKNOWN"))).drop("__sc", "__tc")
