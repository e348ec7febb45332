"""Writers, run log and staging housekeeping.

Targets are directories of parquet.  A merge never reads and overwrites the
same path in one plan: merged output goes to a new path (see
``operators.merge``) and the caller swaps the pointer.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaestor.functions.dates import year_month_key


def write_staging(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Truncate-and-load a staging table."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def append_staging(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append one batch (A07).  Parquet appends add files; retries of a task
    are handled by the output committer."""
    df.write.mode("append").format(fmt).save(path)
    return path


def full_refresh(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """TRUNCATE + INSERT of a warehouse table."""
    return write_staging(df, path, fmt)


def partition_by_month(df: DataFrame, date_col: str, sort_cols: Sequence[str] = (),
                       partition_col: str = "ym") -> DataFrame:
    """Layout of a month-partitioned fact (A13): a ``ym`` column, rows range
    partitioned on (ym, sort keys) so a hot month is split over several tasks
    and files come out sorted (parquet min/max stats then prune like a skip
    index)."""
    out = df.withColumn(partition_col, year_month_key(date_col))
    keys = [partition_col, *sort_cols]
    return out.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_partitioned_fact(df: DataFrame, path: str, date_col: str, sort_cols: Sequence[str] = (),
                           partition_col: str = "ym") -> str:
    (partition_by_month(df, date_col, sort_cols, partition_col)
     .write.mode("overwrite").partitionBy(partition_col).parquet(path))
    return path


def seed_allowed_values(fields: DataFrame, field_col: str = "field_code",
                        values_col: str = "allowed_values") -> DataFrame:
    """Code lists from field specifications (A15).  ``values_col`` is an array
    of structs (code, description_en, description_mt) or of strings."""
    exploded = fields.select(F.col(field_col).alias("field_code"), F.explode(values_col).alias("v"))
    vt = exploded.schema["v"].dataType
    if isinstance(vt, T.StructType):
        names = vt.fieldNames()
        return exploded.select(
            "field_code", F.col("v.code").alias("code"),
            (F.col("v.description_en") if "description_en" in names else F.lit(None).cast("string")).alias("description_en"),
            (F.col("v.description_mt") if "description_mt" in names else F.lit(None).cast("string")).alias("description_mt"),
        ).dropDuplicates(["field_code", "code"])
    return exploded.select("field_code", F.col("v").alias("code"),
                           F.lit(None).cast("string").alias("description_en"),
                           F.lit(None).cast("string").alias("description_mt")).dropDuplicates(["field_code", "code"])


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("execution_id", T.StringType()),
    T.StructField("mapping_code", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_extracted", T.LongType()),
    T.StructField("rows_validated", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("error_message", T.StringType()),
])


def run_record(spark: SparkSession, execution_id: str, mapping_code: str, started_at: _dt.datetime,
               ended_at: _dt.datetime, counts: dict, status: str = "SUCCESS",
               error: str | None = None) -> DataFrame:
    """One run-log row (A16); counts come from the job's own aggregates."""
    row = (execution_id, mapping_code, started_at, ended_at, status,
           int(counts.get("extracted", 0)), int(counts.get("validated", 0)),
           int(counts.get("rejected", 0)), int(counts.get("loaded", 0)), error)
    return spark.createDataFrame([row], RUN_LOG_SCHEMA)


def purge_staging(df: DataFrame, loaded_at_col: str, as_of, retention_days: int) -> DataFrame:
    """Rows younger than the retention window (A17); write to a new path."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), retention_days)
    return df.where(F.col(loaded_at_col).cast("date") >= cutoff)
