"""Structured Streaming forms of the incremental loads.

The reference is batch-incremental ("rows with modified_timestamp > max
loaded, merged on key").  Here each load is a streaming query over a file
source with a checkpoint in the shared ``spark.checkpoint.dir``:

* J01 ``incremental_upsert_stream``: ``readStream`` -> ``foreachBatch``
  keyed upsert (A08), each batch into a path of its own.
* J02 ``late_lookback``: event-time watermark + ``dropDuplicatesWithinWatermark``.
* J03 ``running_summary_stream``: per-key count/sum/max partial states
  written per micro-batch, merged on read (mergeable states, D15).
* J04 ``monthly_rollup_stream``: daily sums appended once the watermark
  passes the day, added up by calendar month on reading.
* J05 daily flag refresh: ``plans.calendar.refresh_relative_flags``.
* J06 ``freshness_check``: hours since the last load, banded OK/WARN/ERROR.

``availableNow`` processes everything present and stops, which is how the
nightly window runs it; the same code runs continuously with a processing
time trigger.
"""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.operators.aggregates import merge_states, partial_state
from quaestor.operators.merge import latest_per_key, upsert
from quaestor.operators.ranges import written
from quaestor.session import checkpoint_dir


def incremental_upsert_stream(spark: SparkSession, source: DataFrame, target_root: str, keys: Sequence[str],
                              order_cols: Sequence[str] | None = None, checkpoint: str | None = None,
                              name: str = "upsert", available_now: bool = True):
    """Keyed upsert (A08) of every micro-batch of ``source``.

    Batch n merges into what batch n - 1 wrote and writes ``batch=n`` under
    ``target_root``; no plan reads the path it writes, and a batch that is run
    again writes the same rows.  Returns the query and the list of versions
    written so far; the last one is the target."""
    root, versions = target_root.rstrip("/"), []
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/{name}"

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = latest_per_key(batch, keys, order_cols)
        merged = fresh if batch_id == 0 else upsert(
            batch.sparkSession.read.parquet(f"{root}/batch={batch_id - 1}"), fresh, keys, order_cols)
        path = f"{root}/batch={batch_id}"
        merged.write.mode("overwrite").parquet(path)
        versions.append(path)

    w = source.writeStream.foreachBatch(merge_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(), versions


def bucketed_upsert_stream(spark: SparkSession, source: DataFrame, target: str, keys: Sequence[str], order_cols: Sequence[str],
                           buckets: int = 64, checkpoint: str | None = None, name: str = "bucketed", available_now: bool = True):
    """J01 for a large target: the target lies in ``buckets`` folders by the hash
    of the key, and a micro-batch rewrites only those its keys fall into
    (dynamic partition overwrite); the files of all others stay as they are.

    Of a key the row with the greatest ``order_cols`` stays, whichever came
    first, so rows that come late change nothing newer, and a batch that runs
    again after a failure, wherever that was, gives the same rows.  The merged
    rows are written to the shared folder before the target is touched.
    ``read_buckets`` reads the target; its cost and a batch's grow with the
    buckets touched, so choose ``buckets`` for some 100 MB each.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/{name}"
    keys = list(keys)

    def write(df: DataFrame, mode: str) -> None:
        df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = written(latest_per_key(batch, keys, order_cols)
                        .withColumn("bucket", F.expr(f"cast(pmod(xxhash64({', '.join(keys)}), {buckets}) as int)")))
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        write(fresh.where("false"), "append")  # the folder is there from now on
        old = batch.sparkSession.read.schema(fresh.schema).parquet(target).where(F.col("bucket").isin(touched))
        merged = written(latest_per_key(old.unionByName(fresh), keys, order_cols))
        write(merged.hint("rebalance", "bucket"), "overwrite")

    w = source.writeStream.foreachBatch(merge_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_buckets(spark: SparkSession, target: str) -> DataFrame:
    """The rows of what ``bucketed_upsert_stream`` has written."""
    return spark.read.parquet(target).drop("bucket")


def deduplicated_stream(stream: DataFrame, ts_col: str, keys: Sequence[str], out_path: str, checkpoint: str,
                        lookback: str = "24 hours", available_now: bool = True):
    """J02 as a running query: rows at most ``lookback`` late pass once per key,
    later ones are dropped; appended to ``out_path``.  Started again with the
    same ``checkpoint``, it goes on with the keys and the watermark it had."""
    w = (late_lookback(stream, ts_col, keys, lookback).writeStream.outputMode("append").format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return w.start()


def late_lookback(stream: DataFrame, ts_col: str, keys: Sequence[str], lookback: str = "24 hours") -> DataFrame:
    """Tolerate rows up to ``lookback`` late; duplicates of a key inside
    the watermark are dropped (state is bounded by the lookback)."""
    return stream.withWatermark(ts_col, lookback).dropDuplicatesWithinWatermark(list(keys))


def running_summary_stream(spark: SparkSession, stream: DataFrame, keys: Sequence[str], value: str,
                           target_root: str, checkpoint: str | None = None, name: str = "summary",
                           available_now: bool = True):
    """Per-key count/sum/max as mergeable states; each micro-batch writes
    its own partial states to ``batch=n`` (again, if it is run again)."""
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/{name}"

    def write_states(batch: DataFrame, batch_id: int) -> None:
        partial_state(batch, keys, value).write.mode("overwrite").parquet(f"{target_root}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(write_states).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_summary(spark: SparkSession, target_root: str, keys: Sequence[str]) -> DataFrame:
    """The states of all batches, merged with one partial aggregate."""
    s = spark.read.option("basePath", target_root).parquet(target_root)
    return merge_states(s.select(*keys, "state_count", "state_sum", "state_max"), keys)


def monthly_rollup_stream(stream: DataFrame, ts_col: str, keys: Sequence[str], value: str, out_path: str,
                          checkpoint: str, watermark: str = "31 days", available_now: bool = True):
    """Sums by key and day with the day's calendar month, appended once
    the watermark passes the day; ``monthly_totals`` adds them up.  State is
    bounded by the watermark; no month is cut by a window of fixed length."""
    agg = (stream.withWatermark(ts_col, watermark)
           .groupBy(F.window(ts_col, "1 day").alias("w"), *keys)
           .agg(F.count(F.lit(1)).alias("row_count"), F.sum(value).alias("total"))
           .withColumn("month", F.trunc(F.col("w.start"), "month")))
    w = (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return w.start()


def monthly_totals(rollup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Calendar-month rows of what ``monthly_rollup_stream`` has appended."""
    return rollup.groupBy("month", *keys).agg(F.sum("row_count").alias("row_count"), F.sum("total").alias("total"))


def freshness_check(df: DataFrame, loaded_at_col: str, as_of, warn_hours: int = 24, error_hours: int = 48,
                    source_col: str | None = None) -> DataFrame:
    """Hours since the last load per source; WARN > 24 h, ERROR > 48 h."""
    a = F.lit(as_of).cast("timestamp")
    g = df.groupBy(*( [source_col] if source_col else [])).agg(F.max(loaded_at_col).alias("last_loaded_at"))
    hours = ((F.unix_timestamp(a) - F.unix_timestamp(F.col("last_loaded_at").cast("timestamp"))) / 3600)
    return (g.withColumn("hours_since_load", F.floor(hours).cast("bigint"))
            .withColumn("freshness_status", F.when(F.col("hours_since_load") > error_hours, "ERROR")
                        .when(F.col("hours_since_load") > warn_hours, "WARN").otherwise("OK")))


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{os.getpid()}"
