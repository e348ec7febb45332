"""Scans and source metadata.

Filters and column lists are expressed on the DataFrame so Catalyst pushes
them into the parquet (or JDBC) scan; nothing is read eagerly.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tables of the driver test data set.
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_source(spark: SparkSession, path: str, fmt: str = "parquet",
                options: dict | None = None, schema=None) -> DataFrame:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """JDBC source with range-partitioned parallel reads (extract from an OLTP
    system).  Filters applied afterwards are pushed into the SQL."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; the file layout and
    ``spark.sql.files.maxPartitionBytes`` decide the partitions."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_table(df: DataFrame, columns: Sequence[str] | None = None, where: str | None = None,
               order_by: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """SELECT [TOP n] cols FROM t WHERE f ORDER BY o."""
    out = df
    if where:
        out = out.where(F.expr(where))
    if columns:
        out = out.select(*columns)
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        if not order_by:
            raise ValueError("a limit needs order_by")
        out = out.limit(limit)
    return out


def scan_incremental(df: DataFrame, column: str, last_value=None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with ``column > last_value`` (all rows when last_value is None).

    Ordering is not needed for a set-based load; the merge is keyed.
    """
    out = df if last_value is None else df.where(F.col(column) > F.lit(last_value))
    return out.select(*columns) if columns else out


def high_watermark(df: DataFrame, column: str, alias: str = "high_watermark") -> DataFrame:
    """MAX(column) as a one-row DataFrame (A03); partial aggregation per task."""
    return df.agg(F.max(column).alias(alias))


def row_count(df: DataFrame, where: str | None = None, alias: str = "row_count") -> DataFrame:
    """COUNT(*) with optional filter."""
    src = df.where(F.expr(where)) if where else df
    return src.agg(F.count(F.lit(1)).alias(alias))


def profile_table(df: DataFrame, columns: Iterable[str] | None = None, exact: bool = True) -> DataFrame:
    """Data profile of a source (A05): one row per column with type, null
    count, distinct count, min, max, max length and a key-candidate flag.

    All statistics come from a single aggregation over the table.  With
    ``exact=False`` distinct counts use HyperLogLog++ (mergeable sketches, no
    per-column shuffle), the right choice for very wide or very large tables.
    """
    cols = list(columns) if columns is not None else df.columns
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [
            F.count_if(x.isNull()).alias(f"n{i}"),
            (F.countDistinct(x) if exact else F.approx_count_distinct(x)).alias(f"d{i}"),
            F.min(x).cast("string").alias(f"lo{i}"),
            F.max(x).cast("string").alias(f"hi{i}"),
            F.max(F.length(x.cast("string"))).alias(f"len{i}"),
        ]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(dtypes[c]).alias("data_type"),
                     F.col(f"n{i}").cast("bigint").alias("null_count"),
                     F.col(f"d{i}").cast("bigint").alias("distinct_count"),
                     F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                     F.col(f"len{i}").cast("int").alias("max_length"),
                     ((F.col(f"d{i}") == F.col("__rows")) & (F.col(f"n{i}") == 0)).cast("int")
                     .alias("is_key_candidate"),
                     F.col("__rows").cast("bigint").alias("row_count"))
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


#: Bounds of the sketches: relative error of distinct counts (three standard
#: errors at 2**12 registers) and error of a quantile's rank.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.03


def profile_load(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Mergeable profile of one load (A05): a row per column with counts, ends
    and two sketches, one of the distinct values and, for numbers and dates, one
    of the quantiles (dates as days since 1970).  One pass, one row a column;
    store it beside the load."""
    cols = list(columns) if columns is not None else df.columns
    types = dict(df.dtypes)

    def number(c):
        if types[c] == "date":
            return F.unix_date(c).cast("double")
        if types[c].startswith(("timestamp",)):
            return F.unix_seconds(F.col(c).cast("timestamp")).cast("double")
        numeric = types[c].startswith(("decimal", "tinyint", "smallint", "int", "bigint", "float", "double"))
        return F.col(c).cast("double") if numeric else F.lit(None).cast("double")

    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        text, value = F.col(c).cast("string"), number(c)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.hll_sketch_agg(text, 12).alias(f"d{i}"),
                 F.kll_sketch_agg_double(value).alias(f"q{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"),
                 F.min(text).alias(f"first{i}"), F.max(text).alias(f"last{i}"), F.max(F.length(text)).alias(f"len{i}")]
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col("__rows").alias("row_count"),
                     F.col(f"n{i}").alias("null_count"), F.col(f"lo{i}").alias("min_number"), F.col(f"hi{i}").alias("max_number"),
                     F.col(f"first{i}").alias("min_text"), F.col(f"last{i}").alias("max_text"), F.col(f"len{i}").alias("max_length"),
                     F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("quantile_sketch"))
            for i, c in enumerate(cols)]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of any loads as one (rows of ``profile_load`` or of this)."""
    return profiles.groupBy("column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("min_number").alias("min_number"),
        F.max("max_number").alias("max_number"), F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.max("max_length").alias("max_length"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def read_profile(merged: DataFrame) -> DataFrame:
    """Estimates of a profile: distinct_estimate within DISTINCT_ERROR, p25,
    median and p75 within RANK_ERROR of their rank (NULL for text)."""
    some = F.col("min_number").isNotNull()
    at = lambda q: F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q)))
    return merged.select("column_name", "data_type", "row_count", "null_count", "min_number", "max_number", "min_text", "max_text",
                         "max_length", F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
                         at(0.25).alias("p25"), at(0.5).alias("median"), at(0.75).alias("p75"))
