"""Small helpers that the training-data operators share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from quaestor.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable_by_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the cluster's shared checkpoint folder and read it
    back: later steps neither recompute it nor depend on the executors that
    made it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()  # lets Spark drop the shuffle files of what is written now
    return spark.read.schema(df.schema).parquet(path)


def batches_by_chars(texts: list[str], limit: int = 1_000_000):
    """Index ranges of ``texts`` that hold about ``limit`` characters each, one
    text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def importable_by_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.
    Where executors have other folders, install the package there or submit it
    with ``--py-files``; this setting then does no harm."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
