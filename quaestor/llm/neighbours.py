"""Approximate nearest neighbours: multiprobe p-stable hashing.

Each of ``tables`` tables hashes a vector to ``hashes`` values
floor((a.x + b) / width) with normal a.  A query visits its own bucket and the
``probes - 1`` neighbouring ones whose borders lie nearest (sum of squared
distances to the borders crossed, the estimated order of success).  What the
tables give is merged and ranked by the exact measure in double precision.

The measure is the inner product.  Vectors are scaled by the largest norm and
get one more component that makes them unit vectors, queries a zero there; then
the largest inner product is the smallest distance, which the hashes are for.

Buckets are dealt out in blocks of about ``BLOCK`` rows: a larger bucket is
split by vec_id, and a probe visits all its blocks.  A block keeps the
``k`` best of each query, and these lists meet in one window per query.
Queries that found fewer than ``k`` are compared with every row, in blocks.

Cases: vectors that are null, zero, of another dimension than most, or hold
null or non-finite components take no part, nor do null vec_ids; equal scores
go to the smaller vec_id; repeated rows count once; an empty table gives none.
"""

from __future__ import annotations

from itertools import product
from typing import Iterator, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaestor.llm.common import staged, table

TABLES, HASHES, WIDTH, PROBES, BLOCK = 8, 4, 1.6, 12, 4096


def _matrix(column, dim: int) -> np.ndarray:
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(c.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _hashing(dim: int, largest: float, tables: int, hashes: int, width: float, probes: int):
    """(table, bucket, id, vector) rows: one bucket a table for index rows,
    ``probes`` for queries."""
    rng = np.random.default_rng(17)
    a = rng.normal(size=(tables, dim + 1, hashes))
    b = rng.uniform(0, width, size=(tables, 1, hashes))
    steps = np.array(list(product((0, -1, 1), repeat=hashes)))
    mix = np.array([pow(1_000_003, i + 1, 1 << 61) for i in range(hashes)], np.int64)

    def rows(is_query: bool):
        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column(1), dim) / largest
                extra = np.zeros(len(x)) if is_query else np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
                x = np.hstack([x, extra[:, None]])
                for t in range(tables):
                    at = (x @ a[t] + b[t]) / width
                    h = np.floor(at).astype(np.int64)
                    if is_query:
                        below = at - h
                        cost = np.where(steps[:, None] == -1, below ** 2, np.where(steps[:, None] == 1, (1 - below) ** 2, 0))
                        order = np.argsort(cost.sum(axis=2), axis=0, kind="stable")[:probes]  # probes x rows
                        h = (h[None] + steps[order]).reshape(-1, hashes)
                        who = np.tile(np.arange(len(x)), len(order))
                    else:
                        who = np.arange(len(x))
                    yield pa.record_batch([pa.array(np.full(len(who), t, np.int32)), pa.array((h * mix).sum(axis=1)),
                                           batch.column(0).take(pa.array(who)), batch.column(1).take(pa.array(who))],
                                          names=["t", "bucket", "id", "vector"])

        return hashed

    return rows


_FOUND = "query_id long, vec_id long, score double"


def _best(k: int, dim: int):
    """The ``k`` best rows of a block for each query that visits it."""

    def best(key: Tuple[pa.Scalar, ...], queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if queries.num_rows and rows.num_rows:
            q, v = _matrix(queries.column("vector"), dim), _matrix(rows.column("vector"), dim)
            q_ids, v_ids = queries.column("id").to_numpy(), rows.column("id").to_numpy()
            for lo in range(0, len(q), 512):
                rough = q[lo:lo + 512] @ v.T
                for i, line in enumerate(rough):
                    line[v_ids == q_ids[lo + i]] = -np.inf
                    n = min(k, len(line))
                    # all that may belong to the best, whatever the product's order of sums
                    edge = np.partition(line, len(line) - n)[len(line) - n]
                    if edge == -np.inf:
                        near = np.flatnonzero(line > -np.inf)
                    else:
                        near = np.flatnonzero(line >= edge - 1e-9 * (1 + abs(edge)))
                    score = np.cumsum(q[lo + i] * v[near], axis=1)[:, -1] if len(near) else np.zeros(0)
                    order = np.lexsort((v_ids[near], -score))[:k]
                    found += zip([int(q_ids[lo + i])] * len(order), v_ids[near][order].tolist(), score[order].tolist())
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()),
                         "vec_id": pa.array([f[1] for f in found], pa.int64()),
                         "score": pa.array([f[2] for f in found], pa.float64())})

    return best


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int, float]:
    """Rows that take part (id, vector), their dimension and largest norm."""
    v = F.col("vector")
    fine = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("id").isNotNull() & F.exists(v, lambda x: x != 0)
                   & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))))
    sizes = (fine.groupBy(F.size(v).alias("dim"))
             .agg(F.count(F.lit(1)).alias("n"),
                  F.max(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)).alias("square"))
             .orderBy(F.desc("n"), "dim").first())
    if sizes is None:
        return fine, 1, 1.0
    return fine.where(F.size(v) == sizes.dim), sizes.dim, sizes.square ** 0.5


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row where
    ``is_query`` (SQL on ``id``) holds, among all rows but itself."""
    rows, dim, largest = _usable(vectors, id_col, vector_col)
    rows = staged(rows)
    queries = rows.where(is_query).dropDuplicates(["id"])
    hashed = _hashing(dim, largest, tables, hashes, width, probes)
    ddl = "t int, bucket long, id long, vector array<double>"
    index, visits = rows.mapInArrow(hashed(False), ddl), queries.mapInArrow(hashed(True), ddl)
    split = staged(index.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n"))
                   .select("t", "bucket", F.expr(f"cast(ceil(n / {BLOCK}) as int) as blocks")))

    def nearest(asked: DataFrame, searched: DataFrame, *key: str) -> DataFrame:
        return asked.groupBy(*key).cogroup(searched.groupBy(*key)).applyInArrow(_best(k, dim), _FOUND)

    # the same table under two sets of columns
    twice = [split.select(*[F.col(c).alias(c) for c in split.columns]).hint("merge") for _ in range(2)]
    found = nearest(
        visits.join(twice[0], ["t", "bucket"]).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))),
        index.join(twice[1], ["t", "bucket"]).withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)")),
        "t", "bucket", "block")
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(f: DataFrame) -> DataFrame:
        return f.withColumn("rank", F.dense_rank().over(top)).where(F.col("rank") <= k).distinct()

    first = staged(ranked(found))
    full = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("query_id")
    short = staged(queries.join(full, queries.id == full.query_id, "left_anti"))
    if not short.isEmpty():
        blocks = max(1, -(-rows.count() // BLOCK))
        rest = nearest(short.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))),
                       rows.withColumn("block", F.expr(f"cast(pmod(xxhash64(id), {blocks}) as int)")), "block")
        first = (first.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
                 .unionByName(ranked(rest)))
    return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "id % 20 = 0")
