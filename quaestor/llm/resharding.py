"""Sharding: minimum-cost-flow resharding.

Old shards have sizes, new shards capacities.  Each old shard's rows fall into
blocks by a hash; the blocks' sizes (a bounded table: at most
``MOST_BLOCKS`` rows) come to the driver, where a minimum-cost flow from old to
new shards, staying costing nothing and a byte moved costing one, gives the
transfers that move the fewest bytes.  Blocks are then picked to make up each
transfer, largest first, and every row follows its block.

Law: ``bytes``.  New shards differ from the mean by a few blocks at most; a
block holds about ``ROWS_PER_BLOCK`` rows.  Equal rows are spread over the
blocks of their old shard by their place in the scan, so a hot key does not
make a large block.  Rows are numbered inside blocks, and blocks inside shards,
so no task sorts a whole shard.

Cases: a null text has no bytes (its row still counts ``OVERHEAD``) and the
checksum of nothing; null doc_ids hash like any value; repeated rows are placed
each; an empty table gives no rows; a text larger than a shard's capacity stays
whole and its shard is that much larger.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaestor.llm.common import staged, table

OVERHEAD, ROWS_PER_BLOCK, LEAST_BLOCKS, MOST_BLOCKS = 16, 20_000, 256, 400_000


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Units sent from each supply to each capacity at least total
    ``cost(i, j)``; everything is sent, so capacities must suffice.
    Successive shortest paths with potentials over a bipartite graph."""
    n, m = len(supply), len(capacity)
    left, room, flow = list(supply), list(capacity), defaultdict(int)
    potential = [0] * (n + m)
    while any(left):
        # Dijkstra from all supplies that have units left
        dist, back = [None] * (n + m), [None] * (n + m)
        heap = [(0, i) for i in range(n) if left[i]]
        for _, i in heap:
            dist[i] = 0
        heapq.heapify(heap)
        done, end = [False] * (n + m), None
        while heap:
            d, u = heapq.heappop(heap)
            if done[u]:
                continue
            done[u] = True
            if u >= n and room[u - n]:
                end = u
                break
            if u < n:
                steps = ((n + j, cost(u, j)) for j in range(m))
            else:
                steps = ((i, -cost(i, u - n)) for i in range(n) if flow.get((i, u - n)))
            for v, c in steps:
                at = d + c + potential[u] - potential[v]
                if not done[v] and (dist[v] is None or at < dist[v]):
                    dist[v], back[v] = at, u
                    heapq.heappush(heap, (at, v))
        if end is None:
            raise ValueError("the capacities do not hold the supplies")
        for v in range(n + m):
            potential[v] += min(dist[v], dist[end]) if done[v] else dist[end]
        path, v = [end], end
        while back[v] is not None:
            v = back[v]
            path.append(v)
        path.reverse()
        sent = min([left[path[0]], room[end - n],
                    *[flow[b, a - n] for a, b in zip(path, path[1:]) if a >= n]])
        for a, b in zip(path, path[1:]):
            if a < n:
                flow[a, b - n] += sent
            else:
                flow[b, a - n] -= sent
        left[path[0]] -= sent
        room[end - n] -= sent
    return {k: v for k, v in flow.items() if v}


def place_blocks(blocks: list[tuple[int, int, int]], capacity: list[int]) -> dict[tuple[int, int], int]:
    """New shard of each block (old shard, block, size): transfers by minimum
    cost, then the largest blocks that still fit one."""
    sizes = defaultdict(int)
    for old, _, size in blocks:
        sizes[old] += size
    olds = sorted(sizes)
    total, given = sum(sizes.values()), sum(capacity)
    if given < total:
        raise ValueError("the capacities do not hold the rows")
    moves = min_cost_flow([sizes[o] for o in olds], capacity, lambda i, j: 0 if olds[i] == j else 1)
    out = {}
    for i, old in enumerate(olds):
        own = sorted((b for b in blocks if b[0] == old), key=lambda b: (-b[2], b[1]))
        away = {j: v for (a, j), v in moves.items() if a == i and j != old}
        stay = moves.get((i, old), 0)
        for _, block, size in own:
            # the transfer with most bytes open, or staying if that has more
            j = max(away, key=lambda j: (away[j], -j), default=None)
            if j is not None and (away[j] > stay or old >= len(capacity)):
                away[j] -= size
                out[old, block] = j
            else:
                stay -= size
                out[old, block] = old
    return out


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """doc_id, size and text_crc32 of every row, and the columns ``more``."""
    utf8 = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.length(utf8) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(utf8).alias("text_crc32"), *more)


def reshard(rows: DataFrame, old_shard, n_old: int, capacity_of) -> DataFrame:
    """``rows`` (doc_id, size, text_crc32 and more) with their new ``shard`` and
    ``slot``.  ``old_shard``: a column from 0 to n_old - 1; ``capacity_of``: the
    new shards' capacities, given the total size."""
    spark = rows.sparkSession
    spread = F.xxhash64("doc_id", "text_crc32", "size", F.monotonically_increasing_id())
    here = staged(rows.withColumn("old_shard", old_shard.cast("int")).withColumn("spread", spread))
    n = here.count()
    per_shard = min(max(LEAST_BLOCKS, -(-n // (n_old * ROWS_PER_BLOCK))), MOST_BLOCKS // n_old)
    here = here.withColumn("block", F.pmod("spread", F.lit(per_shard)).cast("int"))
    blocks = here.groupBy("old_shard", "block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    capacity = capacity_of(sum(b["size"] for b in blocks))
    placed = place_blocks([(b["old_shard"], b["block"], b["size"]) for b in blocks], capacity)
    first, index = defaultdict(int), []
    for b in sorted(blocks, key=lambda b: (b["old_shard"], b["block"])):
        shard = placed[b["old_shard"], b["block"]]
        index.append((b["old_shard"], b["block"], shard, first[shard]))
        first[shard] += b["rows"]
    plan = spark.createDataFrame(index, "old_shard int, block int, shard int, first long")
    inside = Window.partitionBy("old_shard", "block").orderBy("doc_id", "text_crc32", "size", "spread")
    return (here.withColumn("at", F.row_number().over(inside).cast("long") - 1)
            .join(F.broadcast(plan), ["old_shard", "block"])  # at most MOST_BLOCKS rows
            .withColumn("slot", F.col("first") + F.col("at"))
            .drop("spread", "block", "first", "at"))


def equal_capacities(n_new: int):
    """Capacities that hold any total in ``n_new`` shards of near equal size."""
    return lambda total: [total // n_new + (j < total % n_new) for j in range(n_new)]


def rewrite(resharded: DataFrame, path: str) -> None:
    """Writes the shards that gain or lose rows as ``shard=N`` folders; the
    others' files stay as they are."""
    moved = resharded.where("old_shard != shard")
    touched = moved.select("shard").union(moved.select(F.col("old_shard").alias("shard"))).distinct()
    (resharded.join(F.broadcast(touched), "shard")  # a row for each shard at most
     .repartition("shard", F.expr("slot div 1000000")).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out in 32 shards by a hash of doc_id move to 40 of near
    equal bytes."""
    rows = sized(table(spark, sf_dir, "documents"))
    old = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(32))
    return reshard(rows, old, 32, equal_capacities(40)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")
