r"""Conversation prefix trie on minimal perfect hash node tables.

A node is a distinct sequence of leading turns (role, text); conversations that
begin with it are its members.

1. Turns are numbered and reduced to 120 bits of md5 each; texts go no further.
   A prefix's digest is the XOR of 128-bit hashes of (place, turn) over its
   turns, so running digests need no order of shuffles and can be cut anywhere.
2. Conversations are dealt to shards in segments of ``segment`` turns, each with
   the turn before it (its *ghost*), so one long conversation fills no shard; a
   shard's segments begin at one depth.  It enumerates its distinct digests, gives them slots by a minimal
   perfect hash, verifies every key against the digest in its slot, scatters
   counts into flat arrays by slot, and finds every node's parent.
3. Shards' nodes meet by digest: one row a shard, however many members.  That
   gives members and the smallest one, whose shard owns the node.  Members that
   disagree on parent, depth or last turn would be a collision of digests; this
   ends the job.
4. Each shard puts what it owns into flat arrays again and accumulates it
   through the parent slots, deepest nodes first.  A node's whole path stands in
   the shard of its smallest member, so the shards' sums add up to the subtree's.
   What a conversation owns in later segments is added at a segment's last turn.
5. Conversations that end at a node are hashed as a stream in the order of
   conv_id: range partitions write pieces of bytes, one task a node reads them in
   order, a piece at a time.

Depth costs no rounds and a hot node no more than one row a shard.

Cases: rows with a null conv_id take no part; a null turn comes first, equal
turns are ordered by role, then by the text's digest, and repeated rows are turns
of their own; null role and text are empty.  ``conv_id - conv_id % 100`` is taken
with the remainder from 0 to 99.  No conversations, no nodes.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from typing import Iterator, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaestor.llm.common import staged, table

#: Rows a shard, and turns a segment of a conversation.
SHARD, SEGMENT = 200_000, 1024


# ------------------------------------------------------------------ turns and prefix digests

def turns_of(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 1), a, b (60 bits of the turn's digest each), chars.
    Places come from a range sort and counts per partition, so a conversation
    may stand in many partitions."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    digest = F.md5(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    keyed = (rows.where("conv_id is not null")
             .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                     digest.alias("digest"), F.length(text).cast("long").alias("chars"))
             .select("conv_id", "turn", "role", F.expr("cast(conv(substring(digest, 1, 15), 16, 10) as long) as a"),
                     F.expr("cast(conv(substring(digest, 16, 15), 16, 10) as long) as b"), "chars"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "a", "b"]
    # an id holds partition and place in it; written, so it stays
    numbered = staged(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                      .select("conv_id", "a", "b", "chars", F.monotonically_increasing_id().alias("at"))
                      .withColumn("part", F.expr("shiftright(at, 33)")))
    parts = numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    skip = parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    return (numbered.join(skip.hint("merge"), ["conv_id", "part"])
            .select("conv_id", F.expr("at - first + skip + 1").alias("place"), "a", "b", "chars"))


def rebuilt(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """conv_id of every conversation, and the turns of the rebuilt ones: the
    first h = crc32(conv_id) % ``most`` of conversation conv_id - conv_id %
    ``block``, then its own from h on."""
    h = f"cast(crc32(encode(cast(conv_id as string), 'UTF-8')) % {most} as int)"
    convs = staged(turns.groupBy("conv_id").agg(F.max("place").alias("own"))
                   .withColumn("h", F.expr(h)).withColumn("base", F.expr(f"conv_id - pmod(conv_id, {block})")))
    heads = (turns.where(F.col("place") < most).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("place", "a", "b", "chars"))).alias("head")))  # most - 1 turns
    lent = staged(convs.join(heads, "base", "left")
                  .select("conv_id", "h", "own", F.expr("slice(coalesce(head, array()), 1, h)").alias("head")))
    first = lent.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    rest = (turns.join(lent.where("own > h").select("conv_id", "h", F.size("head").alias("k")).hint("merge"), "conv_id")
            .where("place > h").select("conv_id", F.expr("place - h + k").alias("place"), "a", "b", "chars"))
    return convs.select("conv_id"), first.unionByName(rest)


def prefixes(convs: DataFrame, turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """A row per conversation and prefix, in segments with ghosts: conv_id, seg,
    depth, p, q (digest), a, b, chars, last (the conversation ends here), ghost."""
    keyed = turns.select("*", F.expr(f"cast(place div {segment} as long)").alias("seg"),
                         F.xxhash64("place", "a", "b").alias("x"), F.xxhash64("b", "place", "a").alias("y"))
    totals = keyed.groupBy("conv_id", "seg").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("place").alias("end"))
    by_seg = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "seg", F.coalesce(F.bit_xor("x").over(by_seg), F.lit(0)).alias("cx"),
                            F.coalesce(F.bit_xor("y").over(by_seg), F.lit(0)).alias("cy"),
                            F.max("end").over(Window.partitionBy("conv_id")).alias("length"))
    running = Window.partitionBy("conv_id", "seg").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    # a segment is at most ``segment`` rows: places are gapless
    rows = (keyed.join(carried, ["conv_id", "seg"])
            .select("conv_id", "seg", F.col("place").alias("depth"),
                    F.col("cx").bitwiseXOR(F.bit_xor("x").over(running)).alias("p"),
                    F.col("cy").bitwiseXOR(F.bit_xor("y").over(running)).alias("q"), "a", "b", "chars",
                    (F.col("place") == F.col("length")).alias("last")))
    lengths = totals.groupBy("conv_id").agg(F.lit(1).alias("some"))
    zero = F.lit(0).cast("long")
    root = (convs.join(lengths, "conv_id", "left")
            .select("conv_id", zero.alias("seg"), zero.alias("depth"), zero.alias("p"), zero.alias("q"), zero.alias("a"),
                    zero.alias("b"), zero.alias("chars"), F.col("some").isNull().alias("last")))
    rows = staged(rows.unionByName(root))
    ghosts = rows.where(f"depth % {segment} = {segment - 1} and not last").withColumn("seg", F.col("seg") + 1)
    return (rows.withColumn("ghost", F.lit(False))
            .unionByName(ghosts.withColumn("last", F.lit(False)).withColumn("ghost", F.lit(True))))


# ------------------------------------------------------------------ node tables

def _mix(p: np.ndarray, q: np.ndarray, level: int) -> np.ndarray:
    h = p.astype(np.uint64) ^ (q.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level * 0xD1342543DE82EF95) % (1 << 64))
    for shift, by in ((32, 0xD6E8FEB86659FD93), (32, 0xD6E8FEB86659FD93)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return h ^ (h >> np.uint64(32))


class NodeTable:
    """Minimal perfect hash of distinct 128-bit digests: on each level keys that
    hash to a place of their own take it, the others go on to the next; a key's
    slot is the rank of its place.  ``p`` and ``q`` hold the digests by slot."""

    def __init__(self, p: np.ndarray, q: np.ndarray):
        self.n, self.levels = len(p), []
        self.p, self.q = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        taken, left_p, left_q = 0, p, q
        while len(left_p):
            if len(self.levels) > 200:
                raise ValueError("digests of a shard are not distinct")
            size = 2 * len(left_p)
            at = (_mix(left_p, left_q, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.cumsum(alone) - 1 + taken
            self.levels.append((size, alone, rank))
            fits = alone[at]
            self.p[rank[at[fits]]], self.q[rank[at[fits]]] = left_p[fits], left_q[fits]
            taken += int(fits.sum())
            left_p, left_q = left_p[~fits], left_q[~fits]

    def slots(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those not in the table."""
        out, left = np.full(len(p), -1, np.int64), np.arange(len(p))
        for level, (size, alone, rank) in enumerate(self.levels):
            at = (_mix(p[left], q[left], level) % np.uint64(size)).astype(np.int64)
            here = alone[at]
            out[left[here]] = rank[at[here]]
            left = left[~here]
        known = out >= 0
        known[known] = (self.p[out[known]] == p[known]) & (self.q[out[known]] == q[known])
        return np.where(known, out, -1)


def _numpy(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [t.column(n).to_numpy() for n in names]


_LOCAL = pa.schema([(c, pa.int64()) for c in ("shard", "seg", "p", "q", "parent_p", "parent_q", "depth", "a", "b", "chars", "members",
                                               "smallest", "clash")])
_LOCAL_DDL = ", ".join(f"{c} long" for c in _LOCAL.names)


def _distinct(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    order = np.lexsort((q, p))
    new = np.concatenate([[True], (np.diff(p[order]) != 0) | (np.diff(q[order]) != 0)])
    return order[new]


def _enumerate(key: Tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """A shard's prefixes -> its nodes, with members counted in it."""
    conv, depth, p, q, a, b, chars, ghost = _numpy(rows, "conv_id", "depth", "p", "q", "a", "b", "chars", "ghost")
    kinds = _distinct(p, q)
    nodes = NodeTable(p[kinds], q[kinds])
    slot = nodes.slots(p, q)
    if (slot < 0).any():
        raise ValueError("a digest is missing from its node table")
    n = nodes.n
    own = {name: np.zeros(n, np.int64) for name in ("depth", "a", "b", "chars")}
    for name, values in zip(own, (depth, a, b, chars)):
        own[name][slot] = values
    # the row above in the same conversation is the parent
    order = np.lexsort((depth, conv))
    above = np.concatenate([[False], (np.diff(conv[order]) == 0) & (np.diff(depth[order]) == 1)])
    parent = np.full(len(p), -1, np.int64)
    parent[order[above]] = slot[order[np.flatnonzero(above) - 1]]
    of = np.full(n, -1, np.int64)
    np.maximum.at(of, slot, parent)
    clash = (own["depth"][slot] != depth) | (own["a"][slot] != a) | (own["b"][slot] != b) | (~ghost & (parent != of[slot]))
    members, smallest = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    np.add.at(members, slot[~ghost], 1)
    np.minimum.at(smallest, slot[~ghost], conv[~ghost])
    out = [np.full(n, key[0].as_py()), np.full(n, key[1].as_py()), nodes.p, nodes.q, np.where(of >= 0, nodes.p[of], 0), np.where(of >= 0, nodes.q[of], 0),
           own["depth"], own["a"], own["b"], own["chars"], members, smallest, np.full(n, int(clash.sum()))]
    return pa.table([pa.array(x, pa.int64()) for x in out], schema=_LOCAL)


_SUMS = pa.schema([(c, pa.int64()) for c in ("p", "q", "children", "leaves", "saved", "parent_conv_id")])
_SUMS_DDL = ", ".join(f"{c} long" for c in _SUMS.names)


def _accumulate(key: Tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """A shard's nodes -> its share of each node's children, leaves and savings."""
    p, q, pp, pq, depth, chars, n_convs, conv, owned, leaf, ghost, add_leaves, add_saved = _numpy(
        rows, "p", "q", "parent_p", "parent_q", "depth", "chars", "n_convs", "conv_id", "owned", "leaf", "ghost", "add_leaves", "add_saved")
    nodes = NodeTable(p, q)
    slot = nodes.slots(p, q)
    row = np.empty(nodes.n, np.int64)  # the row of each slot
    row[slot] = np.arange(nodes.n)
    parent = np.where(depth[row] > 0, nodes.slots(pp[row], pq[row]), -1)
    ghosts, owned = ghost[row], owned[row]
    parent[ghosts] = -1
    children = np.zeros(nodes.n, np.int64)
    leaves = (owned & leaf[row]).astype(np.int64) + add_leaves[row]
    saved = np.where(owned, (n_convs[row] - 1) * chars[row], 0) + add_saved[row]
    counts = (owned & (parent >= 0)).nonzero()[0]
    np.add.at(children, parent[counts], 1)
    by_depth = np.argsort(-depth[row], kind="stable")
    cuts = np.flatnonzero(np.diff(depth[row][by_depth])) + 1
    for level in np.split(by_depth, cuts):  # deepest first
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    above = np.where(parent >= 0, conv[row][parent], -1)
    tell = owned & (parent >= 0)
    out = [nodes.p, nodes.q, children, np.where(ghosts, 0, leaves), np.where(ghosts, 0, saved)]
    return pa.table([*(pa.array(x, pa.int64()) for x in out), pa.array(above, pa.int64(), mask=~tell)], schema=_SUMS)


# ------------------------------------------------------------------ conversations that end at a node

def _pieces(batches: Iterator[pa.RecordBatch], most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Rows in the order of node and conv_id -> pieces of the joined ids."""
    at, first, text = None, None, []

    def piece():
        return pa.record_batch([pa.array([at[0]]), pa.array([at[1]]), pa.array([first]), pa.array([",".join(text)])],
                               names=["p", "q", "first", "ids"])

    for batch in batches:
        for p, q, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if (p, q) != at or len(text) >= most:
                if text:
                    yield piece()
                at, first, text = (p, q), conv, []
            text.append(str(conv))
    if text:
        yield piece()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> SHA-256 of each node's joined ids."""
    at, state = None, None

    def told():
        return pa.record_batch([pa.array([at[0]]), pa.array([at[1]]), pa.array([state.hexdigest()])], names=["p", "q", "ends_sha256"])

    for batch in batches:
        for p, q, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (p, q) != at:
                if at:
                    yield told()
                at, state = (p, q), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if at:
        yield told()


def _ends(rows: DataFrame) -> DataFrame:
    order = ["p", "q", "conv_id"]
    pieces = (rows.where("last and not ghost").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(_pieces, "p long, q long, first long, ids string"))
    return (pieces.repartition("p", "q").sortWithinPartitions("p", "q", "first")
            .mapInArrow(_hash_pieces, "p long, q long, ends_sha256 string"))


# ------------------------------------------------------------------ the trie

def trie(convs: DataFrame, turns: DataFrame, shard: int = SHARD, segment: int = SEGMENT) -> DataFrame:
    """One row per node of the conversations ``convs`` (conv_id, distinct) with
    ``turns`` (conv_id, place gapless from 1, a, b, chars)."""
    spark = convs.sparkSession
    rows = staged(prefixes(convs, turns, segment))
    shards = max(-(-rows.count() // shard), int(spark.conf.get("spark.sql.shuffle.partitions")))
    to = f"cast(pmod(xxhash64(%s, %s), {shards}) as long)"
    dealt = rows.withColumn("shard", F.expr(to % ("conv_id", "seg")))
    local = staged(dealt.groupBy("shard", "seg").applyInArrow(_enumerate, _LOCAL_DDL))
    # ghosts have no members of their own; the smallest member tells the owner
    every = [F.min(c).alias(c) for c in ("depth", "a", "b", "chars")]
    agree = " and ".join(f"min({c}) = max({c})" for c in ("depth", "a", "b"))
    whole = F.expr("if(members > 0, struct(parent_p as p, parent_q as q), null)")
    nodes = staged(local.withColumn("parent", whole).groupBy("p", "q").agg(
        *every, F.min("parent").alias("parent"), F.sum("members").alias("n_convs"),
        F.min(F.expr("if(members > 0, smallest, null)")).alias("conv_id"),
        F.expr(f"assert_true(max(clash) = 0 and {agree} and min(parent) = max(parent), 'prefix digests collide')").alias("fine"))
        .drop("fine"))
    has_child = nodes.where("depth > 0").groupBy("parent.p", "parent.q").agg(F.lit(True).alias("inner"))
    nodes = staged(nodes.select("p", "q", "parent", "depth", "chars", "n_convs", "conv_id")
                   .join(has_child.hint("merge"), ["p", "q"], "left")
                   .withColumn("leaf", F.col("inner").isNull()).drop("inner")
                   .withColumn("seg", F.expr(f"cast(depth div {segment} as long)")))
    # what the smallest members own in later segments, at the last turn of this one
    owned = (nodes.groupBy("conv_id", "seg").agg(F.sum(F.expr("(n_convs - 1) * chars")).alias("s"),
                                                 F.sum(F.expr("cast(leaf as long)")).alias("l")).where("seg > 0"))
    segs = rows.where(f"not ghost and depth % {segment} = {segment - 1}").select("conv_id", "seg", "p", "q")
    both = (segs.withColumns({"s": F.lit(0).cast("long"), "l": F.lit(0).cast("long")})
            .unionByName(owned.select("conv_id", "seg", F.lit(None).cast("long").alias("p"), F.lit(None).cast("long").alias("q"), "s", "l"))
            .groupBy("conv_id", "seg").agg(F.max("p").alias("p"), F.max("q").alias("q"), F.sum("s").alias("s"), F.sum("l").alias("l")))
    behind = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    later = (both.select("conv_id", "seg", "p", "q", F.sum("s").over(behind).alias("s"), F.sum("l").over(behind).alias("l"))
             .where("p is not null and s is not null"))
    carried = (later.select(F.expr(to % ("conv_id", "seg")).alias("shard"), "seg", "p", "q", "s", "l")
               .groupBy("shard", "seg", "p", "q").agg(F.sum("s").alias("add_saved"), F.sum("l").alias("add_leaves")))
    shared = (local.select("shard", "seg", "p", "q", "parent_p", "parent_q", (F.col("members") == 0).alias("ghost"))
              .join(nodes.drop("parent", "seg").hint("merge"), ["p", "q"])
              .join(carried.hint("merge"), ["shard", "seg", "p", "q"], "left")
              .withColumn("owned", F.expr(f"not ghost and shard = {to % ('conv_id', 'seg')}"))
              .select("shard", "seg", "p", "q", "parent_p", "parent_q", "depth", "chars", "n_convs", "conv_id", "owned", "leaf", "ghost",
                      F.coalesce("add_leaves", F.lit(0)).alias("add_leaves"), F.coalesce("add_saved", F.lit(0)).alias("add_saved")))
    sums = shared.groupBy("shard", "seg").applyInArrow(_accumulate, _SUMS_DDL)
    null = {c: F.lit(None).cast(t).alias(c) for c, t in (
        ("conv_id", "long"), ("depth", "long"), ("n_convs", "long"), ("children", "long"), ("leaves", "long"), ("saved", "long"),
        ("parent_conv_id", "long"), ("ends_sha256", "string"))}

    def aligned(df: DataFrame) -> DataFrame:
        return df.select("p", "q", *[df[c] if c in df.columns else null[c] for c in null])

    told = aligned(nodes).unionByName(aligned(sums)).unionByName(aligned(_ends(rows)))
    return (told.groupBy("p", "q").agg(
        F.max("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_conv_id").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"), F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")).drop("p", "q"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(staged(turns_of(table(spark, sf_dir, "conversations")))))


#: Prefixes as lists of turns, subtrees by comparing them.
SQL = r"""
WITH crc AS (
  SELECT list(r ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM range(256) g(i))),
own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
convs AS (
  SELECT conv_id, turns, conv_id - ((conv_id % 100) + 100) % 100 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(s)), lambda k: ord(s[k + 1])::BIGINT)),
             lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT *, CAST(conv_id AS VARCHAR) AS s FROM own), crc),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM convs c LEFT JOIN own b ON b.conv_id = c.base),
nodes AS (
  SELECT turns[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CASE WHEN len(turns) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt) GROUP BY 1, 2),
kinds AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth = p.depth + 1 AND n.path[1:n.depth - 1] = p.path),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM kinds WHERE depth > 0 GROUP BY 1, 2),
below AS (
  SELECT v.conv_id, v.depth, CAST(sum(CASE WHEN u.depth > 0 THEN (u.n_convs - 1) * length(u.path[u.depth].t) ELSE 0 END) AS BIGINT) AS saved,
         count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM (SELECT path, depth, n_convs, conv_id, unnest(range(depth + 1)) AS top FROM kinds) u
  JOIN kinds v ON v.depth = u.top AND v.path = u.path[1:u.top]
  LEFT JOIN kids k ON k.conv_id = u.conv_id AND k.depth = u.depth GROUP BY 1, 2)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves, b.saved AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM kinds n LEFT JOIN kids k USING (conv_id, depth) JOIN below b USING (conv_id, depth)
"""
