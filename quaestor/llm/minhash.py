"""MinHash near-duplicates, confirmed on full shingle sets.

1. Every document's distinct word shingles (64-bit hashes) give ``bands * rows``
   minima of universal hashes; each band's minima make one bucket.  Documents
   with equal sets are one class from here on.
2. In a bucket, members are compared with its hub only, the earliest document
   of the bucket.  That joins clusters of near copies in rows proportional to
   them.
3. A pair goes on if its signatures agree often enough (six standard deviations
   below the threshold) and counts if intersection and union of its full sets do.
4. What is left in a bucket with several components is settled exactly, without
   its pairs: with c the earliest document of its largest component and D(x) the
   symmetric difference of x and c, a link of x and y allows |D(x)| + |D(y)| -
   2 |D(x) & D(y)| differing shingles, at most s (|x| + |y|) with s = (1 - t) /
   (1 + t).  If x isn't linked to c, x and y must share entries of D: pairs meet
   under the first entries of D (what c lacks before what x lacks, since
   additions are rare), in a prefix of s |x| (1 + 1 / t) + 1, if the places
   leave room for the number needed.
5. Components by alternating large-star and small-star.

A pair at the threshold shares no bucket with a chance of (1 - t**rows)**bands:
5e-8 at 0.8 and 5e-11 at 0.85 with 32 bands of 4.

Cases: null, empty and blank texts have no shingles and are linked with
nothing; a text with fewer words than a shingle is one shingle; repeated rows
are equal sets, and ``kept`` holds for each row whose doc_id is the component's
smallest; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import batches_by_chars, staged, table
from quaestor.llm.components import connected_components

BANDS, ROWS = 32, 4
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: A-Z lower-cased, words
    between ASCII white space, ``k`` words a shingle."""
    words = [t.encode().lower().split() for t in texts]
    flat = np.array([w for ws in words for w in ws], dtype=object)
    if not len(flat):
        return [np.zeros(0, np.uint64) for _ in texts]
    hashed = pd.util.hash_array(flat, categorize=False)
    out, at = [], 0
    for ws in words:
        n = len(ws)
        h, at = hashed[at:at + n], at + n
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        width = min(k, n)
        s = np.full(n - width + 1, width, np.uint64)
        for j in range(width):
            s = _mixed(s + h[j:n - width + 1 + j])
        out.append(np.unique(s))
    return out


def _set_key(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _hashes(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of ``n`` universal hashes."""
    rng = np.random.default_rng(20_240_229)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def _minima(sets: list[np.ndarray], a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Smallest value of each hash (columns) over each set (rows)."""
    x, starts = np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets[:-1])])
    return np.stack([np.minimum.reduceat(x * ak + ck, starts) for ak, ck in zip(a, c)], axis=1)


def _signatures(k: int, bands: int, rows: int):
    a, c = _hashes(bands * rows)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in batches_by_chars(texts):
                sets = shingle_sets(texts[lo:hi], k)
                full = [i for i, s in enumerate(sets) if len(s)]
                band = [[] for _ in sets]
                if full:
                    minima = _minima([sets[i] for i in full], a, c)
                    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(full), 1))
                    for r in range(rows):
                        keys = _mixed(keys + minima[:, r::rows])
                    for i, ks in zip(full, keys.view(np.int64).tolist()):
                        band[i] = ks
                yield pa.record_batch([pa.array(ids[lo:hi], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                       pa.array([_set_key(s) for s in sets], pa.binary()),
                                       pa.array(band, pa.list_(pa.int64()))],
                                      names=["doc_id", "n_shingles", "node", "bands"])

    return sign


def _full_sets(k: int, n: int):
    """Shingles and signature (a byte of each of ``n`` minima) of the documents
    that stand for the nodes asked for."""
    a, c = _hashes(n)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in batches_by_chars(texts):
                # a doc_id may stand on several texts: keep the one asked for
                own = [(x, s) for x, s in zip(nodes[lo:hi], shingle_sets(texts[lo:hi], k)) if _set_key(s) == x]
                if own:
                    short = _mixed(_minima([s for _, s in own], a, c)).astype(np.uint8)
                    yield pa.record_batch([pa.array([x for x, _ in own], pa.binary()),
                                           pa.array([x.tobytes() for x in short], pa.binary()),
                                           pa.array([s.tobytes() for _, s in own], pa.binary())],
                                          names=["node", "signature", "shingles"])

    return sets


def _linked(need: float, num: int, den: int):
    """Pairs whose signatures agree in ``need`` places and whose sets are similar."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for p, q, x, y in zip(*(b.column(i) for i in range(2, 6))):
                p, q = np.frombuffer(p.as_py(), np.uint8), np.frombuffer(q.as_py(), np.uint8)
                if (p == q).sum() < need:
                    keep.append(False)
                    continue
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return linked


_DIFFERENCE_DDL = "hub binary, entry long, node binary, component binary, of_hub binary, at int, d int, n int, far boolean"


def _differences(num: int, den: int):
    """For every node and hub the first entries of their symmetric difference:
    what the hub lacks, then what the node lacks, each in the hashes' order."""

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                hub, entry, node, component, of_hub, at, d, n, far = [], [], [], [], [], [], [], [], []
                for u, v, c, h, x, y in zip(*(part.column(i).to_pylist() for i in range(6))):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    own, lost = np.setdiff1d(x, y, True), np.setdiff1d(y, x, True)
                    size, both = len(own) + len(lost), len(x) - len(own)
                    most = min(size, (den - num) * len(x) // num + 1)
                    hub += [v] * most
                    entry.append(np.concatenate([own, lost])[:most].view(np.int64))
                    node += [u] * most
                    component += [c] * most
                    of_hub += [h] * most
                    at.append(np.arange(most))
                    d += [size] * most
                    n += [len(x)] * most
                    far += [den * both < num * (len(x) + len(y) - both)] * most
                flat = lambda a, t: pa.array(np.concatenate(a) if a else [], t)
                yield pa.record_batch(
                    [pa.array(hub, pa.binary()), flat(entry, pa.int64()), pa.array(node, pa.binary()),
                     pa.array(component, pa.binary()), pa.array(of_hub, pa.binary()), flat(at, pa.int32()), pa.array(d, pa.int32()),
                     pa.array(n, pa.int32()), pa.array(far, pa.bool_())],
                    names=["hub", "entry", "node", "component", "of_hub", "at", "d", "n", "far"])

    return differences


def near_duplicates(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100), bands: int = BANDS,
                    rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document; links are
    pairs with ``threshold[1] * intersection >= threshold[0] * union``."""
    num, den = threshold
    t = num / den
    need = bands * rows * (t - 6 * (t * (1 - t) / (bands * rows)) ** 0.5)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = staged(source.mapInArrow(
        _signatures(k, bands, rows),
        "doc_id long, n_shingles long, node binary, bands array<long>"))
    classes = signed.where("node is not null").groupBy("node").agg(F.first("bands").alias("bands"),
                                                                   F.min("doc_id").alias("doc_id"))
    buckets = staged(classes.select("node", "doc_id", F.explode("bands").alias("band")))
    several = staged(buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "node")).alias("hub"))
                     .where("n > 1").select("band", F.col("hub.node").alias("hub")))
    stars = staged(buckets.join(several.hint("merge"), "band"))
    nodes = staged(stars.select("node", "doc_id").distinct())
    wanted = nodes.select("node", F.col("doc_id").alias("wanted"))
    sets = staged(source.join(wanted.hint("merge"), source.doc_id.eqNullSafe(F.col("wanted")))
                  .select("node", "text").mapInArrow(_full_sets(k, bands * rows), "node binary, signature binary, shingles binary")
                  .dropDuplicates(["node"]))

    def with_both(pairs: DataFrame, *cols: str) -> DataFrame:
        """``pairs`` (u, v) with columns of both nodes, cu and cv for c."""
        for end in ("u", "v"):
            pairs = pairs.join(sets.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in cols])
                               .hint("merge"), end)
        return pairs

    def links(pairs: DataFrame) -> DataFrame:
        return (with_both(pairs, "signature", "shingles")
                .select("u", "v", "signature_u", "signature_v", "shingles_u", "shingles_v")
                .mapInArrow(_linked(need, num, den), "u binary, v binary"))

    edges = staged(links(stars.where("node != hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()))
    found = staged(connected_components(edges))
    at = staged(stars.join(found.hint("merge"), "node", "left")
                .select("band", "node", "doc_id", F.coalesce("component", "node").alias("component")))
    # the reference of a bucket: the earliest document of its largest component
    info = staged(at.groupBy("component").agg(F.count(F.lit(1)).alias("size"),
                                              F.min(F.struct("doc_id", "node")).alias("first")))
    at = staged(at.join(info.hint("merge"), "component").select("band", "node", "component", "size", F.col("first.node").alias("v")))
    mixed = staged(at.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                          F.max(F.struct("size", "component", "v")).alias("ref"))
                   .where("lo != hi").select("band", F.col("ref.component").alias("of_hub"), F.col("ref.v").alias("ref")))
    around = (at.join(mixed.hint("merge"), "band").where("node != ref")
              .select(F.col("node").alias("u"), F.col("ref").alias("v"), "component", "of_hub").distinct())
    entries = staged(with_both(around, "shingles").select("u", "v", "component", "of_hub", "shingles_u", "shingles_v")
                     .mapInArrow(_differences(num, den), _DIFFERENCE_DDL))
    x = entries.select("hub", "entry", F.struct("node", "component", "at", "d", "n", "far").alias("x"))
    y = entries.select(F.col("hub").alias("hub_y"), F.col("entry").alias("entry_y"),
                       F.struct("node", "component", "at", "d", "n").alias("y"))
    room = f"{den + num} * (x.d + y.d - 2 * least(x.d - x.at, y.d - y.at)) <= {den - num} * (x.n + y.n)"
    pairs = (x.join(y, F.expr(f"hub = hub_y and entry = entry_y and x.far and x.component != y.component and {room}"))
             .select(F.col("x.node").alias("u"), F.col("y.node").alias("v")).distinct())
    to_hub = (entries.where("not far and component != of_hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
              .distinct())
    late = staged(links(pairs).unionByName(to_hub))
    if not late.isEmpty():
        found = staged(connected_components(edges.unionByName(late)))
    placed = (signed.select("doc_id", "n_shingles", "node").join(found.hint("merge"), "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    smallest = staged(placed.where("component is not null").groupBy("component")
                      .agg(F.min("doc_id").alias("smallest")))
    return (placed.join(smallest.hint("merge"), "component", "left")
            .select("doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"))
            .withColumn("kept", F.expr("doc_id <=> component_id")))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` with the smallest doc_id of each component of near duplicates;
    rows that repeat a doc_id stay or go together."""
    stay = (near_duplicates(docs, id_col=id_col, text_col=text_col, **rule).where("kept")
            .select(F.col("doc_id").alias("_stays")).distinct())
    return docs.join(stay.hint("merge"), docs[id_col].cast("long").eqNullSafe(F.col("_stays")), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, threshold=(85, 100))
