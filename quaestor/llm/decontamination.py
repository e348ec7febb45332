r"""Benchmark decontamination: prefix-filtered set join of item windows.

A window is ``window`` consecutive words of an item (an item of fewer words is
one window).  A window is contained in a document where all its shingles
(``shingle`` words, or the whole item if shorter) stand there in order; the
document words of such places are hit.

1. The items' shingles are counted over the whole corpus and ordered from rare
   to frequent.  As all shingles of a window are needed, its necessary prefix is
   one shingle, its rarest (prefix filter).  Neighbouring windows mostly share it.
2. Documents are scanned for prefix shingles.  What leaves the scan is the place
   with the words that a window around it can cover, at most ``window - shingle``
   before and ``window`` from it on; a text without one sends its counts only.
3. Places meet the prefix index in a join on the shingle.  From the place on,
   document and item are compared outwards word by word; enough words must agree
   on both sides for a window (length and positional bounds).  All windows in the
   agreeing stretch lie in the document, so that stretch is hit, exactly.

The scan looks shingles up in a bitmap of at most ``BITS`` bits sized by their
number; what it lets through in error meets no equal words.  The index is
broadcast only if its rows and words are few (``SMALL``), else both sides are
shuffled.  Both passes read each text once, in numpy over its bytes.

Cases: null texts have no words; items without words or with a null item_id take
no part; items that repeat an item_id are one item; every document row, repeated
or not, gives its row; empty tables give no rows, or no hits.  Other columns are
not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import batches_by_chars, staged, table

WINDOW, SHINGLE = 10, 3
BITS = 1 << 24
SMALL = 8 << 20  # bytes of an index that may be broadcast
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: Bytes of UTF-8 that are no part of a word as blanks, A-Z in lower case.
_FOLD = np.array([c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
                  for c in range(256)], np.uint8)


# ------------------------------------------------------------------ words of many texts at once

class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, 1 << 20)
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                                  for b in (_BASE, _INVERSE))
        return self.up, self.down


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of ``texts``: folded bytes, starts, ends and hashes of all, and
    the first word of each text (and the end)."""

    def __init__(self, texts: list[str], powers: _Powers):
        parts = [t.encode() for t in texts]
        raw = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
        self.bytes = _FOLD[raw]
        inside = np.concatenate([[False], self.bytes != 32, [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = turns[::2], turns[1::2]
        at = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        self.first = np.searchsorted(self.starts, at)
        up, down = powers.upto(len(raw) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up[:len(raw)])])
        self.hashes = _mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def shingles(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each word on (over the ends of texts too)."""
        m = max(0, len(self.hashes) - n + 1)
        h = np.full(m, n, np.uint64)
        for i in range(n):
            h = _mixed(h * np.uint64(_BASE) + self.hashes[i:i + m])
        return h

    def text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, words, side="right") - 1

    def words(self, lo: int, hi: int) -> list[str]:
        return bytes(self.bytes[self.starts[lo]:self.ends[hi - 1]]).decode().split() if hi > lo else []


def _found(words: Words, sizes: list[int], bitmap: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places, shingles and their size of shingles inside a text that pass the bitmap."""
    mask = np.uint64(len(bitmap) * 64 - 1)
    for n in sizes:
        h = words.shingles(n)
        bit = h & mask
        at = np.flatnonzero((bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1))
        at = at[at + n <= words.first[words.text_of(at) + 1]]
        yield at, h[at].view(np.int64), n


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes in column ``shingle``; a power of two of them, 64 a
    hash and ``BITS`` at most, so the driver gets a bounded number of words."""
    n = hashes.count()
    longs = 1 << max(6, min(BITS, 64 * n) // 64 - 1).bit_length()
    longs = min(longs, BITS // 64)
    rows = (hashes.select(F.expr(f"shingle & {longs * 64 - 1}L").alias("bit"))
            .groupBy(F.expr("shiftright(bit, 6)").alias("i"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).collect())  # at most ``longs``
    bitmap = np.zeros(longs, np.int64)
    for r in rows:
        bitmap[r.i] = r.bits
    return bitmap.view(np.uint64)


# ------------------------------------------------------------------ index of the items

def _item_shingles(size: int):
    """An item's words and the hashes of its shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for b in batches:
            for item_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = Words([text], powers)
                n = len(w.starts)
                if n:
                    yield pa.record_batch([pa.array([item_id], pa.int64()), pa.array([w.words(0, n)], pa.list_(pa.string())),
                                           pa.array([w.shingles(min(size, n)).view(np.int64)], pa.list_(pa.int64()))],
                                          names=["item_id", "words", "shingles"])

    return rows


def _count_shingles(sizes: list[int], bitmap: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for lo, hi in batches_by_chars(texts):
                words = Words(texts[lo:hi], powers)
                for _, shingles, _ in _found(words, sizes, bitmap):
                    kinds, n = np.unique(shingles, return_counts=True)
                    yield pa.record_batch([pa.array(kinds), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    return count


def _rarest(window: int):
    """For each item the places of the rarest shingle of any of its windows,
    with the words that such a window covers before it (nearest first) and from
    it on."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for item_id, words, shingles, counts in zip(*(c.to_pylist() for c in b.columns)):
                n, size = len(words), len(words) - len(shingles) + 1
                span = min(window, n)
                rank = list(zip(counts, shingles))
                chosen = {min(range(i, i + span - size + 1), key=rank.__getitem__) for i in range(n - span + 1)}
                out += [{"shingle": shingles[q], "item_id": item_id, "size": size, "span": span,
                         "item_before": words[max(0, q + size - span):q][::-1], "item_from": words[q:q + span]} for q in sorted(chosen)]
            yield pa.RecordBatch.from_pylist(out, schema=_INDEX)

    return rows


_INDEX = pa.schema([("shingle", pa.int64()), ("item_id", pa.int64()), ("size", pa.int32()), ("span", pa.int32()),
                    ("item_before", pa.list_(pa.string())), ("item_from", pa.list_(pa.string()))])
_INDEX_DDL = ("shingle long, item_id long, size int, span int, item_before array<string>, item_from array<string>")


def prefix_index(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, list[int]]:
    """The prefix shingles of ``items`` (item_id, text) by their rarity in
    ``docs`` (text), and the sizes of shingles among them."""
    cut = staged(items.where("item_id is not null and text is not null").select("item_id", "text")
                 .mapInArrow(_item_shingles(min(shingle, window)), "item_id long, words array<string>, shingles array<long>")
                 .withColumn("item", F.monotonically_increasing_id()))
    places = cut.select("item", F.posexplode("shingles").alias("at", "shingle"))
    sizes = [r.size for r in cut.select(F.expr("size(words) - size(shingles) + 1").alias("size")).distinct().collect()]  # ``shingle`` at most
    kinds = staged(places.select("shingle").distinct())
    counts = (docs.select("text").mapInArrow(_count_shingles(sorted(sizes), _bitmap(kinds)), "shingle long, n long")
              .groupBy("shingle").agg(F.sum("n").alias("n")))
    known = (places.join(counts, "shingle", "left").groupBy("item")
             .agg(F.expr("transform(sort_array(collect_list(struct(at, coalesce(n, 0L) as n))), x -> x.n)").alias("counts")))
    return staged(cut.join(known, "item").select("item_id", "words", "shingles", "counts")
                  .mapInArrow(_rarest(window), _INDEX_DDL)), sorted(sizes)


# ------------------------------------------------------------------ documents

_SCAN = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(pa.struct([
    ("shingle", pa.int64()), ("at", pa.int64()), ("before", pa.list_(pa.string())), ("here", pa.list_(pa.string()))])))])
_SCAN_DDL = ("doc_id long, n_words long, places array<struct<shingle: long, at: long, before: array<string>, "
             "here: array<string>>>")


def _scan(sizes: list[int], bitmap: np.ndarray, window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for b in batches:
            ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in batches_by_chars(texts):
                words = Words(texts[lo:hi], powers)
                first = words.first.tolist()
                places: list[list] = [[] for _ in range(lo, hi)]
                for at, shingles, n in _found(words, sizes, bitmap):
                    for i, s, t in zip(at.tolist(), shingles.tolist(), words.text_of(at).tolist()):
                        places[t].append({"shingle": s, "at": i - first[t],
                                          "before": words.words(max(first[t], i + n - window), i)[::-1],
                                          "here": words.words(i, min(first[t + 1], i + window))})
                yield pa.record_batch([pa.array(ids[lo:hi], pa.int64()), pa.array(np.diff(words.first[:hi - lo + 1])),
                                       pa.array(places, _SCAN.field(2).type)], schema=_SCAN)

    return scan


def _agreeing(a: str, b: str) -> str:
    """Number of leading elements in which two arrays agree."""
    same = f"zip_with({a}, {b}, (x, y) -> x <=> y and x is not null)"
    return f"if(array_position({same}, false) = 0, size({same}), array_position({same}, false) - 1)"


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Two frames: row, doc_id, n_words of each row of ``docs`` (doc_id, text),
    and row, item_id, begin, end of each stretch that windows of an item cover."""
    index, sizes = prefix_index(docs, items, window, shingle)
    scanned = staged(docs.select("doc_id", "text").mapInArrow(_scan(sizes, _bitmap(index.select("shingle").distinct()), window), _SCAN_DDL)
                     .withColumn("row", F.monotonically_increasing_id()))
    size = index.agg(F.expr("sum(64 + octet_length(array_join(item_before, ' ')) + octet_length(array_join(item_from, ' ')))")).first()[0]
    places = scanned.select("row", F.explode("places").alias("p")).select("row", "p.*")
    met = places.join(index.hint("broadcast" if (size or 0) <= SMALL else "merge"), "shingle")
    found = (met.withColumn("l", F.expr(_agreeing("before", "item_before")))
             .withColumn("r", F.expr(_agreeing("here", "item_from")))
             .where("r >= size and l + r >= span")
             .select("row", "item_id", F.expr("at - l").alias("begin"), F.expr("at + r").alias("end")).distinct())
    return scanned.select("row", "doc_id", "n_words"), found


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated.  ``items`` has item_id and text."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows, found = occurrences(source, asked, window, shingle)
    hits = (found.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"),  # of one text
                                     F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
            .select("row", "ids", F.expr("aggregate(spans, struct(0L as hit, 0L as upto), (s, x) -> struct("
                                         "s.hit + greatest(0L, x.end - greatest(x.begin, s.upto)) as hit, "
                                         "greatest(s.upto, x.end) as upto), s -> s.hit)").alias("n_hit")))
    return (rows.join(hits, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.expr("cast(coalesce(size(ids), 0) as long)").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_WORDS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
#: Every window of every item against all stretches of as many words.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
items AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, span, array_to_string(w[i:i + span - 1], ' ') AS words
  FROM (SELECT item_id, w, least(len(w), 10) AS span, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT row, i, span, array_to_string(w[i:i + span - 1], ' ') AS words
  FROM (SELECT row, w, span, unnest(range(1, len(w) - span + 2)) AS i FROM d, (SELECT DISTINCT span FROM windows) WHERE len(w) >= span)),
hits AS (SELECT p.row, p.i, p.span, x.item_id FROM places p JOIN windows x ON p.span = x.span AND p.words = x.words),
hit_words AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + span)) AS place FROM hits) GROUP BY row),
hit_items AS (
  SELECT row, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hw.n, 0) AS n_hit, coalesce(hi.n, 0) AS n_items,
       sha256(coalesce(hi.ids, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words hw USING (row) LEFT JOIN hit_items hi USING (row)
"""
