"""Packing: bounded-space online packing of documents into token sequences.

Every scan partition packs its own documents with a fixed number of open
windows.  A document's ids (closed by the end id) go to the open window with
the least room that still holds them (best fit); when none does, the fullest
window is filled with the document's head, emitted, and the rest goes on.  At
the end of a partition at most ``open_windows`` windows are left; those pieces
travel with their ids and are merged in groups of ``fan_in`` partitions, level
by level, each group joining its leftovers end to end and cutting at the window
size, so one window a group goes on and a single one may end short.

Memory per task: the open windows, one Arrow batch and the encoder's cache.
The first level is written to the shared folder before it is merged, so the
numbering survives lost executors.

Cases: a null text counts as empty and is the end id alone; an empty table
gives no rows; documents longer than a window are cut at the window size;
repeated rows (and null doc_ids) are packed once for each row.
"""

from __future__ import annotations

import zlib
from typing import Iterator, Tuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import batches_by_chars, staged, table
from quaestor.llm.tokens import loaded, public_path

WINDOW = 2048
_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
           ("part", pa.int64()), ("open", pa.bool_())]
SCHEMA = pa.schema(_FIELDS)
DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
       "ids binary, part long, open boolean")


class _Rows:
    """Collects piece rows column by column."""

    def __init__(self):
        self.cols = [[] for _ in _FIELDS]

    def add(self, *values):
        for c, v in zip(self.cols, values):
            c.append(v)

    def __len__(self):
        return len(self.cols[0])

    def batch(self) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(self.cols, SCHEMA)], schema=SCHEMA)
        self.__init__()
        return out


class _Window:
    __slots__ = ("pieces", "used")

    def __init__(self):
        self.pieces, self.used = [], 0

    def put(self, doc_id, start, ids, doc_tokens):
        self.pieces.append((doc_id, start, ids, doc_tokens))
        self.used += len(ids) // 4


def _emit(rows: _Rows, w: _Window, number: int, part: int, is_open: bool, with_ids: bool) -> None:
    at = 0
    for doc_id, start, ids, total in w.pieces:
        rows.add(doc_id, start, len(ids) // 4, zlib.crc32(ids), total, number, at,
                 ids if is_open or with_ids else None, part, is_open)
        at += len(ids) // 4


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int, open_windows: int,
                    with_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = loaded(path, "word")
    end = end_id.to_bytes(4, "little")
    part = TaskContext.get().partitionId()
    number = part << 32
    windows: list[_Window] = []
    rows = _Rows()

    for b in batches:
        doc_ids = b.column(0).to_pylist()
        texts = [t or "" for t in b.column(1).to_pylist()]
        for lo, hi in batches_by_chars(texts, 8_000_000):
            for doc_id, ids in zip(doc_ids[lo:hi], enc.encode(texts[lo:hi])):
                ids += end
                total, start = len(ids) // 4, 0
                while start < total:
                    left = total - start
                    if left >= size:
                        fit = _Window()
                        windows.append(fit)
                        take = size
                    else:
                        fit = max((w for w in windows if w.used + left <= size), key=lambda w: w.used, default=None)
                        take = left
                        if fit is None and len(windows) < open_windows:
                            fit = _Window()
                            windows.append(fit)
                        elif fit is None:
                            fit = max(windows, key=lambda w: w.used)
                            take = size - fit.used
                    fit.put(doc_id, start, ids[4 * start:4 * (start + take)], total)
                    start += take
                    if fit.used == size:
                        windows.remove(fit)
                        _emit(rows, fit, number, part, False, with_ids)
                        number += 1
            if len(rows) > 20_000:
                yield rows.batch()
    for w in windows:
        _emit(rows, w, number, part, True, with_ids)
        number += 1
    if len(rows):
        yield rows.batch()


def _merge_group(level: int, size: int, last: bool, with_ids: bool):
    """Joins a group's leftovers end to end; a window that stays short is left
    open unless this is the last level."""

    def merge(key: Tuple[pa.Scalar, ...], pieces: pa.Table) -> pa.Table:
        group = key[0].as_py()
        number = (level << 56) + (group << 32)
        rows, w = _Rows(), _Window()
        d = pieces.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pydict()
        for doc_id, start, ids, total in zip(d["doc_id"], d["start"], d["ids"], d["doc_tokens"]):
            at = 0
            while at < len(ids):
                head = ids[at:at + 4 * (size - w.used)]
                w.put(doc_id, start + at // 4, head, total)
                at += len(head)
                if w.used == size:
                    _emit(rows, w, number, group, False, with_ids)
                    number += 1
                    w = _Window()
        if w.used:
            _emit(rows, w, number, group, not last, with_ids)
        return pa.Table.from_batches([rows.batch()])

    return merge


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, size: int = WINDOW, open_windows: int = 32,
         fan_in: int = 64, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, ``with_ids``, the piece's ids (little-endian
    unsigned 32-bit)."""
    path = tokenizer or public_path("word_bpe_49k.json")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = staged(source.mapInArrow(
        lambda it: _pack_partition(it, path, end_id, size, open_windows, with_ids), DDL))
    out, left = first.where("not open"), first.where("open")
    groups = (first.agg(F.max("part")).first()[0] or 0) + 1
    level = 1
    while True:
        last = groups <= fan_in
        merged = (left.withColumn("part", F.expr(f"part div {fan_in}"))
                  .groupBy("part").applyInArrow(_merge_group(level, size, last, with_ids), DDL))
        if last:
            out = out.unionByName(merged)
            break
        merged = staged(merged)
        out, left = out.unionByName(merged.where("not open")), merged.where("open")
        groups, level = -(-groups // fan_in), level + 1
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                      *["ids"] * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
