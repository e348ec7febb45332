"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over ``WINDOW`` characters cuts texts where their content says
so, hence copies, near copies and passages that documents share fall into the
same chunks wherever they stand.  A chunk that occurs more than once is encoded
once, in the document that owns it; every other document takes its ids by a
join.  Runs of chunks that nobody shares are one chunk.  Ids of neighbouring
chunks are then joined: the text around the joint is encoded anew, from a word
start on the left to one on the right, wider and wider until its two halves
agree exactly with what the chunks hold there.

Passes: (1) chunk digests of every document; (2) count by digest (partial sums
before the shuffle) and an owner for each that repeats; (3) a scan that finishes
documents without shared chunks and sets the others aside, zstd-compressed: a
bitmap of fixed size, which errs only towards setting aside, tells them apart;
(4) owners encode their chunks; (5) the documents set aside meet their chunks'
ids.  A chunk in a third of all documents is one row on one side of a sort-merge
join whose other side Spark splits.

Cases: a null text counts as empty (no ids; the digests of nothing); repeated
rows and null doc_ids each give their row; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import batches_by_chars, staged, table
from quaestor.llm.tokens import PieceEncoder, loaded, public_path

WINDOW, SHORTEST, MEAN_BITS, LONGEST = 16, 256, 9, 8192
_BASE = 0x9E3779B97F4A7C15
_WORD_START = re.compile(r" (?=\S)")
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE and its inverse modulo 2**64 to the powers 0 to n."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(1 << 16, 2 * n)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def chunk_ends(text: str) -> list[int]:
    """Where the chunks of ``text`` end, in characters; the last is its length."""
    n = len(text)
    if n <= SHORTEST:
        return [n] if n else []
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(0x1234567)
    up, down = _powers(n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[:n], dtype=np.uint64)])
    rolling = (total[WINDOW:] - total[:-WINDOW]) * down[:n - WINDOW + 1]
    ends, last = [], 0
    for at in (np.flatnonzero(rolling >> np.uint64(64 - MEAN_BITS) == 0) + WINDOW).tolist():
        while at - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if at - last >= SHORTEST and n - at >= SHORTEST:
            ends.append(at)
            last = at
    while n - last > LONGEST:
        last += LONGEST
        ends.append(last)
    return [*ends, n] if last < n else ends


def _key(doc_id, text: str) -> bytes:
    return hashlib.blake2b(f"{doc_id}\0{text}".encode(), digest_size=16).digest()


def _rows(batches: Iterator[pa.RecordBatch], limit: int = 1_000_000) -> Iterator[list[tuple]]:
    """(doc_id, text) of about ``limit`` characters at a time."""
    for b in batches:
        ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
        for lo, hi in batches_by_chars(texts, limit):
            yield list(zip(ids[lo:hi], texts[lo:hi]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _rows(batches):
        keys, hashes = [], []
        for doc_id, text in rows:
            keys.append(_key(doc_id, text))
            starts = [0, *(ends := chunk_ends(text))]
            hashes.append([hashlib.blake2b(text[a:b].encode(), digest_size=16).digest() for a, b in zip(starts, ends)])
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(hashes, pa.list_(pa.binary()))],
                              names=["doc_key", "hashes"])


def _texts(payloads: list[bytes]) -> list[str]:
    import zstandard

    z = zstandard.ZstdDecompressor()
    return [z.decompress(p).decode() for p in payloads]


_STEP = pa.schema([("doc_key", pa.binary()), ("doc_id", pa.int64()), ("payload", pa.binary()), ("n_tokens", pa.int64()),
                   ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.binary()),
                   ("decoded", pa.string())])
_STEP_DDL = ("doc_key binary, doc_id long, payload binary, n_tokens long, ids_sha256 string, decoded_sha256 string, "
             "ids binary, decoded string")
#: Bits of the bitmap of documents with shared chunks (8 MB), and of one row of it.
_BITMAP, _ROW = 1 << 26, 1 << 15


def _bit(key: bytes) -> int:
    return int.from_bytes(key[:4], "big") % _BITMAP


def _finished(enc: PieceEncoder, doc_id, ids: bytes, whole: bool) -> dict:
    decoded = enc.decode(ids)
    return {"doc_id": doc_id, "n_tokens": len(ids) // 4,
            "ids_sha256": hashlib.sha256(ids).hexdigest(),
            "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
            "ids": ids if whole else None, "decoded": decoded if whole else None}


def _whole_step(path: str, bitmap, whole: bool):
    """Finishes documents that share nothing; the others' texts go on."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, z, marked = loaded(path, "byte"), zstandard.ZstdCompressor(level=3), bitmap.value
        for rows in _rows(batches, 8_000_000):
            keys = [_key(*r) for r in rows]
            aside = [bool(marked[_bit(k) // 8] >> _bit(k) % 8 & 1) for k in keys]
            alone = [r for r, a in zip(rows, aside) if not a]
            out = [_finished(enc, doc_id, ids, whole) for (doc_id, _), ids in zip(alone, enc.encode([t for _, t in alone]))]
            out += [{"doc_key": k, "doc_id": r[0], "payload": z.compress(r[1].encode())}
                    for k, r, a in zip(keys, rows, aside) if a]
            yield pa.RecordBatch.from_pylist(out, schema=_STEP)

    return step


def _chunk_step(path: str):
    """ids of the chunks that a document owns, each encoded by itself."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = loaded(path, "byte")
        for b in batches:
            for lo in range(0, b.num_rows, 4000):
                part = b.slice(lo, 4000).to_pydict()
                hashes, chunks = [], []
                for text, own in zip(_texts(part["payload"]), part["own"]):
                    starts = [0, *(ends := chunk_ends(text))]
                    for s in own:
                        hashes.append(s["hash"])
                        chunks.append(text[starts[s["pos"]]:ends[s["pos"]]])
                yield pa.record_batch([pa.array(hashes, pa.binary()),
                                       pa.array([_narrow(ids) for ids in enc.encode(chunks)], pa.binary())],
                                      names=["hash", "ids"])

    return step


def _narrow(ids: bytes) -> bytes:
    """16-bit ids where all fit, told apart by a first byte."""
    a = np.frombuffer(ids, "<u4")
    return b"\2" + a.astype("<u2").tobytes() if not len(a) or a.max() < 1 << 16 else b"\4" + ids


def _widen(ids: bytes) -> bytes:
    return np.frombuffer(ids, "<u2", offset=1).astype("<u4").tobytes() if ids[0] == 2 else ids[1:]


def _agreed_tail(enc: PieceEncoder, text: str, start: int, end: int, ids: bytes) -> tuple[int, int]:
    """The last word start in text[start:end] behind which a new encoding is
    what ``ids`` end with, and the bytes before it; ``start`` and 0 if none."""
    cuts = [m.start() for m in _WORD_START.finditer(text, max(start, end - 256), end) if m.start() > start]
    if not cuts:
        cuts = [m.start() for m in _WORD_START.finditer(text, start, end) if m.start() > start]
    for p in reversed(cuts):
        tail = enc.one(text[p:end])
        if ids.endswith(tail) and tail:
            return p, len(ids) - len(tail)
    return start, 0


def _agreed_head(enc: PieceEncoder, text: str, start: int, end: int, ids: bytes) -> tuple[int, int]:
    """The first word start in text[start:end] before which a new encoding is
    what ``ids`` begin with, and its bytes; ``end`` and all if none."""
    for m in _WORD_START.finditer(text, start, end):
        if (r := m.start()) > start and r + 1 < end:
            head = enc.one(text[start:r])
            if ids.startswith(head):
                return r, len(head)
    return end, len(ids)


def joined(enc: PieceEncoder, text: str, parts: list[tuple[int, int, bytes]]) -> bytes:
    """ids of ``text`` from those of its consecutive parts (start, end, ids)."""
    if not parts:
        return b""
    out = []
    start, end, ids = parts[0]
    for nxt_start, nxt_end, nxt in parts[1:]:
        p, keep = _agreed_tail(enc, text, start, end, ids)
        r, skip = _agreed_head(enc, text, nxt_start, nxt_end, nxt)
        out.append(ids[:keep])
        middle = enc.one(text[p:r])
        if r < nxt_end:
            out.append(middle)
            start, ids = r, nxt[skip:]
        else:
            start, ids = p, middle
        end = nxt_end
    return b"".join([*out, ids])


def _join_step(path: str, whole: bool):
    """Documents from their shared chunks' ids and the rest, encoded here."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = loaded(path, "byte")
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000).to_pydict()
                texts, plans, rest = _texts(part["payload"]), [], []
                for text, chunks in zip(texts, part["chunks"]):
                    known = {c["pos"]: c["ids"] for c in chunks or ()}
                    ends = chunk_ends(text)
                    parts, start = [], 0
                    for pos, end in enumerate(ends):
                        if pos in known:
                            begin = ends[pos - 1] if pos else 0
                            if start < begin:
                                parts.append((start, begin, None))
                            parts.append((begin, end, known[pos]))
                            start = end
                    if start < len(text):
                        parts.append((start, len(text), None))
                    rest += [text[x:y] for x, y, ids in parts if ids is None]
                    plans.append(parts)
                fresh = iter([ids for x, y in batches_by_chars(rest, 8_000_000) for ids in enc.encode(rest[x:y])])
                out = [_finished(enc, doc_id, joined(enc, text, [
                    (x, y, next(fresh) if ids is None else _widen(ids)) for x, y, ids in parts]), whole)
                    for doc_id, text, parts in zip(part["doc_id"], texts, plans)]
                yield pa.RecordBatch.from_pylist(out, schema=_STEP)

    return step


def encode_decode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                  whole: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, ``whole``, ids
    (little-endian unsigned 32-bit) and the decoded text."""
    path = tokenizer or public_path("byte_bpe_50k.json")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    digests = staged(source.mapInArrow(_digests, "doc_key binary, hashes array<binary>"))
    found = digests.select("doc_key", F.posexplode("hashes").alias("pos", "hash"))
    shared = staged(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"),
                                              F.min(F.struct("doc_key", "pos")).alias("owner")).where("n > 1").drop("n"))
    info = staged(found.join(shared.hint("merge"), "hash")
                  .withColumn("own", (F.col("owner.doc_key") == F.col("doc_key")) & (F.col("owner.pos") == F.col("pos")))
                  .groupBy("doc_key").agg(F.collect_set(F.struct("pos", "hash", "own")).alias("shared")))
    bit = F.expr(f"cast(conv(hex(substring(doc_key, 1, 4)), 16, 10) as bigint) % {_BITMAP}") + 1
    bits = bytearray(_BITMAP // 8)
    for r in (info.groupBy(F.bitmap_bucket_number(bit).alias("at"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()):  # the bitmap, 8 MB
        bits[(r["at"] - 1) * _ROW // 8:r["at"] * _ROW // 8] = r["bits"]
    bitmap = docs.sparkSession.sparkContext.broadcast(bytes(bits))
    seen = staged(source.mapInArrow(_whole_step(path, bitmap, whole), _STEP_DDL))
    aside = seen.where("payload is not null").select("doc_key", "doc_id", "payload")
    own = (info.select("doc_key", F.expr("filter(shared, s -> s.own)").alias("own")).where("size(own) > 0").hint("merge"))
    chunks = staged(aside.join(own, "doc_key").select("payload", "own")
                    .mapInArrow(_chunk_step(path), "hash binary, ids binary").dropDuplicates(["hash"]))
    wanted = (info.select("doc_key", F.explode("shared").alias("s")).select("doc_key", "s.pos", "s.hash")
              .join(chunks.hint("merge"), "hash")
              .groupBy("doc_key").agg(F.collect_list(F.struct("pos", "ids")).alias("chunks")))
    rest = (aside.join(wanted.hint("merge"), "doc_key", "left").select("doc_id", "payload", "chunks")
            .mapInArrow(_join_step(path, whole), _STEP_DDL))
    return seen.where("payload is null").unionByName(rest).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * whole)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), whole=False)
