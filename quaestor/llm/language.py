"""Language identification with segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary.  Training counts, for each
language, the pieces into which the vocabulary's own tokenizer cuts a bounded
sample of labelled texts, and smooths them to probabilities.  A word's
probability in a language is the sum over all its segmentations into pieces
(forward algorithm over the word's characters, all languages and many words at
once); a text's is the product over its words.  The language of the largest
probability wins, and the score is its share among the learned languages.

That share is near 1 for any text of some length, also for one in a language
that was not learned.  So ``accepted_rows`` asks for more: the text's gain, its
log probability in the winning language over that under a background where all
pieces are equally likely, per character, which does not grow with the length.
It must be at least ``least_gain`` of what the language's training texts gain.

All normal pieces of the vocabulary count, and a word of any length is scored
whole: what the last characters' sums have in common moves to a logarithm as
they get small.  A character outside the vocabulary has probability ``UNKNOWN``
in every language.

Cases: a null text and one without a letter give ``und`` and score 0; equal
probabilities go to the alphabetically first language; without any labelled
training text every text is ``und``; repeated rows each give their row; an
empty table gives none.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import batches_by_chars, table
from quaestor.llm.tokens import public_path

UNKNOWN, SMOOTHING = 1e-7, 0.1
#: Bound of the training sample: about so many labelled documents a language,
#: each read whole, in slices of about so many characters.
TRAIN_DOCS, SLICE_CHARS = 1000, 20_000
SPACE = "▁"  # the vocabulary's mark of a word's start
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 21
_SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_MODELS: dict = {}


def held_out(doc_id):
    """crc32 of the doc_id as text, modulo 4, is 2 (a column; null for null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


class Model:
    """Piece probabilities by language, and scores of texts."""

    #: Words whose scores are kept, and characters that are looked up at once.
    CACHED, AT_ONCE = 200_000, 150_000

    def __init__(self, languages: list[str], pieces: list[str], probabilities: np.ndarray,
                 usual: np.ndarray | None = None):
        """``usual``: gain of each language's training texts."""
        self.languages, self.probabilities = languages, probabilities
        self.usual = np.zeros(len(languages)) if usual is None else usual
        # the background is one column more than the languages
        self._columns = np.hstack([probabilities, np.full((len(pieces), 1), 1 / max(len(pieces), 1))])
        self.hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self._longest = max(map(len, pieces), default=1)
        self._index: dict[str, int] = {}
        self._scores = np.zeros((0, len(languages) + 1))
        self._table = None

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
        return h

    @staticmethod
    def _slot(h: int) -> int:
        return (h * int(_BASE)) % (1 << 64) >> (64 - _SLOT_BITS)

    def _slots(self) -> np.ndarray:
        """Open-addressed table from hash to row of the probabilities; the last
        row is that of no piece."""
        if self._table is None:
            size, none = 1 << _SLOT_BITS, len(self.hashes)
            keys, rows = np.zeros(size, np.uint64), np.full(size, none, np.int32)
            for row, h in enumerate(self.hashes.tolist()):
                at = self._slot(h)
                while rows[at] != none:
                    at = (at + 1) % size
                keys[at], rows[at] = h, row
            self._probes = 1
            for h in self.hashes.tolist():
                at, n = self._slot(h), 1
                while keys[at] != h:
                    at, n = (at + 1) % size, n + 1
                self._probes = max(self._probes, n)
            self._keys, self._table = keys, rows
            self._rows = np.vstack([self._columns, np.zeros((1, self._columns.shape[1]))])
        return self._table

    def _lookup(self, h: np.ndarray) -> np.ndarray:
        rows = self._slots()
        at = ((h * _BASE) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        out = np.where(self._keys[at] == h, rows[at], len(self.hashes))
        for n in range(1, self._probes):
            near = (at + n) & (len(rows) - 1)
            out = np.where((out == len(self.hashes)) & (self._keys[near] == h), rows[near], out)
        return out

    def _words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language and the background."""
        out = np.empty((len(words), self._columns.shape[1]))
        lengths = np.array([len(w) for w in words])
        # up to 32 characters by length, longer ones with others of up to twice theirs
        groups = np.where(lengths <= 32, lengths, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        for group in np.unique(groups).tolist():
            who = np.flatnonzero(groups == group)
            at_once = max(1, self.AT_ONCE // group)
            for lo in range(0, len(who), at_once):
                part = who[lo:lo + at_once]
                out[part] = self._forward([words[i] for i in part.tolist()], lengths[part])
        return out

    def _forward(self, words: list[str], lengths: np.ndarray) -> np.ndarray:
        n, columns = int(lengths.max()), self._columns.shape[1]
        codes = np.frombuffer("".join(w.ljust(n, "\0") for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = codes.reshape(len(words), n).astype(np.uint64) + np.uint64(1)
        out, scale = np.empty((len(words), columns)), np.zeros((len(words), columns))
        forward, step = deque([np.ones((len(words), columns))], self._longest), max(1, self.AT_ONCE // len(words))
        for begin in range(0, n, step):
            first = max(0, begin - self._longest + 1)
            found = self._found(codes[:, first:begin + step])
            for end in range(begin, min(begin + step, n)):
                total = forward[-1] * np.maximum(self._rows[found[0][0][:, end - first]], UNKNOWN)
                for length in range(2, min(len(found), end + 1) + 1):
                    rows, matched = found[length - 1]
                    at = end - first + 1 - length
                    if matched[at]:
                        total += forward[-length] * self._rows[rows[:, at]]
                if total.min() < 1e-100:
                    forward = deque([f / total for f in forward], self._longest)
                    scale += np.log(total)
                    total = np.ones_like(total)
                forward.append(total)
                done = lengths == end + 1
                if done.any():
                    out[done] = np.log(total[done]) + scale[done]
        return out

    def _found(self, codes: np.ndarray) -> list[tuple[np.ndarray, bytes]]:
        """For each length, rows of the pieces that begin at each character, and
        whether any does."""
        self._slots()
        h, out = np.zeros_like(codes), []
        for length in range(1, min(self._longest, codes.shape[1]) + 1):
            h = h[:, :codes.shape[1] - length + 1] * _BASE + codes[:, length - 1:]
            rows = self._lookup(h)
            out.append((rows, (rows != len(self.hashes)).any(axis=0).tobytes()))
        return out

    def _learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self._index]
        if not fresh:
            return
        if len(self._index) > self.CACHED:
            self._index, self._scores = {}, self._scores[:0]
            fresh = list(words)
        for w, i in zip(fresh, range(len(self._index), len(self._index) + len(fresh))):
            self._index[w] = i
        self._scores = np.vstack([self._scores, self._words([SPACE + w for w in fresh])])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        return [(lang, score) for lang, score, _ in self.judge(texts)]

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, score and gain (as a share of the language's usual one, or
        as it is where that is not positive) of each text."""
        split = [(t or "").split() if _has_letter(t) else None for t in texts]
        self._learn(set().union(*[ws for ws in split if ws is not None]))
        out = []
        for words in split:
            if words is None or not self.languages:
                out.append(("und", 0.0, 0.0))
                continue
            *total, background = self._scores[np.fromiter(map(self._index.__getitem__, words), np.int64, len(words))].sum(axis=0)
            share, best = np.exp(np.array(total) - max(total)), int(np.argmax(total))
            gain = (total[best] - background) / (len(words) + sum(map(len, words)))
            out.append((self.languages[best], float(share.max() / share.sum()),
                        float(gain / self.usual[best] if self.usual[best] > 0 else gain)))
        return out


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """``text`` cut at single blanks, where no piece goes across."""
    at = 0
    while cut := _SINGLE_BLANK.search(text, at + size):
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def _count_pieces(vocabulary: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        found: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(i for part in _slices(text) for i in sp.encode(part))
        rows = [(lang, piece, n) for lang, c in found.items() for piece, n in c.items()]
        yield pa.record_batch([pa.array([r[i] for r in rows], t)
                               for i, t in enumerate((pa.string(), pa.int32(), pa.int64()))], names=["lang", "piece", "n"])

    return count


def train(labelled: DataFrame, vocabulary: str | None = None, docs_per_language: int = TRAIN_DOCS) -> Model:
    """``labelled``: doc_id, text, lang.  Counts of pieces come to the driver:
    languages times vocabulary at most."""
    import sentencepiece

    vocabulary = vocabulary or public_path("piece_bpe_32k.model")
    known = labelled.where("text is not null and lang is not null")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    fit = [i for i, p in enumerate(pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    counts = np.zeros((len(pieces), len(languages)))
    if languages:
        share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, docs_per_language / sizes[k])))])
        sample = known.where((F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)) < share[F.col("lang")])
        for r in (sample.select("lang", "text").mapInArrow(_count_pieces(vocabulary), "lang string, piece int, n long")
                  .groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()):
            counts[r.piece, languages.index(r.lang)] += r.n
    kept = counts[fit] + SMOOTHING
    probabilities, lengths = kept / kept.sum(axis=0, keepdims=True), np.array([len(pieces[i]) for i in fit])
    usual = (counts[fit] * np.log(probabilities * len(fit))).sum(axis=0) / np.maximum(lengths @ counts[fit], 1)
    return Model(languages, [pieces[i] for i in fit], probabilities, usual)


def _model(sent, key: int) -> Model:
    """The process's copy of the model, with the words it has scored so far."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = sent.value
    return _MODELS[key]


def _predict(sent, key: int):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent, key)
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            for lo, hi in batches_by_chars([t or "" for t in texts]):
                said = model.predict(texts[lo:hi])
                part = b.slice(lo, hi - lo)
                yield pa.record_batch([*part.columns[:-1], pa.array([x for x, _ in said], pa.string()),
                                       pa.array([x for _, x in said], pa.float64())],
                                      names=[*b.schema.names[:-1], "lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every document, with lang_pred and score."""
    source = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x vocabulary
    key = zlib.crc32(model.probabilities.tobytes())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(_predict(sent, key), f"{fields}{', ' if fields else ''}lang_pred string, score double")


def accepted_rows(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text",
                  least_gain: float = 0.5) -> DataFrame:
    """The documents with a language (not ``und``) whose score is at least
    ``least`` and whose gain is at least ``least_gain`` of the language's usual
    one, with their own columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x vocabulary
    key, at = zlib.crc32(model.probabilities.tobytes()), docs.columns.index(text_col)

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent, key)
        for b in batches:
            texts = b.column(at).to_pylist()
            for lo, hi in batches_by_chars([t or "" for t in texts]):
                said = model.judge(texts[lo:hi])
                yield b.slice(lo, hi - lo).filter(
                    pa.array([x != "und" and s >= least and g >= least_gain for x, s, g in said], pa.bool_()))

    return docs.mapInArrow(accepted, docs.schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Labelled documents that are not held out."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
            .where(~F.coalesce(held_out("doc_id"), F.lit(False))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = identify(docs, train(training_rows(docs)), ["doc_id"])
    return told.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score")
