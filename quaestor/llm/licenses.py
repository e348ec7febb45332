"""License scans: exact set-similarity join of text blocks with templates.

A block is ``block_words`` words of a text, blocks overlap by half, so a passage
of up to half a block lies whole in one.  A block matches a template if it holds
at least ``containment`` of the template's distinct words.

Words of all templates are counted over all blocks of the corpus (documents'
blocks holding the word) and ordered from rare to frequent.  With o words
needed of a template of n, one of its n - o + 1 rarest words must stand in the
block (prefix filter), the block must hold o template words at all (length
filter), and from the matching word on both must have enough words left
(positional filter).  What passes is verified by counting.  The templates are a
parameter, so the join's small side has as many rows as they have words, and
blocks that hold no rare template word never leave the scan.

Cases: a null text counts as empty; texts without words have n_words 0, null
places, no labels, score 0; every row, repeated or not, gives its row.
"""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import batches_by_chars, table

#: Phrases whose consecutive words are a base label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Short notices as they stand in files; label and text, a parameter of the scan.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with "
               "the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    ("cc-by", "This work is licensed under CC BY 4.0, a Creative Commons Attribution International License"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without prior written "
                    "permission"),
]

#: Bytes of UTF-8 that are no part of a word, as blanks; those of code points
#: beyond ASCII all are.
_BLANKED = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().translate(_BLANKED).split()


def _block_words(words: list[bytes], vocabulary, size: int) -> dict[int, set[bytes]]:
    """The ``vocabulary`` words of each block that has any, by block number.
    Block i begins at word i * size / 2; the last full or partial one ends the
    text."""
    step = size // 2
    last = max(0, -(-len(words) // step) - 2)
    out: dict[int, set[bytes]] = {}
    for at, w in enumerate(words):
        if w in vocabulary:
            for i in {min(at // step, last), max(0, min(at // step - 1, last))}:
                if i * step <= at < i * step + size:
                    out.setdefault(i, set()).add(w)
    return out


def _phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, int, str]]:
    """(first word, last word, label) of every place of every phrase."""
    line, found = b" %s " % b" ".join(words), []
    for phrase, label in phrases.items():
        look, n = f" {phrase} ".encode(), len(phrase.split())
        at = line.find(look)
        while at >= 0:
            first = line.count(b" ", 0, at)
            found.append((first, first + n - 1, label))
            at = line.find(look, at + 1)
    return found


def _count_words(vocabulary: frozenset[bytes], size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = dict.fromkeys(vocabulary, 0)
        for b in batches:
            for text in b.column(0):
                for held in _block_words(words_of(text.as_py() or ""), vocabulary, size).values():
                    for w in held:
                        n[w] += 1
        yield pa.record_batch([pa.array([w.decode() for w in n], pa.string()), pa.array(list(n.values()), pa.int64())],
                              names=["word", "n"])

    return count


_SCAN = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                   ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
                   ("blocks", pa.list_(pa.struct([("first", pa.int64()), ("ranks", pa.list_(pa.int32()))])))])
_SCAN_DDL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
             "blocks array<struct<first: long, ranks: array<int>>>")


def _scan(rank: dict[bytes, int], prefix: frozenset[bytes], least: int, size: int, phrases: dict[str, str]):
    """Base columns of each text, and its blocks that can match a template: the
    ranks of the template words they hold, rare ones first."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in batches_by_chars(texts):
                rows = []
                for doc_id, text in zip(ids[lo:hi], texts[lo:hi]):
                    words = words_of(text)
                    places, kept = _phrase_places(words, phrases), []
                    if not prefix.isdisjoint(words):
                        for i, held in sorted(_block_words(words, rank, size).items()):
                            if len(held) >= least and not prefix.isdisjoint(held):
                                kept.append({"first": i * (size // 2), "ranks": sorted(rank[w] for w in held)})
                    starts = [p[0] for p in places]
                    rows.append({"doc_id": doc_id, "n_words": len(words), "n_base": len(places),
                                 "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                                 "base_labels": sorted({p[2] for p in places}), "blocks": kept})
                yield pa.RecordBatch.from_pylist(rows, schema=_SCAN)

    return scan


def _plan(docs: DataFrame, templates, containment: float, block_words: int):
    """Global order of the templates' words and the prefix index on it."""
    for label, text in templates:
        if len(words_of(text)) > block_words // 2:
            raise ValueError(f"a template of {label} has more words than half a block of {block_words}; give larger blocks")
    sets = [(label, set(words_of(text))) for label, text in templates]
    vocabulary = frozenset().union(*(s for _, s in sets))
    counts = (docs.select("text").mapInArrow(_count_words(vocabulary, block_words), "word string, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).collect())  # a row for each template word
    n = {r.word.encode(): r.n for r in counts}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (n.get(w, 0), w)))}
    index, least = [], len(vocabulary)
    for number, (label, words) in enumerate(sets):
        ranks = sorted(rank[w] for w in words)
        need = max(1, -int(-containment * len(ranks) // 1))
        least = min(least, need)
        index += [(rank_, number, label, at, need, ranks) for at, rank_ in enumerate(ranks[:len(ranks) - need + 1])]
    return rank, index, least


def matches(docs: DataFrame, templates=TEMPLATES, containment: float = 0.8, block_words: int = 64,
            phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per document and matching block and template (or one with null
    template): row, the base columns, block_first, template, label, containment."""
    spark = docs.sparkSession
    rank, index, least = _plan(docs, templates, containment, block_words)
    by_rank = {i: w for w, i in rank.items()}
    prefix = frozenset(by_rank[r[0]] for r in index)
    small = spark.createDataFrame(index, "rank int, template int, label string, at int, need int, ranks array<int>")
    scanned = docs.select("doc_id", "text").mapInArrow(
        _scan(rank, prefix, least, block_words, PHRASES if phrases is None else phrases), _SCAN_DDL)
    base = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    probes = (scanned.withColumn("row", F.monotonically_increasing_id())
              .select(*base, F.explode_outer("blocks").alias("block"))
              .select(*base, F.col("block.first").alias("block_first"), F.col("block.ranks").alias("held"))
              .select(*base, "block_first", "held", F.posexplode_outer("held").alias("held_at", "rank")))
    return (probes.join(F.broadcast(small), "rank", "left")
            .withColumn("possible", F.expr(
                "size(held) >= need and 1 + least(size(ranks) - at - 1, size(held) - held_at - 1) >= need"))
            .withColumn("common", F.expr("if(possible, size(array_intersect(held, ranks)), 0)"))
            .withColumn("hit", F.expr("coalesce(common >= need, false)"))
            .select(*base, *[F.expr(f"if(hit, {c}, null) as {c}") for c in ("block_first", "template", "label")],
                    F.expr("if(hit, common / size(ranks), null) as containment")))


def scan(docs: DataFrame, templates=TEMPLATES, containment: float = 0.8, block_words: int = 64,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (largest containment found, 1 at a base phrase)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = matches(source, templates, containment, block_words)
    firsts = [F.first(c).alias(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")]
    one = found.groupBy("row").agg(*firsts, F.collect_set("label").alias("added"), F.max("containment").alias("best"))
    return one.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", "added")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
