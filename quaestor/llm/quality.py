r"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

A rule is a few column steps and a condition that rejects.  On a bounded sample
the cascade measures each rule's time and the share of texts it rejects, and
orders the rules by rejections per second.  A text that a rule rejects is not
looked at by the later ones: their steps are null for it.  The order changes
only the work: a text is kept if no rule rejects it.

Words are runs of other characters than space and \x09-\x0D; a repeated word
lies in a window of three words that stands twice or more in the text.  Windows
are found without a shuffle: each window's hash and place are packed into one
long, the longs are sorted, and only windows whose neighbour has the same hash
are compared word by word.

Cases: a null text has no words and is rejected as too short, like an empty or
blank one; repeated rows each give their row; an empty table gives none;
columns of the input keep their names, those of the rules begin with ``_q_``.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import table

#: Bound of the sample on which the rules' order is measured.
SAMPLE_ROWS = 1000

_BLANKS = r"' \t\n\u000B\u000C\r'"
_PLACES = 1 << 24  # places that fit beside a hash in one long

#: Columns and how they follow from ``_q_text`` and earlier ones.
STEPS = {
    "_q_trimmed": f"trim(BOTH {_BLANKS} FROM _q_text)",
    "_q_words": r"if(_q_trimmed = '', array(), split(_q_trimmed, '[ \\t-\\r]+'))",
    "n_words": "cast(size(_q_words) as bigint)",
    "word_chars": f"cast(length(translate(_q_text, {_BLANKS}, '')) as bigint)",
    "n_symbols": "cast(length(_q_text) - length(translate(_q_text, '#*$%&|<>', '')) as bigint)",
    "_q_lines": f"filter(split(_q_text, '\\n'), x -> translate(x, {_BLANKS}, '') != '')",
    "n_dup_lines": "cast(size(_q_lines) - size(array_distinct(_q_lines)) as bigint)",
    "_q_packed": "sort_array(if(n_words < 4, array(), transform(sequence(0, cast(n_words as int) - 3), "
                 "i -> shiftleft(xxhash64(_q_words[i], _q_words[i + 1], _q_words[i + 2]), 24) | (i & 16777215))))",
    # places of windows whose sorted neighbour has the same hash bits
    "_q_alike": f"if(n_words > {_PLACES}, sequence(0, cast(n_words as int) - 3), transform(filter(_q_packed, (x, i) -> "
                "(i > 0 and shiftright(_q_packed[i - 1], 24) = shiftright(x, 24)) or "
                "(i < size(_q_packed) - 1 and shiftright(_q_packed[i + 1], 24) = shiftright(x, 24))), "
                "x -> cast(x & 16777215 as int)))",
    "_q_windows": "sort_array(transform(_q_alike, "
                  "i -> struct(_q_words[i] as a, _q_words[i + 1] as b, _q_words[i + 2] as c, i as at)))",
    "_q_twice": "sort_array(transform(filter(_q_windows, (x, i) -> "
                "(i > 0 and struct(_q_windows[i - 1].a, _q_windows[i - 1].b, _q_windows[i - 1].c) = struct(x.a, x.b, x.c)) or "
                "(i < size(_q_windows) - 1 and struct(_q_windows[i + 1].a, _q_windows[i + 1].b, _q_windows[i + 1].c) "
                "= struct(x.a, x.b, x.c))), x -> x.at))",
    "n_repeat_words": "cast(aggregate(_q_twice, struct(0 as until, 0 as n), (s, at) -> "
                      "struct(at + 3 as until, s.n + at + 3 - greatest(at, s.until) as n)).n as bigint)",
    "_q_upper": "length(regexp_replace(_q_text, '[^A-Z]', ''))",
    "_q_marks": "length(_q_text) - length(translate(_q_text, '!', ''))",
    "_q_letters": r"length(regexp_replace(_q_text, '\\P{L}', ''))",
}
_WORDS = ("_q_trimmed", "_q_words", "n_words")
_REPEATS = (*_WORDS, "_q_packed", "_q_alike", "_q_windows", "_q_twice", "n_repeat_words")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Rule(NamedTuple):
    name: str
    steps: tuple[str, ...]
    rejects: str


RULES = (
    Rule("few_words", _WORDS, "n_words < 50"),
    Rule("repetition", _REPEATS, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", (*_WORDS, "n_symbols"), "10 * n_symbols > n_words"),
    Rule("word_length", (*_WORDS, "word_chars"), "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("repeated_lines", ("_q_lines", "n_dup_lines"), "2 * n_dup_lines > size(_q_lines)"),
    Rule("capitals", ("word_chars", "_q_upper"), "10 * _q_upper > 3 * word_chars"),
    Rule("exclamations", (*_WORDS, "_q_marks"), "5 * _q_marks > n_words"),
    Rule("letters", ("word_chars", "_q_letters"), "2 * _q_letters < word_chars"),
)


def with_steps(df: DataFrame, steps, where: str | None = None) -> DataFrame:
    """Adds the steps that ``df`` lacks, null where ``where`` is false."""
    for s in steps:
        if s not in df.columns:
            df = df.withColumn(s, F.expr(f"case when {where} then {STEPS[s]} end" if where else STEPS[s]))
    return df


def measured_order(docs: DataFrame, rules=RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejections per second, most first, as measured on a sample
    of about ``sample_rows`` texts."""
    n = docs.count()
    sample = (docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_q_text"))
              .sample(min(1.0, sample_rows / max(n, 1)), seed=7).persist())
    try:
        sample.count()
        worth = []
        for rule in rules:
            looked = with_steps(sample, rule.steps).agg(F.count_if(F.expr(rule.rejects)).alias("n"))
            looked.first()  # compiles
            began = time.perf_counter()
            rejected = looked.first().n
            worth.append((rejected + 0.5) / (time.perf_counter() - began))
    finally:
        sample.unpersist()
    return [r for _, _, r in sorted(zip((-w for w in worth), range(len(rules)), rules))]


def cascade(docs: DataFrame, rules, text_col: str = "text", first=()) -> DataFrame:
    """``docs`` with the steps ``first``, ``_q_rejected`` and what the rules
    needed; rules are tried in the order given."""
    out = with_steps(docs.withColumn("_q_text", F.coalesce(F.col(text_col).cast("string"), F.lit(""))), first)
    out = out.withColumn("_q_rejected", F.lit(False))
    for rule in rules:
        # a step that an earlier rule took holds null for what was rejected by
        # then, and so does this rule's verdict
        out = with_steps(out, rule.steps, "not _q_rejected")
        out = out.withColumn("_q_rejected", F.expr(f"_q_rejected or coalesce({rule.rejects}, false)"))
    return out


def metrics(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """Base columns of every document, base_failed, and kept by the cascade;
    they take the place of columns of ``docs`` that have their names."""
    mine = {*STEPS, "_q_text", "_q_rejected", "base_failed", "kept"}
    if text_col.lower() in mine:
        raise ValueError(f"the text column has the name of a result: {text_col}")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in mine])
    order = measured_order(docs, rules, text_col)
    return (cascade(docs, order, text_col, (*_REPEATS, "word_chars", "n_symbols", "_q_lines", "n_dup_lines"))
            .withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
            .withColumn("kept", F.expr("not base_failed and not _q_rejected")))


def kept_rows(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    # the rules see the text alone, so the columns of ``docs`` may have any names
    renamed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_q_row"), F.col(text_col).alias("_q_in"))
    told = cascade(renamed, measured_order(docs, rules, text_col), "_q_in")
    # a filter would be pushed below the steps and repeat them; a row number
    # that it needs as well holds it back
    return (told.withColumn("_q_at", F.monotonically_increasing_id()).where("not _q_rejected and _q_at >= 0")
            .select("_q_row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return metrics(docs).select("doc_id", *BASE, "base_failed", "kept")


#: DuckDB: the same from unnested windows.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT i + j) AS n FROM twice, (VALUES (0), (1), (2)) s(j) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n, count(*) AS n_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(l.n_lines, 0) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_letters,
         length(regexp_replace(t, '[^!]', '', 'g')) AS marks,
         length(regexp_replace(t, '\P{L}', '', 'g')) AS letters
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN lines l USING (r)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > n_lines OR 10 * upper_letters > 3 * word_chars OR 5 * marks > n_words
            OR 2 * letters < word_chars) AS kept
FROM b
"""
