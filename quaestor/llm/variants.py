r"""Spelling variant grouping by finite-state composition.

Words one edit apart (one code point inserted, deleted or replaced) are found by
composing the minimised acceptor of the vocabulary with a one-edit transducer
and the acceptor again.  Before the edit both acceptors stand in one state, so
the composition begins in an *initial state* that words share, and each initial
state is a part of its own:

* Two words differ first at one place, the length of their common prefix.
  Places are dealt out in zones, so every pair belongs to one zone.
* In the zone [0, 3) two words share all that follows the zone: the part is the
  rest of the word, and its acceptor holds the zone's two or three code points.
* From place 3 on they share the first three code points: the part is this
  prefix, and its acceptor holds the rest of the word.
* A prefix with more than ``most`` words is split: up to their common prefix
  they differ nowhere, the place behind it is a zone of its own (what surrounds
  it is the part), and each longer prefix is a part again.

Parts are dealt to partitions by hash; a task reads its rows in the order of
parts and holds one part at a time.  A zone's part has no more words than
strings of three code points, a prefix's no more than ``most``.  Inside, states
are minimal, so edits at a state are composed once for all words through it.

A word's form is its near word of the largest count if that is at least
``ratio`` times its own; roots are found by doubling the steps along forms.

Cases: null texts have no words, a null doc_id stands as an empty string in the
hash; repeated rows count as often as they stand; of equal counts the smaller
word in code-point order wins; an empty table gives no rows.  Other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import staged, table

ZONE, MOST = 3, 100_000
_LOWER = {c: c + 32 for c in range(65, 91)}


# ------------------------------------------------------------------ words

def _count_words(least: int, one_in: int, most: int = 200_000):
    """(word, n) rows of runs of letters, summed over ``most`` words at a time."""
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()

        def rows():
            out = pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])
            n.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                here: Counter = Counter()
                for m in runs.finditer(text.as_py() or ""):
                    here[m.group()] += 1
                    if len(here) >= most:
                        _add(n, here, start, least, one_in)
                        here.clear()
                        if len(n) >= most:
                            yield rows()
                _add(n, here, start, least, one_in)
                if len(n) >= most:
                    yield rows()
        yield rows()

    return count


def _add(n: Counter, here: Counter, start: int, least: int, one_in: int) -> None:
    for run, times in here.items():
        word = run if run.islower() else run.lower() if run.isascii() else run.translate(_LOWER)
        h = zlib.crc32(word.encode(), start)
        if h % one_in == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < least:
                continue
        n[word] += times


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, min_count: int = 2,
               one_in: int = 31) -> DataFrame:
    """word, n: runs of at least ``least`` letters and ``min_count`` occurrences.
    Where ``one_in`` divides crc32 of ``<doc_id>:<run>``, a run loses a code point."""
    source = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return (source.mapInArrow(_count_words(least, one_in), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# ------------------------------------------------------------------ composition

class Acceptor:
    """Minimal deterministic acyclic acceptor of sorted distinct strings.  State
    ids grow from the ends to the start: arcs lead to smaller ids."""

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        # the path of the last string: for each of its states, arcs that are settled, and whether it accepts
        path: list[dict[str, int]] = [{}]
        ends: list[bool] = [False]
        last = ""
        for s in strings:
            shared = 0
            for a, b in zip(s, last):
                if a != b:
                    break
                shared += 1
            self._settle(path, ends, last, shared)
            for _ in s[shared:]:
                path.append({})
                ends.append(False)
            ends[len(s)] = True
            last = s
        self._settle(path, ends, last, 0)
        self.start = self._state(path[0], ends[0])

    def _settle(self, path, ends, last: str, shared: int) -> None:
        while len(path) > shared + 1:
            arcs, end = path.pop(), ends.pop()
            path[-1][last[len(path) - 1]] = self._state(arcs, end)

    def _state(self, arcs: dict[str, int], end: bool) -> int:
        key = (end, *arcs.items())
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(end)
        return state

    def both(self, q: int, r: int, skip: str, after: str) -> list[str]:
        """Strings accepted from ``q`` and from ``r``, none that begins with
        ``skip`` (the empty one is followed by ``after``)."""
        arcs, final = self.arcs, self.final
        out = [""] if final[q] and final[r] and (not skip or skip != after) else []
        todo = [(arcs[q][a], arcs[r][a], a) for a in arcs[q].keys() & arcs[r].keys() if a != skip]
        while todo:
            q, r, s = todo.pop()
            if q == r:  # all that follows is common
                out += [s + rest for rest in self.strings(q)]
                continue
            if final[q] and final[r]:
                out.append(s)
            x, y = arcs[q], arcs[r]
            todo += [(x[a], y[a], s + a) for a in x.keys() & y.keys()]
        return out

    def strings(self, q: int) -> list[str]:
        out, todo = [], [(q, "")]
        while todo:
            q, s = todo.pop()
            if self.final[q]:
                out.append(s)
            todo += [(r, s + a) for a, r in self.arcs[q].items()]
        return out

    def one_edit(self, after: str = "", full: int | None = None) -> Iterator[tuple[str, str]]:
        """Every pair of accepted strings one edit apart, once: acceptor, one-edit
        transducer, acceptor.  ``after`` is the code point that follows all of
        them; with ``full``, one of a pair has that length."""
        edits: list[list[tuple[str, str]]] = []  # for each state, what may follow the edit and before
        alive: list[bool] = []
        for q, arcs in enumerate(self.arcs):
            found = []
            labels = sorted(arcs)
            for i, a in enumerate(labels):
                for b in labels[i + 1:]:  # a replaced by b
                    found += [(a + s, b + s) for s in self.both(arcs[a], arcs[b], "", "")]
                # a inserted: the rest does not begin with a, or the words differ later
                found += [(s, a + s) for s in self.both(q, arcs[a], a, after)]
            edits.append(found)
            alive.append(bool(found) or any(alive[r] for r in arcs.values()))
        if not alive[self.start]:
            return
        walk, before = [(self.start, iter(self.arcs[self.start].items()))], []
        while True:
            q, arcs = walk[-1]
            step = next(((a, r) for a, r in arcs if alive[r]), None)
            if step:
                before.append(step[0])
                walk.append((step[1], iter(self.arcs[step[1]].items())))
                continue
            if edits[q]:
                p = "".join(before)
                for x, y in edits[q]:
                    if full is None or len(p) + max(len(x), len(y)) == full:
                        yield p + x, p + y
            walk.pop()
            if not walk:
                return
            before.pop()


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part (zone, prefix, rest) and middle -> for each word with
    near words in the part: their number and the best one."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    out: list[tuple] = []

    def flush():
        cols = list(zip(*out)) or [[]] * 4
        out.clear()
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    def part(key, counts: dict[str, int]) -> None:
        full, prefix, rest = key
        near: dict[str, list] = {}
        for x, y in Acceptor(list(counts)).one_edit(rest[:1], full):
            for a, b in ((x, y), (y, x)):
                e = near.get(a)
                told = (-counts[b], b)
                if e is None:
                    near[a] = [1, told]
                else:
                    e[0] += 1
                    if told < e[1]:
                        e[1] = told
        for a, (n, (less, b)) in near.items():
            out.append((prefix + a + rest, n, -less, prefix + b + rest))

    at, counts = None, {}
    for batch in batches:
        for full, prefix, rest, middle, n in zip(*(c.to_pylist() for c in batch.columns)):
            key = (full, prefix, rest)
            if key != at:
                if len(counts) > 1:
                    part(at, counts)
                    if len(out) > 10_000:
                        yield flush()
                at, counts = key, {}
            counts[middle] = n
    if len(counts) > 1:
        part(at, counts)
    yield flush()


def _zone(words: DataFrame, begin, width: int) -> DataFrame:
    """Rows of the zone [begin, begin + width): what stands before and after it
    is the part.  The shorter word of a pair ends its middle one place earlier."""
    ends = [(F.lit(0), F.length("word") >= begin + width)]
    ends.append((F.lit(1), F.length("word") >= begin + width - 1))
    rows = words.select("word", "n", F.explode(F.array(*[F.when(fits, less) for less, fits in ends])).alias("less"),
                        begin.alias("begin")).where("less is not null")
    return rows.select(F.lit(width).alias("full"), F.expr("substring(word, 1, begin)").alias("prefix"),
                       F.expr(f"substring(word, begin + {width} - less + 1)").alias("rest"),
                       F.expr(f"substring(word, begin + 1, {width} - less)").alias("middle"), "n")


def _parts(words: DataFrame, most: int) -> DataFrame:
    """Rows (full, prefix, rest, middle, n) of all initial states."""
    parts = _zone(words, F.lit(0), ZONE)
    open_ = words.where(F.length("word") >= ZONE).select("word", "n", F.lit(ZONE).alias("begin"))
    while True:
        keyed = open_.withColumn("prefix", F.expr("substring(word, 1, begin)"))
        hot = staged(keyed.groupBy("prefix").agg(F.count(F.lit(1)).alias("m"), F.min("word").alias("a"), F.max("word").alias("b"))
                     .where(F.col("m") > most)
                     .select("prefix", F.expr("array_position(zip_with(split(a, ''), split(b, ''), (x, y) -> x <=> y), false)"
                                              " - 1").alias("common")))
        if hot.isEmpty():
            break
        marked = keyed.join(hot.hint("merge"), "prefix", "left")
        cool = marked.where("common is null").select("word", "n", "begin")
        split = staged(marked.where("common is not null").select("word", "n", F.col("common").cast("int").alias("begin")))
        parts = parts.unionByName(_zone(split, F.col("begin"), 1))
        parts = parts.unionByName(_open(cool))
        open_ = split.withColumn("begin", F.col("begin") + 1).where("length(word) >= begin")
    return parts.unionByName(_open(open_))


def _open(rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(None).cast("int").alias("full"), F.expr("substring(word, 1, begin)").alias("prefix"),
                       F.lit("").alias("rest"), F.expr("substring(word, begin + 1)").alias("middle"), "n")


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, n_near, best_n, best for each of ``words`` (word, n, distinct) that
    has near words: their number and the one of largest n."""
    key = ["full", "prefix", "rest"]
    parts = _parts(words, most).repartition(*key).sortWithinPartitions(*key, "middle")
    found = parts.select(*key, "middle", "n").mapInArrow(_compose, "word string, n_near long, best_n long, best string")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: ``forms`` (word, form) followed to the last.  Counts grow
    along forms, so there is no way back; each round doubles the steps."""
    now = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next")).hint("merge")
        new = staged(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("moved")))
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def group(words: DataFrame, ratio: int = 10, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of ``words`` (word, n)."""
    near = near_words(words, most)
    # one row a word on either side: a union and a sum in place of a join
    told = staged(words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                               F.lit(None).cast("string").alias("best"))
                  .unionByName(near.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best"))
                  .groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
                                       F.max("best_n").alias("best_n"), F.max("best").alias("best"))
                  .withColumn("fits", F.expr(f"coalesce(best_n >= {ratio} * n, false)"))
                  .select("word", "n", "n_near", F.expr("if(fits, best, null)").alias("form"),
                          F.expr("if(fits, best_n, null)").alias("form_n")))
    roots = _roots(told.where("form is not null").select("word", "form"))
    return (told.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(staged(vocabulary(table(spark, sf_dir, "documents"))))


#: The words, one-edit pairs by way of the strings that a deletion leaves, and
#: forms followed by a recursive query.
SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(r ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM range(256) g(i))),
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(s)), lambda k:
           CAST('0x' || substr(hex(s), 2 * k + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT *, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS s FROM runs), crc),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, hex(encode(other)))) AS best FROM near GROUP BY word),
told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
         CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, form AS root FROM told WHERE form IS NOT NULL
  UNION ALL SELECT w.word, t.form FROM walk w JOIN told t ON t.word = w.root WHERE t.form IS NOT NULL),
ends AS (SELECT w.word, w.root FROM walk w JOIN told t ON t.word = w.root WHERE t.form IS NULL)
SELECT t.word, t.form, coalesce(e.root, t.word) AS root, t.n, t.n_near, t.form_n FROM told t LEFT JOIN ends e USING (word)
"""
