r"""Line dedup: exact set-similarity join of lines, in DataFrame expressions only.

A line's tokens are the distinct words between ASCII white space, lower-cased.
A line is removed if an earlier line (by doc_id, then place) has a token set
with Jaccard similarity of at least ``num / den``, itself included if that line
was removed too.  All lines with a word take part, unless ``min_tokens`` asks
for more of them.

1. All tokens of the corpus are counted in ``2**15`` hash buckets (a bounded
   table); a token's order is its bucket's count class, then its hash: rare
   tokens first, the same order everywhere.
2. Lines with equal token sets are one class, which its first line stands for.
   That settles sets of up to three tokens at 0.8: with n tokens another set's
   similarity is n / (n + 1) at most, so such classes make no pairs.
3. Two sets as similar as that share one of their first n - need(n) + 1 tokens
   (prefix filter).  Pairs that meet must also have close sizes (length filter),
   enough tokens behind the meeting place (positional filter), and few differing
   bits in a parity bitmap of 128 bits of their tokens (the bits that differ are no more
   than the tokens that do).  The last join meets tokens within bands of sizes only.
4. First every class meets only the earliest class under its rarest tokens; that
   resolves clusters of near copies in rows proportional to their size.  The
   classes that are left meet all earlier ones under all prefix tokens.
5. Pairs are verified on the words themselves.  Places wanted and classes settled
   go to all executors while they are few (counted first); else both sides of
   the join are shuffled.

Cases: null and empty texts have no lines to remove; lines without a word stay;
rows that repeat doc_id and text are one document to the rules and each give
their row; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import staged, table

BUCKETS = 1 << 15
#: Entries (some 30 bytes each) up to which one side of a join is sent to all executors.
SMALL = 200_000
#: White space other than blanks and line ends, as SQL writes it.
_WHITE = (r"\t", r"\u000B", r"\u000C", r"\r")
_FIRST = 4  # prefix tokens under which the first round looks
#: Rule by which all lines with a word take part.
EVERY_LINE = {"min_tokens": 1}


def _blank(text: str) -> str:
    """``text`` with blanks for all white space but line ends.  Looking for single
    characters needs no pattern matcher; few texts have one."""
    odd = " or ".join(f"contains({text}, '{c}')" for c in _WHITE)
    return f"if({odd}, translate({text}, '{''.join(_WHITE)}', '{' ' * len(_WHITE)}'), {text})"


def _words(line: str) -> str:
    return f"array_remove(array_distinct(split(lower({_blank(line)}), ' ')), '')"


def _rarity(texts: DataFrame) -> tuple[list[int], int]:
    """Count class (1 to 126) of each token bucket, and the class of the middle token."""
    rows = (texts.select(F.expr(_blank("text")).alias("text"))
            .select(F.explode(F.expr(r"split(lower(replace(text, '\n', ' ')), ' ')")).alias("w")).where("w != ''")
            .groupBy(F.expr(f"cast(xxhash64(w) & {BUCKETS - 1} as int)").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")).toArrow())  # at most BUCKETS rows
    classes, tokens = [1] * BUCKETS, [0] * 127
    for bucket, n in zip(rows["bucket"].to_pylist(), rows["n"].to_pylist()):
        classes[bucket] = min(126, 1 + int(3 * math.log2(n + 1)))
        tokens[classes[bucket]] += n
    return classes, next((c for c in range(127) if 2 * sum(tokens[:c + 1]) > sum(tokens)), 1)


def _need(n: str, num: int, den: int) -> str:
    """Tokens that a set of ``n`` must share with any partner."""
    return f"({num} * {n} + {den - 1}) div {den}"


def _lines(docs: DataFrame, num: int, den: int, min_tokens: int) -> DataFrame:
    """Every line that takes part: its place, the key of its token set, size,
    128 parity bits and prefix (31-bit token hashes, rare first); and for each
    row of ``docs`` one without a size, at the place behind its last line."""
    rarity, middle = _rarity(docs)
    # what stands between two blanks is in every set once, among the tokens of the middle
    # class: it parts rare from frequent tokens, which have 64 parity bits each
    gap = docs.sparkSession.sql("SELECT xxhash64('')").first()[0]
    rarity[gap & (BUCKETS - 1)] = middle
    gap_token = f"{middle << 56 | (gap & (1 << 64) - 1) >> 8}L"
    classes = f"cast(split('{','.join(str(c << 56) for c in rarity)}', ',') as array<bigint>)"
    # never null, which lets Spark sort and compare plain longs
    order = f"coalesce({classes}[h & {BUCKETS - 1}], 0L) | shiftrightunsigned(h, 8)"
    hashes = f"array_union(transform(split(lower(line), ' '), w -> xxhash64(w)), array({gap}L))"
    bits = f"cast(split('{','.join(str((1 << i) - (1 << 64 if i == 63 else 0)) for i in range(64))}', ',') as array<bigint>)"
    parity = f"aggregate(slice(tokens, {{}}), 0L, (b, t) -> b ^ {bits}[t & 63])"
    short = f"size(tokens) - 1 - ({_need('(size(tokens) - 1)', num, den)}) + 1"
    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.posexplode(F.concat(F.split(F.expr(_blank("text")), "\n"), F.expr("array(cast(null as string))"))).alias("line_no", "line"))
            .where(F.expr(f"line is null or length(line) >= {2 * min_tokens - 1}"))
            .withColumn("tokens", F.expr(f"sort_array(transform({hashes}, h -> {order}))"))
            .withColumn("gap", F.expr(f"cast(array_position(tokens, {gap_token}) as int)"))
            .select("doc_id", "text_hash", "line_no", F.xxhash64("tokens").alias("k1"),
                    F.xxhash64(F.lit(7), "tokens").alias("k2"), F.expr("if(line is null, null, size(tokens) - 1)").alias("n"),
                    F.expr(parity.format("1, gap - 1")).alias("b0"),
                    F.expr(parity.format("gap + 1, size(tokens)")).alias("b1"),
                    F.expr(f"transform(slice(array_remove(slice(tokens, 1, cast({short} + 1 as int)), {gap_token}), 1, cast({short} as int)), "
                           "t -> cast(t & 2147483647 as int))").alias("prefix")))


def _entries(of: DataFrame, ids: str, prefix: str, side: str, key: str = "token", up: str = "0") -> DataFrame:
    """One row per prefix token, narrow, with columns of one side of a join: key,
    class, parity bits, size and place in the prefix, and ``up`` as a bit between these."""
    return (of.select("*", F.expr(ids).alias("c"), F.posexplode(F.expr(prefix)).alias("at", "token"))
            .select(F.expr(key).alias(f"k{side}"), F.col("c").alias(side), F.col("b0").alias(f"b{side}"),
                    F.col("b1").alias(f"d{side}"),
                    F.expr(f"shiftleft(cast(n as bigint), 32) | shiftleft(cast({up} as bigint), 31) | at").alias(f"p{side}")))


def _banded(of: DataFrame, num: int, den: int) -> DataFrame:
    """``of`` with a band of its size; sizes of one band differ by (den / num)**3 at
    most.  A class whose largest partner lies in the band above has a second row
    there (``up`` is 1), so that all partners have the larger one's band in common.
    Of the smaller one a shorter prefix will do: it shares num / (num + den) of both
    sizes, of twice its own at least."""
    width = 3 * math.log(den / num) or 1.0

    def band(n: str) -> str:
        return f"cast(floor(ln({n}) / {width!r}) as int)"
    above = f"{band(f'({den} * n div {num})')} > {band('n')}"
    return (of.withColumn("up", F.expr(f"explode(if({above}, array(0, 1), array(0)))"))
            .withColumn("band", F.expr(f"{band('n')} + up"))
            .withColumn("prefix", F.expr(f"if(up = 0, prefix, slice(prefix, 1, cast(n - ({2 * num} * n + {num + den - 1}) "
                                         f"div {num + den} + 1 as int)))")))


def _close(num: int, den: int) -> str:
    """Length, positional and bitmap filters of prefix entries x and y."""
    n, at = {s: f"shiftright(p{s}, 32)" for s in "xy"}, {s: f"(p{s} & 2147483647)" for s in "xy"}
    # shared tokens of a pair of sizes a, b: at least num (a + b) / (num + den)
    both = f"(({num} * ({n['x']} + {n['y']}) + {num + den - 1}) div {num + den})"
    return (f"{den} * least({n['x']}, {n['y']}) >= {num} * greatest({n['x']}, {n['y']})"
            f" and least({n['x']} - {at['x']}, {n['y']} - {at['y']}) >= {both}"
            f" and bit_count(bx ^ by) + bit_count(dx ^ dy) <= {n['x']} + {n['y']} - 2 * {both}")


def _sent(df: DataFrame, items: str = "1") -> DataFrame:
    """A staged frame that a join sends to all executors if it is small;
    ``items``: entries in a row, each of fixed width."""
    return df.hint("broadcast" if (df.agg(F.sum(F.expr(items))).first()[0] or 0) <= SMALL else "merge")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """The later class of each of ``pairs`` (x, y) whose words are similar."""
    pairs = staged(pairs)
    spots = pairs.select(F.col("x").alias("id")).union(pairs.select(F.col("y").alias("id"))).distinct()
    wanted = staged(classes.select("id", "doc_id", "text_hash", "line_no").join(spots.hint("merge"), "id")
                    .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("id", "line_no")).alias("wanted")))
    here = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), "text")
    words = staged(here.join(_sent(wanted, "size(wanted)"), here.d.eqNullSafe(F.col("doc_id")) & (here.h == F.col("text_hash")))
                   .select(F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w"))
                   .select("w.id", F.expr("element_at(lines, w.line_no + 1)").alias("line"))
                   .dropDuplicates(["id"]).select("id", F.expr(_words("line")).alias("words")))
    wx, wy = [words.select(F.col("id").alias(c), F.col("words").alias(f"w{c}")).hint("merge") for c in ("x", "y")]
    common = "size(array_intersect(wx, wy))"
    return (pairs.join(wx, "x").join(wy, "y")
            .where(F.expr(f"{den} * {common} >= {num} * (size(wx) + size(wy) - {common})")).select("x").distinct())


def removed_lines(docs: DataFrame, num: int = 4, den: int = 5, min_tokens: int = 1) -> DataFrame:
    """doc_id, text_hash, line_no of every line of ``docs`` (doc_id, text) that
    an earlier one resembles."""
    return _removed(docs, staged(_lines(docs, num, den, min_tokens)), num, den, min_tokens)


def _removed(docs: DataFrame, cut: DataFrame, num: int = 4, den: int = 5, min_tokens: int = 1) -> DataFrame:
    """``removed_lines`` of what ``_lines`` cut."""
    # short lines go after the write: a filter before it would cut words twice
    lines = cut.where(F.col("n") >= min_tokens)
    place = ["doc_id", "text_hash", "line_no"]
    # ids in the order of places: ranges of them, and rows in order inside
    classes = staged(lines.groupBy("k1", "k2").agg(
        F.min(F.struct(*place)).alias("first"), F.first("n").alias("n"), F.first("b0").alias("b0"), F.first("b1").alias("b1"),
        F.first("prefix").alias("prefix"),
        F.count(F.lit(1)).alias("copies"))
        .select("k1", "k2", "first.*", "n", "b0", "b1", "prefix", "copies")
        .repartitionByRange(*place).sortWithinPartitions(*place).withColumn("id", F.monotonically_increasing_id()))
    close = _close(num, den)
    # sets that another one can resemble
    meet = classes.where(F.expr(f"{den - num} * n >= {num}"))
    few = [_entries(meet, "id", f"slice(prefix, 1, {_FIRST})", s) for s in "xy"]
    heads = staged(few[1].groupBy(F.col("ky").alias("token"))
                   .agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("y", "by", "dy", "py")).alias("e"))
                   .where("m > 1").select("token", "e.*"))
    near = (few[0].join(heads.hint("merge"), F.expr(f"kx = token and y < x and {close}"))
            .select("x", "y").distinct())
    found = staged(_verified(near, classes, docs, num, den))
    # what is settled keeps its entries for later lines to meet, under -1 - id;
    # both sides are the same entries, shuffled once
    known = (meet.select("id", "n", "b0", "b1", "prefix")
             .join(_sent(found.select(F.col("x").alias("id"), F.lit(True).alias("gone"))), "id", "left"))
    both = [_entries(_banded(known, num, den), "if(gone, -1 - id, id)", "prefix", s,
                     "shiftleft(cast(token as bigint), 16) | band", "up") for s in "xy"]
    ids = {s: f"if({s} < 0, -1 - {s}, {s})" for s in "xy"}
    # x is the larger one, in its own band, y in that or from the band below; the later one is not settled
    larger = (f"(py & 2147483648) != 0 or shiftright(px, 32) > shiftright(py, 32)"
              f" or shiftright(px, 32) = shiftright(py, 32) and {ids['x']} > {ids['y']}")
    met = (both[0].join(both[1].hint("merge"), F.expr(
        f"kx = ky and if((px & 2147483648) = 0 and if({ids['x']} > {ids['y']}, x, y) >= 0 and ({larger}), {close}, false)"))
        .select(F.expr(f"greatest({ids['x']}, {ids['y']})").alias("x"), F.expr(f"least({ids['x']}, {ids['y']})").alias("y")).distinct())
    gone = staged(found.unionByName(_verified(met, classes, docs, num, den)).distinct())
    told = staged(classes.select("id", "k1", "k2", "copies", F.struct(*place).alias("place"))
                  .join(_sent(gone.select(F.col("x").alias("id"), F.lit(True).alias("gone"))), "id", "left")
                  .where("gone or copies > 1").select("k1", "k2", "place", F.coalesce("gone", F.lit(False)).alias("gone")))
    return (lines.select("k1", "k2", *place).join(_sent(told), ["k1", "k2"])
            .where(F.expr(f"gone or not (struct({', '.join(place)}) <=> place)")).select(*place).distinct())


def _by_document(removed: DataFrame) -> DataFrame:
    """doc_id, text_hash and the sorted places of the lines that go."""
    return (removed.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
            .agg(F.sort_array(F.collect_list("line_no")).alias("removed")))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` with the lines that go cut out of the text (null stays null)."""
    gone = _by_document(removed_lines(_source(docs, id_col, text_col), **rule))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    joined = rows.join(gone.hint("merge"), rows.doc_id.eqNullSafe(F.col("d"))
                       & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("h")), "left")
    kept = F.expr(r"if(removed is null, text, array_join(transform(array_except(sequence(0, size(split(text, '\n')) - 1), "
                  r"removed), i -> element_at(split(text, '\n'), i + 1)), '\n'))")
    return joined.withColumn("text", kept).select(
        *[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its number of lines, how many go, and their places."""
    docs = _source(table(spark, sf_dir, "documents"), "doc_id", "text")
    cut = staged(_lines(docs, 4, 5, **EVERY_LINE))
    gone = _by_document(_removed(docs, cut, **EVERY_LINE))
    # an empty text is cut into one empty line, and has none
    sizes = cut.where("n is null").select("doc_id", "text_hash", F.when(F.col("text_hash") == F.xxhash64(F.lit("")), 0)
                                          .otherwise(F.col("line_no")).cast("long").alias("n_lines"))
    return (sizes.join(gone.hint("merge"), sizes.doc_id.eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
            .select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("removed", F.expr("array()")).cast("array<int>").alias("removed")))
