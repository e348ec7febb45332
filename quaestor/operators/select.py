"""Row selection, lookups and ordering."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaestor.functions.strings import whole_word_match
from quaestor.operators.scd import point_in_time  # noqa: F401  (B23)


def filter_source(df: DataFrame, condition: str | Column | None) -> DataFrame:
    """Source filter such as ``STATUS != 'DELETED'`` (B11), pushed to the scan."""
    if condition is None:
        return df
    return df.where(F.expr(condition) if isinstance(condition, str) else condition)


def current_rows(df: DataFrame, flag_col: str = "is_current") -> DataFrame:
    """is_current = 1 / is_current_version = 1 / is_active."""
    c = F.col(flag_col)
    return df.where((c == F.lit(True)) if dict(df.dtypes)[flag_col] == "boolean" else (c == 1))


def expiring_within(df: DataFrame, date_col: str, as_of, days: int, out_col: str = "days_until_expiry") -> DataFrame:
    """Rows whose date lies in [as_of, as_of + days]."""
    a = F.lit(as_of).cast("date")
    d = F.col(date_col).cast("date")
    return df.where(d.between(a, F.date_add(a, days))).withColumn(out_col, F.datediff(d, a))


def effective_code_lookup(ref: DataFrame, code_col: str, country_col: str, country: str,
                          mode: str = "effective", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Country-specific row wins over the universal (NULL country) row per code
    (B21); ``mode='specific'`` or ``'universal'`` return only one kind."""
    spec = F.col(country_col) == F.lit(country)
    univ = F.col(country_col).isNull()
    if mode == "specific":
        return ref.where(spec)
    if mode == "universal":
        return ref.where(univ)
    cand = ref.where(spec | univ)
    others = [c for c in ref.columns if c != code_col]
    best = cand.groupBy(code_col).agg(F.min(F.struct(univ.alias("__u"), *[F.col(t) for t in tiebreak],
                                                     F.struct(*[F.col(c) for c in others]).alias("__r"))).alias("__b"))
    return best.select(code_col, *[F.col(f"__b.__r.{c}").alias(c) for c in others]).select(*ref.columns)


def localized_value(df: DataFrame, translations: DataFrame, key_cols: dict, attribute: str, lang: str,
                    fallback_lang: str = "en", value_col: str = "translated_value", out_col: str = "label") -> DataFrame:
    """Translation lookup with English fallback (B22).  ``key_cols`` maps df
    column -> translation key column."""
    t = translations.where(F.col("attribute_name") == attribute)
    want = t.where(F.col("language_code") == lang).select(*[F.col(v).alias(f"__k{i}") for i, v in enumerate(key_cols.values())],
                                                          F.col(value_col).alias("__want"))
    fb = t.where(F.col("language_code") == fallback_lang).select(*[F.col(v).alias(f"__f{i}") for i, v in enumerate(key_cols.values())],
                                                                 F.col(value_col).alias("__fb"))
    out = df.join(want, [df[k] == want[f"__k{i}"] for i, k in enumerate(key_cols)], "left")
    out = out.join(fb, [out[k] == fb[f"__f{i}"] for i, k in enumerate(key_cols)], "left")
    drop = [f"__k{i}" for i in range(len(key_cols))] + [f"__f{i}" for i in range(len(key_cols))]
    return out.withColumn(out_col, F.coalesce("__want", "__fb")).drop(*drop, "__want", "__fb")


def text_search(df: DataFrame, col: str, term: str) -> DataFrame:
    """Whole-word, case-insensitive search."""
    return df.where(whole_word_match(col, term))


def eligibility_check(df: DataFrame, value_col: str, schemes: Sequence[tuple[str, float]],
                      out_col: str = "eligibility") -> DataFrame:
    """Threshold eligibility against the scheme parameters (B25): one row per
    (entity, scheme), ELIGIBLE when value <= threshold.  The schemes are
    configuration, expanded with ``explode`` of a literal array (no join)."""
    arr = F.array(*[F.struct(F.lit(code).alias("scheme_code"), F.lit(thr).cast("decimal(19,2)").alias("threshold"))
                    for code, thr in schemes])
    out = df.withColumn("__s", F.explode(arr)).select("*", "__s.scheme_code", "__s.threshold").drop("__s")
    return out.withColumn(out_col, F.when(F.col(value_col) <= F.col("threshold"), F.lit("ELIGIBLE"))
                          .otherwise(F.lit("NOT_ELIGIBLE")))


def top_k(df: DataFrame, order_cols: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k (F01, F02); order_cols must end in a unique
    tiebreak.  Planned as TakeOrderedAndProject: each task keeps its k best,
    only k x tasks rows reach the final merge."""
    return df.orderBy(*order_cols).limit(k)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], k: int,
                    rank_col: str = "rank_in_group") -> DataFrame:
    """Top k rows per group.  ``row_number() <= k`` lets Spark insert a
    partial group limit before the shuffle (WindowGroupLimit), so each task
    ships at most k rows per group even for a hot group."""
    from pyspark.sql import Window
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def ordered_output(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Multi-key sort with direction and NULLS LAST (F03): spec = [(col, 'asc'|'desc')]."""
    cols = [F.col(c).asc_nulls_last() if d.lower() == "asc" else F.col(c).desc_nulls_last() for c, d in spec]
    return df.orderBy(*cols)


def cap_rows(df: DataFrame, n: int | None = None, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """The first ``n`` rows in an order (F04); all rows when ``n`` is None.  A
    cap without an order would give arbitrary rows and is refused."""
    if n is None:
        return df
    if not order_by:
        raise ValueError("cap_rows needs an order")
    return df.orderBy(*order_by).limit(n)
