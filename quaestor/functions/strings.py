"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaestor.functions.numeric import col


def blank_to_null(c) -> Column:
    """'' or whitespace-only -> NULL."""
    x = col(c)
    return F.when(F.trim(x.cast("string")) != "", x)


def is_blank(c) -> Column:
    """NULL or blank string (the DQ notion of 'missing')."""
    x = col(c)
    return x.isNull() | (F.trim(x.cast("string")) == "")


def clean_identifier(c) -> Column:
    """upper(trim(strip non-alphanumerics))."""
    return F.upper(F.trim(F.regexp_replace(col(c).cast("string"), "[^0-9A-Za-z]", "")))


def normalize_identifier(value, source_normalized=None) -> Column:
    """UPPER(REPLACE(value, ' ', '')), the source's own normalised value wins
    when populated (H03)."""
    n = F.upper(F.replace(col(value).cast("string"), F.lit(" "), F.lit("")))
    if source_normalized is not None:
        n = F.coalesce(blank_to_null(source_normalized), n)
    return n


def right(c, n: int) -> Column:
    """RIGHT(c, n)."""
    x = col(c).cast("string")
    return F.when(F.length(x) <= n, x).otherwise(F.substring(x, -n, n))


def whole_word_match(c, term: str) -> Column:
    """Case-insensitive whole-word search."""
    import re
    return col(c).rlike("(?i)\\b" + re.escape(term) + "\\b")


def regex_full_match(c, pattern) -> Column:
    """Anchored match; pattern may be a literal or a column holding the regex."""
    if isinstance(pattern, str):
        return col(c).rlike("^(?:" + pattern + ")$")
    return col(c).rlike(F.concat(F.lit("^(?:"), col(pattern), F.lit(")$")))


def regex_prefix_match(c, pattern: str) -> Column:
    """Prefix-anchored match, i.e. Python ``re.match``."""
    return col(c).rlike("^(?:" + pattern + ")")


def address_line(city, district, unknown: str = "Unknown") -> Column:
    """'city, district' unless both are unknown."""
    c, d = col(city), col(district)
    both_unknown = (F.coalesce(c, F.lit(unknown)) == unknown) & (F.coalesce(d, F.lit(unknown)) == unknown)
    return F.when(both_unknown, F.lit(unknown)).otherwise(F.concat_ws(", ", c, d))


def concat_path(*parts) -> Column:
    """CONCAT_WS(' > ', ...) skipping NULL and empty parts."""
    return F.concat_ws(" > ", *[blank_to_null(p) for p in parts])
