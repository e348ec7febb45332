"""JSON and array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaestor.functions.numeric import col

# JSON shapes used by tax-framework columns.
RANGE_TABLE = T.ArrayType(T.StructType([
    T.StructField("from", T.DoubleType()),
    T.StructField("to", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
]))
STRING_LIST = T.ArrayType(T.StringType())
I18N_MAP = T.MapType(T.StringType(), T.StringType())


def json_field(c, path: str, cast: str | None = None) -> Column:
    """get_json_object with an optional cast."""
    v = F.get_json_object(col(c), path)
    return v.cast(cast) if cast else v


def json_map(c, value_type: T.DataType = T.StringType()) -> Column:
    return F.from_json(col(c), T.MapType(T.StringType(), value_type))


def json_range_lookup(value, table_json) -> Column:
    """(H14) Value from a JSON range table ``[{"from":..,"to":..,"value":..}]``: the
    first entry with from <= v < to (open 'to' when NULL)."""
    arr = F.from_json(col(table_json), RANGE_TABLE)
    v = col(value).cast("double")
    hit = F.filter(arr, lambda e: (e["from"] <= v) & (e["to"].isNull() | (v < e["to"])))
    return F.element_at(hit, 1)["value"]


def localized(c, lang: str, fallback: str = "en") -> Column:
    m = F.from_json(col(c), I18N_MAP)
    return F.coalesce(m[lang], m[fallback])


def split_codes(c, sep: str = ",") -> Column:
    """Comma-separated codes -> trimmed array."""
    return F.filter(F.transform(F.split(col(c), sep), lambda x: F.trim(x)), lambda x: x != "")


def any_code_in(c, codes, sep: str = ",") -> Column:
    """Any of the codes present in a code list."""
    return F.arrays_overlap(split_codes(c, sep), F.array(*[F.lit(x) for x in codes]))
