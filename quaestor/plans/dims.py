"""Dimension builders.

Dimension keys are dense positions in natural-key order (``sequential_key``,
distributed), continuing after the current maximum on incremental loads.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaestor.functions.codes import band
from quaestor.functions.numeric import money
from quaestor.functions.strings import address_line, normalize_identifier
from quaestor.operators.joins import unpivot_amounts, union_sources
from quaestor.operators.keys import bounded, sequential_key
from quaestor.operators.mapping import map_lookup
from quaestor.operators.windows import flag_primary, share_of_total

# Party risk bands on the account balance and the defaults used
# when a reference lookup misses.
UNKNOWN = "Unknown"
BALANCE_RISK_BANDS = [(0, "HIGH"), (1000, "MEDIUM"), (None, "LOW")]


def build_dim_party(parties: DataFrame, geography: DataFrame, batch_id: int = 1, start_key: int = 0) -> DataFrame:
    """Party joined to its geography (broadcast: bounded by the number
    of places), names normalised, risk band, address line, batch id and a
    dense key after ``start_key``.  parties: party_id, party_name, nation_key,
    segment, balance; geography: nation_key, nation_name, region_name."""
    g = bounded(geography.select("nation_key", "nation_name", "region_name"))
    j = parties.join(g, "nation_key", "left")
    out = j.select(
        "party_id", F.upper(F.trim("party_name")).alias("party_name"), F.col("segment").alias("party_segment"),
        money("balance").alias("account_balance"), band("balance", BALANCE_RISK_BANDS).alias("risk_rating"),
        F.coalesce("nation_name", F.lit(UNKNOWN)).alias("district_name"),
        F.coalesce("region_name", F.lit(UNKNOWN)).alias("region_name"),
        address_line("nation_name", "region_name").alias("address_line"),
        F.lit(batch_id).alias("batch_id"))
    return sequential_key(out, ["party_id"], "party_key", offset=start_key)


def build_dim_tax_type(codes: DataFrame, code_col: str, categories: Mapping[str, str],
                       frequencies: Mapping[str, str], progressive: Sequence[str] = ()) -> DataFrame:
    """One row per active code, ordered key, direct flag (INCOME
    category), PROGRESSIVE/FLAT rate type, default frequency ANNUAL."""
    d = codes.select(F.col(code_col).alias("tax_type_code")).where(F.col("tax_type_code").isNotNull()).distinct()
    cat = map_lookup(F.col("tax_type_code"), categories, "OTHER")
    out = d.select("tax_type_code",
                   F.trim(F.substring_index("tax_type_code", "-", -1)).alias("tax_type_name"),
                   cat.alias("tax_category"),
                   (cat == "INCOME").cast("int").alias("is_direct_tax"),
                   F.when(F.col("tax_type_code").isin(*progressive), F.lit("PROGRESSIVE")).otherwise(F.lit("FLAT"))
                   .alias("rate_type"),
                   map_lookup(F.col("tax_type_code"), frequencies, "ANNUAL").alias("filing_frequency"))
    return sequential_key(out, ["tax_type_code"], "tax_type_key")


def build_dim_geography(regions: DataFrame, nations: DataFrame) -> DataFrame:
    """I11 for a two-level source: generic levels with parent key, full path,
    path codes and depth.  Region keys are offset so both levels share one
    key space (parent key built by id offset)."""
    r = regions.select((F.col("r_regionkey") + 1000).alias("geography_key"), F.lit(None).cast("long").alias("parent_geography_key"),
                       F.lit(1).alias("hierarchy_level"), F.col("r_name").alias("level_1_name"),
                       F.lit(None).cast("string").alias("level_2_name"),
                       F.col("r_regionkey").cast("string").alias("full_path_codes"))
    n = nations.join(bounded(regions), nations["n_regionkey"] == regions["r_regionkey"], "left").select(
        F.col("n_nationkey").cast("long").alias("geography_key"), (F.col("n_regionkey") + 1000).cast("long").alias("parent_geography_key"),
        F.lit(2).alias("hierarchy_level"), F.col("r_name").alias("level_1_name"), F.col("n_name").alias("level_2_name"),
        F.concat_ws("/", F.col("r_regionkey").cast("string"), F.col("n_nationkey").cast("string")).alias("full_path_codes"))
    out = r.withColumn("geography_key", F.col("geography_key").cast("long")).unionByName(n)
    return (out.withColumn("full_path", F.concat_ws(" > ", "level_1_name", "level_2_name"))
            .withColumn("depth", F.col("hierarchy_level")))


def build_bridge_party_identifier(identifiers: DataFrame, parties: DataFrame, id_types: DataFrame) -> DataFrame:
    """Identifiers + current party key + identifier type attributes +
    normalised value.  identifiers: party_id, identifier_type, identifier_value,
    normalized_value (optional)."""
    cur = parties.where(F.col("is_current") == 1).select("party_id", "party_key")
    j = identifiers.join(cur, "party_id", "left").join(bounded(id_types), "identifier_type", "left")
    nv = normalize_identifier("identifier_value", "normalized_value" if "normalized_value" in identifiers.columns else None)
    return j.withColumn("normalized_value", nv)


def build_bridge_amount_split(df: DataFrame, parent_keys: Sequence[str], amount_cols: Mapping[str, str],
                              key_name: str = "account_type", tiebreak: str | None = None) -> DataFrame:
    """Unpivot wide amounts (G03) + share of parent total in % (E06) +
    primary flag on the largest amount (E07)."""
    u = unpivot_amounts(df, parent_keys, amount_cols, key_name, "amount")
    u = share_of_total(u, parent_keys, "amount", "allocation_pct")
    order = F.create_map(*[x for i, code in enumerate(amount_cols.values()) for x in (F.lit(code), F.lit(i))])
    u = u.withColumn("__tb", F.col(tiebreak) if tiebreak else F.element_at(order, F.col(key_name)))
    return flag_primary(u, parent_keys, "amount", ["__tb"]).drop("__tb")


def build_dim_registration(sources: Mapping[str, DataFrame]) -> DataFrame:
    """I14 first step: one registration frame from several sources with a
    type tag (G05); SCD2 is applied with ``operators.scd.scd2_merge``."""
    return union_sources(sources, "registration_source")


def build_registration_history(sources: Mapping[str, DataFrame], keys: Sequence[str],
                               values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Versions of a party's registration from sources (keys, valid_from,
    valid_to and the columns ``values[name]``) whose validity overlaps, has gaps
    and comes in any order; ``is_current`` marks the open version."""
    from quaestor.operators.ranges import merge_timelines
    out = merge_timelines(sources, keys, "valid_from", "valid_to", values)
    return out.withColumn("is_current", F.col("valid_to").isNull().cast("int"))


def build_dim_tax_scheme(schemes: DataFrame, countries: DataFrame, types: DataFrame, current: DataFrame | None,
                         as_of: str, tracked: Sequence[str]) -> DataFrame:
    """Resolve country and tax-type keys (C03, bounded dimensions,
    broadcast) and apply the snapshot as an SCD2 load (I04)."""
    from quaestor.operators.keys import resolve_dimension_key
    from quaestor.operators.scd import initial_scd2, scd2_merge
    s = resolve_dimension_key(schemes, countries, {"country_code": "country_code"}, "country_key", broadcast_dim=True)
    s = resolve_dimension_key(s, types, {"tax_type_code": "tax_type_code"}, "tax_type_key", broadcast_dim=True)
    if current is None:
        return initial_scd2(s, ["scheme_code"], as_of, "scheme_key")
    return scd2_merge(current, s, ["scheme_code"], tracked, as_of, key_col="scheme_key")


def build_dim_tax_period(periods: DataFrame, types: DataFrame, as_of: str) -> DataFrame:
    """Periods joined to their (bounded) tax-type dimension; status from
    the as-of date when the source has none; closed = CLOSED/LOCKED, current
    = OPEN; quarter from the month when monthly, from the period number
    (1-4) when quarterly, else NULL."""
    a = F.lit(as_of).cast("date")
    p = periods.join(bounded(types.select("tax_type_code", "tax_type_key")), "tax_type_code", "left")
    status = F.coalesce(F.col("period_status") if "period_status" in periods.columns else F.lit(None).cast("string"),
                        F.when(F.col("period_end_date") < a, F.lit("CLOSED"))
                        .when(F.col("period_start_date") > a, F.lit("FUTURE")).otherwise(F.lit("OPEN")))
    q = (F.when(F.col("frequency") == "MONTHLY", F.quarter("period_start_date"))
         .when((F.col("frequency") == "QUARTERLY") & F.col("period_number").between(1, 4), F.col("period_number")))
    return (p.withColumn("period_status", status)
            .withColumn("is_closed", F.col("period_status").isin("CLOSED", "LOCKED").cast("int"))
            .withColumn("is_current", (F.col("period_status") == "OPEN").cast("int"))
            .withColumn("period_quarter", q.cast("int")))


def build_dim_country(spark, countries: Sequence[Mapping]) -> DataFrame:
    """Country configuration rows (currency, fiscal start, year offset,
    label pattern, membership flags) as a dimension; full refresh."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("country_code", T.StringType()), T.StructField("currency_code", T.StringType()),
                           T.StructField("fiscal_start_month", T.IntegerType()),
                           T.StructField("fiscal_year_offset", T.IntegerType()),
                           T.StructField("label_pattern", T.StringType()), T.StructField("is_eu_member", T.IntegerType())])
    rows = [(c["country_code"], c.get("currency_code"), int(c.get("fiscal_start_month", 1)),
             int(c.get("fiscal_year_offset", 0)), c.get("label_pattern", "{YEAR}"), int(c.get("is_eu_member", 0)))
            for c in countries]
    out = spark.createDataFrame(rows, schema)
    return sequential_key(out, ["country_code"], "country_key")


def build_dim_account_subtype(subtypes: DataFrame, countries: DataFrame, types: DataFrame) -> DataFrame:
    """Rates given as fractions become decimal percentages; country and
    tax-type keys resolved against bounded dimensions."""
    from quaestor.operators.keys import resolve_dimension_key
    s = subtypes.withColumn("rate_pct", (F.col("rate_fraction").cast("decimal(12,8)") * 100).cast("decimal(7,4)"))
    s = resolve_dimension_key(s, countries, {"country_code": "country_code"}, "country_key", on_missing="unknown",
                              broadcast_dim=True)
    return resolve_dimension_key(s, types, {"tax_type_code": "tax_type_code"}, "tax_type_key", on_missing="unknown",
                                 broadcast_dim=True)
