"""Row-level data quality.

All active rules are evaluated in one projection that builds an array of
violation structs per row; the annotated frame is then split three ways
(valid / rejected / exploded violations).  Set-based rules (UNIQUE,
REFERENTIAL) are aggregates or anti-joins joined back, never per-rule passes
over the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaestor.functions.strings import is_blank, regex_prefix_match

VIOLATION_T = T.StructType([
    T.StructField("rule_code", T.StringType()), T.StructField("rule_type", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("action", T.StringType()),
    T.StructField("column_name", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("message", T.StringType())])

REJECT_SEVERITIES = ("ERROR", "CRITICAL")


@dataclass
class Rule:
    rule_code: str
    rule_type: str
    columns: Sequence[str]
    params: Mapping = field(default_factory=dict)
    severity: str = "ERROR"
    action: str = "REJECT"
    active: bool = True
    message: str | None = None


def _rule(r) -> Rule:
    return r if isinstance(r, Rule) else Rule(**r)


# ---- single-column checks: each returns "fails" as a boolean Column ---------

def fails_not_null(c: Column) -> Column:
    """NULL or blank fails."""
    return is_blank(c)


def fails_pattern(c: Column, pattern: str) -> Column:
    """NULL passes; prefix-anchored match like ``re.match``."""
    return c.isNotNull() & ~regex_prefix_match(c.cast("string"), pattern)


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def fails_range(c: Column, lo=None, hi=None, dtype: str | None = None) -> Column:
    """Inclusive bounds; NULL and non-numeric values pass."""
    numeric = dtype is not None and (dtype in _NUMERIC or dtype.startswith("decimal"))
    v = c.cast("double") if numeric else c.cast("string").try_cast("double")
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (v < F.lit(float(lo)))
    if hi is not None:
        bad = bad | (v > F.lit(float(hi)))
    return v.isNotNull() & bad


def fails_length(c: Column, lo=None, hi=None) -> Column:
    """Inclusive on the string length; NULL passes."""
    n = F.length(c.cast("string"))
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (n < lo)
    if hi is not None:
        bad = bad | (n > hi)
    return c.isNotNull() & bad


def _date_bound(b, as_of) -> Column:
    if b is None:
        return None
    s = str(b).strip()
    if s.upper() == "CURRENT_DATE":
        return F.lit(as_of).cast("date")
    if s.upper().startswith("CURRENT_DATE"):  # CURRENT_DATE - INTERVAL n YEAR style bounds
        expr = s.upper().replace("CURRENT_DATE", f"DATE'{as_of}'")
        return F.expr(expr).cast("date")
    return F.lit(s).cast("date")


def fails_date_range(c: Column, lo=None, hi=None, as_of: str = "2001-08-01", dtype: str | None = None) -> Column:
    """Non-date fails; bounds may be literals, CURRENT_DATE or CURRENT_DATE
    +/- INTERVAL (evaluated at ``as_of``) (L05)."""
    if dtype is not None and (dtype == "date" or dtype.startswith("timestamp")):
        d = c.cast("date")
    else:
        d = F.coalesce(c.try_cast("date"), F.try_to_date(c.cast("string")))
    bad = c.isNotNull() & d.isNull()
    lb, ub = _date_bound(lo, as_of), _date_bound(hi, as_of)
    if lb is not None:
        bad = bad | (d < lb)
    if ub is not None:
        bad = bad | (d > ub)
    return c.isNotNull() & bad


def fails_allowed(c: Column, values: Sequence) -> Column:
    """Domain membership (L08); NULL passes."""
    return c.isNotNull() & ~c.cast("string").isin([str(v) for v in values])


def _row_check(r: Rule, as_of: str, dtypes: Mapping[str, str] | None = None) -> list[tuple[str, Column]]:
    t = r.rule_type.upper()
    p = r.params or {}
    out = []
    for cname in r.columns:
        c = F.col(cname)
        if t == "NOT_NULL":
            f = fails_not_null(c)
        elif t == "PATTERN":
            f = fails_pattern(c, p["pattern"])
        elif t == "RANGE":
            f = fails_range(c, p.get("min"), p.get("max"), (dtypes or {}).get(cname))
        elif t == "LENGTH":
            f = fails_length(c, p.get("min"), p.get("max"))
        elif t == "DATE_RANGE":
            f = fails_date_range(c, p.get("min"), p.get("max"), as_of, (dtypes or {}).get(cname))
        elif t in ("ALLOWED_VALUES", "CODELIST"):
            f = fails_allowed(c, p["values"])
        elif t == "CUSTOM":
            # A SQL predicate that must hold; NULL result passes
            e = p["expression"]
            f = ~F.coalesce(F.expr(e) if isinstance(e, str) else e, F.lit(True))
        else:
            continue
        out.append((cname, f))
        if t == "CUSTOM":
            break
    return out


def apply_rules(df: DataFrame, rules: Sequence, as_of: str = "2001-08-01",
                references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Annotate every row with ``_violations`` (L09 first half).  CUSTOM rules
    (K02) are Spark SQL predicates (or Columns) that must hold.

    UNIQUE (L06): duplicates found by an aggregate on the key columns joined
    back.  REFERENTIAL (L07): left join to the distinct reference keys.
    """
    rs = [_rule(r) for r in rules if _rule(r).active]
    out = df
    viols = []
    for i, r in enumerate(rs):
        t = r.rule_type.upper()
        if t == "UNIQUE":
            dup = (out.groupBy(*r.columns).agg(F.count(F.lit(1)).alias(f"__n{i}"))
                   .where(F.col(f"__n{i}") > 1))
            out = out.join(dup, list(r.columns), "left")
            fails = [(",".join(r.columns), F.col(f"__n{i}").isNotNull(),
                      F.concat_ws(":", *[F.col(c).cast("string") for c in r.columns]))]
        elif t == "REFERENTIAL":
            ref = references[r.params["reference"]]
            rk = r.params.get("reference_column", r.columns[0])
            keys = ref.select(F.col(rk).alias(f"__rk{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
            out = out.join(keys, F.col(r.columns[0]) == F.col(f"__rk{i}"), "left").drop(f"__rk{i}")
            fails = [(r.columns[0], F.col(r.columns[0]).isNotNull() & F.col(f"__hit{i}").isNull(),
                      F.col(r.columns[0]).cast("string"))]
        else:
            fails = [(cn, f, F.col(cn).cast("string")) for cn, f in _row_check(r, as_of, dict(df.dtypes))]
        for cn, f, val in fails:
            msg = r.message or f"{r.rule_type} check failed"
            viols.append(F.when(f, F.struct(F.lit(r.rule_code).alias("rule_code"), F.lit(t).alias("rule_type"),
                                            F.lit(r.severity.upper()).alias("severity"),
                                            F.lit(r.action.upper()).alias("action"),
                                            F.lit(cn).alias("column_name"), val.alias("value"),
                                            F.lit(msg).alias("message"))))
    helper = [c for c in out.columns if c.startswith("__n") or c.startswith("__hit")]
    arr = F.filter(F.array(*viols), lambda v: v.isNotNull()) if viols else F.array().cast(T.ArrayType(VIOLATION_T))
    return out.withColumn("_violations", arr).drop(*helper)


def _rejecting(v: Column) -> Column:
    return v["severity"].isin(*REJECT_SEVERITIES) & (v["action"] == "REJECT")


def valid_rows(annotated: DataFrame) -> DataFrame:
    """Rows kept (no rejecting violation); warnings stay attached."""
    return annotated.where(~F.exists("_violations", _rejecting))


def rejected_rows(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.exists("_violations", _rejecting))


def violation_log(annotated: DataFrame, key_cols: Sequence[str], run_id: str, table_name: str) -> DataFrame:
    """One row per violation with rule, column, value, message, action, run id."""
    from quaestor.functions.hashing import row_identifier
    return (annotated.select(row_identifier(*key_cols).alias("row_id"), F.explode("_violations").alias("v"))
            .select(F.lit(run_id).alias("execution_id"), F.lit(table_name).alias("table_name"), "row_id", "v.*"))


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, rejected, violations); persist ``annotated`` once upstream when
    all three are written."""
    viol = annotated.select(F.explode("_violations").alias("v")).select("v.*")
    return valid_rows(annotated), rejected_rows(annotated), viol


def rule_outcomes(annotated: DataFrame, rules: Sequence) -> DataFrame:
    """Per rule: violation count, distinct rows affected, severity (L09/L10 summary)."""
    v = annotated.select(F.monotonically_increasing_id().alias("__row"), F.explode("_violations").alias("v"))
    return v.groupBy("v.rule_code", "v.rule_type", "v.severity", "v.action").agg(
        F.count(F.lit(1)).alias("violation_count"), F.countDistinct("__row").alias("rows_affected"))


def error_budget(annotated: DataFrame, max_reject_pct: float = 5.0) -> DataFrame:
    """Load fails when more than ``max_reject_pct`` % of rows are rejected."""
    from quaestor.functions.numeric import pct
    s = annotated.agg(F.count(F.lit(1)).alias("total_rows"),
                      F.count_if(F.exists("_violations", _rejecting)).alias("rejected_rows"))
    s = s.withColumn("reject_pct", pct("rejected_rows", "total_rows", 2))
    return s.withColumn("status", F.when(F.col("reject_pct") > F.lit(max_reject_pct), F.lit("FAIL")).otherwise(F.lit("PASS")))


def dq_summary(log: DataFrame, as_of: str, days: int = 30, ts_col: str = "logged_at") -> DataFrame:
    """Violations and last seen per rule within ``days`` of as_of."""
    a = F.lit(as_of).cast("date")
    recent = log.where(F.col(ts_col).cast("date") >= F.date_sub(a, days))
    return recent.groupBy("rule_code", "severity").agg(F.count(F.lit(1)).alias("violation_count"),
                                                       F.max(ts_col).alias("last_seen"))
