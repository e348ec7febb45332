"""Form specification jobs.

A form specification (fields, formulas, validation rules) is configuration
read on the driver; it becomes DataFrame plans directly, no SQL text is
generated.  Row formulas are Spark SQL expressions applied in dependency
order; aggregate formulas are grouped child frames joined once.
"""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaestor.functions.numeric import money
from quaestor.operators import dq as DQ
from quaestor.operators.windows import year_to_date


def _deps(expr: str, names: set[str]) -> set[str]:
    return {t for t in re.findall(r"[A-Za-z_][A-Za-z0-9_]*", expr) if t in names}


def formula_order(formulas: Mapping[str, str]) -> list[str]:
    """Topological order of row formulas (target -> expression)."""
    names = set(formulas)
    order, done = [], set()

    def visit(n, stack=()):
        if n in done:
            return
        if n in stack:
            raise ValueError(f"formula cycle through {n}")
        for d in _deps(formulas[n], names - {n}):
            visit(d, stack + (n,))
        done.add(n)
        order.append(n)

    for n in formulas:
        visit(n)
    return order


def form_formulas_row(df: DataFrame, formulas: Mapping[str, str], money_targets: Sequence[str] = ()) -> DataFrame:
    """Sums, differences, GREATEST(0, .), LEAST caps, rate x base,
    IF/THEN as CASE - each formula one column, in dependency order, in a
    single projection chain that Catalyst collapses."""
    out = df
    for name in formula_order(formulas):
        c = F.expr(formulas[name])
        out = out.withColumn(name, money(c) if name in money_targets else c)
    return out


def form_formulas_agg(parent: DataFrame, child: DataFrame, key: str, aggs: Mapping[str, Column]) -> DataFrame:
    """SUM / COUNT / COUNT DISTINCT over line items, pre-aggregated on
    the parent key and joined once (no fan-out)."""
    a = child.groupBy(key).agg(*[v.alias(k) for k, v in aggs.items()])
    return parent.join(a, key, "left")


def form_formula_conditional_sum(child: DataFrame, key: str, value: str, dim: str, members: Sequence[str],
                                 prefix: str = "sum_") -> DataFrame:
    """SUM with a filter per dimension member (e.g. per member state),
    one conditional aggregate per member."""
    return child.groupBy(key).agg(*[
        F.coalesce(F.sum(F.when(F.col(dim) == m, money(value))), F.lit(0).cast("decimal(19,2)"))
        .alias(f"{prefix}{m}".lower().replace("-", "_").replace(" ", "_")) for m in members])


def form_year_to_date(df: DataFrame, keys: Sequence[str], period_col: str, values: Sequence[str]) -> DataFrame:
    """N04 year-to-date form formula."""
    return year_to_date(df, keys, period_col, values)


def form_calc_check(df: DataFrame, submitted: str, recomputed: str | Column, tolerance: float = 0.01,
                    out_col: str = "calc_difference") -> DataFrame:
    """Rows whose submitted value differs from the formula by more than
    the tolerance."""
    r = F.expr(recomputed) if isinstance(recomputed, str) else recomputed
    return df.withColumn(out_col, money(submitted) - money(r)).where(F.abs(F.col(out_col)) > F.lit(tolerance))


def form_rules(df: DataFrame, rules: Sequence[Mapping], as_of: str,
               references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run a form's validation rules (the rule types of the form
    specifications).  Returns the frame annotated with ``_violations``.

    range, pattern, codelist / allowed_values, required, format (length),
    date_range, uniqueness and lookup (existence in a reference frame) map to
    the DQ engine; cross_field, conditional, conditional_required,
    date_logic, comparison, date, minimum and calculation carry a Spark SQL
    predicate that must hold; iban is the ISO 7064 mod-97 check.  VIES
    validation needs an external service and is not built.
    """
    from quaestor.functions.identifiers import mod97_valid
    mapped = []
    for r in rules:
        t = r["type"].lower()
        base = {"rule_code": r["code"], "severity": r.get("severity", "ERROR"), "action": r.get("action", "REJECT")}
        if t == "range":
            mapped.append({**base, "rule_type": "RANGE", "columns": [r["field"]],
                           "params": {"min": r.get("min"), "max": r.get("max")}})
        elif t == "pattern":
            mapped.append({**base, "rule_type": "PATTERN", "columns": [r["field"]], "params": {"pattern": r["pattern"]}})
        elif t in ("codelist", "allowed_values"):
            mapped.append({**base, "rule_type": "ALLOWED_VALUES", "columns": [r["field"]], "params": {"values": r["values"]}})
        elif t == "uniqueness":
            mapped.append({**base, "rule_type": "UNIQUE", "columns": list(r["fields"])})
        elif t == "required":
            mapped.append({**base, "rule_type": "NOT_NULL", "columns": [r["field"]]})
        elif t == "format":
            mapped.append({**base, "rule_type": "LENGTH", "columns": [r["field"]],
                           "params": {"min": r.get("min"), "max": r.get("max")}})
        elif t == "date_range":
            mapped.append({**base, "rule_type": "DATE_RANGE", "columns": [r["field"]],
                           "params": {"min": r.get("min"), "max": r.get("max")}})
        elif t == "lookup":
            mapped.append({**base, "rule_type": "REFERENTIAL", "columns": [r["field"]],
                           "params": {"reference": r["reference"], "reference_column": r["reference_column"]}})
        elif t == "iban":
            c = F.col(r["field"])
            mapped.append({**base, "rule_type": "CUSTOM", "columns": [r["field"]],
                           "params": {"expression": c.isNull() | mod97_valid(c)}})
        elif t in ("cross_field", "conditional", "conditional_required", "date_logic", "comparison", "date",
                   "minimum", "calculation"):
            mapped.append({**base, "rule_type": "CUSTOM", "columns": [r.get("field", "")],
                           "params": {"expression": r["expression"]}})
        else:
            raise ValueError(f"unknown or unsupported form rule type {t}")
    return DQ.apply_rules(df, mapped, as_of, references)
