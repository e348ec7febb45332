"""Rule packs as data (Appendix A shapes -> L22-L32 operators).

A YAML/dict rule names its shape, the frames it reads and its parameters;
``build_rules`` turns the list into the callables ``checks.run_rule_pack``
executes (one aggregate per rule, unioned into one result)."""

from __future__ import annotations

import os
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaestor.functions.strings import regex_full_match
from quaestor.operators import checks as CHK

PACK_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "packs")


def load_pack(name: str) -> list[dict]:
    import yaml
    with open(os.path.join(PACK_DIR, f"{name}.yaml")) as fh:
        return yaml.safe_load(fh)


def _builder(r: Mapping):
    shape = r["shape"]
    t = r["table"]
    if shape == "predicate":
        return lambda fr: CHK.rule_predicate(fr[t], r["where"])
    if shape == "at_most_one":
        return lambda fr: CHK.rule_at_most_one(fr[t], r["group_by"], r.get("where"), r.get("exactly", False))
    if shape == "referential":
        return lambda fr: fr[t].where(F.col(r["column"]).isNotNull()).join(
            fr[r["reference"]].select(F.col(r["reference_column"]).alias(r["column"])).distinct(), r["column"], "left_anti")
    if shape == "cross_table":
        return lambda fr: CHK.rule_cross_table(fr[t], fr[r["other"]], r["on"], F.expr(r["mismatch"]))
    if shape == "sum_reconciles":
        return lambda fr: CHK.rule_sum_reconciles(fr[t], fr[r["child"]], r["key"], r["amount"], r["child_amount"],
                                                  r.get("tolerance", 0.01))
    if shape == "no_overlap":
        return lambda fr: CHK.rule_no_overlap(fr[t], r["group_by"], r["start"], r["end"], r["id"],
                                              r.get("check_gaps", False))
    if shape == "timeliness":
        return lambda fr: CHK.rule_timeliness(fr[t], r["date"], fr["__as_of"], r["sla_days"], r.get("where"))
    if shape == "regex":
        return lambda fr: fr[t].where(F.col(r["column"]).isNotNull() & ~regex_full_match(r["column"], r["pattern"]))
    if shape == "completeness":
        return lambda fr: CHK.rule_completeness(fr[t], fr[r["child"]], r["key"], r.get("min_children", 1),
                                                r.get("seq_col"))
    if shape == "balance_equation":
        return lambda fr: CHK.balance_equation(fr[t], r["opening"], r["debit"], r["credit"], r["closing"],
                                               r.get("tolerance", 0.01))
    raise ValueError(f"unknown rule shape {shape}")


def build_rules(pack: Sequence[Mapping]) -> list[dict]:
    return [{"code": r["code"], "table": r["table"], "severity": r.get("severity", "ERROR"), "build": _builder(r)}
            for r in pack]


def run_pack(pack: Sequence[Mapping], frames: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    fr = dict(frames)
    fr["__as_of"] = as_of
    return CHK.run_rule_pack(build_rules(pack), fr)
