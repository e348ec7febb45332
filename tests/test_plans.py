"""Plan guards: what the physical plans must (not) contain at any scale."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import SF01

# Queries whose only nested-loop joins attach a one-row aggregate
# (attach_scalars) or a bounded period table (fiscal years).
BOUNDED_NLJ = {"bridge_party_identifier", "compliance_event_analytics", "current_tax_periods", "current_taxpayers",
               "dim_date", "incremental_orders_lookback", "returns_by_fiscal_year", "scd2_checks", "scd2_party_merge",
               "tax_periods", "warehouse_validation", "urgent_returns_current_party", "dim_tax_period",
               "missing_account_periods", "ledger_postings",
               "first_return_day_after_due"}


def plan_text(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not n.startswith("stream_")))
def test_no_cartesian_products(spark, name):
    p = plan_text(E.queries()[name](spark, SF01))
    assert "CartesianProduct" not in p
    if "BroadcastNestedLoopJoin" in p:
        assert name in BOUNDED_NLJ


def test_filters_and_columns_reach_the_scan(spark):
    p = plan_text(E.queries()["incremental_orders_lookback"](spark, SF01), "formatted")
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in p
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in p  # the watermark scan reads one column
    p = plan_text(E.queries()["revenue_by_type_month"](spark, SF01), "formatted")
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in p


def test_aggregations_are_partial(spark):
    p = plan_text(E.queries()["filing_compliance_summary"](spark, SF01))
    assert "partial_sum" in p and "partial_count" in p
