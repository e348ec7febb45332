"""Binding of tax-administration concepts to the driver's test tables.

Done once here; every query then calls the same operators it would call on
real tax schemas.  The oracle SQL repeats the same binding as CTEs
(``quaestor.plans.sqlbind``).

| concept                         | test table binding                                       |
|---------------------------------|----------------------------------------------------------|
| party                           | customer (c_custkey, c_name, c_nationkey, segment, bal)  |
| geography region > nation       | region, nation                                           |
| tax type                        | distinct o_orderpriority                                 |
| tax return / assessment         | orders (period = order date, amount = o_totalprice)      |
| return lines, allocations       | lineitem by l_orderkey (charge type = l_returnflag)      |
| due date                        | last day of the order month + 15 days                    |
| filing date                     | first l_shipdate of the return's lines                   |
| payment                         | lineitem: date = l_shipdate, amount = price*(1-discount) |
| ledger                          | orders debit (+), payments credit (-), account = party   |
| compliance events, streams      | events (party = user_id, type = event_type)              |
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.functions.dates import date_key
from quaestor.functions.numeric import money, MONEY
from quaestor.sources.scan import table

# As-of dates of the test data (max order date, end of events).
AS_OF_ORDERS = "2001-08-01"
AS_OF_EVENTS = "2024-01-31"
DUE_DAYS_AFTER_MONTH_END = 15


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "sf_dir"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = table(self.spark, self.sf_dir, name)
        return self._cache[name]


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def party(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name"),
                    F.col("c_nationkey").alias("nation_key"), F.col("c_mktsegment").alias("segment"),
                    money("c_acctbal").alias("balance"))


def return_lines(t: Tables) -> DataFrame:
    """One row per return line (lineitem)."""
    l_ = t.lineitem
    return l_.select(
        F.col("l_orderkey").alias("return_id"), F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id"),
        money("l_extendedprice").alias("line_amount"),
        F.col("l_returnflag").alias("charge_type_code"), F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        money(money("l_extendedprice") * (F.lit(1) - money("l_discount"))).alias("payment_amount"),
        money("l_discount").alias("discount"), money("l_tax").alias("tax_rate"))


def line_totals(t: Tables) -> DataFrame:
    """Per-return totals of the child lines, pre-aggregated before any
    join (no fan-out)."""
    return return_lines(t).groupBy("return_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("line_amount").alias("declared_amount"),
        F.sum("payment_amount").alias("paid_amount"),
        F.min("ship_date").alias("first_ship_date"),
        F.max("ship_date").alias("last_ship_date"))


def returns(t: Tables) -> DataFrame:
    """Tax returns / assessments (orders) without line information."""
    o = t.orders
    d = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_orderkey").alias("return_id"), F.col("o_custkey").alias("party_id"),
        F.col("o_orderpriority").alias("tax_type_code"), d.alias("period_date"),
        money("o_totalprice").alias("assessed_amount"), F.col("o_orderstatus").alias("status"),
        F.date_add(F.last_day(d), DUE_DAYS_AFTER_MONTH_END).alias("due_date"))


def filings(t: Tables) -> DataFrame:
    """Returns with their filing date and lateness (one row per return)."""
    r = returns(t).join(line_totals(t), "return_id", "left")
    filed = F.col("first_ship_date").isNotNull()
    return (r.withColumn("filing_date", F.col("first_ship_date"))
            .withColumn("is_filed", filed.cast("int"))
            .withColumn("is_late", (filed & (F.col("first_ship_date") > F.col("due_date"))).cast("int"))
            .withColumn("is_on_time", (filed & (F.col("first_ship_date") <= F.col("due_date"))).cast("int"))
            .withColumn("days_late", F.when(filed, F.greatest(F.datediff("first_ship_date", "due_date"), F.lit(0)))))


def timed_payments(t: Tables) -> DataFrame:
    """Payments (one per line) with the paying party and the due date resolved
    via the return.

    The test lineitem has no unique key: (order, line) repeats, and at
    sf0.001 even (order, line, part, supplier) does, so a payment is
    identified by (order, line, part, supplier, ship date) - unique at every
    scale, and a total order for the allocation scans."""
    lines = return_lines(t)
    r = t.orders.select(F.col("o_orderkey").alias("return_id"), F.col("o_custkey").alias("party_id"),
                        F.col("o_orderpriority").alias("tax_type_code"),
                        F.date_add(F.last_day(F.col("o_orderdate").cast("date")), DUE_DAYS_AFTER_MONTH_END).alias("due_date"))
    return lines.join(r, "return_id").select(
        F.concat_ws("-", "return_id", "line_number", "part_id", "supplier_id",
                    date_key("ship_date").cast("string")).alias("payment_id"),
        "return_id", "line_number", "party_id", "tax_type_code",
        F.col("ship_date").alias("payment_date"), F.col("payment_amount"),
        F.col("charge_type_code"), F.col("line_status"), "due_date")


def payments(t: Tables) -> DataFrame:
    """Payments without the due date of their return."""
    return timed_payments(t).drop("due_date")


def ledger(t: Tables) -> DataFrame:
    """Account ledger: return amount as a debit on the order date, each
    payment as a credit on its ship date."""
    debit = returns(t).select(
        F.col("party_id").alias("account_id"), F.col("period_date").alias("txn_date"),
        F.lit("ASSESSMENT").alias("txn_type"), F.col("assessed_amount").alias("amount"),
        F.col("return_id").alias("ref_id"), F.lit(0).alias("ref_line"))
    credit = payments(t).select(
        F.col("party_id").alias("account_id"), F.col("payment_date").alias("txn_date"),
        F.lit("PAYMENT").alias("txn_type"), (-F.col("payment_amount")).cast(MONEY).alias("amount"),
        F.col("return_id").alias("ref_id"), F.col("line_number").alias("ref_line"))
    return debit.unionByName(credit)


def events(t: Tables) -> DataFrame:
    e = t.events
    return e.select(F.col("event_id"), F.col("ts").alias("event_ts"), F.col("ts").cast("date").alias("event_date"),
                    F.col("user_id").alias("party_id"), F.col("event_type"),
                    money("value").alias("event_value"), F.col("props"))
