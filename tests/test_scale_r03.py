"""Findings of round 3: closures of forests, periods, timelines, allocations and
aging behind one shuffle by key, against plain Python and their own other form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quaestor.operators import hierarchy as H
from quaestor.operators import ledger as LED
from quaestor.operators import ranges as R
from quaestor.plans import facts as FCT
from quaestor.plans import queries as Q
from quaestor.plans import snapshots as SNAP

DAY = dt.date(2024, 1, 1)


def rows(df):
    return sorted(map(str, df.collect()))


def forest(n=120):
    rng = random.Random(5)
    up = {f"n{i}": f"n{rng.randrange(max(0, i - 4), i)}" if i % 30 else None for i in range(n)}
    return up | {"lost": "no node", "n119": "lost"}


def closure_of(up):
    out = set()
    for n in up:
        at, d = n, 0
        while at is not None:
            out.add((n, at, d, 0))
            at, d = up.get(at), d + 1
    return out


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_forest_closure(spark, monkeypatch, block):
    """pairs of a forest are right, each once, whatever the blocks."""
    monkeypatch.setattr(H, "BLOCK", block)
    up = forest()
    nodes = spark.createDataFrame([*up.items(), (None, "n1"), ("n5", up["n5"])], "id string, p string")
    got = [tuple(r) for r in H.walk_hierarchy(nodes, "id", "p").collect()]
    assert len(got) == len(set(got)) and set(got) == closure_of(up)


def test_closure_writes_nodes_not_pairs(spark, monkeypatch):
    """what is written grows with the nodes, not with the pairs."""
    sizes, plain = [], H.written

    def counted(df):
        out = plain(df)
        sizes.append(out.count())
        return out
    monkeypatch.setattr(H, "written", counted)
    nodes = spark.range(600).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    assert H.walk_hierarchy(nodes, "id", "up").count() == 600 * 601 // 2
    assert max(sizes) <= 600


def test_two_parents_keep_each_way(spark):
    """No forest: a row per way up, as before."""
    nodes = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", None)], "id string, p string")
    got = sorted(tuple(r) for r in H.walk_hierarchy(nodes, "id", "p").where("descendant = 'd'").collect())
    assert got == [("d", "a", 2, 0), ("d", "a", 2, 0), ("d", "b", 1, 0), ("d", "c", 1, 0), ("d", "d", 0, 0)]


def test_missing_periods(spark):
    """an account without key or periods keeps all; no candidate is shuffled."""
    m = lambda k: dt.date(2024, k, 1)
    accounts = spark.createDataFrame([(1, "a", m(1), m(4)), (1, "b", m(3), m(4)), (2, "a", m(4), m(4)), (None, "a", m(4), m(4)),
                                      (3, "a", None, m(4)), (2, "a", m(4), m(4))], "p int, t string, s date, e date")
    have = spark.createDataFrame([(1, "a", m(2)), (1, "a", m(2)), (1, "a", None), (1, "a", m(4)), (2, "b", m(4)), (None, "a", m(4))],
                                 "p int, t string, period_month date")
    out = LED.open_account_periods(accounts, "s", "e", have, ["p", "t", "period_month"])
    got = sorted((str(r.p), r.t, r.period_month) for r in out.collect())
    assert got == sorted([("1", "a", m(1)), ("1", "a", m(3)), ("1", "b", m(3)), ("1", "b", m(4)), ("2", "a", m(4)), ("2", "a", m(4)),
                          ("None", "a", m(4))])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan


def test_timelines_alike_in_both_forms(spark):
    """windows behind one shuffle and range cuts give the same versions."""
    rng = random.Random(3)
    day = lambda k: DAY + dt.timedelta(k)
    made = lambda n: spark.createDataFrame(
        [(rng.choice([1, 1, 2, None]), *(lambda s: (day(s), rng.choice([None, day(s + rng.randrange(-1, 15))])))(rng.randrange(60)),
          rng.choice("xyz")) for _ in range(n)], f"k int, s date, e date, v{n} string")
    sources = {"one": made(40), "two": made(25)}
    each = [R.merge_timelines(sources, ["k"], "s", "e", {"one": ["v40"], "two": ["v25"]}, hot_rows=h) for h in (0, 10**6)]
    assert each[1]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert each[0].schema.simpleString() == each[1].schema.simpleString()
    assert rows(each[0]) == rows(each[1]) and each[1].count() > 20


def lines(spark):
    """Payments of three accounts: some above what is owed, some without amount,
    two of one id."""
    rng = random.Random(11)
    p = [(rng.randrange(1, 4), f"p{i}", DAY + dt.timedelta(rng.randrange(90)), rng.choice([None, -3, 0, 5, 20, 70])) for i in range(60)]
    p += [(2, "p7", p[7][2], 4), (9, "far", DAY, 6), (None, "none", DAY, 6)]
    pay = spark.createDataFrame([(a, b, c, None if d is None else str(d)) for a, b, c, d in p], "party_id int, payment_id string, payment_date date, x string") \
        .select("party_id", "payment_id", "payment_date", F.col("x").cast("decimal(19,2)").alias("payment_amount"))
    owed = spark.createDataFrame([(rng.randrange(1, 4), i, DAY + dt.timedelta(rng.randrange(90)), rng.choice([10, 30, 50])) for i in range(20)],
                                 "party_id int, return_id int, due_date date, amount int")
    return pay, owed


@pytest.mark.parametrize("hot", [0, 10**6])
def test_allocation_keeps_supply(spark, hot):
    """payments settled where they are allocated are those of the join."""
    pay, owed = lines(spark)
    args = ["party_id"], "return_id", ["due_date"], "amount"
    plain = LED.allocate(owed, pay, *args, "payment_id", ["payment_date"], "payment_amount", hot_rows=hot)
    one = pay.where("payment_id != 'p7'")
    carried = LED.allocate(owed, one, *args, ["payment_id", "payment_date", "payment_amount"], ["payment_date"], "payment_amount",
                           hot_rows=hot, keep_supply=True, stored=True)
    got = FCT.settled_payments(carried)
    want = FCT.build_fact_payment(one.where("payment_amount > 0"), LED.allocate(owed, one, *args, "payment_id", ["payment_date"], "payment_amount"))
    assert rows(got) == rows(want.select(*got.columns))
    assert got.where("allocation_count = 0").count() > 1 and plain.where("allocated_amount <= 0 or return_id is null").isEmpty()


def test_dated_allocations_are_the_join(spark, tmp_path):
    """repeated lines and repeated orders give the rows of the join on payment_id."""
    ts = lambda k: dt.datetime(2000, 1, 1) + dt.timedelta(k)
    orders = [(1, 1, "F", 100.0, ts(0), "1-URGENT"), (1, 2, "F", 60.0, ts(0), "1-URGENT"), (2, 1, "O", 80.0, ts(9), "2-HIGH"),
              (3, None, "O", 50.0, ts(4), "2-HIGH"), (None, 1, "O", 40.0, ts(4), "2-HIGH")]
    items = [(1, 1, 1, 1, 1.0, 40.0, 0.0, 0.0, "A", "F", ts(3)), (1, 1, 1, 1, 1.0, 40.0, 0.0, 0.0, "A", "F", ts(3)),
             (1, 1, 1, 1, 1.0, 0.0, 0.0, 0.0, "A", "F", ts(3)), (2, 1, 1, 2, 1.0, 90.0, 0.0, 0.0, "A", "F", None),
             (2, 1, None, 3, 1.0, None, 0.0, 0.0, "A", "F", ts(5)), (3, 1, 1, 1, 1.0, 90.0, 0.0, 0.0, "A", "F", ts(5)),
             (2, 2, 2, 4, 1.0, 500.0, 0.0, 0.0, "A", "F", ts(8))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    t = Q.B.tables(spark, str(tmp_path))
    want = Q._allocations(t).join(Q.B.payments(t).select("payment_id", "payment_date"), "payment_id")
    got = Q.dated_allocations(t)
    assert rows(got.select(*want.columns)) == rows(want) and want.count() > 6
    fact = FCT.build_fact_payment(Q.B.payments(t), Q._allocations(t))
    assert rows(Q.q_fact_payment(spark, str(tmp_path)).select(*fact.columns)) == rows(fact)


def test_aging_alike_in_both_forms(spark):
    """events made behind one shuffle by account are those of the range cuts."""
    rng = random.Random(2)
    day = lambda k: DAY + dt.timedelta(k)
    items = spark.createDataFrame([(i, rng.choice([1, 1, 2, None]), day(s := rng.randrange(200)), day(s + 20), rng.randrange(1, 50))
                                   for i in range(40)], "item_id int, account_id int, posted_date date, due_date date, amount int")
    paid = spark.createDataFrame([(rng.randrange(42), day(rng.randrange(300)), rng.randrange(1, 9)) for _ in range(50)],
                                 "item_id int, paid_date date, allocated_amount int")
    each = [SNAP.build_open_item_aging(items, paid, "2025-06-30", hot_rows=h) for h in (0, 10**6)]
    assert each[0].schema.simpleString() == each[1].schema.simpleString()
    assert rows(each[0]) == rows(each[1]) and each[1].count() > 20
