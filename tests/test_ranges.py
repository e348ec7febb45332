"""Operators over range cuts, deep hierarchies and growing periods against
plain Python, with a key that holds most rows and stands in several ranges."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from quaestor.operators import hierarchy as H
from quaestor.operators import joins as JN
from quaestor.operators import ledger as LED
from quaestor.operators import ranges as R
from quaestor.plans import dims as DIM
from quaestor.plans import snapshots as SNAP

DAY = dt.date(2024, 1, 1)


@pytest.fixture()
def ranged(spark):
    """Ranges stay as many as shuffle partitions, small as they are here."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def hot_rows(n=400):
    rng = random.Random(3)
    return [(rng.choice([None, 1, 2, 7, 7, 7, 7]), i, rng.choice([None, rng.randrange(100)])) for i in range(n)]


def test_a_hot_key_stands_in_many_ranges_and_runs_through(ranged):
    rows = hot_rows()
    cut = R.cut(ranged.createDataFrame(rows, "k int, o int, v int"), ["k"], ["o"])
    assert cut.where("k = 7").select(R.PART).distinct().count() > 2
    per_range = [r["count"] for r in cut.groupBy(R.PART).count().collect()]
    assert max(per_range) <= 2 * sorted(per_range)[len(per_range) // 2]
    sums = {(r.k, r.o): r.s for r in R.running_sums(cut, ["k"], {"s": F.coalesce("v", F.lit(0))}).collect()}
    upto = {(r.k, r.o): r.f for r in R.filled(cut, ["k"], {"f": "v"}).collect()}
    before = {(r.k, r.o): r.f for r in R.filled(cut, ["k"], {"f": "v"}, inclusive=False).collect()}
    for k in {r[0] for r in rows}:
        total, last = 0, None
        for _, o, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            assert before[k, o] == last
            total, last = total + (v or 0), last if v is None else v
            assert (sums[k, o], upto[k, o]) == (total, last)


def test_as_of_join_takes_the_latest_on_or_before_each_date(ranged):
    rng = random.Random(5)
    right = [(rng.choice([1, 7, 7, 7, None]), None if i % 50 == 0 else DAY + dt.timedelta(rng.randrange(200)), i, f"r{i}") for i in range(300)]
    left = [(i, rng.choice([1, 2, 7, 7, None]), None if i % 40 == 0 else DAY + dt.timedelta(rng.randrange(220))) for i in range(200)]
    df = R.join_as_of(ranged.createDataFrame(left, "id int, k int, d date"), ranged.createDataFrame(right, "k int, d date, seq int, name string"),
                      ["k"], "d", "d", ["seq", "name"], ["seq"])
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        df.explain()
    assert "NestedLoop" not in plan.getvalue() and "Cartesian" not in plan.getvalue()
    got = {r.id: (r.seq, r.name) for r in df.collect()}
    for i, k, d in left:
        there = [(x[1], x[2], x[3]) for x in right if x[0] == k and x[1] is not None and d is not None and x[1] <= d]
        assert got[i] == (max(there)[1:] if there else (None, None))
    assert len(got) == len(left)


def test_registration_history_equals_day_by_day(ranged):
    rng = random.Random(6)

    def records(n):
        out = []
        for _ in range(n):
            s = rng.randrange(100)
            e = rng.choice([None, s + rng.randrange(0, 30), s + rng.randrange(0, 30), s - 3])
            out.append((rng.choice([1, 7, 7, 7]), None if rng.random() < 0.05 else DAY + dt.timedelta(s),
                        None if e is None else DAY + dt.timedelta(e), rng.choice("abc")))
        rng.shuffle(out)
        return out

    data = {n: records(25) for n in ("p", "q", "r", "s", "t")}
    frames = {n: ranged.createDataFrame(v, f"party int, valid_from date, valid_to date, {n}_code string") for n, v in data.items()}
    got = DIM.build_registration_history(frames, ["party"], {n: [f"{n}_code"] for n in data}).collect()

    def says(name, party, day):
        there = [(s, v, e) for k, s, e, v in data[name] if k == party and s is not None and s <= day and (e is None or e >= s)]
        # the latest start; of equal ones the greater value, then the later end, no end before any
        if not there:
            return None
        s, v, e = max(there, key=lambda x: (x[0], x[1], x[2] or dt.date.min))
        return v if e is None or e >= day else None

    for party in (1, 7):
        versions = sorted((r for r in got if r.party == party), key=lambda r: r.valid_from)
        assert [r.version_no for r in versions] == list(range(1, len(versions) + 1))
        for n in range(140):
            day = DAY + dt.timedelta(n)
            want = tuple(says(x, party, day) for x in data)
            here = [r for r in versions if r.valid_from <= day and (r.valid_to is None or r.valid_to >= day)]
            if any(want):
                assert len(here) == 1 and tuple(here[0][f"{x}_code"] for x in data) == want
                assert tuple(here[0][f"has_{x}"] for x in data) == tuple(int(w is not None) for w in want)
            else:
                assert not here
        for a, b in zip(versions, versions[1:]):  # equal neighbours are one version
            if a.valid_to == b.valid_from - dt.timedelta(1):
                assert [a[f"{x}_code"] for x in data] != [b[f"{x}_code"] for x in data]


@pytest.mark.parametrize("hot_rows", [10, 1000])
def test_priority_allocation_with_a_hot_party(ranged, hot_rows):
    rng = random.Random(9)
    liabilities = [(rng.choice([1, 7, 7, 7]), i, DAY + dt.timedelta(rng.randrange(90)), rng.randrange(0, 50), rng.randrange(0, 30), rng.randrange(1, 400))
                   for i in range(80)]
    payments = [(rng.choice([1, 7, 7, 7, 9]), f"P{i}", DAY + dt.timedelta(rng.randrange(90)), rng.choice([0, 5, 90, 3000])) for i in range(60)]
    ranks = [("INTEREST", "i"), ("PENALTY", "p"), ("PRINCIPAL_TAX", "t")]
    charges = LED.unpivot_charges(ranged.createDataFrame(liabilities, "party int, a int, due date, i int, p int, t int"), ranks, ["party", "a", "due"])
    out = LED.allocate(charges, ranged.createDataFrame(payments, "party int, pid string, day date, amt int"), ["party"],
                       ["a", "charge_type_code"], ["charge_rank", "due", "a"], "amount", "pid", ["day"], "amt", sequence_col="seq",
                       hot_rows=hot_rows)
    got = sorted((r.party, r.pid, r.seq, r.a, r.charge_type_code, float(r.allocated_amount)) for r in out.collect())
    want = []
    for party in (1, 7, 9):
        open_ = [[rank, due, a, code, float(amount)] for k, a, due, *amounts in liabilities if k == party
                 for rank, (code, amount) in enumerate(zip(("INTEREST", "PENALTY", "PRINCIPAL_TAX"), amounts)) if amount > 0]
        open_.sort()
        for _, pid, _, amt in sorted((p for p in payments if p[0] == party), key=lambda p: (p[2], p[1])):
            seq = 0
            while amt > 0 and open_:
                part = min(amt, open_[0][4])
                seq += 1
                want.append((party, pid, seq, open_[0][2], open_[0][3], float(part)))
                amt, open_[0][4] = amt - part, open_[0][4] - part
                if open_[0][4] == 0:
                    open_.pop(0)
    assert got == sorted(want)


def test_aging_buckets_add_up_to_the_debit_balance(ranged):
    rng = random.Random(2)
    items = [(i, rng.choice([1, 7, 7]), DAY + dt.timedelta(rng.randrange(300)), None, 10 * rng.randrange(1, 30)) for i in range(60)]
    items = [(i, k, p, p + dt.timedelta(rng.randrange(-20, 90)), a) for i, k, p, _, a in items]
    paid = [(i, p + dt.timedelta(rng.randrange(-30, 500)), a // 2) for i, _, p, _, a in items for _ in range(rng.randrange(3))]
    got = SNAP.build_open_item_aging(ranged.createDataFrame(items, "item_id int, account_id int, posted_date date, due_date date, amount int"),
                                     ranged.createDataFrame(paid, "item_id int, paid_date date, allocated_amount int"), "2025-12-31").collect()
    names = [n for n, _ in SNAP.AGING_BUCKETS]
    ends = [0, 30, 60, 90, 180, 365, 10**6]
    for r in got:
        assert sum(r[n] for n in names) == r.debit_balance
        want = dict.fromkeys(names, 0)
        for i, k, posted, due, a in items:
            if k == r.account_id and posted <= r.month_end:
                left = a - sum(x for j, d, x in paid if j == i and max(d, posted) <= r.month_end)
                late = (r.month_end - due).days
                want[next(n for n, e in zip(names, ends) if late <= e)] += left
        assert {n: int(r[n]) for n in names} == want
    assert {(r.account_id, r.month_end) for r in got} >= {(k, (p.replace(day=28) + dt.timedelta(4)).replace(day=1) - dt.timedelta(1)) for _, k, p, _, _ in items}


def test_chain_of_a_thousand_nodes(spark, monkeypatch):
    rounds = []
    plain = H.written
    monkeypatch.setattr(H, "written", lambda df: (rounds.append(1), plain(df))[1])
    nodes = spark.range(1000).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    got = H.walk_hierarchy(nodes, "id", "up")
    assert got.count() == 1000 * 1001 // 2 and got.where("distance != descendant - ancestor or is_cycle = 1").isEmpty()
    assert len(rounds) <= 36  # two or three writes a round of ten
    cut = H.walk_hierarchy(nodes, "id", "up", max_depth=5)
    assert cut.agg(F.max("distance")).first()[0] == 5
    assert cut.where("is_truncated = 1").select("descendant").distinct().count() == 1000 - 6
    flat = H.flatten_levels(got.where("descendant < 8"), nodes.withColumn("name", F.concat(F.lit("n"), "id")), "id", "name", max_levels=3)
    r = flat.where("id = 7").first()
    assert (r.level_1, r.level_3, r.depth, r.levels_cut, r.full_path) == ("n0", "n2", 8, 1, " > ".join(f"n{i}" for i in range(8)))


@pytest.mark.parametrize("bound", [None, 6])
def test_cycles_and_missing_parents(spark, bound):
    up = {"a": None, "b": "a", "x": "y", "y": "z", "z": "x", "v": "x", "w": "v", "self": "self", "m": "not there"}
    nodes = spark.createDataFrame([*up.items(), (None, "a")], "id string, p string")
    got = {(r.descendant, r.ancestor, r.distance, r.is_cycle) for r in H.walk_hierarchy(nodes, "id", "p", max_depth=bound).collect()}
    want = set()
    for n in up:
        want.add((n, n, 0, 0))
        seen, at, d = set(), up[n], 1
        while at is not None and at not in seen and d <= (bound or 99):
            want.add((n, at, d, int(at == n)))
            seen.add(at)
            at, d = up.get(at), d + 1
    assert got == want


def test_growing_intervals_give_one_row_per_match(spark):
    rng = random.Random(4)
    facts = [(i, rng.choice(["a", "b"]), None if i % 30 == 0 else DAY + dt.timedelta(rng.choice([5, rng.randrange(400)]))) for i in range(200)]
    periods = []
    for n in range(60):
        s = rng.randrange(380)
        periods.append((n, rng.choice(["a", "b"]), DAY + dt.timedelta(s), rng.choice([None, DAY + dt.timedelta(s + rng.randrange(-2, 120))])))
    periods.append((99, "a", None, None))
    f = spark.createDataFrame(facts, "id int, t string, d date")
    p = spark.createDataFrame(periods, "period int, t string, s date, e date")
    for on, width in (((), None), (("t",), 7)):
        df = JN.join_growing_intervals(f, "d", p if on else p.drop("t"), "s", "e", ["period"], on=on, width=width)
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain()
        assert "NestedLoop" not in plan.getvalue() and "Cartesian" not in plan.getvalue()
        want = []
        for i, t, d in facts:
            hit = [n for n, pt, s, e in periods if d and s and s <= d and (e is None or d <= e) and (not on or pt == t)]
            want += [(i, n) for n in hit] or [(i, None)]
        assert sorted(((r.id, r.period) for r in df.collect()), key=str) == sorted(want, key=str)
    none = JN.join_growing_intervals(f.where("false"), "d", p, "s", "e", ["period"], on=("t",))
    assert none.count() == 0 and none.columns == ["id", "t", "d", "period"]
