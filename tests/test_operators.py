import uuid
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from quaestor.operators import checks as CHK, dq as DQ, keys as K, ledger as LED, mapping as MAP, merge as MRG
from quaestor.operators import scd as SCD, windows as WIN
from quaestor.session import checkpoint_dir
from quaestor.operators.hierarchy import walk_hierarchy, cycle_nodes


def test_ingestion_fixture_mapping(spark):
    # FIXTURES section 1: source rows, expected target rows, lookup I/C
    src = spark.createDataFrame([("TP001", "  john doe  ", "I", "2023-01-15"), ("TP002", "ABC Company Ltd", "C", "2023-02-20"),
                                 ("TP003", "Jane Smith", "I", "2023-03-10")],
                                "taxpayer_id string, taxpayer_name string, taxpayer_type string, registration_date string")
    m = [{"source_column": "taxpayer_id", "target_column": "party_id", "is_key": True},
         {"source_column": "taxpayer_name", "target_column": "party_name", "transformation_type": "EXPRESSION",
          "expression": "UPPER(TRIM({source_column}))"},
         {"source_column": "taxpayer_type", "target_column": "party_type", "transformation_type": "LOOKUP",
          "lookup": {"I": "INDIVIDUAL", "C": "COMPANY"}},
         {"source_column": "registration_date", "target_column": "registration_date", "data_type": "DATE"}]
    out = MAP.good_rows(MAP.apply_mapping(src, m)).orderBy("party_id").collect()
    assert [(r.party_id, r.party_name, r.party_type) for r in out] == [
        ("TP001", "JOHN DOE", "INDIVIDUAL"), ("TP002", "ABC COMPANY LTD", "COMPANY"), ("TP003", "JANE SMITH", "INDIVIDUAL")]


def test_cast_failures_are_error_rows(spark):
    src = spark.createDataFrame([("1", "x"), ("2", "12")], "id string, amount string")
    mapped = MAP.apply_mapping(src, [{"source_column": "id", "target_column": "id"},
                                     {"source_column": "amount", "target_column": "amount", "data_type": "INT"}])
    assert MAP.error_rows(mapped).count() == 1
    assert MAP.good_rows(mapped).first().amount == 12


def test_lookup_null_and_fallback(spark):
    df = spark.createDataFrame([("I",), (None,), ("Z",)], "t string")
    out = [r.v for r in df.select(MAP.map_lookup(F.col("t"), {"I": "INDIVIDUAL"}, "OTHER").alias("v")).collect()]
    assert out == ["INDIVIDUAL", None, "OTHER"]


def test_upsert_insert_update(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "C"), (3, "C2")], "k int, v string")
    up = dict((r.k, r.v) for r in MRG.upsert(tgt, src, ["k"], ["v"]).collect())
    assert up == {1: "a", 2: "B", 3: "C2"}
    again = dict((r.k, r.v) for r in MRG.upsert(MRG.upsert(tgt, src, ["k"], ["v"]), src, ["k"], ["v"]).collect())
    assert again == up  # idempotent
    ins = dict((r.k, r.v) for r in MRG.insert_ignore(tgt, src, ["k"], ["v"]).collect())
    assert ins == {1: "a", 2: "b", 3: "C"}
    upd = dict((r.k, r.v) for r in MRG.update_existing(tgt, src, ["k"], ["v"]).collect())
    assert upd == {1: "a", 2: "B"}
    assert MRG.load_with_strategy(tgt, src, [], "UPSERT").count() == 5


def test_scd2_invariants(spark):
    cur = SCD.initial_scd2(spark.createDataFrame([(1, "x"), (2, "y")], "k int, seg string"), ["k"], "2024-01-01")
    inc = spark.createDataFrame([(1, "x"), (2, "z"), (3, "w")], "k int, seg string")
    out = SCD.scd2_merge(cur, inc, ["k"], ["seg"], "2024-06-01")
    rows = out.collect()
    assert len(rows) == 4
    current = [r for r in rows if r.is_current == 1]
    assert sorted(r.k for r in current) == [1, 2, 3]
    assert sorted(r.surrogate_key for r in rows) == [1, 2, 3, 4]
    old2 = [r for r in rows if r.k == 2 and r.is_current == 0][0]
    new2 = [r for r in rows if r.k == 2 and r.is_current == 1][0]
    assert str(old2.valid_to) == "2024-06-01" and new2.version_number == 2 and new2.valid_to is None
    checks = {r.check_name: r.rows_failed for r in CHK.check_scd2(out, "d").collect()}
    assert checks == {"scd2_current_open": 0, "scd2_history_closed": 0}


def test_sequential_key_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("nk"))
    a = K.sequential_key(df, ["nk"], "k", offset=10)
    b = df.withColumn("k", F.row_number().over(Window.orderBy("nk")) + 10)
    assert a.exceptAll(b.select("nk", F.col("k").cast("long"))).count() == 0


def test_running_agg_chunked_equals_plain(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("acct"), F.col("id").alias("t"),
                                     (F.col("id") % 17 - 8).alias("amt"))
    a = WIN.running_agg(df, ["acct"], [F.col("t")], "amt", "bal", "sum")
    b = WIN.running_agg(df, ["acct"], [F.col("t")], "amt", "bal", "sum", chunk=F.floor(F.col("t") / 100))
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    c = WIN.running_agg(df, ["acct"], [F.col("t")], "amt", "mx", "max", inclusive=False)
    d = WIN.running_agg(df, ["acct"], [F.col("t")], "amt", "mx", "max", inclusive=False, chunk=F.floor(F.col("t") / 64))
    assert c.exceptAll(d.select(*c.columns)).count() == 0


def test_allocation_waterfall_sums(spark):
    dem = spark.createDataFrame([(1, "L1", 1, 100.0), (1, "L2", 2, 50.0), (2, "L3", 1, 10.0)],
                                "acct int, lid string, prio int, amt double")
    sup = spark.createDataFrame([(1, "P1", 1, 30.0), (1, "P2", 2, 200.0), (2, "P3", 1, 4.0)],
                                "acct int, pid string, d int, amt double")
    a = LED.allocate(dem, sup, ["acct"], "lid", ["prio"], "amt", "pid", ["d"], "amt")
    got = sorted((r.lid, r.pid, r.allocated_amount) for r in a.collect())
    assert got == [("L1", "P1", Decimal("30.00")), ("L1", "P2", Decimal("70.00")), ("L2", "P2", Decimal("50.00")),
                   ("L3", "P3", Decimal("4.00"))]
    summ = {r.pid: r.excess_amount for r in LED.allocation_summary(sup, a, ["acct"], "pid", "amt").collect()}
    assert summ["P2"] == Decimal("80.00") and summ["P1"] == 0


def test_installments_sum_to_total(spark):
    plans = spark.createDataFrame([(1, 100.0, 3, "2024-01-31")], "id int, total double, n int, start string") \
        .withColumn("start", F.col("start").cast("date"))
    s = LED.installment_schedule(plans, "total", "n", "start", 1).collect()
    assert sum(r.installment_amount for r in s) == Decimal("100.00")
    assert [str(r.due_date) for r in s] == ["2024-01-31", "2024-02-29", "2024-03-31"]
    p = LED.installment_split(plans, "total", "n").collect()
    assert sum(r.installment_amount for r in p) == Decimal("100.00")
    assert p[0].installment_amount == Decimal("40.00")
    odd = LED.installment_split(plans.limit(1).withColumn("total", F.lit("100.01").cast("decimal(19,2)"))
                                .withColumn("n", F.lit(3)), "total", "n").orderBy("installment_no").collect()
    assert [str(r.installment_amount) for r in odd] == ["40.00", "24.00", "36.01"]


def test_progressive_tax(spark):
    df = spark.createDataFrame([(50000.0,), (300000.0,)], "x double")
    br = [(0, 100000, 0.0), (100000, 250000, 6.0), (250000, None, 12.0)]
    out = [r.t for r in df.select(LED.progressive_tax("x", br).alias("t")).collect()]
    assert out == [Decimal("0.00"), Decimal("15000.00")]


def test_percentile_rank_matches_window(spark):
    df = spark.range(0, 500).select((F.col("id") % 4).alias("g"), (F.col("id") * 37 % 101).alias("s"))
    a = WIN.percentile_rank(df, ["g"], "s")
    b = df.withColumn("pr", F.percent_rank().over(Window.partitionBy("g").orderBy("s")))
    j = a.join(b, ["g", "s"]).where(F.abs(F.col("percentile_rank") - F.col("pr") * 100) > 0.006)
    assert j.count() == 0


def test_overlap_and_islands(spark):
    df = spark.createDataFrame([(1, 1, "2024-01-01", "2024-01-10"), (1, 2, "2024-01-05", "2024-01-07"),
                                (1, 3, "2024-01-10", "2024-01-12"), (2, 4, "2024-01-01", "2024-01-02"),
                                (3, 5, "2024-01-01", None), (3, 6, "2024-03-01", "2024-03-02"),
                                (None, 7, "2024-01-01", "2024-01-02"), (None, 8, "2024-01-02", "2024-01-03")],
                               "g int, id int, s string, e string")
    out = {r.id: r.overlaps_previous for r in WIN.overlap_flags(df, ["g"], "s", "e", "id").collect()}
    assert out == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0, 6: 1, 7: 0, 8: 1}
    chunked = WIN.overlap_flags(df, ["g"], "s", "e", "id", chunk=F.substring("s", 1, 7)).collect()
    assert {r.id: r.overlaps_previous for r in chunked} == out
    m = spark.createDataFrame([(1, i, v) for i, v in enumerate([5, 6, 7, 1, 8, 9])], "k int, i int, v int")
    runs = WIN.gaps_and_islands(m, ["k"], "i", F.col("v") > 4, 2).orderBy("run_start").collect()
    assert [(r.run_start, r.run_end, r.run_length) for r in runs] == [(0, 2, 3), (4, 5, 2)]


def test_repeat_flag_and_primary(spark):
    ev = spark.createDataFrame([(1, "p", "a", 1), (2, "p", "a", 2), (3, "p", "b", 1)], "id int, party string, t string, ts int")
    out = {r.id: r.is_repeat for r in WIN.repeat_event_flag(ev, ["party", "t"], "ts", "id").collect()}
    assert out == {1: 0, 2: 1, 3: 0}
    b = spark.createDataFrame([(1, "x", 5.0, 1), (1, "y", 5.0, 2), (2, "z", 1.0, 1)], "p int, c string, amt double, o int")
    prim = {r.c: r.is_primary for r in WIN.flag_primary(b, ["p"], "amt", ["o"]).collect()}
    assert prim == {"x": 1, "y": 0, "z": 1}


def test_dq_split(spark):
    df = spark.createDataFrame([(1, "A", 5.0), (1, "B", 50.0), (2, None, 1.0)], "k int, c string, x double")
    rules = [{"rule_code": "NN", "rule_type": "NOT_NULL", "columns": ["c"]},
             {"rule_code": "RG", "rule_type": "RANGE", "columns": ["x"], "params": {"max": 10}, "severity": "WARNING",
              "action": "FLAG"},
             {"rule_code": "UQ", "rule_type": "UNIQUE", "columns": ["k"]}]
    ann = DQ.apply_rules(df, rules)
    valid, rejected, viol = DQ.split(ann)
    assert valid.count() == 0 and rejected.count() == 3
    counts = {r.rule_code: r.violation_count for r in DQ.rule_outcomes(ann, rules).collect()}
    assert counts == {"NN": 1, "RG": 1, "UQ": 2}
    assert DQ.error_budget(ann).first().status == "FAIL"


def test_hierarchy_walk_detects_cycles(spark, tmp_path):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "id string, p string")
    closure = walk_hierarchy(nodes, "id", "p", max_depth=5)
    anc = sorted(r.ancestor for r in closure.where("descendant = 'c' and distance > 0").collect())
    assert anc == ["a", "b"]
    assert sorted(r.descendant for r in cycle_nodes(closure).collect()) == ["x", "y"]


def test_rule_shapes(spark):
    p = spark.createDataFrame([(1, 10.0), (2, 5.0)], "k int, amt double")
    c = spark.createDataFrame([(1, 4.0), (1, 6.0), (2, 1.0)], "k int, amt double")
    assert [r.k for r in CHK.rule_sum_reconciles(p, c, "k", "amt", "amt").collect()] == [2]
    iv = spark.createDataFrame([(1, 1, "2024-01-01", "2024-01-31"), (1, 2, "2024-01-15", "2024-02-28")],
                               "g int, id int, s string, e string")
    assert CHK.rule_no_overlap(iv, ["g"], "s", "e", "id").count() == 1
    pack = CHK.run_rule_pack([{"code": "R1", "build": lambda fr: fr["p"].where("amt < 0")},
                              {"code": "R2", "build": lambda fr: fr["p"].where("amt > 6"), "severity": "WARNING"}],
                             {"p": p})
    assert {r.rule_code: r.status for r in pack.collect()} == {"R1": "PASS", "R2": "WARNING"}


def test_chunked_allocation_equals_plain(spark):
    import random
    rnd = random.Random(7)
    dem = [(a, f"L{a}-{i}", i, float(rnd.randint(1, 500))) for a in range(3) for i in range(40)]
    sup = [(a, f"P{a}-{i}", i, float(rnd.randint(1, 400))) for a in range(3) for i in range(50)]
    d = spark.createDataFrame(dem, "acct int, lid string, prio int, amt double")
    s = spark.createDataFrame(sup, "acct int, pid string, day int, amt double")
    plain = LED.allocate(d, s, ["acct"], "lid", ["prio"], "amt", "pid", ["day"], "amt")
    chunked = LED.allocate(d, s, ["acct"], "lid", ["prio"], "amt", "pid", ["day"], "amt", chunk_width=700.0,
                           demand_chunk=F.floor(F.col("prio") / 7), supply_chunk=F.floor(F.col("day") / 9))
    assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0
    # conservation: per account, allocated = min(total demand, total supply)
    tot = {r.acct: r.t for r in plain.groupBy("acct").agg(F.sum("allocated_amount").alias("t")).collect()}
    for a in range(3):
        td = sum(x[3] for x in dem if x[0] == a)
        ts = sum(x[3] for x in sup if x[0] == a)
        assert float(tot[a]) == min(td, ts)


def test_join_patterns(spark):
    from quaestor.operators import joins as JN
    decl = spark.createDataFrame([(1, None, "DE"), (2, "CN", "US")], "id int, origin string, dispatch string")
    ctry = spark.createDataFrame([("DE", "Germany"), ("CN", "China")], "code string, name string")
    out = {r.id: r.name for r in JN.join_coalesced_key(decl, ctry, ["origin", "dispatch"], "code").collect()}
    assert out == {1: "Germany", 2: "China"}
    a = spark.createDataFrame([(1, None), (2, "VAT")], "k int, t string")
    b = spark.createDataFrame([(1, None, "x"), (2, "VAT", "y")], "k2 int, t2 string, v string")
    assert JN.join_null_safe(a, b, {"k": "k2", "t": "t2"}, "inner").count() == 2
    ids = spark.createDataFrame([("TIN", "MLT", "123"), ("TIN", "LKA", "9")], "id_type string, country string, value string")
    fmt = spark.createDataFrame([("TIN", None, "generic"), ("TIN", "MLT", "malta")], "id_type string, country string, rule string")
    got = sorted((r.country, r.rule) for r in JN.join_universal_or_specific(ids, fmt, ["id_type"], "country").collect())
    assert got == [("LKA", "generic"), ("MLT", "generic"), ("MLT", "malta")]
    rows = spark.createDataFrame([(1, "A,B"), (2, "C")], "id int, codes string")
    ref = spark.createDataFrame([("A",), ("C",)], "code string")
    assert [(r.id, r.code) for r in JN.join_anti_array(rows, "codes", "id", ref, "code").collect()] == [(1, "B")]


def test_select_helpers(spark):
    from quaestor.operators import select as SEL
    ref = spark.createDataFrame([("A", None, "univ"), ("A", "MLT", "mt"), ("B", None, "univB")],
                                "code string, country string, label string")
    got = sorted((r.code, r.label) for r in SEL.effective_code_lookup(ref, "code", "country", "MLT").collect())
    assert got == [("A", "mt"), ("B", "univB")]
    tr = spark.createDataFrame([("TT", 1, "name", "en", "Income"), ("TT", 1, "name", "mt", "Dħul"), ("TT", 2, "name", "en", "VAT")],
                               "object_type string, key int, attribute_name string, language_code string, translated_value string")
    df = spark.createDataFrame([(1,), (2,)], "k int")
    lab = {r.k: r.label for r in SEL.localized_value(df, tr, {"k": "key"}, "name", "mt").collect()}
    assert lab == {1: "Dħul", 2: "VAT"}


def test_chunked_running_sum_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 1), (None, "2024-01-01", 2), (None, None, 4)], "k int, d string, v int")
    out = WIN.running_agg(df, ["k"], ["d"], "v", "s", chunk=F.substring("d", 1, 7)).collect()
    assert sorted((r.v, r.s) for r in out) == [(1, 1), (2, 6), (4, 4)]


def test_sequential_key_is_dense_with_wide_rows(spark):
    wide = (spark.range(0, 150_000, 1, 40).select(F.col("id").alias("nk"), F.xxhash64("id").alias("h"))
            .withColumn("payload", F.repeat(F.sha2(F.col("h").cast("string"), 256), 3)).orderBy("h"))
    keyed = K.sequential_key(wide, ["nk"], "k", offset=5)
    path = f"{checkpoint_dir(spark)}/keys-{uuid.uuid4().hex[:8]}"
    keyed.write.parquet(path)
    back = spark.read.parquet(path)
    r = back.agg(F.count("*").alias("n"), F.countDistinct("k").alias("d"), F.min("k").alias("lo"), F.max("k").alias("hi"),
                 F.sum((F.col("k") != F.col("nk") + 6).cast("int")).alias("bad")).first()
    assert (r.n, r.d, r.lo, r.hi, r.bad) == (150_000, 150_000, 6, 150_005, 0)


def test_scd2_sees_separators_and_nulls(spark):
    from quaestor.operators.scd import initial_scd2, scd2_merge
    cols = "nk int, a string, b string"
    first = initial_scd2(spark.createDataFrame([(1, "a|b", "c"), (2, None, "x"), (3, "s", "t")], cols), ["nk"], "2024-01-01")
    nxt = spark.createDataFrame([(1, "a", "b|c"), (2, "_null_", "x"), (3, "s", "t"), (3, "s", "t")], cols)
    out = scd2_merge(first, nxt, ["nk"], ["a", "b"], "2024-02-01").collect()
    assert sorted((r.nk, r.version_number, r.is_current) for r in out) == [
        (1, 1, 0), (1, 2, 1), (2, 1, 0), (2, 2, 1), (3, 1, 1)]
    assert len({r.surrogate_key for r in out}) == 5


def test_median_matches_percentile(spark):
    from quaestor.operators import aggregates as AGG
    df = (spark.range(0, 1001).select((F.col("id") % 4).alias("g"), (F.col("id") * 7919 % 1013 - 200.5).alias("v"))
          .unionByName(spark.createDataFrame([(None, 2.0), (None, 5.0), (9, None)], "g long, v double")))
    got = {r.g: r.m for r in AGG.median(df, ["g"], "v", "m", step=50).collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert got == want


def test_rows_without_a_parent_have_shares_and_a_primary(spark):
    from quaestor.operators import windows as WIN
    df = spark.createDataFrame([(1, 30.0, 1), (1, 10.0, 2), (None, 5.0, 3), (None, 15.0, 4)], "p int, amount double, t int")
    out = WIN.flag_primary(WIN.share_of_total(df, ["p"], "amount"), ["p"], "amount", ["t"])
    assert sorted((r.t, float(r.share_pct), r.is_primary) for r in out.collect()) == [(1, 75.0, 1), (2, 25.0, 0), (3, 25.0, 0), (4, 75.0, 1)]


def test_customs_median_with_unknown_transport(spark):
    from quaestor.plans import analytics as M
    rows = [("IN", "1", v, 1.0, None, None, "DE") for v in (1.0, 2.0, 9.0)] + [(None, None, 4.0, 1.0, "P", "CN", None)]
    df = spark.createDataFrame(rows, "flow string, transport_mode string, customs_value double, duty_amount double, preference_code string, "
                                     "origin_country string, dispatch_country string")
    got = {(r.flow, r.transport): (r.declarations, r.median_value, float(r.preference_rate)) for r in M.customs_analytics(df).collect()}
    assert got == {("IN", "SEA"): (3, 2.0, 0.0), (None, "OTHER"): (1, 4.0, 100.0)}
