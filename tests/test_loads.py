"""Operators over several loads: bucketed upserts, event-time streams that are
started again, accumulating snapshots and profiles that merge."""

import datetime as dt
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from quaestor.operators.merge import accumulate_milestones
from quaestor.plans import facts as FCT
from quaestor.sources import scan as SCAN
from quaestor.streaming import incremental as ST

ROW = "k long, v string, ver int"


def load(spark, path, i, rows, schema=ROW):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/load{i}")


def run_upsert(spark, path, ckpt="ckpt"):
    src = ST.file_stream(spark, f"{path}/in/*", ROW)
    ST.bucketed_upsert_stream(spark, src, f"{path}/target", ["k"], ["ver"], buckets=8, checkpoint=f"{path}/{ckpt}").awaitTermination()


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{path}/target")
            for f in fs if f.endswith(".parquet")}


def rows_of(spark, path):
    return sorted(map(tuple, ST.read_buckets(spark, f"{path}/target").select("k", "v", "ver").collect()))


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path)
    load(spark, path, 0, [(k, "a", 1) for k in range(200)])
    run_upsert(spark, path)
    before = files(path)
    load(spark, path, 1, [(5, "b", 2), (5, "c", 3), (6, "old", 0), (1000, "new", 1)])
    run_upsert(spark, path)
    after = files(path)
    touched = {r.b for r in spark.createDataFrame([(5,), (6,), (1000,)], "k long").selectExpr("pmod(xxhash64(k), 8) as b").collect()}
    for f, t in before.items():
        assert (after.get(f) == t) == (int(f.split("bucket=")[1].split("/")[0]) not in touched)
    want = sorted([(k, "a", 1) for k in range(200) if k != 5] + [(5, "c", 3), (1000, "new", 1)])
    assert rows_of(spark, path) == want
    # the same loads once more, as after a failure that lost the checkpoint
    run_upsert(spark, path, "another")
    assert rows_of(spark, path) == want
    load(spark, path, 2, [], ROW)
    run_upsert(spark, path)
    assert rows_of(spark, path) == want


EV = "id long, ts timestamp, v int"


def at(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def test_rows_in_time_pass_once_over_restarts(spark, tmp_path):
    path = str(tmp_path)
    loads = [[(i, at(i), i) for i in range(0, 50)], [(45, at(45), 45), (49, at(49), 49)] + [(i, at(i), i) for i in range(50, 80)],
             [(60, at(60), 60), (900, at(3), 1), (81, at(81), 81), (81, at(81), 81)]]
    for i, rows in enumerate(loads):
        load(spark, path, i, rows, EV)
        ST.deduplicated_stream(ST.file_stream(spark, f"{path}/in/*", EV), "ts", ["id"], f"{path}/out", f"{path}/ckpt", "24 hours").awaitTermination()
    got = sorted(r.id for r in spark.read.parquet(f"{path}/out").collect())
    assert got == [*range(80), 81]  # 900 is 77 hours late


def test_days_are_told_once_the_watermark_has_passed(spark, tmp_path):
    path, out = str(tmp_path), str(tmp_path) + "/out"
    loads = [[(1, at(1), 5), (2, at(30), 7)], [(3, at(10), 1), (4, at(24 * 5), 2)], [(5, at(2), 100)], [(6, at(24 * 60), 0)]]
    for i, rows in enumerate(loads):
        load(spark, path, i, rows, EV)
        ST.monthly_rollup_stream(ST.file_stream(spark, f"{path}/in/*", EV), "ts", [], "v", out, f"{path}/ckpt", watermark="2 days").awaitTermination()
    # id 3 comes within the watermark, id 5 after its day is closed
    got = ST.monthly_totals(spark.read.parquet(out), []).collect()
    assert [(r.month, r.row_count, r.total) for r in got] == [(dt.date(2024, 1, 1), 4, 15)]


AUDIT = "id int, planned date, begun date, ended date, loaded_at int, status string, amount int"


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_loads_in_any_order_give_the_same_snapshot(spark, order):
    d = dt.date(2024, 1, 1)
    loads = [[(1, d, None, None, 1, "PLANNED", None), (2, d, None, None, 1, "PLANNED", 5)],
             [(1, None, d + dt.timedelta(9), None, 2, "BEGUN", 7), (3, None, d, None, 2, None, None)],
             [(1, None, d + dt.timedelta(12), d + dt.timedelta(30), 3, "CLOSED", None), (2, None, None, None, 3, None, 4)]]
    frames = [spark.createDataFrame(x, AUDIT) for x in loads]
    got, *rest = [frames[i] for i in order]
    for f in rest:
        got = accumulate_milestones(got, f, ["id"], ["planned", "begun", "ended"], "loaded_at")
    got = accumulate_milestones(got, frames[order[0]], ["id"], ["planned", "begun", "ended"], "loaded_at")  # a load that comes twice
    assert sorted(tuple(r)[:-1] for r in got.collect()) == [
        (1, d, d + dt.timedelta(9), d + dt.timedelta(30), 3, "CLOSED", 7), (2, d, None, None, 3, "PLANNED", 4), (3, None, d, None, 2, None, None)]


def test_audit_snapshot_of_an_open_case(spark):
    cols = ", ".join(f"{m} date" for m in FCT.AUDIT_MILESTONES)
    cases = spark.createDataFrame([(1, 2, "VAT", dt.date(2024, 1, 5), *[None] * 5, None, None, None, None, None, None, None, None)],
                                  f"audit_case_id int, party_id int, tax_type_code string, {cols}, audit_period_from date, audit_period_to date, "
                                  "case_status_code string, selection_method_code string, adjustment_amount double, penalty_amount double, "
                                  "interest_amount double, objection_filed boolean")
    r = FCT.build_fact_audit_snapshot(cases, spark.createDataFrame([], "audit_case_id int")).first()
    assert (r.date_key, r.start_date_key, r.actual_completion_date_key, r.duration_days) == (20240105, 20240105, None, None)
    assert (r.is_risk_based, r.is_completed, r.has_findings, r.is_appealed, r.findings_count, r.total_amount) == (0, 0, 0, 0, 0, 0)


def test_profiles_of_loads_merge_within_the_bounds(spark):
    rng = random.Random(1)
    data = [(i, rng.gauss(0, 100), rng.choice([None, "x", "yy", str(i % 300)]), dt.date(2024, 1, 1) + dt.timedelta(i % 90)) for i in range(6000)]
    df = spark.createDataFrame(data, "id long, v double, s string, d date")
    parts = [SCAN.profile_load(df.where(F.col("id") % 3 == k)) for k in range(3)]
    merged = SCAN.merge_profiles(SCAN.merge_profiles(parts[0].unionByName(parts[1])).unionByName(parts[2].select(*SCAN.merge_profiles(parts[2]).columns)))
    got = {r.column_name: r for r in SCAN.read_profile(merged).collect()}
    exact = {r.column_name: r for r in SCAN.profile_table(df).collect()}
    for c, r in got.items():
        assert (r.row_count, r.null_count, r.max_length) == (exact[c].row_count, exact[c].null_count, exact[c].max_length)
        assert abs(r.distinct_estimate - exact[c].distinct_count) <= exact[c].distinct_count * SCAN.DISTINCT_ERROR + 1
    values = sorted(x[1] for x in data)
    for q, x in ((got["v"].p25, 0.25), (got["v"].median, 0.5), (got["v"].p75, 0.75)):
        assert abs(sum(v <= q for v in values) / len(values) - x) <= SCAN.RANK_ERROR
    assert (got["v"].min_number, got["v"].max_number) == (values[0], values[-1]) and got["s"].median is None and got["d"].median is not None
    empty = SCAN.read_profile(SCAN.merge_profiles(SCAN.profile_load(df.where("false")))).collect()
    assert {(r.row_count, r.distinct_estimate, r.median) for r in empty} == {(0, 0, None)}
