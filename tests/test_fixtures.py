"""Operators whose inputs have no counterpart in the driver tables (audits,
customs, schemes, objections), checked on small literal fixtures against a
hand-computed expectation; plus the streaming forms."""

import datetime as dt
import os
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from quaestor.operators import dq as DQ
from quaestor.plans import analytics as M, calendar as CAL, dims as DIM, facts as FCT
from quaestor.session import checkpoint_dir
from quaestor.sources import sinks as SNK


def test_audit_effectiveness(spark):
    a = spark.createDataFrame([("VAT", "2024-01-10", "2024-03-10", 1000.0, 400.0, 1),
                               ("VAT", "2024-02-01", "2024-02-11", 500.0, 500.0, 1),
                               ("VAT", "2024-05-01", None, 900.0, 0.0, 0)],
                              "tax_type_code string, start_date string, completion_date string, assessed_amount double, "
                              "collected_amount double, is_completed int")
    a = a.withColumn("start_date", F.col("start_date").cast("date")).withColumn("completion_date", F.col("completion_date").cast("date"))
    r = M.audit_effectiveness(a).first()
    assert r.total_audits == 2 and r.collection_rate == Decimal("60.00") and r.avg_audit_days == Decimal("35.00")


def test_fact_audit_and_objection(spark):
    cases = spark.createDataFrame([(1, 7, "2024-01-01", None, "2024-02-01", "2022-01-01", "2023-12-31", 1000.0, 1, 0)],
                                  "audit_case_id int, party_id int, assignment_date string, actual_start_date string, "
                                  "actual_completion_date string, audit_period_from string, audit_period_to string, "
                                  "total_amount_assessed double, taxpayer_agreed int, objection_filed int")
    for c in ("assignment_date", "actual_start_date", "actual_completion_date", "audit_period_from", "audit_period_to"):
        cases = cases.withColumn(c, F.col(c).cast("date"))
    findings = spark.createDataFrame([(1, 10.0), (1, 20.0)], "audit_case_id int, tax_adjustment double")
    r = FCT.build_fact_audit(cases, findings).first()
    assert r.findings_count == 2 and r.primary_date_key == 20240101 and r.periods_covered == 2
    obj = spark.createDataFrame([(1, 7, "2024-01-01", "2024-01-31", "reduced", 0, 100.0, 40.0)],
                                "objection_case_id int, party_id int, filing_date string, decision_date string, "
                                "decision_outcome_code string, appeal_filed int, amount_disputed double, amount_adjusted double")
    obj = obj.withColumn("filing_date", F.col("filing_date").cast("date")).withColumn("decision_date", F.col("decision_date").cast("date"))
    o = FCT.build_fact_objection(obj).first()
    assert o.is_reduced == 1 and o.resolution_days == 30 and o.resolved_amount == Decimal("40.00")


def test_objection_candidates(spark):
    a = spark.createDataFrame([(1, "FINALIZED", 0, 100.0), (2, "FINALIZED", 1, 50.0), (3, "OPEN", 0, 70.0),
                               (4, "FINALIZED", 0, 0.0), (5, "FINALIZED", 0, 300.0)],
                              "audit_case_id int, case_status_code string, taxpayer_agreed int, total_amount_assessed double")
    assert [r.audit_case_id for r in M.objection_candidates(a).collect()] == [5, 1]


def test_customs_analytics(spark):
    d = spark.createDataFrame([("IMPORT", "1", "CN", None, 100.0, 10.0, "GSP"), ("IMPORT", "1", None, "DE", 300.0, 30.0, None),
                               ("EXPORT", "4", "US", None, 50.0, 0.0, None)],
                              "flow string, transport_mode string, origin_country string, dispatch_country string, "
                              "customs_value double, duty_amount double, preference_code string")
    rows = {(r.flow, r.transport): r for r in M.customs_analytics(d).collect()}
    sea = rows[("IMPORT", "SEA")]
    assert sea.declarations == 2 and sea.duty_revenue == Decimal("40.00") and sea.median_value == 200.0
    assert sea.preference_rate == Decimal("50.00") and ("EXPORT", "AIR") in rows


def test_tax_scheme_views_and_scd(spark):
    s = spark.createDataFrame([("S1", "MLT", "VAT", "STD", "2020-01-01", None, 18.0),
                               ("S2", "MLT", "VAT", "SME", "2020-01-01", "2023-01-01", 5.0)],
                              "scheme_code string, country_code string, tax_type_code string, scheme_type string, "
                              "valid_from string, valid_to string, rate double")
    s = s.withColumn("valid_from", F.col("valid_from").cast("date")).withColumn("valid_to", F.col("valid_to").cast("date"))
    v = M.tax_scheme_views(s, "2024-06-30").collect()
    assert [(r.scheme_code, r.scheme_type_label) for r in v] == [("S1", "Standard")]
    countries = spark.createDataFrame([("MLT", 1)], "country_code string, country_key int")
    types = spark.createDataFrame([("VAT", 3)], "tax_type_code string, tax_type_key int")
    snap = s.select("scheme_code", "country_code", "tax_type_code", "scheme_type", "rate")
    dim = DIM.build_dim_tax_scheme(snap, countries, types, None, "2024-01-01", ["rate"])
    assert dim.where("is_current = 1").count() == 2
    changed = snap.withColumn("rate", F.when(F.col("scheme_code") == "S1", 20.0).otherwise(F.col("rate")))
    dim2 = DIM.build_dim_tax_scheme(changed, countries, types, dim, "2024-07-01", ["rate"])
    assert dim2.count() == 3 and dim2.where("is_current = 1 and scheme_code = 'S1'").first().rate == 20.0


def test_partitioned_fact_write_and_seeds(spark):
    base = f"{checkpoint_dir(spark)}/fact-{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, "2024-01-05", 1.0), (2, "2024-02-05", 2.0)], "id int, d string, v double") \
        .withColumn("d", F.col("d").cast("date"))
    SNK.write_partitioned_fact(df, base, "d", ["id"])
    back = spark.read.parquet(base)
    assert sorted(r.ym for r in back.select("ym").distinct().collect()) == [202401, 202402]
    assert back.where("ym = 202402").count() == 1  # partition pruning target
    spec = spark.createDataFrame([("F1", [("A", "Alpha", "Alfa"), ("B", "Beta", None)])],
                                 "field_code string, allowed_values array<struct<code:string,description_en:string,description_mt:string>>")
    assert SNK.seed_allowed_values(spec).count() == 2


def test_run_log_and_dq_summary(spark):
    rec = SNK.run_record(spark, "run-1", "MAP1", dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2),
                         {"extracted": 10, "validated": 9, "rejected": 1, "loaded": 9})
    assert rec.first().rows_rejected == 1
    log = spark.createDataFrame([("R1", "ERROR", "2024-01-20 00:00:00"), ("R1", "ERROR", "2023-11-01 00:00:00"),
                                 ("R2", "WARNING", "2024-01-25 00:00:00")], "rule_code string, severity string, logged_at string") \
        .withColumn("logged_at", F.col("logged_at").cast("timestamp"))
    s = {r.rule_code: r.violation_count for r in DQ.dq_summary(log, "2024-01-31").collect()}
    assert s == {"R1": 1, "R2": 1}


def test_relative_flag_refresh(spark):
    spine = CAL.spine_between(spark, "2024-01-01", "2024-03-31")
    d = CAL.build_dim_date(spine, "2024-01-15")
    assert d.where("is_today = 1").count() == 1
    d2 = CAL.refresh_relative_flags(d, "2024-02-10")
    assert d2.where("is_current_month = 1").count() == 29 and d2.where("is_today = 1").first().full_date == dt.date(2024, 2, 10)


def test_late_lookback_stream_dedupes(spark, tmp_path):
    from quaestor.streaming.incremental import late_lookback
    src = f"{checkpoint_dir(spark)}/late-src-{uuid.uuid4().hex[:8]}"
    rows = [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 12:00:00"), (2, "2024-01-01 11:00:00")]
    spark.createDataFrame(rows, "k int, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    stream = spark.readStream.schema("k int, ts timestamp").parquet(src)
    q = (late_lookback(stream, "ts", ["k"], "24 hours").writeStream.format("memory").queryName("late_test")
         .option("checkpointLocation", f"{src}-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.k for r in spark.sql("select k from late_test").collect()) == [1, 2]


def test_monthly_rollup_stream(spark):
    from quaestor.streaming.incremental import monthly_rollup_stream, monthly_totals
    src = f"{checkpoint_dir(spark)}/roll-src-{uuid.uuid4().hex[:8]}"
    rows = [("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-02 10:00:00", 2.0), ("a", "2024-04-01 10:00:00", 5.0)]
    spark.createDataFrame(rows, "k string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    stream = spark.readStream.schema("k string, ts timestamp, v double").parquet(src)
    q = monthly_rollup_stream(stream, "ts", ["k"], "v", f"{src}-out", f"{src}-ckpt", watermark="1 day")
    q.awaitTermination()
    out = spark.read.parquet(f"{src}-out")
    # only windows closed by the watermark are emitted (append mode)
    assert out.agg(F.sum("total")).first()[0] == 3.0
    months = monthly_totals(out, ["k"]).collect()
    assert [(str(r.month), r.row_count, r.total) for r in months] == [("2024-01-01", 2, 3.0)]


def test_upsert_stream_over_several_batches(spark):
    from quaestor.streaming.incremental import incremental_upsert_stream
    src = f"{checkpoint_dir(spark)}/up-src-{uuid.uuid4().hex[:8]}"
    cols = "k int, ts int, v string"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], cols).coalesce(1).write.parquet(src)

    def run():
        stream = spark.readStream.schema(cols).parquet(src)
        q, versions = incremental_upsert_stream(spark, stream, f"{src}-out", ["k"], ["ts"], checkpoint=f"{src}-ckpt")
        q.awaitTermination()
        return versions
    assert len(run()) == 1
    spark.createDataFrame([(2, 3, "c"), (2, 2, "late"), (3, 1, "d")], cols).coalesce(1).write.mode("append").parquet(src)
    last = run()[-1]
    assert sorted(map(tuple, spark.read.parquet(last).select("k", "v").collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert run() == []

def test_writers_purge_and_registry(spark):
    from quaestor.operators import mapping as MAP
    from quaestor.sources import scan as SC
    base = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-03-01 00:00:00")], "id int, loaded_at string") \
        .withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    SNK.write_staging(df, base)
    SNK.append_staging(df, base)
    back = spark.read.parquet(base)
    assert back.count() == 4
    assert SNK.purge_staging(back, "loaded_at", "2024-03-10", 30).count() == 2
    assert SC.high_watermark(back, "id").first()[0] == 2
    assert SC.row_count(back, "id = 1").first()[0] == 2
    assert SC.scan_table(back, ["id"], "id > 1", ["id"], 1).count() == 1
    prof = {r.column_name: r for r in SC.profile_table(df, exact=False).collect()}
    assert prof["id"].is_key_candidate == 1 and prof["id"].null_count == 0
    MAP.register_transform("reverse_text", lambda c: F.reverse(c))
    out = MAP.apply_mapping(spark.createDataFrame([("abc",)], "s string"),
                            [{"source_column": "s", "target_column": "r", "transformation_type": "FUNCTION",
                              "function": "reverse_text"}]).first()
    assert out.r == "cba"


def test_form_rule_types(spark):
    from quaestor.plans import forms as FRM
    form = spark.createDataFrame([(1, "123456789", "GB82 WEST 1234 5698 7654 32", 10.0, 4.0, 6.0, "short"),
                                  (2, "12345", "GB82 WEST 1234 5698 7654 33", 10.0, 4.0, 7.0, "long enough text")],
                                 "id int, tin string, iban string, total double, a double, b double, descr string")
    reg = spark.createDataFrame([("123456789",)], "tin string")
    rules = [{"code": "P", "type": "pattern", "field": "tin", "pattern": r"[0-9]{9}$"},
             {"code": "L", "type": "lookup", "field": "tin", "reference": "register", "reference_column": "tin"},
             {"code": "I", "type": "iban", "field": "iban"},
             {"code": "C", "type": "calculation", "field": "total", "expression": "abs(total - (a + b)) <= 0.01"},
             {"code": "F", "type": "format", "field": "descr", "min": 10}]
    ann = FRM.form_rules(form, rules, "2024-01-01", {"register": reg})
    bad = {r.id: sorted(v.rule_code for v in r._violations) for r in ann.collect()}
    assert bad == {1: ["F"], 2: ["C", "I", "L", "P"]}


def test_country_subtype_and_run_summary(spark):
    from quaestor.operators.aggregates import run_summary
    from quaestor.operators.windows import link_prior_periods
    c = DIM.build_dim_country(spark, [{"country_code": "MLT", "currency_code": "EUR", "fiscal_start_month": 1,
                                       "fiscal_year_offset": 1, "is_eu_member": 1},
                                      {"country_code": "LKA", "currency_code": "LKR", "fiscal_start_month": 4}])
    assert [(r.country_code, r.country_key) for r in c.orderBy("country_key").collect()] == [("LKA", 1), ("MLT", 2)]
    types = spark.createDataFrame([("VAT", 7)], "tax_type_code string, tax_type_key int")
    sub = spark.createDataFrame([("S1", "MLT", "VAT", 0.05), ("S2", "XXX", "VAT", 0.18)],
                                "subtype_code string, country_code string, tax_type_code string, rate_fraction double")
    out = {r.subtype_code: r for r in DIM.build_dim_account_subtype(sub, c, types).collect()}
    assert out["S1"].rate_pct == Decimal("5.0000") and out["S1"].country_key == 2 and out["S2"].country_key == -1
    rec = SNK.run_record(spark, "r1", "MAP1", dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 1, 0, 30),
                         {"extracted": 10, "rejected": 1, "loaded": 9}) \
        .unionByName(SNK.run_record(spark, "r2", "MAP1", dt.datetime(2024, 1, 2, 1), dt.datetime(2024, 1, 2, 1, 1, 30),
                                    {"extracted": 5, "loaded": 5}, status="FAILED"))
    s = run_summary(rec).first()
    assert (s.runs, s.successful_runs, s.rows_loaded, s.avg_run_seconds) == (2, 1, 14, Decimal("60.00"))
    per = spark.createDataFrame([("VAT", "2023-01-01", 1), ("VAT", "2023-02-01", 2), ("VAT", "2024-01-01", 3),
                                 ("PIT", "2024-01-01", 4)], "t string, s string, k int").withColumn("s", F.col("s").cast("date"))
    links = {r.k: (r.prior_period_key, r.same_period_prior_year_key) for r in link_prior_periods(per, ["t"], "s", "k").collect()}
    assert links == {1: (None, None), 2: (1, None), 3: (2, 1), 4: (None, None)}


def test_collection_refund_registration_facts(spark):
    actions = spark.createDataFrame([(1, 10, "GARNISHMENT", 300.0), (2, 10, "REMINDER", 0.0)],
                                    "action_id int, case_id int, action_type_code string, action_collected double")
    cases = spark.createDataFrame([(10, 7, "2024-01-01", 1000.0)], "case_id int, account_id int, case_opened_date string, "
                                  "current_debt_amount double").withColumn("case_opened_date", F.col("case_opened_date").cast("date"))
    dues = spark.createDataFrame([(7, "2023-12-15"), (7, "2023-11-15")], "account_id int, due_date string") \
        .withColumn("due_date", F.col("due_date").cast("date"))
    c = {r.action_id: r for r in FCT.build_fact_collection(actions, cases, dues, "2024-03-01").collect()}
    assert c[1].effectiveness_ratio == Decimal("0.3000") and c[1].is_escalated == 1 and c[2].is_successful == 0
    assert c[1].days_since_opened == 60 and c[1].debt_due_date == dt.date(2023, 11, 15)
    ref = spark.createDataFrame([(1, 7, "2024-01-01", 500.0, 100.0, "2024-01-10", None)],
                                "refund_id int, party_id int, claim_date string, gross_refund_amount double, "
                                "offset_amount double, approval_date string, refund_date string")
    for col in ("claim_date", "approval_date", "refund_date"):
        ref = ref.withColumn(col, F.col(col).cast("date"))
    r = FCT.build_fact_refund(ref).first()
    assert (r.net_refund_amount, r.is_approved, r.is_disbursed, r.processing_days, r.approval_days) == \
        (Decimal("400.00"), 1, 0, 0, 9)
    acc = spark.createDataFrame([(1, "VAT", "2024-01-01"), (2, None, "2024-01-01")],
                                "party_id int, tax_type_code string, registration_date string") \
        .withColumn("registration_date", F.col("registration_date").cast("date"))
    assert FCT.build_fact_registration(acc).count() == 1
    m = spark.createDataFrame([(100.0, 20.0, 30.0, 5.0, 2.0, 50.0, 10.0, 70.0, 40.0, 10.0, 5.0)],
                              "gross_income double, deductions double, tax_liability double, tax_credits double, "
                              "tax_withheld double, output_vat double, input_vat double, payment_amount double, "
                              "tax_paid double, penalty_paid double, interest_paid double")
    f = FCT.derive_payment_measures(FCT.derive_filing_measures(m)).first()
    assert (f.taxable_income, f.tax_payable, f.vat_net, f.unallocated_amount) == \
        (Decimal("80.00"), Decimal("23.00"), Decimal("40.00"), Decimal("15.00"))
