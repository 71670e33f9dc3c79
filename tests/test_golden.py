"""Golden cases: the reference's own unit expectations on hand-built rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tieout.operators import audit, marts
from tieout.plans.ledger import seed_frames

TB_DDL = ("entity_id INT, account_code STRING, posting_date DATE, daily_debits_usd DECIMAL(38,2), "
          "daily_credits_usd DECIMAL(38,2), daily_net_usd DECIMAL(38,2), running_balance_usd DECIMAL(38,2)")
D = dt.date(2026, 4, 1)


def _dims(spark):
    from tieout.sources.fixtures import dim_account

    return dim_account(spark)


def _control(spark, sl_rows, gl_rows):
    seeds = seed_frames(spark)
    sl = spark.createDataFrame(sl_rows, TB_DDL)
    gl = spark.createDataFrame(gl_rows, TB_DDL)
    return marts.recon_control_account(sl, gl, _dims(spark), seeds("tolerance_rules"), seeds("materiality"))


def test_control_account_ties(spark):
    row = (1, "2000", D, Decimal("0"), Decimal("100"), Decimal("100"), Decimal("100"))
    out = _control(spark, [row], [row]).collect()
    assert len(out) == 1
    assert out[0]["variance_usd"] == Decimal("0.00") and out[0]["status"] == "PASS"


def test_control_account_material_break(spark):
    sl = (1, "2000", D, Decimal("0"), Decimal("1000"), Decimal("1000"), Decimal("1000"))
    gl = (1, "2000", D, Decimal("0"), Decimal("0"), Decimal("0"), Decimal("0"))
    out = _control(spark, [sl], [gl]).collect()
    assert out[0]["variance_usd"] == Decimal("1000.00") and out[0]["status"] == "FAIL"


def test_control_account_missing_side_is_zero(spark):
    sl = (1, "1200", D, Decimal("0"), Decimal("10"), Decimal("10"), Decimal("10"))
    out = _control(spark, [sl], []).collect()
    assert out[0]["gl_balance_usd"] == Decimal("0") and out[0]["variance_usd"] == Decimal("10.00")
    assert out[0]["status"] == "WARN"  # above 0.05 tolerance, below 500 materiality


CHK_DDL = "run_id STRING, check_name STRING, status STRING, breaks_value_usd DECIMAL(38,2)"


@pytest.mark.parametrize(
    "statuses,expected",
    [(["PASS", "WARN", "FAIL"], "FAIL"), (["PASS", "WARN"], "WARN"), (["PASS", "PASS"], "PASS"), ([], "PASS")],
)
def test_status_rollup(spark, statuses, expected):
    runs = spark.createDataFrame([("r1",)], "run_id STRING")
    checks = spark.createDataFrame([("r1", f"c{i}", s, Decimal(0)) for i, s in enumerate(statuses)], CHK_DDL)
    assert audit.overall_status(runs, checks).first()["status"] == expected


def test_run_totals(spark):
    checks = spark.createDataFrame(
        [("r1", "a", "FAIL", Decimal("100")), ("r1", "b", "WARN", Decimal("50")), ("r1", "c", "PASS", Decimal("0"))],
        CHK_DDL,
    )
    r = audit.run_totals(checks).first()
    assert r["total_breaks_value_usd"] == Decimal("150.00") and r["fail_count"] == 1 and r["warn_count"] == 1


def _card(spark, rows):
    return spark.createDataFrame(
        rows, "run_id STRING, check_name STRING, pass_count BIGINT, warn_count BIGINT, fail_count BIGINT, "
              "breaks_value_usd DECIMAL(38,2)",
    )


def test_run_round_trip(spark):
    card = _card(spark, [
        ("r1", "control_account", 0, 0, 12, Decimal("123.45")),
        ("r1", "transaction_level", 0, 3, 0, Decimal("9.99")),
        ("r1", "roll_forward", 5, 0, 0, Decimal("0")),
    ])
    checks = audit.check_results(card)
    runs = spark.createDataFrame([("r1", D, "manual:cli", dt.datetime(2026, 4, 1, 8))],
                                 "run_id STRING, business_date DATE, triggered_by STRING, started_at TIMESTAMP")
    start = audit.audit_start_run(runs)
    final, check_events = audit.audit_finalize(start, checks, F.lit("2026-04-01 08:09:10"))
    latest = audit.latest_runs(start.unionByName(final)).first()
    assert latest["status"] == "FAIL" and latest["finished_at"] == dt.datetime(2026, 4, 1, 8, 9, 10)
    assert audit.run_totals(check_events).first()["total_breaks_value_usd"] == Decimal("133.44")
    by = {r["check_name"]: r for r in checks.collect()}
    assert by["control_account"]["status"] == "FAIL" and by["control_account"]["breaks_count"] == 12
    assert by["transaction_level"]["status"] == "WARN" and by["transaction_level"]["breaks_count"] == 3
    assert by["roll_forward"]["status"] == "PASS"


def test_finalize_twice_is_idempotent(spark):
    ev = spark.createDataFrame(
        [("r1", "X", "WARN", 5, Decimal("0"), None, 0, 5, 0, 1), ("r1", "X", "FAIL", 10, Decimal("0"), None, 0, 0, 10, 2)],
        "run_id STRING, check_name STRING, status STRING, breaks_count INT, breaks_value_usd DECIMAL(38,2), "
        "materiality_usd DECIMAL(18,2), pass_count BIGINT, warn_count BIGINT, fail_count BIGINT, event_seq BIGINT",
    )
    out = audit.latest_checks(ev).collect()
    assert len(out) == 1 and out[0]["status"] == "FAIL" and out[0]["breaks_count"] == 10


def test_mark_error_truncates(spark):
    runs = spark.createDataFrame([("r1", D, "schedule", dt.datetime(2026, 4, 1, 8))],
                                 "run_id STRING, business_date DATE, triggered_by STRING, started_at TIMESTAMP")
    start = audit.audit_start_run(runs)
    end = F.lit("2026-04-01 08:01:00")
    err = audit.audit_mark_error(start, runs, "boom " * 200, end).first()
    assert err["status"] == "ERROR" and len(err["error_message"]) == 500 and err["event_seq"] == 2
    assert err["finished_at"] == dt.datetime(2026, 4, 1, 8, 1)
    final, _ = audit.audit_finalize(start, spark.createDataFrame([], CHK_DDL + ", breaks_count INT, "
                                    "materiality_usd DECIMAL(18,2), pass_count BIGINT, warn_count BIGINT, "
                                    "fail_count BIGINT"), end)
    late = audit.audit_mark_error(start.select(*audit.RUN_COLUMNS).unionByName(final), runs, "late", end).first()
    assert late["event_seq"] == 3


def test_alert_digest_split(spark):
    runs = spark.createDataFrame([("r1", D, "FAIL")], "run_id STRING, business_date DATE, status STRING")
    checks = spark.createDataFrame(
        [("r1", "control_account", "FAIL", 12, Decimal("123456.78")),
         ("r1", "transaction_level", "WARN", 3, Decimal("4567.89")),
         ("r1", "roll_forward", "PASS", 0, Decimal("0"))],
        "run_id STRING, check_name STRING, status STRING, breaks_count INT, breaks_value_usd DECIMAL(38,2)",
    )
    d = audit.alert_digest(runs, checks).first()
    assert d["above_count"] == 1 and d["below_count"] == 2
    assert "`control_account` — 12 breaks, $123,456.78 (FAIL)" in d["body"]
    assert d["footer"] == "_2 smaller check(s) stayed under the limit of $10,000 and are not listed._"
    assert d["headline"].startswith(":rotating_light:")


def test_alert_digest_nothing_above(spark):
    runs = spark.createDataFrame([("r1", D, "PASS")], "run_id STRING, business_date DATE, status STRING")
    checks = spark.createDataFrame([("r1", "roll_forward", "PASS", 0, Decimal("0"))],
                                   "run_id STRING, check_name STRING, status STRING, breaks_count INT, "
                                   "breaks_value_usd DECIMAL(38,2)")
    d = audit.alert_digest(runs, checks).first()
    assert d["body"] == "_No checks above the materiality threshold._"


def test_evidence_name():
    assert audit.evidence_name("2026-05-03", "11111111-2222-3333-4444-555555555555") == \
        "recon_evidence_2026-05-03_11111111"


def test_classifier_requires_default(spark):
    from tieout.functions.rules import classify_by_account

    rules = spark.createDataFrame([("2000", Decimal("500"), "HIGH")],
                                  "account_code STRING, materiality_usd DECIMAL(18,2), severity STRING")
    df = spark.createDataFrame([("2000", Decimal("1"))], "account_code STRING, v DECIMAL(18,2)")
    with pytest.raises(ValueError):
        classify_by_account(df, "account_code", "v", rules)


def test_classifier_rule(spark):
    from tieout.functions.rules import classify_by_account

    seeds = seed_frames(spark)
    df = spark.createDataFrame(
        [("2000", Decimal("0")), ("2000", Decimal("499.99")), ("2000", Decimal("500")), ("7777", Decimal("999"))],
        "account_code STRING, v DECIMAL(18,2)",
    )
    out = [r["status"] for r in classify_by_account(df, "account_code", "v", seeds("materiality"))
           .orderBy("account_code", "v").collect()]
    assert out == ["PASS", "WARN", "FAIL", "WARN"]


def test_fx_revaluation_missing_rate_fails(spark):
    gl = spark.createDataFrame(
        [(1, D, "4000", "INR", Decimal("100.00"), Decimal("1.20"), Decimal("0"), Decimal("0.012"))],
        "entity_id INT, posting_date DATE, account_code STRING, currency STRING, amount_currency DECIMAL(18,2), "
        "debit_usd DECIMAL(18,2), credit_usd DECIMAL(18,2), fx_rate DECIMAL(18,8)",
    )
    fx = spark.createDataFrame([], "rate_date DATE, from_currency STRING, to_currency STRING, rate DECIMAL(18,8)")
    r = marts.recon_fx_revaluation(gl, fx).first()
    assert r["eod_fx_rate"] is None and r["status"] == "FAIL"


def test_summary_null_on_empty(spark):
    empty_ctl = spark.createDataFrame([], "posting_date DATE, status STRING, variance_usd DECIMAL(18,2)")
    empty_txn = spark.createDataFrame([], "business_date DATE, status STRING, amount_delta_usd DECIMAL(18,2)")
    empty_rf = spark.createDataFrame([], "posting_date DATE, status STRING, roll_forward_variance_usd DECIMAL(18,2)")
    rows = marts.recon_summary(empty_ctl, empty_txn, empty_rf).collect()
    assert len(rows) == 3 and all(r["pass_count"] is None for r in rows)


def test_seed_literals_match_csv_shape(spark):
    seeds = seed_frames(spark)
    tol = {r["account_code"]: r for r in seeds("tolerance_rules").collect()}
    assert tol["1300"]["amount_tolerance_usd"] == Decimal("0.1000") and tol["DEFAULT"]["timing_tolerance_days"] == 0
    mat = {r["account_code"]: r for r in seeds("materiality").collect()}
    assert mat["9999"]["materiality_usd"] == Decimal("0.00") and mat["DEFAULT"]["severity"] == "LOW"
    _ = F


def test_rule_fallback_is_per_field_and_single_default(spark):
    from tieout.functions.rules import resolve_rule

    rules = spark.createDataFrame(
        [("2000", Decimal("0.05"), None), ("DEFAULT", Decimal("0.01"), 0)],
        "account_code STRING, amount_tolerance_usd DECIMAL(18,4), timing_tolerance_days INT",
    )
    df = spark.createDataFrame([("2000",), ("6000",)], "acct STRING")
    out = {r["acct"]: r for r in resolve_rule(df, "acct", rules, ["amount_tolerance_usd", "timing_tolerance_days"])
           .collect()}
    assert out["2000"]["amount_tolerance_usd"] == Decimal("0.0500")
    assert out["2000"]["timing_tolerance_days"] == 0  # NULL field falls back to DEFAULT's
    assert out["6000"]["amount_tolerance_usd"] == Decimal("0.0100")
    two = rules.unionByName(rules.filter(F.col("account_code") == "DEFAULT"))
    with pytest.raises(ValueError):
        resolve_rule(df, "acct", two, ["amount_tolerance_usd"])


def test_check_trend_window_follows_newest_run(spark):
    from tieout.operators import reports

    runs = spark.createDataFrame(
        [("r1", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 8)), ("r2", dt.date(2024, 4, 1), dt.datetime(2024, 4, 1, 8)),
         ("r3", dt.date(2024, 4, 20), dt.datetime(2024, 4, 20, 8))],
        "run_id STRING, business_date DATE, started_at TIMESTAMP",
    )
    checks = spark.createDataFrame(
        [(r, "recon_summary", "PASS", 0, Decimal("0")) for r in ("r1", "r2", "r3")],
        "run_id STRING, check_name STRING, status STRING, breaks_count INT, breaks_value_usd DECIMAL(18,2)",
    )
    got = sorted(r["business_date"] for r in reports.check_trend(runs, checks).collect())
    assert got == [dt.date(2024, 4, 1), dt.date(2024, 4, 20)]
    assert reports.check_trend(runs.limit(0), checks).count() == 0
