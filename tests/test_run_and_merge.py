"""Whole runs, the file-level merge, the SCD2 snapshot, the GL stream and strict rates."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tieout.operators import audit, history, postings
from tieout.plans import storage
from tieout.plans.job import JobConfig, run
from tieout.plans.session import apply_engine_conf, ensure_checkpoint_dir
from tieout.sources.fixtures import fixture
from tieout.sources.schemas import RAW_DDL
from tieout.streaming import gl_stream

from conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _mart(spark, rows):
    return spark.createDataFrame(rows, "k STRING, v INT, posting_month STRING")


def _merge(spark, path, rows):
    out = history.merge_into_path(spark, path, _mart(spark, rows), ["k"], path + "-staging")
    return sorted(((r["k"], r["v"], r["posting_month"]) for r in out.collect()), key=str)


def test_merge_empties_the_month_a_key_leaves(spark, tmp_path):
    path = str(tmp_path / "t")
    _merge(spark, path, [("K", 1, "2024-01"), ("L", 2, "2024-03")])
    assert _merge(spark, path, [("K", 5, "2024-02")]) == [("K", 5, "2024-02"), ("L", 2, "2024-03")]
    assert _merge(spark, path, [("K", 5, "2024-02")]) == [("K", 5, "2024-02"), ("L", 2, "2024-03")]


def test_merge_keeps_other_rows_without_a_month(spark, tmp_path):
    path = str(tmp_path / "t")
    _merge(spark, path, [("N1", 1, None), ("A", 1, "2024-01")])
    got = _merge(spark, path, [("N2", 2, None), ("B", 2, "2024-02")])
    assert got == sorted([("A", 1, "2024-01"), ("B", 2, "2024-02"), ("N1", 1, None), ("N2", 2, None)], key=str)
    got = _merge(spark, path, [("N1", 9, None)])
    assert ("N1", 9, None) in got and ("N2", 2, None) in got and len(got) == 4
    assert len(_merge(spark, path, [])) == 4


def test_merge_into_a_table_with_only_the_empty_month(spark, tmp_path):
    path = str(tmp_path / "t")
    _merge(spark, path, [("N1", 1, None)])
    assert _merge(spark, path, [("N1", 2, "2024-01")]) == [("N1", 2, "2024-01")]


def test_snapshot_versions(spark):
    ddl = "k STRING, a STRING, b STRING"
    one = spark.createDataFrame([("same", "x", None), ("new_b", "x", None), ("gone", "x", "y")], ddl)
    two = spark.createDataFrame([("same", "x", None), ("new_b", "x", "z"), ("added", "q", "q")], ddl)
    s1 = history.scd2_snapshot(None, one, "k", ["a", "b"], "2024-01-01 00:00:00")
    s2 = history.scd2_snapshot(s1, two, "k", ["a", "b"], "2024-02-01 00:00:00")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    got = {(r["k"], r["b"], r["valid_from"], r["valid_to"]) for r in s2.collect()}
    assert got == {("same", None, t1, None), ("new_b", None, t1, t2), ("new_b", "z", t2, None),
                   ("gone", "y", t1, t2), ("added", "q", t2, None)}
    kept = history.scd2_snapshot(s1, two, "k", ["a", "b"], "2024-02-01 00:00:00", invalidate_hard_deletes=False)
    assert kept.filter("k = 'gone' AND valid_to IS NULL").count() == 1


def _gl(spark, rows):
    """(journal, day, amount, ingested day) -> raw GL lines."""
    full = [(j, 1, 1, dt.date(2024, 1, d), dt.date(2024, 1, d), "1000", Decimal(a), Decimal(0), "USD", Decimal(a),
             Decimal(1), "AP", j, None, "x", dt.datetime(2024, 2, i)) for j, d, a, i in rows]
    return spark.createDataFrame(full, RAW_DDL["gl_journal"])


def test_stream_corrections_on_other_days(spark, tmp_path):
    landing, daily = str(tmp_path / "landing"), str(tmp_path / "daily")
    sink = gl_stream.gl_batch_sink(landing, daily)
    batches = [[("X", 1, 100, 1)], [("X", 2, 100, 2)], [("Y", 1, 7, 3)], [("X", 1, 100, 1), ("Z", 3, 5, 1)]]
    for i, rows in enumerate(batches):
        sink(_gl(spark, rows), i)
    expected = {(dt.date(2024, 1, 1), Decimal(7)), (dt.date(2024, 1, 2), Decimal(100)), (dt.date(2024, 1, 3), Decimal(5))}

    def got():
        return {(r["posting_date"], r["daily_debits_usd"]) for r in gl_stream.daily_table(spark, daily).collect()}

    assert got() == expected
    sink(_gl(spark, batches[1]), 1)  # batches redelivered after a crash change nothing
    sink(_gl(spark, batches[3]), 3)
    assert got() == expected


def test_strict_rate_lookup_fails_on_a_gap(spark):
    docs = spark.createDataFrame([(dt.date(2024, 1, 1), "EUR"), (dt.date(2024, 1, 2), "EUR")], "d DATE, currency STRING")
    rates = spark.createDataFrame([(dt.date(2024, 1, 1), "EUR", "USD", Decimal("1.08"))],
                                  "rate_date DATE, from_currency STRING, to_currency STRING, rate DECIMAL(18,8)")
    assert postings.fx_lookup(docs, rates, "d").filter("looked_up_rate IS NULL").count() == 1
    with pytest.raises(Exception, match="no USD rate for EUR 2024-01-02"):
        postings.fx_lookup(docs, rates, "d", strict=True).collect()
    assert postings.fx_lookup(docs.limit(1), rates, "d", strict=True).count() == 1


def test_show_run_resolves_a_prefix_to_one_run(spark):
    runs = spark.createDataFrame([("run-2", None, "PASS"), ("run-1", None, "FAIL")],
                                 "run_id STRING, business_date DATE, status STRING")
    checks = spark.createDataFrame([("run-1", "a"), ("run-1", "b"), ("run-2", "a")], "run_id STRING, check_name STRING")
    assert [(r["run_id"], r["check_name"]) for r in audit.audit_show_run(runs, checks, "run").collect()] == [
        ("run-1", "a"), ("run-1", "b")]


def test_engine_conf_is_applied_to_any_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    apply_engine_conf(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


@pytest.fixture(scope="module")
def warehouse(spark):
    from tieout.plans.materialize import new_table_dir

    return new_table_dir(spark, "run-test")


def test_full_then_incremental_run(spark, warehouse):
    raw = fixture(spark, SF_SMALL).raw_tables()
    first = run(spark, JobConfig(warehouse=warehouse, threads=4), raw_tables=raw)
    whole = _rows(first.ledger.txn_level())
    second = run(spark, JobConfig(warehouse=warehouse, threads=4))
    assert first.status == second.status == "FAIL"
    assert _rows(second.ledger.txn_level()) == whole
    log = spark.read.parquet(os.path.join(warehouse, "audit", "recon_runs"))
    latest = audit.latest_runs(log).collect()
    assert {r["run_id"] for r in latest} == {first.run_id, second.run_id}
    assert all(r["finished_at"] > r["started_at"] and r["event_seq"] == 2 for r in latest)
    counts = spark.read.parquet(os.path.join(warehouse, "audit", "recon_row_counts"))
    assert counts.filter(F.col("run_id") == first.run_id).count() == 8
    snap = spark.read.parquet(storage.latest_version(spark, os.path.join(warehouse, "history", "chart_of_accounts")))
    assert snap.count() == 24 and snap.filter("valid_to IS NULL").count() == 24
    assert all(storage.exists(spark, os.path.join(r["evidence_url"], "txn_breaks", "_SUCCESS")) for r in latest)
    pruned = spark.read.parquet(os.path.join(warehouse, "history", "recon_transaction_level"))
    plan = pruned.filter("posting_month = '2000-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(posting_month" in plan


def test_failed_run_is_marked(spark, warehouse, monkeypatch):
    from tieout.plans import job

    def broken(*_args):
        raise ValueError("boom")

    monkeypatch.setattr(job, "run_concurrently", broken)
    with pytest.raises(ValueError):
        run(spark, JobConfig(warehouse=warehouse, threads=4, triggered_by="test"))
    log = spark.read.parquet(os.path.join(warehouse, "audit", "recon_runs")).filter("triggered_by = 'test'")
    last = audit.latest_runs(log).collect()
    assert len(last) == 1 and last[0]["status"] == "ERROR" and "boom" in last[0]["error_message"]
    assert last[0]["finished_at"] is not None and last[0]["event_seq"] == 2


def test_checkpoint_folder_must_be_shared_on_a_cluster(spark):
    class Conf:
        def get(self, _key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return Conf()

    class Session:
        sparkContext = Context()  # noqa: N815

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
