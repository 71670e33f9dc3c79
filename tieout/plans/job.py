"""One reconciliation run as a Spark job graph.

    ingest (optional) -> build (staging .. marts, checks) -> audit, snapshot, evidence

All build tasks are submitted at once (`run_concurrently`); the ledger
builds each frame once under a per-key lock, so every task waits only for
what it reads and independent work overlaps (a DAG run). Shared layers and
marts are written as Parquet tables under the run's warehouse folder. The
transaction mart is kept from run to run, partitioned by posting month: the
first run (or `full_refresh`) builds it whole, later runs match only the
documents with a line in the lookback window and merge them in. The audit log
is appended (never rewritten): a RUNNING event first, then the finalize
events, or an ERROR event if the build fails.
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.operators import audit, audit_log, history, matching
from tieout.plans import checks, storage
from tieout.plans.ledger import Ledger, RunParams, seed_frames
from tieout.plans.materialize import write_table
from tieout.plans.parallel import run_concurrently
from tieout.plans.session import apply_engine_conf, apply_scale_conf
from tieout.sources.files import scan_raw_table
from tieout.sources.schemas import DATA_FEEDS, RAW_TABLES, raw_schema

# a new version of an account opens when one of these changes
ACCOUNT_CHECK_COLUMNS = ["account_name", "account_type", "parent_account_code", "is_control_account", "subledger_source"]


@dataclass
class JobConfig:
    warehouse: str
    params: RunParams = field(default_factory=RunParams)
    threads: int = 8
    business_date: dt.date | None = None
    triggered_by: str = "schedule"
    git_commit_sha: str | None = None
    manifest_hash: str | None = None
    alert_threshold_usd: str = "10000"
    # raw input size: when given, partition sizing follows it (`session.scale_conf`)
    input_bytes: int | None = None
    # build the transaction mart whole even where an earlier run left one
    full_refresh: bool = False


@dataclass
class RunResult:
    run_id: str
    ledger: Ledger
    seconds: dict[str, float]
    layer_seconds: dict[str, float]
    status: str = "RUNNING"


def ingest(spark: SparkSession, tables: Mapping[str, DataFrame], warehouse: str, threads: int = 8) -> None:
    """Write raw feeds as typed Parquet tables (ingestion times kept), concurrently."""

    def write(t: str):
        src = tables[t]
        cols = [src[f.name].cast(f.dataType).alias(f.name) for f in raw_schema(t).fields]
        write_table(src.select(*cols), os.path.join(warehouse, t))

    run_concurrently({t: (lambda t=t: write(t)) for t in RAW_TABLES if t in tables}, threads)


def transaction_mart(led: Ledger, warehouse: str, full_refresh: bool) -> DataFrame:
    """The transaction-level mart, kept under `history/` and partitioned by posting month.

    An incremental run replaces the rows of whole documents, so a line whose
    other side arrives later, in another month, leaves nothing stale.
    """
    spark = led.spark
    path = os.path.join(warehouse, "history", "recon_transaction_level")
    if full_refresh or not storage.exists(spark, path):
        whole = matching.recon_transaction_level(led.matched(), led.tolerance_rules(), led.params.recon_at)
        out = write_table(history.month_partition(whole), path, ["posting_month"])
    else:
        start = history.window_start(spark.read.parquet(path))
        changed = history.incremental_slice(
            led.postings(), led.stg_gl(), led.tolerance_rules(), start, led.params.recon_at, by_document=True
        )
        out = history.merge_into_path(spark, path, changed, history.DOCUMENT_KEYS, os.path.join(warehouse, "staging"))
    return out.drop("posting_month")


def account_snapshot(led: Ledger, warehouse: str) -> DataFrame:
    """SCD2 history of the chart of accounts, one version more per run."""
    folder = os.path.join(warehouse, "history", "chart_of_accounts")
    before = storage.latest_version(led.spark, folder)
    snap = history.scd2_snapshot(
        led.spark.read.parquet(before) if before else None, led.stg("dim_account"), "account_code",
        ACCOUNT_CHECK_COLUMNS, led.params.recon_at.strftime("%Y-%m-%d %H:%M:%S"),
    )
    return storage.publish(snap, folder)


def run(spark: SparkSession, cfg: JobConfig, raw_tables: Mapping[str, DataFrame] | None = None) -> RunResult:
    run_id = str(uuid.uuid4())
    apply_engine_conf(spark)
    if cfg.input_bytes:
        apply_scale_conf(spark, cfg.input_bytes)
    seconds: dict[str, float] = {}
    layers: dict[str, float] = {}
    audit_dir = os.path.join(cfg.warehouse, "audit")
    runs_path = os.path.join(audit_dir, "recon_runs")

    def layer(name: str, tasks, threads: int | None = None):
        t0 = time.time()
        out, sec = run_concurrently(tasks, threads or cfg.threads)
        seconds.update(sec)
        layers[name] = round(time.time() - t0, 3)
        return out

    if raw_tables is not None:
        layer("ingest", {"ingest_raw_tables": lambda: ingest(spark, raw_tables, cfg.warehouse, cfg.threads)})

    led = Ledger(
        spark, lambda t: scan_raw_table(spark, cfg.warehouse, t), seed_frames(spark), cfg.params,
        table_dir=os.path.join(cfg.warehouse, "marts"),
    )
    led.built_by["txn_level"] = lambda: transaction_mart(led, cfg.warehouse, cfg.full_refresh)
    bdate = cfg.business_date or cfg.params.recon_at.date()
    started = dt.datetime.now(dt.timezone.utc)
    run_row = spark.createDataFrame(
        [(run_id, bdate, cfg.triggered_by, started)],
        "run_id STRING, business_date DATE, triggered_by STRING, started_at TIMESTAMP",
    )
    start_event = audit.audit_start_run(run_row, cfg.git_commit_sha)
    start_event.write.mode("append").parquet(runs_path)

    def now():
        return F.lit(dt.datetime.now(dt.timezone.utc))

    try:
        # Everything is submitted at once: the ledger builds each frame exactly
        # once under a per-key lock, so a task waits only for the frames it
        # reads, and independent work (e.g. raw-table checks during staging)
        # overlaps. Shared layers and marts are written as tables on build.
        out = layer("build", {
            "stg_gl_journal": led.stg_gl,
            "subledger_postings": led.postings,
            "subledger_trial_balance": led.sl_tb,
            "gl_trial_balance": led.gl_tb,
            "recon_transaction_level": led.txn_level,
            "recon_control_account": led.control,
            "recon_roll_forward": led.roll_forward,
            "recon_aging": led.aging,
            "recon_fx_revaluation": led.fx_reval,
            "recon_suspense_monitor": led.suspense,
            "recon_manual_je_flag": led.manual_je,
            "recon_variance_analysis": led.variance,
            "recon_summary": led.summary,
            "monthly_scorecard": led.scorecard,
            "chart_of_accounts_snapshot": lambda: account_snapshot(led, cfg.warehouse),
            "source_row_counts": lambda: _append(
                audit.source_row_counts(run_id, {t: led.raw(t) for t in DATA_FEEDS}),
                os.path.join(audit_dir, "recon_row_counts")),
            "dq_report": lambda: write_table(checks.dq_report(led, cfg.threads),
                                             os.path.join(cfg.warehouse, "out", "dq_report")),
        }, threads=2 * cfg.threads)
        summary = out["recon_summary"]

        def finalize():
            chk = audit.check_results(summary.withColumn("run_id", F.lit(run_id)))
            name = audit.evidence_name(str(bdate), run_id)
            final, check_events = audit.audit_finalize(
                start_event, chk, now(), cfg.manifest_hash, os.path.join(cfg.warehouse, "evidence", name))
            final.write.mode("append").parquet(runs_path)
            check_events = _append(check_events, os.path.join(audit_dir, "recon_check_results"))
            latest = audit_log.latest_events(spark, runs_path, ["run_id"], start_event.schema).filter(
                F.col("run_id") == run_id)
            mine = check_events.filter(F.col("run_id") == run_id)
            write_table(audit.alert_digest(latest, mine, cfg.alert_threshold_usd),
                        os.path.join(cfg.warehouse, "out", "alert_digest"))
            counts = spark.read.parquet(os.path.join(audit_dir, "recon_row_counts"))
            audit.evidence_pack({
                "run_summary": audit.evidence_run_summary(latest, counts),
                "check_results": audit.evidence_check_results(mine, latest),
                "control_breaks": audit.evidence_control_breaks(led.control()),
                "txn_breaks": audit.evidence_txn_breaks(led.txn_level()),
                "manual_jes": audit.evidence_manual_jes(led.manual_je()),
            }, os.path.join(cfg.warehouse, "evidence"), str(bdate), run_id)
            return latest.first()["status"]

        status = layer("audit", {"audit_and_alerts": finalize})["audit_and_alerts"]
    except Exception as exc:  # stamp the run as ERROR, then re-raise
        log = spark.read.parquet(runs_path).filter(F.col("run_id") == run_id)
        _append(audit.audit_mark_error(log, run_row, f"{type(exc).__name__}: {exc}", now()), runs_path)
        raise
    # after the run's last event: a compaction that fails changes neither its state nor the log
    audit_log.compact(spark, runs_path, ["run_id"], start_event.schema)
    return RunResult(run_id, led, seconds, layers, status)


def _append(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)
