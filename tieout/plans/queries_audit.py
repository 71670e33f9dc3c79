"""Registered queries: audit log, check roll-ups, alert digest, evidence."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tieout.operators import audit, audit_log, reports
from tieout.plans.catalog import register
from tieout.plans.ledger import fixture_ledger as L
from tieout.plans.materialize import new_table_dir
from tieout.plans.session import ensure_checkpoint_dir
from tieout.plans.oracle_sql import RECON_AT, q
from tieout.sources.schemas import DATA_FEEDS

_FEEDS = DATA_FEEDS

AUDIT_CTES = """scorecard AS (
  SELECT strftime(posting_date, '%Y-%m') AS business_month, 'control_account' AS check_name,
         max(posting_date) AS as_of_date,
         CAST(count(*) FILTER (WHERE status = 'PASS') AS BIGINT) AS pass_count,
         CAST(count(*) FILTER (WHERE status = 'WARN') AS BIGINT) AS warn_count,
         CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS fail_count,
         CAST(sum(CASE WHEN status <> 'PASS' THEN abs(variance_usd) ELSE 0 END) AS DECIMAL(38,2)) AS breaks_value_usd
  FROM control GROUP BY 1
  UNION ALL
  SELECT strftime(business_date, '%Y-%m'), 'transaction_level', max(business_date),
         CAST(count(*) FILTER (WHERE status = 'MATCHED') AS BIGINT), CAST(0 AS BIGINT),
         CAST(count(*) FILTER (WHERE status = 'BREAK') AS BIGINT),
         CAST(sum(CASE WHEN status = 'BREAK' THEN abs(amount_delta_usd) ELSE 0 END) AS DECIMAL(38,2))
  FROM txn_level GROUP BY 1
  UNION ALL
  SELECT strftime(posting_date, '%Y-%m'), 'roll_forward', max(posting_date),
         CAST(count(*) FILTER (WHERE status = 'PASS') AS BIGINT), CAST(0 AS BIGINT),
         CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT),
         CAST(sum(CASE WHEN status = 'FAIL' THEN abs(roll_forward_variance_usd) ELSE 0 END) AS DECIMAL(38,2))
  FROM roll_fwd GROUP BY 1
),
runs0 AS (
  SELECT 'run-' || business_month AS run_id, max(as_of_date) AS business_date, 'schedule' AS triggered_by,
         CAST(max(as_of_date) AS TIMESTAMP) + INTERVAL 8 HOUR AS started_at
  FROM scorecard GROUP BY business_month
),
checks AS (
  SELECT run_id, check_name,
         CASE WHEN fail_count > 0 THEN 'FAIL' WHEN warn_count > 0 THEN 'WARN' ELSE 'PASS' END AS status,
         CAST(fail_count + warn_count AS INTEGER) AS breaks_count, breaks_value_usd,
         CAST(NULL AS DECIMAL(18,2)) AS materiality_usd, pass_count, warn_count, fail_count
  FROM (SELECT 'run-' || business_month AS run_id, check_name,
               CAST(coalesce(sum(pass_count), 0) AS BIGINT) AS pass_count,
               CAST(coalesce(sum(warn_count), 0) AS BIGINT) AS warn_count,
               CAST(coalesce(sum(fail_count), 0) AS BIGINT) AS fail_count,
               CAST(coalesce(sum(breaks_value_usd), 0) AS DECIMAL(38,2)) AS breaks_value_usd
        FROM scorecard GROUP BY 1, 2) g
),
run_status AS (
  SELECT r.run_id,
         CASE max(CASE c.status WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END)
           WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS status
  FROM runs0 r LEFT JOIN checks c ON c.run_id = r.run_id GROUP BY r.run_id
),
runs AS (
  SELECT r.run_id, r.business_date, r.triggered_by, r.started_at, r.started_at + INTERVAL 5 MINUTE AS finished_at,
         s.status, CAST(NULL AS VARCHAR) AS git_commit_sha, CAST(NULL AS VARCHAR) AS dbt_manifest_hash,
         CAST(NULL AS VARCHAR) AS evidence_url, CAST(NULL AS VARCHAR) AS error_message,
         CAST(2 AS BIGINT) AS event_seq
  FROM runs0 r JOIN run_status s ON s.run_id = r.run_id
),
latest_run AS (SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1),
row_counts AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT 'run-' || strftime(posting_date, '%Y-%m') AS run_id, 'raw.{t}' AS table_name, "
    f"CAST(count(*) AS BIGINT) AS row_count FROM raw_{t} GROUP BY 1" for t in sorted(_FEEDS)
) + "\n)"


def A(body: str, extra: str = "") -> str:  # noqa: N802
    return q(body, AUDIT_CTES + ("," + extra if extra else ""))


@register("monthly_scorecard", A("SELECT * FROM scorecard"))
def monthly_scorecard(spark, sf_dir):
    return L(spark, sf_dir).scorecard()


@register("check_results", A("SELECT * FROM checks"))
def check_results(spark, sf_dir):
    return L(spark, sf_dir).audit_checks()


@register("overall_status", A("SELECT run_id, status FROM run_status"))
def overall_status(spark, sf_dir):
    led = L(spark, sf_dir)
    return audit.overall_status(audit.runs_from_scorecard(led.scorecard()), led.audit_checks())


@register(
    "run_totals",
    A("""SELECT run_id, CAST(coalesce(sum(breaks_value_usd), 0) AS DECIMAL(38,2)) AS total_breaks_value_usd,
                CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS fail_count,
                CAST(count(*) FILTER (WHERE status = 'WARN') AS BIGINT) AS warn_count
         FROM checks GROUP BY run_id"""),
)
def run_totals(spark, sf_dir):
    return audit.run_totals(L(spark, sf_dir).audit_checks())


@register(
    "audit_start_run",
    A("""SELECT run_id, business_date, triggered_by, started_at, CAST(NULL AS TIMESTAMP) AS finished_at,
                'RUNNING' AS status, CAST(NULL AS VARCHAR) AS git_commit_sha, CAST(NULL AS VARCHAR) AS dbt_manifest_hash,
                CAST(NULL AS VARCHAR) AS evidence_url, CAST(NULL AS VARCHAR) AS error_message,
                CAST(1 AS BIGINT) AS event_seq
         FROM runs0"""),
)
def audit_start_run(spark, sf_dir):
    return audit.audit_start_run(audit.runs_from_scorecard(L(spark, sf_dir).scorecard()))


@register("audit_finalize", A("SELECT * FROM runs"))
def audit_finalize(spark, sf_dir):
    """Latest state of the run log after start + finalize events."""
    return L(spark, sf_dir).audit_runs()


@register("audit_finalize_compacted", A("SELECT * FROM runs"))
def audit_finalize_compacted(spark, sf_dir):
    """Latest state read from a stored log: start events in a snapshot, final events in the tail."""
    events = L(spark, sf_dir).run_events()
    log = os.path.join(new_table_dir(spark, "audit-log"), "recon_runs")
    for seq in (1, 2):
        events.filter(F.col("event_seq") == seq).coalesce(1).write.mode("append").parquet(log)
        if seq == 1:
            audit_log.compact(spark, log, ["run_id"], events.schema, due=1)
    return audit_log.latest_events(spark, log, ["run_id"], events.schema)


@register("audit_finalize_checks", A("SELECT *, CAST(2 AS BIGINT) AS event_seq FROM checks"))
def audit_finalize_checks(spark, sf_dir):
    """Check events appended twice (finalize run twice): the latest view keeps one row per check."""
    c = L(spark, sf_dir).audit_checks()
    first = c.withColumn("status", F.lit("WARN")).withColumn("event_seq", F.lit(1).cast("bigint"))
    second = c.withColumn("event_seq", F.lit(2).cast("bigint"))
    return audit.latest_checks(first.unionByName(second))


_ERR = "dbt build failed: " + "x" * 600


@register(
    "audit_mark_error",
    A(f"""SELECT run_id, business_date, triggered_by, started_at, {RECON_AT} AS finished_at, 'ERROR' AS status,
                 git_commit_sha,
                 dbt_manifest_hash, evidence_url, substr('{_ERR}', 1, 500) AS error_message, event_seq + 1 AS event_seq
          FROM latest_run"""),
)
def audit_mark_error(spark, sf_dir):
    led = L(spark, sf_dir)
    return audit.audit_mark_error(led.run_events(), reports.latest_run(led.audit_runs()), _ERR,
                                  F.lit(led.params.recon_at))


@register("audit_list_runs", A("SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 10"))
def audit_list_runs(spark, sf_dir):
    return audit.audit_list_runs(L(spark, sf_dir).audit_runs(), 10)


@register(
    "audit_show_run",
    A("""SELECT r.run_id, r.business_date, r.status AS run_status, c.check_name, c.status, c.breaks_count,
                c.breaks_value_usd, c.materiality_usd, c.pass_count, c.warn_count, c.fail_count
         FROM runs r JOIN checks c ON c.run_id = r.run_id
         WHERE r.run_id = (SELECT min(run_id) FROM runs WHERE starts_with(run_id, 'run-2000'))"""),
)
def audit_show_run(spark, sf_dir):
    led = L(spark, sf_dir)
    return audit.audit_show_run(led.audit_runs(), led.audit_checks(), "run-2000")


_DIGEST = """digest_lines AS (
  SELECT run_id,
         string_agg('  • `' || check_name || '` — ' || format('{:,}', breaks_count) || ' breaks, $'
                    || format('{:,.2f}', CAST(breaks_value_usd AS DOUBLE)) || ' (' || status || ')', chr(10)
                    ORDER BY check_name) FILTER (WHERE breaks_value_usd >= 10000) AS lines,
         CAST(count(*) FILTER (WHERE breaks_value_usd >= 10000) AS BIGINT) AS above_count,
         CAST(count(*) FILTER (WHERE breaks_value_usd < 10000) AS BIGINT) AS below_count
  FROM checks GROUP BY run_id
)"""


@register(
    "alert_digest",
    A("""SELECT r.run_id, r.business_date, r.status,
                CASE r.status WHEN 'PASS' THEN ':white_check_mark:' WHEN 'WARN' THEN ':warning:'
                              WHEN 'FAIL' THEN ':rotating_light:' WHEN 'ERROR' THEN ':x:' ELSE ':grey_question:' END
                  || '  *Daily GL Reconciliation — ' || CAST(r.business_date AS VARCHAR) || '*  →  *' || r.status || '*'
                  AS headline,
                'GL Recon ' || CAST(r.business_date AS VARCHAR) || ': ' || r.status AS fallback_text,
                coalesce(d.above_count, 0) AS above_count, coalesce(d.below_count, 0) AS below_count,
                CASE WHEN coalesce(d.above_count, 0) > 0
                     THEN '*Material breaks (above threshold):*' || chr(10) || d.lines
                     ELSE '_No checks above the materiality threshold._' END AS body,
                CASE WHEN coalesce(d.below_count, 0) > 0
                     THEN '_' || CAST(d.below_count AS VARCHAR) || ' smaller check(s) stayed under the limit of '
                          || '$10,000 and are not listed._' END AS footer
         FROM runs r LEFT JOIN digest_lines d ON d.run_id = r.run_id""", _DIGEST),
)
def alert_digest(spark, sf_dir):
    led = L(spark, sf_dir)
    return audit.alert_digest(led.audit_runs(), led.audit_checks())


@register(
    "evidence_run_summary",
    A("""SELECT run_id, 'business_date' AS item, CAST(business_date AS VARCHAR) AS value FROM latest_run
         UNION ALL SELECT run_id, 'status', status FROM latest_run
         UNION ALL SELECT run_id, 'triggered_by', triggered_by FROM latest_run
         UNION ALL SELECT run_id, 'started_at', strftime(started_at, '%Y-%m-%d %H:%M:%S') FROM latest_run
         UNION ALL SELECT c.run_id, 'rows:' || c.table_name, CAST(c.row_count AS VARCHAR)
                   FROM row_counts c SEMI JOIN latest_run l ON l.run_id = c.run_id"""),
)
def evidence_run_summary(spark, sf_dir):
    led = L(spark, sf_dir)
    return audit.evidence_run_summary(reports.latest_run(led.audit_runs()), led.run_row_counts())


@register("evidence_check_results",
          A("SELECT c.* FROM checks c SEMI JOIN latest_run l ON l.run_id = c.run_id ORDER BY check_name"))
def evidence_check_results(spark, sf_dir):
    led = L(spark, sf_dir)
    return audit.evidence_check_results(led.audit_checks(), reports.latest_run(led.audit_runs()))


@register(
    "evidence_control_breaks",
    q("""SELECT * FROM control WHERE status <> 'PASS'
         ORDER BY abs(variance_usd) DESC, entity_id, account_code, posting_date LIMIT 100"""),
)
def evidence_control_breaks(spark, sf_dir):
    return audit.evidence_control_breaks(L(spark, sf_dir).control(), 100)


_TXN_ORDER = ("abs(coalesce(amount_delta_usd, 0)) DESC, source_system, source_doc_id, account_code, "
              "posting_role NULLS FIRST, journal_id NULLS FIRST, journal_line_id NULLS FIRST")


@register("evidence_txn_breaks", q(f"SELECT * FROM txn_level WHERE status = 'BREAK' ORDER BY {_TXN_ORDER} LIMIT 100"))
def evidence_txn_breaks(spark, sf_dir):
    return audit.evidence_txn_breaks(L(spark, sf_dir).txn_level(), 100)


@register("evidence_manual_jes",
          q("SELECT * FROM manual_je ORDER BY abs(amount_usd) DESC, journal_id, journal_line_id LIMIT 100"))
def evidence_manual_jes(spark, sf_dir):
    return audit.evidence_manual_jes(L(spark, sf_dir).manual_je(), 100)


@register(
    "evidence_pack",
    A("""SELECT 'check_results' AS dataset, CAST(count(*) AS BIGINT) AS row_count
           FROM checks c SEMI JOIN latest_run l ON l.run_id = c.run_id
         UNION ALL SELECT 'control_breaks', CAST(least(count(*), 100) AS BIGINT) FROM control WHERE status <> 'PASS'
         UNION ALL SELECT 'txn_breaks', CAST(least(count(*), 100) AS BIGINT) FROM txn_level WHERE status = 'BREAK'
         UNION ALL SELECT 'manual_jes', CAST(least(count(*), 100) AS BIGINT) FROM manual_je
         UNION ALL SELECT 'run_summary', CAST(4 + count(*) AS BIGINT)
           FROM row_counts c SEMI JOIN latest_run l ON l.run_id = c.run_id"""),
)
def evidence_pack(spark, sf_dir):
    """Write the five evidence datasets of the latest run; the manifest is read back from the files."""
    led = L(spark, sf_dir)
    run = reports.latest_run(led.audit_runs())
    datasets = {
        "run_summary": audit.evidence_run_summary(run, led.run_row_counts()),
        "check_results": audit.evidence_check_results(led.audit_checks(), run),
        "control_breaks": audit.evidence_control_breaks(led.control(), 100),
        "txn_breaks": audit.evidence_txn_breaks(led.txn_level(), 100),
        "manual_jes": audit.evidence_manual_jes(led.manual_je(), 100),
    }
    folder = os.path.join(ensure_checkpoint_dir(spark), f"evidence-{uuid.uuid4().hex}")
    r = run.select("business_date", "run_id").first()
    _, manifest = audit.evidence_pack(datasets, folder, str(r["business_date"]), r["run_id"])
    return manifest
