"""Registered queries: the dashboard's reads."""

from __future__ import annotations

from tieout.operators import drill, reports
from tieout.plans.catalog import register
from tieout.plans.ledger import fixture_ledger as L
from tieout.plans.oracle_sql import q
from tieout.plans.queries_audit import A

_RUN_COLS = "run_id, business_date, status, started_at, finished_at, triggered_by"


@register("latest_run", A("SELECT * FROM latest_run"))
def latest_run(spark, sf_dir):
    return reports.latest_run(L(spark, sf_dir).audit_runs())


@register(
    "latest_run_checks",
    A("""SELECT check_name, status, breaks_count, breaks_value_usd, materiality_usd
         FROM checks c SEMI JOIN latest_run l ON l.run_id = c.run_id"""),
)
def latest_run_checks(spark, sf_dir):
    led = L(spark, sf_dir)
    return reports.latest_run_checks(led.audit_runs(), led.audit_checks())


@register("latest_run_row_counts",
          A("SELECT table_name, row_count FROM row_counts c SEMI JOIN latest_run l ON l.run_id = c.run_id"))
def latest_run_row_counts(spark, sf_dir):
    led = L(spark, sf_dir)
    return reports.latest_run_row_counts(led.audit_runs(), led.run_row_counts())


@register("run_history", A(f"SELECT {_RUN_COLS} FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 30"))
def run_history(spark, sf_dir):
    return reports.run_history(L(spark, sf_dir).audit_runs(), 30)


@register("run_history_evidence", A(f"SELECT {_RUN_COLS} FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 50"))
def run_history_evidence(spark, sf_dir):
    return reports.run_history(L(spark, sf_dir).audit_runs(), 50)


_TREND = """trend AS (
  SELECT c.check_name, c.status, c.breaks_count, c.breaks_value_usd, r.business_date, r.started_at
  FROM checks c JOIN runs r ON r.run_id = c.run_id
  WHERE r.started_at >= (SELECT max(started_at) FROM runs) - INTERVAL 60 DAY
)"""


@register("check_trend", A("SELECT * FROM trend", _TREND))
def check_trend(spark, sf_dir):
    led = L(spark, sf_dir)
    return reports.check_trend(led.audit_runs(), led.audit_checks())


@register("status_composition",
          A("SELECT business_date, status, CAST(count(*) AS BIGINT) AS count FROM trend GROUP BY ALL", _TREND))
def status_composition(spark, sf_dir):
    led = L(spark, sf_dir)
    return reports.status_composition(reports.check_trend(led.audit_runs(), led.audit_checks()))


@register(
    "break_filter_values",
    q("""SELECT DISTINCT 'source_system' AS filter_name, source_system AS value FROM txn_level
         WHERE source_system IS NOT NULL
         UNION ALL SELECT DISTINCT 'account_code', account_code FROM txn_level WHERE account_code IS NOT NULL
         UNION ALL SELECT DISTINCT 'break_class', break_class FROM txn_level WHERE break_class IS NOT NULL"""),
)
def break_filter_values(spark, sf_dir):
    return reports.break_filter_values(L(spark, sf_dir).txn_level())


_SYSTEMS, _STATUSES, _ACCOUNTS = ["AP", "AR", "INV"], ["BREAK"], ["1200", "1300", "2000"]
_CLASSES = ["MISSING_GL_POSTING", "MISSING_SL_POSTING", "AMOUNT_MISMATCH", "TIMING_DIFF", "FX_ROUNDING", "UNKNOWN"]
_DETAIL = f"""detail AS (
  SELECT source_system, source_doc_id, account_code, entity_id, sl_posting_date, gl_posting_date, sl_amount_usd,
         gl_amount_usd, amount_delta_usd, posting_lag_days, break_class, status, journal_id
  FROM txn_level
  WHERE source_system IN ('AP', 'AR', 'INV') AND status IN ('BREAK') AND account_code IN ('1200', '1300', '2000')
    AND break_class IN ({", ".join(f"'{c}'" for c in _CLASSES)})
    AND abs(coalesce(amount_delta_usd, 0)) >= 0.05
  ORDER BY abs(coalesce(amount_delta_usd, 0)) DESC, source_system, source_doc_id, account_code,
           posting_role NULLS FIRST, journal_id NULLS FIRST, journal_line_id NULLS FIRST
  LIMIT 1000
)"""


def _detail(spark, sf_dir):
    return reports.break_detail(L(spark, sf_dir).txn_level(), _SYSTEMS, _STATUSES, _ACCOUNTS, _CLASSES, "0.05")


@register("break_detail", q("SELECT * FROM detail", _DETAIL))
def break_detail(spark, sf_dir):
    return _detail(spark, sf_dir)


@register(
    "break_totals",
    q("""SELECT break_class, CAST(sum(abs(amount_delta_usd)) AS DECIMAL(38,2)) AS total_abs_delta_usd,
                CAST(count(*) AS BIGINT) AS breaks FROM detail GROUP BY break_class""", _DETAIL),
)
def break_totals(spark, sf_dir):
    return reports.break_totals(_detail(spark, sf_dir))


# the document whose sides differ most on one account, by sums alone (no line-by-line match to find one document)
_TOP_DOC = """top_doc AS MATERIALIZED (
  SELECT s.source_doc_id
  FROM (SELECT source_system, source_doc_id, account_code, sum(credit_usd - debit_usd) AS usd
        FROM postings GROUP BY source_system, source_doc_id, account_code) s
  JOIN (SELECT source_system, source_doc_id, account_code, sum(credit_usd - debit_usd) AS usd
        FROM stg_gl GROUP BY source_system, source_doc_id, account_code) g
    ON g.source_system = s.source_system AND g.source_doc_id = s.source_doc_id AND g.account_code = s.account_code
  ORDER BY abs(s.usd - g.usd) DESC, s.source_system, s.source_doc_id, s.account_code
  LIMIT 1
)"""


def _top_doc(spark, sf_dir):
    return reports.widest_document(L(spark, sf_dir).postings(), L(spark, sf_dir).stg_gl())


@register("break_drill_sl", q("SELECT p.* FROM postings p WHERE p.source_doc_id = (SELECT source_doc_id FROM top_doc)",
                              _TOP_DOC))
def break_drill_sl(spark, sf_dir):
    """Sub-ledger postings of the document whose sides differ most."""
    return drill.drill(L(spark, sf_dir).postings_by_document(), _top_doc(spark, sf_dir))


@register("break_drill_gl", q("SELECT g.* FROM stg_gl g WHERE g.source_doc_id = (SELECT source_doc_id FROM top_doc)",
                              _TOP_DOC))
def break_drill_gl(spark, sf_dir):
    """GL lines of the document whose sides differ most."""
    return drill.drill(L(spark, sf_dir).gl_by_document(), _top_doc(spark, sf_dir))


@register(
    "aging_by_priority",
    q("""SELECT p.triage_priority, p.priority_order, CAST(coalesce(a.breaks, 0) AS BIGINT) AS breaks,
                CAST(coalesce(a.value_usd, 0) AS DECIMAL(38,2)) AS value_usd
         FROM (VALUES ('LOW', 0), ('MEDIUM', 1), ('HIGH', 2), ('CRITICAL', 3)) AS p(triage_priority, priority_order)
         LEFT JOIN (SELECT triage_priority, count(*) AS breaks, sum(abs(amount_delta_usd)) AS value_usd
                    FROM aging GROUP BY triage_priority) a ON a.triage_priority = p.triage_priority"""),
)
def aging_by_priority(spark, sf_dir):
    return reports.aging_by_priority(L(spark, sf_dir).aging(), spark)


@register(
    "aging_heatmap",
    q("""SELECT account_code, age_bucket, CAST(sum(abs(amount_delta_usd)) AS DECIMAL(38,2)) AS value_usd,
                CAST(count(*) AS BIGINT) AS breaks
         FROM aging GROUP BY account_code, age_bucket HAVING sum(abs(amount_delta_usd)) > 0"""),
)
def aging_heatmap(spark, sf_dir):
    return reports.aging_heatmap(L(spark, sf_dir).aging())


@register(
    "triage_queue",
    q("""SELECT triage_priority, age_bucket, source_system, source_doc_id, account_code, entity_id, business_date,
                sl_amount_usd, gl_amount_usd, amount_delta_usd, break_class
         FROM aging WHERE triage_priority IN ('HIGH', 'CRITICAL')
         ORDER BY abs(amount_delta_usd) DESC, source_system, source_doc_id, account_code, posting_role NULLS FIRST,
                  journal_id NULLS FIRST, journal_line_id NULLS FIRST
         LIMIT 200"""),
)
def triage_queue(spark, sf_dir):
    return reports.triage_queue(L(spark, sf_dir).aging(), 200)


@register(
    "summary_query",
    q("""SELECT check_name, CAST(sum(pass_count) AS BIGINT) AS pass, CAST(sum(warn_count) AS BIGINT) AS warn,
                CAST(sum(fail_count) AS BIGINT) AS fail,
                CAST(round(sum(breaks_value_usd), 2) AS DECIMAL(38,2)) AS breaks_value_usd
         FROM summary GROUP BY check_name"""),
)
def summary_query(spark, sf_dir):
    return reports.summary_query(L(spark, sf_dir).summary())

