"""The declared data-quality checks of the ledger (sources, staging,
intermediate, marts, singular tests) and their two evaluators: Spark models
from a `Ledger`, and DuckDB SQL for the oracle."""

from __future__ import annotations

from tieout.operators import quality
from tieout.operators.quality import Check
from tieout.sources import reference_data as R

# the key of each sub-ledger feed
FEED_KEYS = {
    "ap_invoices": "invoice_id", "ap_payments": "payment_id", "ap_accruals": "accrual_id",
    "ar_invoices": "invoice_id", "ar_receipts": "receipt_id", "ar_credit_memos": "memo_id",
    "inv_transactions": "txn_id",
}

# --- FIXED VALUES: declared tests (model, kind, column, argument, warn_if, error_if, severity)
CHECKS: list[Check] = [
    Check("dim_entity", "not_null", "entity_id"), Check("dim_entity", "unique", "entity_id"),
    Check("dim_entity", "not_null", "entity_code"), Check("dim_entity", "unique", "entity_code"),
    Check("dim_entity", "not_null", "functional_currency"),
    Check("dim_entity", "accepted_values", "functional_currency", tuple(R.CURRENCIES)),
    Check("dim_account", "not_null", "account_id"), Check("dim_account", "unique", "account_id"),
    Check("dim_account", "not_null", "account_code"), Check("dim_account", "unique", "account_code"),
    Check("dim_account", "not_null", "account_type"),
    Check("dim_account", "accepted_values", "account_type", tuple(R.ACCOUNT_TYPES)),
    Check("fx_rate", "not_null", "rate_date"), Check("fx_rate", "not_null", "from_currency"),
    Check("fx_rate", "not_null", "to_currency"), Check("fx_rate", "not_null", "rate"),
    Check("ap_invoices", "not_null", "invoice_id"), Check("ap_invoices", "unique", "invoice_id"),
    Check("ap_invoices", "not_null", "entity_id"),
    Check("ap_invoices", "relationships", "entity_id", ("dim_entity", "entity_id")),
    Check("ap_invoices", "accepted_values", "status", tuple(R.AP_INVOICE_STATUSES)),
    Check("ap_payments", "not_null", "payment_id"), Check("ap_payments", "unique", "payment_id"),
    Check("ap_payments", "relationships", "entity_id", ("dim_entity", "entity_id")),
    Check("ap_accruals", "not_null", "accrual_id"), Check("ap_accruals", "unique", "accrual_id"),
    Check("ar_invoices", "not_null", "invoice_id"), Check("ar_invoices", "unique", "invoice_id"),
    Check("ar_invoices", "relationships", "entity_id", ("dim_entity", "entity_id")),
    Check("ar_receipts", "not_null", "receipt_id"), Check("ar_receipts", "unique", "receipt_id"),
    Check("ar_credit_memos", "not_null", "memo_id"), Check("ar_credit_memos", "unique", "memo_id"),
    Check("ar_credit_memos", "accepted_values", "reason", tuple(R.CREDIT_MEMO_REASONS)),
    Check("inv_transactions", "not_null", "txn_id"), Check("inv_transactions", "unique", "txn_id"),
    Check("inv_transactions", "not_null", "txn_type"),
    Check("inv_transactions", "accepted_values", "txn_type", tuple(R.INV_TXN_TYPES)),
    Check("gl_journal", "not_null", "journal_id"), Check("gl_journal", "not_null", "source_system"),
    Check("gl_journal", "accepted_values", "source_system", tuple(R.SOURCE_SYSTEMS)),
    Check("gl_journal", "not_null", "debit_usd"), Check("gl_journal", "expression", "debit_usd", ">= 0"),
    Check("gl_journal", "not_null", "credit_usd"), Check("gl_journal", "expression", "credit_usd", ">= 0"),
    # staging
    Check("stg_dim_entity", "not_null", "entity_id"), Check("stg_dim_entity", "unique", "entity_id"),
    Check("stg_dim_entity", "accepted_values", "functional_currency", tuple(R.CURRENCIES)),
    Check("stg_dim_account", "not_null", "account_code"), Check("stg_dim_account", "unique", "account_code"),
    Check("stg_dim_account", "accepted_values", "account_type", tuple(R.ACCOUNT_TYPES)),
    *[Check(f"stg_{feed}", kind, key) for feed, key in FEED_KEYS.items() for kind in ("not_null", "unique")],
    Check("stg_fx_rate", "not_null", "rate"), Check("stg_fx_rate", "expression", "rate", "> 0"),
    Check("stg_ap_invoices", "expression", "amount_usd", ">= 0"),
    Check("stg_ar_invoices", "expression", "amount_usd", ">= 0"),
    Check("stg_gl_journal", "unique_combination", None, ("journal_id", "journal_line_id")),
    Check("stg_gl_journal", "not_null", "journal_id"), Check("stg_gl_journal", "not_null", "net_amount_usd"),
    Check("stg_gl_journal", "accepted_values", "source_system", tuple(R.SOURCE_SYSTEMS)),
    # intermediate
    Check("subledger_postings", "expression", None,
          "(debit_usd > 0 and credit_usd = 0) or (debit_usd = 0 and credit_usd > 0) "
          "or (debit_usd = 0 and credit_usd = 0)", 0, 100),
    Check("subledger_postings", "accepted_values", "source_system", ("AP", "AR", "INV")),
    Check("subledger_postings", "not_null", "source_doc_id"),
    Check("subledger_postings", "not_null", "posting_date"),
    Check("subledger_trial_balance", "unique_combination", None, ("entity_id", "account_code", "posting_date")),
    Check("subledger_trial_balance", "not_null", "posting_date"),
    Check("subledger_trial_balance", "not_null", "running_balance_usd"),
    Check("gl_trial_balance", "unique_combination", None, ("entity_id", "account_code", "posting_date")),
    Check("account_hierarchy", "not_null", "account_code"), Check("account_hierarchy", "unique", "account_code"),
    Check("account_hierarchy", "not_null", "level"),
    # marts
    Check("recon_control_account", "unique_combination", None, ("entity_id", "account_code", "posting_date")),
    Check("recon_control_account", "accepted_values", "status", tuple(R.CHECK_STATUSES)),
    Check("recon_transaction_level", "accepted_values", "break_class", tuple(R.BREAK_CLASSES)),
    Check("recon_transaction_level", "accepted_values", "status", ("MATCHED", "BREAK")),
    Check("recon_roll_forward", "accepted_values", "ledger", ("SUBLEDGER", "GL")),
    Check("recon_roll_forward", "accepted_values", "status", ("PASS", "FAIL")),
    Check("recon_summary", "not_null", "check_name"),
    Check("recon_summary", "accepted_values", "check_name", ("control_account", "transaction_level", "roll_forward", "duplicate_invoices")),
    Check("recon_variance_analysis", "accepted_values", "status", ("WARN", "FAIL")),
    Check("recon_aging", "accepted_values", "age_bucket", tuple(R.AGE_BUCKETS)),
    Check("recon_aging", "accepted_values", "triage_priority", tuple(R.TRIAGE_PRIORITIES)),
    Check("recon_fx_revaluation", "accepted_values", "status", ("PASS", "WARN", "FAIL")),
    Check("recon_suspense_monitor", "accepted_values", "status", ("PASS", "FAIL")),
    Check("recon_manual_je_flag", "accepted_values", "status", ("PASS", "FAIL")),
    # singular tests
    Check("stg_gl_journal", "singular", None, "assert_gl_journal_balanced", 0, 1500, "warn"),
    Check("recon_transaction_level", "singular", None, "assert_no_orphan_breaks"),
    Check("subledger_postings", "singular", None, "assert_subledger_postings_balanced"),
]


def spark_models(led):
    # feeds are gone over once or twice, so none is landed for its checks
    m = {t: (lambda t=t: led.feed(t)) for t in [
        "dim_entity", "dim_account", "fx_rate", "ap_invoices", "ap_payments", "ap_accruals", "ar_invoices",
        "ar_receipts", "ar_credit_memos", "inv_transactions", "gl_journal"]}
    m.update({
        **{f"stg_{t}": (lambda t=t: led.stg(t)) for t in ["dim_entity", "dim_account", "fx_rate", *FEED_KEYS]},
        "stg_gl_journal": led.stg_gl,
        "subledger_postings": led.postings,
        "subledger_trial_balance": led.sl_tb,
        "gl_trial_balance": led.gl_tb,
        "account_hierarchy": led.hierarchy,
        "recon_control_account": led.control,
        "recon_transaction_level": led.txn_level,
        "recon_roll_forward": led.roll_forward,
        "recon_summary": led.summary,
        "recon_variance_analysis": led.variance,
        "recon_aging": led.aging,
        "recon_fx_revaluation": led.fx_reval,
        "recon_suspense_monitor": led.suspense,
        "recon_manual_je_flag": led.manual_je,
    })
    return m


def spark_singular(led):
    return {
        "assert_gl_journal_balanced": lambda: quality.test_gl_journal_balanced(led.stg_gl()),
        "assert_no_orphan_breaks": lambda: quality.test_no_orphan_breaks(led.txn_level()),
        "assert_subledger_postings_balanced": lambda: quality.test_subledger_postings_balanced(led.postings()),
    }


def dq_report(led, threads: int = 8):
    """The declared checks, each model's checks as one concurrent job."""
    return quality.run_dq_report(spark_models(led), CHECKS, spark_singular(led), led.spark, threads)


# ------------------------------------------------------------------ oracle side
SQL_MODEL = {
    **{f"stg_{t}": f"raw_{t}" for t in ["dim_entity", "dim_account", "fx_rate", *FEED_KEYS]},
    "stg_gl_journal": "stg_gl", "subledger_postings": "postings", "subledger_trial_balance": "sl_tb",
    "gl_trial_balance": "gl_tb", "account_hierarchy": "chart_hierarchy", "recon_control_account": "control",
    "recon_transaction_level": "txn_level", "recon_roll_forward": "roll_fwd", "recon_summary": "summary",
    "recon_variance_analysis": "variance", "recon_aging": "aging", "recon_fx_revaluation": "fx_reval",
    "recon_suspense_monitor": "suspense", "recon_manual_je_flag": "manual_je",
}

SQL_SINGULAR = {
    "assert_gl_journal_balanced": """SELECT journal_id FROM stg_gl GROUP BY journal_id
        HAVING abs(sum(debit_usd) - sum(credit_usd)) > 0.01""",
    "assert_no_orphan_breaks": "SELECT * FROM txn_level WHERE status = 'BREAK' AND break_class = 'UNKNOWN'",
    "assert_subledger_postings_balanced": """SELECT source_system, source_doc_id FROM postings
        GROUP BY source_system, source_doc_id HAVING abs(sum(debit_usd) - sum(credit_usd)) > 0.01""",
}


def _sql_model(name: str) -> str:
    return SQL_MODEL.get(name, f"raw_{name}")


def _vals(vs) -> str:
    return ", ".join(f"'{v}'" for v in vs)


def check_sql(c: Check) -> str:
    t = _sql_model(c.model)
    if c.kind == "not_null":
        failing = f"SELECT * FROM {t} WHERE {c.column} IS NULL"
    elif c.kind == "accepted_values":
        failing = f"SELECT * FROM {t} WHERE {c.column} NOT IN ({_vals(c.arg)})"
    elif c.kind == "expression":
        cond = f"{c.column} {c.arg}" if c.column else c.arg
        failing = f"SELECT * FROM {t} WHERE NOT ({cond})"
    elif c.kind == "unique":
        failing = f"SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1"
    elif c.kind == "unique_combination":
        cols = ", ".join(c.arg)
        failing = f"SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1"
    elif c.kind == "relationships":
        parent, field = c.arg
        failing = (f"SELECT * FROM {t} c WHERE c.{c.column} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {_sql_model(parent)} p WHERE p.{field} = c.{c.column})")
    elif c.kind == "singular":
        failing = SQL_SINGULAR[str(c.arg)]
    else:
        raise ValueError(c.kind)
    if c.severity == "warn":
        status = f"CASE WHEN n > {c.warn_if} THEN 'WARN' ELSE 'PASS' END"
    else:
        status = f"CASE WHEN n > {c.error_if} THEN 'FAIL' WHEN n > {c.warn_if} THEN 'WARN' ELSE 'PASS' END"
    return (f"SELECT '{c.name}' AS test_name, '{c.model}' AS model, n AS failures, {status} AS status "
            f"FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM ({failing}) f) x")


def dq_report_sql_body() -> str:
    return "\nUNION ALL\n".join(check_sql(c) for c in CHECKS)


def gl_constraints_spark(led):
    return quality.dq_check_constraints(led.raw("gl_journal"))


def gl_constraints_sql_body() -> str:
    parts = [
        f"SELECT '{n}' AS constraint_name, CAST(count(*) FILTER (WHERE NOT ({e})) AS BIGINT) AS failures "
        f"FROM raw_gl_journal"
        for n, e in quality.GL_CHECK_CONSTRAINTS
    ]
    return " UNION ALL ".join(parts)


__all__ = ["CHECKS", "dq_report", "dq_report_sql_body"]
