"""Schemas of the raw (bronze) tables, the seed configs and the audit tables.

Declared as Spark DDL strings so a reader never infers types: money is
decimal(18,2), rates decimal(18,8), quantities decimal(18,4).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 8)
QTY = T.DecimalType(18, 4)
# aggregates of money are widened so a sum never overflows at scale
MONEY_SUM = T.DecimalType(38, 2)

RAW_DDL: dict[str, str] = {
    "dim_entity": (
        "entity_id INT NOT NULL, entity_code STRING NOT NULL, entity_name STRING NOT NULL, "
        "functional_currency STRING NOT NULL, country STRING NOT NULL, ingested_at TIMESTAMP NOT NULL"
    ),
    "dim_account": (
        "account_id INT NOT NULL, account_code STRING NOT NULL, account_name STRING NOT NULL, "
        "account_type STRING NOT NULL, parent_account_code STRING, is_control_account BOOLEAN NOT NULL, "
        "subledger_source STRING, effective_from DATE NOT NULL, effective_to DATE, "
        "ingested_at TIMESTAMP NOT NULL"
    ),
    "fx_rate": (
        "rate_date DATE NOT NULL, from_currency STRING NOT NULL, to_currency STRING NOT NULL, "
        "rate DECIMAL(18,8) NOT NULL, ingested_at TIMESTAMP NOT NULL"
    ),
    "ap_invoices": (
        "invoice_id STRING NOT NULL, vendor_id STRING NOT NULL, entity_id INT NOT NULL, "
        "invoice_date DATE NOT NULL, posting_date DATE NOT NULL, due_date DATE NOT NULL, "
        "currency STRING NOT NULL, amount_currency DECIMAL(18,2) NOT NULL, "
        "amount_usd DECIMAL(18,2) NOT NULL, fx_rate DECIMAL(18,8) NOT NULL, "
        "expense_account_code STRING NOT NULL, control_account_code STRING NOT NULL, "
        "status STRING NOT NULL, description STRING, ingested_at TIMESTAMP NOT NULL"
    ),
    "ap_payments": (
        "payment_id STRING NOT NULL, invoice_id STRING, entity_id INT NOT NULL, "
        "payment_date DATE NOT NULL, posting_date DATE NOT NULL, currency STRING NOT NULL, "
        "amount_currency DECIMAL(18,2) NOT NULL, amount_usd DECIMAL(18,2) NOT NULL, "
        "fx_rate DECIMAL(18,8) NOT NULL, cash_account_code STRING NOT NULL, "
        "control_account_code STRING NOT NULL, method STRING NOT NULL, ingested_at TIMESTAMP NOT NULL"
    ),
    "ap_accruals": (
        "accrual_id STRING NOT NULL, entity_id INT NOT NULL, accrual_date DATE NOT NULL, "
        "posting_date DATE NOT NULL, reversal_date DATE NOT NULL, currency STRING NOT NULL, "
        "amount_currency DECIMAL(18,2) NOT NULL, amount_usd DECIMAL(18,2) NOT NULL, "
        "fx_rate DECIMAL(18,8) NOT NULL, expense_account_code STRING NOT NULL, "
        "control_account_code STRING NOT NULL, description STRING, ingested_at TIMESTAMP NOT NULL"
    ),
    "ar_invoices": (
        "invoice_id STRING NOT NULL, customer_id STRING NOT NULL, entity_id INT NOT NULL, "
        "invoice_date DATE NOT NULL, posting_date DATE NOT NULL, due_date DATE NOT NULL, "
        "currency STRING NOT NULL, amount_currency DECIMAL(18,2) NOT NULL, "
        "amount_usd DECIMAL(18,2) NOT NULL, fx_rate DECIMAL(18,8) NOT NULL, "
        "revenue_account_code STRING NOT NULL, control_account_code STRING NOT NULL, "
        "status STRING NOT NULL, description STRING, ingested_at TIMESTAMP NOT NULL"
    ),
    "ar_receipts": (
        "receipt_id STRING NOT NULL, invoice_id STRING, entity_id INT NOT NULL, "
        "receipt_date DATE NOT NULL, posting_date DATE NOT NULL, currency STRING NOT NULL, "
        "amount_currency DECIMAL(18,2) NOT NULL, amount_usd DECIMAL(18,2) NOT NULL, "
        "fx_rate DECIMAL(18,8) NOT NULL, cash_account_code STRING NOT NULL, "
        "control_account_code STRING NOT NULL, method STRING NOT NULL, ingested_at TIMESTAMP NOT NULL"
    ),
    "ar_credit_memos": (
        "memo_id STRING NOT NULL, invoice_id STRING, entity_id INT NOT NULL, memo_date DATE NOT NULL, "
        "posting_date DATE NOT NULL, currency STRING NOT NULL, amount_currency DECIMAL(18,2) NOT NULL, "
        "amount_usd DECIMAL(18,2) NOT NULL, fx_rate DECIMAL(18,8) NOT NULL, reason STRING NOT NULL, "
        "revenue_account_code STRING NOT NULL, control_account_code STRING NOT NULL, "
        "ingested_at TIMESTAMP NOT NULL"
    ),
    "inv_transactions": (
        "txn_id STRING NOT NULL, item_id STRING NOT NULL, entity_id INT NOT NULL, txn_date DATE NOT NULL, "
        "posting_date DATE NOT NULL, txn_type STRING NOT NULL, quantity DECIMAL(18,4) NOT NULL, "
        "unit_cost_usd DECIMAL(18,4) NOT NULL, amount_usd DECIMAL(18,2) NOT NULL, "
        "inventory_account_code STRING NOT NULL, offset_account_code STRING NOT NULL, "
        "description STRING, ingested_at TIMESTAMP NOT NULL"
    ),
    "gl_journal": (
        "journal_id STRING NOT NULL, journal_line_id INT NOT NULL, entity_id INT NOT NULL, "
        "business_date DATE NOT NULL, posting_date DATE NOT NULL, account_code STRING NOT NULL, "
        "debit_usd DECIMAL(18,2) NOT NULL, credit_usd DECIMAL(18,2) NOT NULL, currency STRING NOT NULL, "
        "amount_currency DECIMAL(18,2) NOT NULL, fx_rate DECIMAL(18,8) NOT NULL, "
        "source_system STRING NOT NULL, source_doc_id STRING, description STRING, "
        "created_by STRING NOT NULL, ingested_at TIMESTAMP NOT NULL"
    ),
}

# FK load order (parents first); truncation runs in reverse
RAW_TABLES = [
    "dim_entity",
    "dim_account",
    "fx_rate",
    "ap_invoices",
    "ap_payments",
    "ap_accruals",
    "ar_invoices",
    "ar_receipts",
    "ar_credit_memos",
    "inv_transactions",
    "gl_journal",
]

# the feeds with document or journal rows (all but the two dimensions and the rates)
DATA_FEEDS = [t for t in RAW_TABLES if t not in ("dim_entity", "dim_account", "fx_rate")]

SEED_DDL: dict[str, str] = {
    "tolerance_rules": (
        "account_code STRING, amount_tolerance_usd DECIMAL(18,4), timing_tolerance_days INT, "
        "fx_tolerance_pct DECIMAL(18,6)"
    ),
    "materiality": "account_code STRING, materiality_usd DECIMAL(18,2), severity STRING",
}

BREAKS_LOG_DDL = "journal_id STRING, journal_line_id INT, break_class STRING, detail STRING"

AUDIT_DDL: dict[str, str] = {
    # append-only event log; latest state per run_id is a view over it
    "recon_runs": (
        "run_id STRING NOT NULL, business_date DATE NOT NULL, triggered_by STRING NOT NULL, "
        "started_at TIMESTAMP NOT NULL, finished_at TIMESTAMP, status STRING NOT NULL, "
        "git_commit_sha STRING, dbt_manifest_hash STRING, "
        "source_row_counts MAP<STRING, BIGINT> NOT NULL, evidence_url STRING, "
        "event_at TIMESTAMP NOT NULL, event_seq BIGINT NOT NULL"
    ),
    "recon_check_results": (
        "run_id STRING NOT NULL, check_name STRING NOT NULL, status STRING NOT NULL, "
        "breaks_count INT NOT NULL, breaks_value_usd DECIMAL(38,2) NOT NULL, "
        "materiality_usd DECIMAL(18,2), details MAP<STRING, BIGINT> NOT NULL, "
        "event_at TIMESTAMP NOT NULL, event_seq BIGINT NOT NULL"
    ),
}


def struct_of(ddl: str) -> T.StructType:
    """Parse a DDL column list into a StructType (no session needed)."""
    return T._parse_datatype_string(ddl)  # noqa: SLF001 - public DDL grammar


def raw_schema(table: str) -> T.StructType:
    return struct_of(RAW_DDL[table])


def raw_columns(table: str) -> list[str]:
    return [f.name for f in raw_schema(table).fields]
