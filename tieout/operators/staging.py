"""Staging: fixed column projections and the keep-latest dedup of the GL feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tieout.functions.columns import money

# staged column order per table (nothing is dropped but ingestion metadata)
STAGED_COLUMNS: dict[str, list[str]] = {
    "dim_entity": ["entity_id", "entity_code", "entity_name", "functional_currency", "country"],
    "dim_account": [
        "account_id", "account_code", "account_name", "account_type", "parent_account_code",
        "is_control_account", "subledger_source", "effective_from", "effective_to",
    ],
    "fx_rate": ["rate_date", "from_currency", "to_currency", "rate"],
    "ap_invoices": [
        "invoice_id", "vendor_id", "entity_id", "invoice_date", "posting_date", "due_date", "currency",
        "amount_currency", "amount_usd", "fx_rate", "expense_account_code", "control_account_code",
        "status", "description",
    ],
    "ap_payments": [
        "payment_id", "invoice_id", "entity_id", "payment_date", "posting_date", "currency",
        "amount_currency", "amount_usd", "fx_rate", "cash_account_code", "control_account_code", "method",
    ],
    "ap_accruals": [
        "accrual_id", "entity_id", "accrual_date", "posting_date", "reversal_date", "currency",
        "amount_currency", "amount_usd", "fx_rate", "expense_account_code", "control_account_code",
        "description",
    ],
    "ar_invoices": [
        "invoice_id", "customer_id", "entity_id", "invoice_date", "posting_date", "due_date", "currency",
        "amount_currency", "amount_usd", "fx_rate", "revenue_account_code", "control_account_code",
        "status", "description",
    ],
    "ar_receipts": [
        "receipt_id", "invoice_id", "entity_id", "receipt_date", "posting_date", "currency",
        "amount_currency", "amount_usd", "fx_rate", "cash_account_code", "control_account_code", "method",
    ],
    "ar_credit_memos": [
        "memo_id", "invoice_id", "entity_id", "memo_date", "posting_date", "currency", "amount_currency",
        "amount_usd", "fx_rate", "reason", "revenue_account_code", "control_account_code",
    ],
    "inv_transactions": [
        "txn_id", "item_id", "entity_id", "txn_date", "posting_date", "txn_type", "quantity",
        "unit_cost_usd", "amount_usd", "inventory_account_code", "offset_account_code", "description",
    ],
}

GL_KEYS = ["journal_id", "journal_line_id"]
GL_STAGED_COLUMNS = [
    "journal_id", "journal_line_id", "entity_id", "business_date", "posting_date", "account_code",
    "debit_usd", "credit_usd", "net_amount_usd", "currency", "amount_currency", "fx_rate",
    "source_system", "source_doc_id", "description", "created_by", "ingested_at",
]


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed projection in the given order (pruned down to the scan by Catalyst)."""
    return df.select(*columns)


def stage(df: DataFrame, table: str) -> DataFrame:
    return project(df, STAGED_COLUMNS[table])


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under `order_by` (e.g. newest ingested_at).

    Planned by Spark as a per-partition group limit before the shuffle
    (WindowGroupLimit), so a key replayed many times is thinned map-side and
    no task receives all copies of a hot key.
    """
    w = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def stg_gl_journal(raw_gl: DataFrame) -> DataFrame:
    """Latest copy of each (journal_id, journal_line_id), plus net = debit - credit.

    Equal ingested_at would be a free choice; all other columns break the tie,
    so copies that still tie are the same line.
    """
    order = [
        F.col("ingested_at").desc(), F.col("debit_usd").desc(), F.col("credit_usd").desc(),
        F.col("posting_date").desc(), F.col("account_code"), F.col("entity_id"),
        *(F.col(c).asc_nulls_last() for c in (
            "business_date", "currency", "amount_currency", "fx_rate", "source_system", "source_doc_id", "description", "created_by",
        )),
    ]
    latest = dedup_latest(raw_gl, GL_KEYS, order)
    return latest.withColumn("net_amount_usd", money(F.col("debit_usd") - F.col("credit_usd"))).select(
        *GL_STAGED_COLUMNS
    )
