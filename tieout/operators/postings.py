"""Double-entry postings: sub-ledger documents as Dr/Cr lines, and GL journals.

Each document becomes two lines from ONE scan: `explode(array(dr, cr))`
instead of a union of two selects over the same source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.functions.columns import money, rate

POSTING_COLUMNS = [
    "source_system", "source_doc_id", "entity_id", "business_date", "posting_date", "currency",
    "amount_currency", "amount_usd", "fx_rate", "account_code", "debit_usd", "credit_usd", "posting_role",
]

def _zero() -> Column:
    return F.lit(0).cast("decimal(18,2)")


def _line(account: Column, debit: Column, credit: Column, role: Column | str) -> Column:
    role_c = F.lit(role) if isinstance(role, str) else role
    return F.struct(
        account.alias("account_code"), money(debit).alias("debit_usd"), money(credit).alias("credit_usd"),
        role_c.alias("posting_role"),
    )


def double_entry(
    df: DataFrame,
    *,
    system: str,
    doc_id: str,
    business_date: str,
    debit_account: Column,
    credit_account: Column,
    amount: Column,
    debit_role: Column | str,
    credit_role: Column | str,
    currency: Column | None = None,
    amount_currency: Column | None = None,
    fx: Column | None = None,
) -> DataFrame:
    """One document row -> a debit line and a credit line in the posting shape."""
    lines = F.explode(
        F.array(
            _line(debit_account, amount, _zero(), debit_role),
            _line(credit_account, _zero(), amount, credit_role),
        )
    ).alias("_l")
    out = df.select(
        F.lit(system).alias("source_system"),
        F.col(doc_id).alias("source_doc_id"),
        F.col("entity_id"),
        F.col(business_date).alias("business_date"),
        F.col("posting_date"),
        (currency if currency is not None else F.col("currency")).alias("currency"),
        money(amount_currency if amount_currency is not None else F.col("amount_currency")).alias("amount_currency"),
        money(amount).alias("amount_usd"),
        rate(fx if fx is not None else F.col("fx_rate")).alias("fx_rate"),
        lines,
    )
    return out.select(*POSTING_COLUMNS[:9], "_l.*")


def post_ap_invoices(stg: DataFrame) -> DataFrame:
    """Dr expense, Cr AP control."""
    return double_entry(
        stg, system="AP", doc_id="invoice_id", business_date="invoice_date",
        debit_account=F.col("expense_account_code"), credit_account=F.col("control_account_code"),
        amount=F.col("amount_usd"), debit_role="AP_INVOICE_EXPENSE", credit_role="AP_INVOICE_CONTROL",
    )


def post_ap_payments(stg: DataFrame) -> DataFrame:
    """Dr AP control, Cr cash."""
    return double_entry(
        stg, system="AP", doc_id="payment_id", business_date="payment_date",
        debit_account=F.col("control_account_code"), credit_account=F.col("cash_account_code"),
        amount=F.col("amount_usd"), debit_role="AP_PAYMENT_CONTROL", credit_role="AP_PAYMENT_CASH",
    )


def post_ar_invoices(stg: DataFrame) -> DataFrame:
    """Dr AR control, Cr revenue."""
    return double_entry(
        stg, system="AR", doc_id="invoice_id", business_date="invoice_date",
        debit_account=F.col("control_account_code"), credit_account=F.col("revenue_account_code"),
        amount=F.col("amount_usd"), debit_role="AR_INVOICE_CONTROL", credit_role="AR_INVOICE_REVENUE",
    )


def post_ar_receipts(stg: DataFrame) -> DataFrame:
    """Dr cash, Cr AR control."""
    return double_entry(
        stg, system="AR", doc_id="receipt_id", business_date="receipt_date",
        debit_account=F.col("cash_account_code"), credit_account=F.col("control_account_code"),
        amount=F.col("amount_usd"), debit_role="AR_RECEIPT_CASH", credit_role="AR_RECEIPT_CONTROL",
    )


def resolve_inventory_accounts(stg_inv: DataFrame) -> DataFrame:
    """(debit, credit) account per inventory transaction; amount made absolute.

    RECEIPT, COGS and non-negative ADJUSTMENT debit the inventory column and
    credit the offset column; a negative ADJUSTMENT swaps them.
    """
    forward = (F.col("txn_type").isin("RECEIPT", "COGS")) | (
        (F.col("txn_type") == "ADJUSTMENT") & (F.col("amount_usd") >= 0)
    )
    return stg_inv.select(
        "txn_id", "entity_id", "txn_date", "posting_date", "txn_type",
        money(F.abs(F.col("amount_usd"))).alias("amount_abs_usd"),
        F.when(forward, F.col("inventory_account_code")).otherwise(F.col("offset_account_code")).alias(
            "debit_account_code"
        ),
        F.when(forward, F.col("offset_account_code")).otherwise(F.col("inventory_account_code")).alias(
            "credit_account_code"
        ),
    )


def post_inventory(resolved: DataFrame) -> DataFrame:
    """Inventory lines are USD at rate 1; roles INV_<type>_DEBIT / _CREDIT."""
    return double_entry(
        resolved, system="INV", doc_id="txn_id", business_date="txn_date",
        debit_account=F.col("debit_account_code"), credit_account=F.col("credit_account_code"),
        amount=F.col("amount_abs_usd"),
        debit_role=F.concat(F.lit("INV_"), F.col("txn_type"), F.lit("_DEBIT")),
        credit_role=F.concat(F.lit("INV_"), F.col("txn_type"), F.lit("_CREDIT")),
        currency=F.lit("USD"), amount_currency=F.col("amount_abs_usd"), fx=F.lit(1),
    )


def subledger_postings(
    ap_invoices: DataFrame, ap_payments: DataFrame, ar_invoices: DataFrame, ar_receipts: DataFrame,
    inv_transactions: DataFrame,
) -> DataFrame:
    """All sub-ledger postings in one shape (accruals and credit memos are not posted)."""
    parts = [
        post_ap_invoices(ap_invoices),
        post_ap_payments(ap_payments),
        post_ar_invoices(ar_invoices),
        post_ar_receipts(ar_receipts),
        post_inventory(resolve_inventory_accounts(inv_transactions)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------- GL side
GL_COLUMNS = [
    "journal_id", "journal_line_id", "entity_id", "business_date", "posting_date", "account_code",
    "debit_usd", "credit_usd", "currency", "amount_currency", "fx_rate", "source_system", "source_doc_id",
    "description", "created_by", "ingested_at",
]

_FEED_LABEL = {
    ("AP", "AP_INVOICE"): "AP invoice ",
    ("AP", "AP_PAYMENT"): "AP payment ",
    ("AR", "AR_INVOICE"): "AR invoice ",
    ("AR", "AR_RECEIPT"): "AR receipt ",
}
DEBIT_ROLES = ["AP_INVOICE_EXPENSE", "AP_PAYMENT_CONTROL", "AR_INVOICE_CONTROL", "AR_RECEIPT_CASH"]
_CREATED_BY = {"AP": "ap_subledger_feed", "AR": "ar_subledger_feed", "INV": "inv_subledger_feed"}


def post_to_gl(postings: DataFrame, ingested_at: str) -> DataFrame:
    """Sub-ledger postings -> balanced GL journal entries.

    Journal id is 'GL-' + document id; the debit line is line 1 and the credit
    line is line 2, as the sub-ledger feeds post them. Works on the output of
    `subledger_postings` so all five feeds share one code path.
    """
    role = F.col("posting_role")
    label = F.when(role.startswith("INV_"), F.concat(
        F.lit("INV "), F.regexp_extract(role, r"^INV_(.*)_(DEBIT|CREDIT)$", 1), F.lit(" ")
    ))
    for (_, prefix), text in _FEED_LABEL.items():
        label = label.when(role.startswith(prefix), F.lit(text))
    created = F.lit(_CREATED_BY["INV"])
    for sys_, who in _CREATED_BY.items():
        created = F.when(F.col("source_system") == sys_, F.lit(who)).otherwise(created)
    return postings.select(
        F.concat(F.lit("GL-"), F.col("source_doc_id")).alias("journal_id"),
        F.when(role.isin(*DEBIT_ROLES) | role.endswith("_DEBIT"), 1).otherwise(2).cast("int").alias(
            "journal_line_id"
        ),
        "entity_id", "business_date", "posting_date", "account_code", "debit_usd", "credit_usd", "currency",
        "amount_currency", "fx_rate", "source_system", "source_doc_id",
        F.concat(label, F.col("source_doc_id")).alias("description"),
        created.alias("created_by"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
    )


def order_journal(gl: DataFrame) -> DataFrame:
    """Journal in (business_date, journal_id, line) order (a range shuffle + sort)."""
    return gl.orderBy("business_date", "journal_id", "journal_line_id")


def fx_lookup(docs: DataFrame, fx_rates: DataFrame, date_col: str, currency_col: str = "currency",
              strict: bool = False) -> DataFrame:
    """Attach the (date, currency -> USD) rate. Rows without a rate keep NULL, or with
    `strict` fail the job that reads them."""
    from tieout.plans.broadcast import checked_broadcast

    fx = fx_rates.filter(F.col("to_currency") == "USD").select(
        F.col("rate_date").alias("_d"), F.col("from_currency").alias("_c"), F.col("rate").alias("looked_up_rate")
    )
    fx = checked_broadcast(fx, max_rows=5_000_000)
    out = docs.join(fx, (docs[date_col] == fx["_d"]) & (docs[currency_col] == fx["_c"]), "left").drop("_d", "_c")
    if not strict:
        return out
    gap = F.concat_ws(" ", F.lit("no USD rate for"), F.col(currency_col), F.col(date_col).cast("string"))
    return out.withColumn("looked_up_rate", F.coalesce(
        F.col("looked_up_rate"), F.raise_error(gap).cast(fx_rates.schema["rate"].dataType)))


def missing_rates(looked_up: DataFrame) -> DataFrame:
    """Rows whose rate lookup failed (the generator treats these as errors)."""
    return looked_up.filter(F.col("looked_up_rate").isNull())
