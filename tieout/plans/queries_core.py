"""Registered queries: sources, staging, postings, balances, reconciliation marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieout.operators import balances, marts, postings, staging
from tieout.plans.catalog import register
from tieout.plans.ledger import fixture_ledger
from tieout.plans.oracle_sql import FRESH_AS_OF, q
from tieout.sources import files, footers
from tieout.sources.fixtures import fixture
from tieout.sources.schemas import DATA_FEEDS


def L(spark, sf_dir):  # noqa: N802
    return fixture_ledger(spark, sf_dir)


# ------------------------------------------------------------------ sources
_RAW_DATA_TABLES = [
    "ap_invoices", "ap_payments", "ap_accruals", "ar_invoices", "ar_receipts", "ar_credit_memos",
    "inv_transactions", "gl_journal",
]


@register("scan_raw_table", q("SELECT * FROM raw_gl_journal"))
def scan_raw_table(spark, sf_dir):
    return L(spark, sf_dir).raw("gl_journal")


@register(
    "table_row_counts",
    q(" UNION ALL ".join(
        f"SELECT 'raw.{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM raw_{t}" for t in _RAW_DATA_TABLES
    )),
)
def table_row_counts(spark, sf_dir):
    led = L(spark, sf_dir)
    return footers.row_counts(spark, {t: led.raw(t) for t in _RAW_DATA_TABLES})


@register(
    "breaks_log_counts",
    q("SELECT break_class, CAST(count(*) AS BIGINT) AS n_breaks FROM raw_breaks_log GROUP BY break_class"),
)
def breaks_log_counts(spark, sf_dir):
    return files.breaks_log_counts(fixture(spark, sf_dir).breaks_log())


_FRESH_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS source_name, max(ingested_at) AS max_loaded_at,
           CAST(date_diff('second', max(ingested_at), {FRESH_AS_OF}) / 3600 AS DECIMAL(18,2)) AS age_hours,
           {w} AS warn_after_hours, {e} AS error_after_hours,
           CASE WHEN max(ingested_at) IS NULL THEN 'error'
                WHEN date_diff('second', max(ingested_at), {FRESH_AS_OF}) > {e} * 3600 THEN 'error'
                WHEN date_diff('second', max(ingested_at), {FRESH_AS_OF}) > {w} * 3600 THEN 'warn'
                ELSE 'pass' END AS freshness_status
       FROM raw_{t}"""
    for t, (w, e) in [(t, (12, 24) if t == "gl_journal" else (26, 30)) for t in sorted(_RAW_DATA_TABLES)]
)


def _newest(led, tables):
    """The newest ingestion time of each feed, from footers, as a one-row frame that the checks read."""
    newest = footers.newest_times(led.spark, {t: led.raw(t) for t in tables}).persist()
    return {t: newest.filter(F.col("table_name") == t) for t in tables}


@register("source_freshness", q(_FRESH_SQL))
def source_freshness(spark, sf_dir):
    led = L(spark, sf_dir)
    return files.source_freshness(_newest(led, _RAW_DATA_TABLES), led.params.freshness_as_of)


@register(
    "gl_freshness_check",
    q(f"""SELECT max(ingested_at) AS max_ingested_at,
                 CAST(date_diff('second', max(ingested_at), {FRESH_AS_OF}) / 3600 AS DECIMAL(18,2)) AS age_hours,
                 CASE WHEN max(ingested_at) IS NULL THEN false
                      ELSE date_diff('second', max(ingested_at), {FRESH_AS_OF}) <= 30 * 3600 END AS passed,
                 CASE WHEN max(ingested_at) IS NULL THEN 'ERROR'
                      WHEN date_diff('second', max(ingested_at), {FRESH_AS_OF}) <= 30 * 3600 THEN 'PASS'
                      WHEN date_diff('second', max(ingested_at), {FRESH_AS_OF}) <= 48 * 3600 THEN 'WARN'
                      ELSE 'ERROR' END AS severity
          FROM raw_gl_journal"""),
)
def gl_freshness_check(spark, sf_dir):
    led = L(spark, sf_dir)
    return files.gl_freshness_check(_newest(led, ["gl_journal"])["gl_journal"], led.params.freshness_as_of)


@register(
    "conform_columns",
    q("""SELECT invoice_id, vendor_id, entity_id, invoice_date, posting_date, due_date, currency, amount_currency,
                amount_usd, fx_rate, expense_account_code, control_account_code, status,
                CAST(NULL AS VARCHAR) AS description, TIMESTAMP '2024-02-01 08:00:00' AS ingested_at
         FROM raw_ap_invoices"""),
)
def conform_columns(spark, sf_dir):
    """An extract with an unknown extra column and no description conforms to ap_invoices."""
    led = L(spark, sf_dir)
    src = led.raw("ap_invoices").drop("description", "ingested_at").withColumn("extra_col", F.lit(1))
    return files.conform_columns(src, "ap_invoices", led.params.recon_at)


# ------------------------------------------------------------------ staging
_STAGED = ["ap_invoices", "ap_payments", "ap_accruals", "ar_invoices", "ar_receipts", "ar_credit_memos",
           "inv_transactions"]

for _t in _STAGED:
    def _mk(t):
        def fn(spark, sf_dir):
            return L(spark, sf_dir).stg(t)

        return fn

    register(f"stg_{_t}", q(f"SELECT {', '.join(staging.STAGED_COLUMNS[_t])} FROM raw_{_t}"))(_mk(_t))


@register("stg_gl_journal", q("SELECT * FROM stg_gl"))
def stg_gl_journal(spark, sf_dir):
    return L(spark, sf_dir).stg_gl()


# ------------------------------------------------------------------ postings
@register("post_ap_invoices", q("SELECT * FROM post_ap_inv"))
def post_ap_invoices(spark, sf_dir):
    return postings.post_ap_invoices(L(spark, sf_dir).stg("ap_invoices"))


@register("post_ap_payments", q("SELECT * FROM post_ap_pay"))
def post_ap_payments(spark, sf_dir):
    return postings.post_ap_payments(L(spark, sf_dir).stg("ap_payments"))


@register("post_ar_invoices", q("SELECT * FROM post_ar_inv"))
def post_ar_invoices(spark, sf_dir):
    return postings.post_ar_invoices(L(spark, sf_dir).stg("ar_invoices"))


@register("post_ar_receipts", q("SELECT * FROM post_ar_rcp"))
def post_ar_receipts(spark, sf_dir):
    return postings.post_ar_receipts(L(spark, sf_dir).stg("ar_receipts"))


@register("resolve_inventory_accounts", q("SELECT * FROM inv_resolved"))
def resolve_inventory_accounts(spark, sf_dir):
    return postings.resolve_inventory_accounts(L(spark, sf_dir).stg("inv_transactions"))


@register("post_inventory", q("SELECT * FROM post_inv"))
def post_inventory(spark, sf_dir):
    return postings.post_inventory(postings.resolve_inventory_accounts(L(spark, sf_dir).stg("inv_transactions")))


@register("subledger_postings", q("SELECT * FROM postings"))
def subledger_postings(spark, sf_dir):
    return L(spark, sf_dir).postings()


@register("subledger_trial_balance", q("SELECT * FROM sl_tb"))
def subledger_trial_balance(spark, sf_dir):
    return L(spark, sf_dir).sl_tb()


@register("gl_trial_balance", q("SELECT * FROM gl_tb"))
def gl_trial_balance(spark, sf_dir):
    return L(spark, sf_dir).gl_tb()


_HIER_SQL = q(
    """SELECT account_code, account_name, account_type, parent_account_code, is_control_account, subledger_source,
              CAST(level AS INTEGER) AS level, root_code, path
       FROM walked""",
    """walked AS (
         WITH RECURSIVE w AS (
           SELECT account_code, account_name, account_type, parent_account_code, is_control_account,
                  subledger_source, 0 AS level, account_code AS root_code, CAST(account_code AS VARCHAR) AS path
           FROM raw_part_tree WHERE parent_account_code IS NULL
           UNION ALL
           SELECT c.account_code, c.account_name, c.account_type, c.parent_account_code, c.is_control_account,
                  c.subledger_source, p.level + 1, p.root_code, p.path || '/' || c.account_code
           FROM raw_part_tree c JOIN w p ON c.parent_account_code = p.account_code
         )
         SELECT * FROM w
       )""",
)


@register("account_hierarchy", _HIER_SQL)
def account_hierarchy(spark, sf_dir):
    """The walk over `part` as a deep tree (the 24-account chart is covered in tests)."""
    return balances.account_hierarchy(fixture(spark, sf_dir).part_tree())


# ------------------------------------------------------------------ GL building
_GL_FROM_SL = q(
    """SELECT 'GL-' || source_doc_id AS journal_id,
              CAST(CASE WHEN posting_role IN ('AP_INVOICE_EXPENSE', 'AP_PAYMENT_CONTROL', 'AR_INVOICE_CONTROL',
                                              'AR_RECEIPT_CASH') OR posting_role LIKE '%\\_DEBIT' ESCAPE '\\'
                        THEN 1 ELSE 2 END AS INTEGER) AS journal_line_id,
              entity_id, business_date, posting_date, account_code, debit_usd, credit_usd, currency, amount_currency,
              fx_rate, source_system, source_doc_id,
              CASE WHEN posting_role LIKE 'INV\\_%' ESCAPE '\\'
                     THEN 'INV ' || regexp_extract(posting_role, '^INV_(.*)_(DEBIT|CREDIT)$', 1) || ' '
                   WHEN posting_role LIKE 'AP_INVOICE%' THEN 'AP invoice '
                   WHEN posting_role LIKE 'AP_PAYMENT%' THEN 'AP payment '
                   WHEN posting_role LIKE 'AR_INVOICE%' THEN 'AR invoice '
                   WHEN posting_role LIKE 'AR_RECEIPT%' THEN 'AR receipt ' END || source_doc_id AS description,
              CASE source_system WHEN 'AP' THEN 'ap_subledger_feed' WHEN 'AR' THEN 'ar_subledger_feed'
                                 ELSE 'inv_subledger_feed' END AS created_by,
              TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
       FROM postings"""
)


@register("post_to_gl", _GL_FROM_SL)
def post_to_gl(spark, sf_dir):
    return postings.post_to_gl(L(spark, sf_dir).postings(), "2024-02-01 00:00:00")


@register(
    "order_journal",
    q("""SELECT business_date, journal_id, journal_line_id, debit_usd, credit_usd FROM stg_gl"""),
)
def order_journal(spark, sf_dir):
    return postings.order_journal(L(spark, sf_dir).stg_gl()).select(
        "business_date", "journal_id", "journal_line_id", "debit_usd", "credit_usd"
    )


@register(
    "fx_lookup",
    q("""SELECT d.invoice_id, d.invoice_date, d.currency, f.rate AS looked_up_rate
         FROM raw_ar_invoices d
         LEFT JOIN raw_fx_rate f ON f.rate_date = d.invoice_date AND f.from_currency = d.currency
                                AND f.to_currency = 'USD'"""),
)
def fx_lookup(spark, sf_dir):
    led = L(spark, sf_dir)
    docs = led.stg("ar_invoices").select("invoice_id", "invoice_date", "currency")
    return postings.fx_lookup(docs, led.stg("fx_rate"), "invoice_date")


@register(
    "to_usd",
    q("""SELECT invoice_id, amount_currency, fx_rate, CAST(amount_currency * fx_rate AS DECIMAL(18,2)) AS usd
         FROM raw_ap_invoices"""),
)
def to_usd(spark, sf_dir):
    from tieout.functions.columns import to_usd as _to_usd

    inv = L(spark, sf_dir).stg("ap_invoices")
    return inv.select("invoice_id", "amount_currency", "fx_rate", _to_usd(F.col("amount_currency"), F.col("fx_rate")).alias("usd"))


@register(
    "business_days",
    q("""SELECT CAST(d AS DATE) AS business_day
         FROM (SELECT unnest(generate_series((SELECT min(posting_date) FROM stg_gl),
                                             (SELECT max(posting_date) FROM stg_gl), INTERVAL 1 DAY)) AS d) t
         WHERE dayofweek(CAST(d AS DATE)) NOT IN (0, 6)"""),
)
def business_days(spark, sf_dir):
    from tieout.functions.calendar import business_days as _bd

    g = L(spark, sf_dir).stg_gl()
    bounds = g.agg(F.min("posting_date").alias("start"), F.max("posting_date").alias("end"))
    return _bd(bounds)


@register(
    "mint_ids",
    q("""SELECT o_orderkey, 'ORD-' || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 7 THEN CAST(o_orderkey AS VARCHAR)
                                      ELSE lpad(CAST(o_orderkey AS VARCHAR), 7, '0') END AS order_id
         FROM orders"""),
)
def mint_ids(spark, sf_dir):
    from tieout.functions.columns import mint_id

    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select("o_orderkey", mint_id("ORD", F.col("o_orderkey"), 7).alias("order_id"))


@register(
    "clamp_dates",
    q("""SELECT payment_id, least(payment_date, DATE '2001-06-30') AS clamped_date FROM raw_ap_payments"""),
)
def clamp_dates(spark, sf_dir):
    from tieout.functions.columns import clamp_date

    p = L(spark, sf_dir).stg("ap_payments")
    return p.select("payment_id", clamp_date(F.col("payment_date"), "2001-06-30").alias("clamped_date"))


# ------------------------------------------------------------------ marts
@register("match_transactions", q("SELECT * FROM matched"))
def match_transactions(spark, sf_dir):
    return L(spark, sf_dir).matched()


@register("recon_transaction_level", q("SELECT * FROM txn_level"))
def recon_transaction_level(spark, sf_dir):
    return L(spark, sf_dir).txn_level()


@register("recon_control_account", q("SELECT * FROM control"))
def recon_control_account(spark, sf_dir):
    return L(spark, sf_dir).control()


@register("recon_roll_forward", q("SELECT * FROM roll_fwd"))
def recon_roll_forward(spark, sf_dir):
    return L(spark, sf_dir).roll_forward()


@register("recon_variance_analysis", q("SELECT * FROM variance"))
def recon_variance_analysis(spark, sf_dir):
    return L(spark, sf_dir).variance()


@register("recon_aging", q("SELECT * FROM aging"))
def recon_aging(spark, sf_dir):
    return L(spark, sf_dir).aging()


@register("recon_fx_revaluation", q("SELECT * FROM fx_reval"))
def recon_fx_revaluation(spark, sf_dir):
    return L(spark, sf_dir).fx_reval()


@register("recon_suspense_monitor", q("SELECT * FROM suspense"))
def recon_suspense_monitor(spark, sf_dir):
    return L(spark, sf_dir).suspense()


@register("recon_manual_je_flag", q("SELECT * FROM manual_je"))
def recon_manual_je_flag(spark, sf_dir):
    return L(spark, sf_dir).manual_je()


@register("recon_summary", q("SELECT * FROM summary"))
def recon_summary(spark, sf_dir):
    return L(spark, sf_dir).summary()


_DUP_INV = """dup_src AS (
  SELECT invoice_id, vendor_id, invoice_date, status,
         CAST(100 + CAST(substr(invoice_id, 8) AS BIGINT) % 3 AS DECIMAL(18,2)) AS amount_usd
  FROM raw_ap_invoices
),
dups AS (
  SELECT vendor_id, invoice_date, amount_usd, CAST(count(*) AS BIGINT) AS duplicate_count,
         min(invoice_id) AS first_invoice_id, max(invoice_id) AS last_invoice_id,
         CASE WHEN count(*) > 2 THEN 'FAIL' ELSE 'WARN' END AS status
  FROM dup_src WHERE status NOT IN ('VOID', 'WRITTEN_OFF')
  GROUP BY vendor_id, invoice_date, amount_usd HAVING count(*) > 1
)"""


def _dup_source(spark, sf_dir):
    """AP invoices with amount 100 + k % 3, where duplicates exist (FIXTURES.md)."""
    inv = L(spark, sf_dir).stg("ap_invoices")
    k = F.substring("invoice_id", 8, 100).cast("bigint")
    return inv.withColumn("amount_usd", (F.lit(100) + k % 3).cast("decimal(18,2)"))


@register("recon_duplicate_invoices", q("SELECT * FROM dups", _DUP_INV))
def recon_duplicate_invoices(spark, sf_dir):
    return marts.recon_duplicate_invoices(_dup_source(spark, sf_dir))


@register(
    "summary_duplicate_invoices",
    q("""SELECT 'duplicate_invoices' AS check_name, max(invoice_date) AS as_of_date, CAST(0 AS BIGINT) AS pass_count,
                CAST(coalesce(sum(CASE WHEN status = 'WARN' THEN 1 ELSE 0 END), 0) AS BIGINT) AS warn_count,
                CAST(coalesce(sum(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END), 0) AS BIGINT) AS fail_count,
                CAST(coalesce(sum(amount_usd * (duplicate_count - 1)), 0) AS DECIMAL(38,2)) AS breaks_value_usd
         FROM dups""", _DUP_INV),
)
def summary_duplicate_invoices(spark, sf_dir):
    return marts.summary_duplicate_invoices(marts.recon_duplicate_invoices(_dup_source(spark, sf_dir)))


@register(
    "duplicate_invoice_members",
    q("""SELECT s.vendor_id, s.invoice_date, s.amount_usd, s.invoice_id, d.duplicate_count, d.status
         FROM dup_src s JOIN dups d USING (vendor_id, invoice_date, amount_usd) WHERE s.status NOT IN ('VOID', 'WRITTEN_OFF')""",
      _DUP_INV),
)
def duplicate_invoice_members(spark, sf_dir):
    src = _dup_source(spark, sf_dir)
    return marts.duplicate_invoice_members(src, marts.recon_duplicate_invoices(src))


# ------------------------------------------------------------------ file I/O (write, read back)
def _scratch(spark, label):
    import os
    import uuid

    from tieout.plans.session import ensure_checkpoint_dir

    return os.path.join(ensure_checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


_IO_TABLES = DATA_FEEDS


@register(
    "write_tables_csv",
    q(" UNION ALL ".join(
        [f"SELECT 'raw__{t}.csv' AS file_name, CAST(count(*) AS BIGINT) AS row_count FROM raw_{t}" for t in _IO_TABLES]
        + ["SELECT '_breaks_log.csv', CAST(count(*) AS BIGINT) FROM raw_breaks_log"]
    )),
)
def write_tables_csv(spark, sf_dir):
    """Export the feeds and the breaks log as CSV; row counts read back from the files."""
    import os

    led = L(spark, sf_dir)
    folder = _scratch(spark, "csv-export")
    files.write_tables_csv(
        {t: led.feed(t) for t in _IO_TABLES}, folder, fixture(spark, sf_dir).breaks_log(), compression="gzip")
    parts = []
    for name in [f"raw__{t}.csv" for t in _IO_TABLES] + ["_breaks_log.csv"]:
        back = spark.read.option("header", True).csv(os.path.join(folder, name))
        parts.append(back.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("file_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# the columns that every data feed shares
_SHARED = "entity_id, CAST(posting_date AS {date}) AS posting_date, ingested_at"


@register("scan_csv_dir", q(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(NULL AS VARCHAR) AS journal_id, CAST(NULL AS INTEGER) AS journal_line_id, "
        f"CAST(NULL AS DECIMAL(18,2)) AS debit_usd, CAST(NULL AS DECIMAL(18,2)) AS credit_usd, "
        f"{_SHARED.format(date='DATE')} FROM raw_{t}" for t in _IO_TABLES if t != "gl_journal")
    + f" UNION ALL SELECT 'gl_journal', journal_id, journal_line_id, debit_usd, credit_usd, "
      f"{_SHARED.format(date='DATE')} FROM raw_gl_journal"))
def scan_csv_dir(spark, sf_dir):
    """CSV round trip of all eight feeds: export, scan the folder back with declared types."""
    led = L(spark, sf_dir)
    folder = _scratch(spark, "csv-dir")
    files.write_tables_csv({t: led.feed(t) for t in _IO_TABLES}, folder, compression="gzip")
    back = files.scan_csv_dir(spark, folder)
    out = None
    for t in _IO_TABLES:
        gl_only = ["journal_id STRING", "journal_line_id INT", "debit_usd DECIMAL(18,2)", "credit_usd DECIMAL(18,2)"]
        part = back[t].select(
            F.lit(t).alias("table_name"),
            *[F.col(c.split()[0]) if t == "gl_journal" else F.lit(None).cast(c.split()[1]).alias(c.split()[0])
              for c in gl_only],
            "entity_id", "posting_date", "ingested_at",
        )
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "load_overwrite",
    q(" UNION ALL ".join(
        f"SELECT 'raw.{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM raw_{t}" for t in _IO_TABLES
    )),
)
def load_overwrite(spark, sf_dir):
    """Bulk load (overwrite) of the feeds into a raw warehouse; counts of what landed."""
    led = L(spark, sf_dir)
    wh = _scratch(spark, "raw-load")
    return files.load_overwrite(spark, {t: led.feed(t) for t in _IO_TABLES}, wh, led.params.recon_at)
