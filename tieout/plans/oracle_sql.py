"""DuckDB oracle SQL for every registered query (independent of the Spark code).

Each text is `WITH <fixture CTEs>, <pipeline CTEs> <query>`; the pipeline CTEs
restate the ledger's staging/intermediate/mart logic in plain SQL.
"""

from __future__ import annotations

from tieout.sources.fixture_sql import with_fixture

RECON_AT = "TIMESTAMP '2024-02-01 08:00:00'"
AS_OF = "DATE '2001-08-01'"
FRESH_AS_OF = "TIMESTAMP '2024-02-01 20:00:00'"

MATCH_TEMPLATE = """
{p}sl_side AS (
  SELECT *, row_number() OVER (PARTITION BY source_system, source_doc_id, account_code, direction
                               ORDER BY sl_posting_date, sl_amount_usd, posting_role, entity_id, business_date,
                                        currency) AS dup_seq
  FROM (SELECT source_system, source_doc_id, entity_id, business_date, posting_date AS sl_posting_date,
               account_code, currency, amount_usd AS sl_amount_usd, posting_role,
               CASE WHEN debit_usd > 0 THEN 'D' WHEN credit_usd > 0 THEN 'C' END AS direction
        FROM {postings}) s
),
{p}gl_side AS (
  SELECT *, row_number() OVER (PARTITION BY source_system, source_doc_id, account_code, direction
                               ORDER BY gl_posting_date, gl_amount_usd, journal_id, journal_line_id) AS dup_seq
  FROM (SELECT source_system, source_doc_id, entity_id, business_date, posting_date AS gl_posting_date,
               account_code, currency, CAST(debit_usd + credit_usd AS DECIMAL(18,2)) AS gl_amount_usd,
               journal_id, journal_line_id,
               CASE WHEN debit_usd > 0 THEN 'D' WHEN credit_usd > 0 THEN 'C' END AS direction
        FROM {stg_gl} WHERE source_system IN ('AP', 'AR', 'INV') AND source_doc_id IS NOT NULL) g
),
{p}matched AS (
  SELECT coalesce(sl.source_system, gl.source_system) AS source_system,
         coalesce(sl.source_doc_id, gl.source_doc_id) AS source_doc_id,
         coalesce(sl.account_code, gl.account_code) AS account_code,
         coalesce(sl.entity_id, gl.entity_id) AS entity_id,
         coalesce(sl.business_date, gl.business_date) AS business_date,
         coalesce(sl.currency, gl.currency) AS currency,
         sl.posting_role, sl.sl_posting_date, gl.gl_posting_date, sl.sl_amount_usd, gl.gl_amount_usd,
         gl.journal_id, gl.journal_line_id
  FROM {p}sl_side sl FULL OUTER JOIN {p}gl_side gl
    ON sl.source_system = gl.source_system AND sl.source_doc_id = gl.source_doc_id
   AND sl.account_code = gl.account_code AND sl.direction = gl.direction AND sl.dup_seq = gl.dup_seq
),
{p}txn_level AS (
  SELECT m.*,
         CAST(coalesce(m.sl_amount_usd, 0) - coalesce(m.gl_amount_usd, 0) AS DECIMAL(18,2)) AS amount_delta_usd,
         CAST(coalesce(m.gl_posting_date - m.sl_posting_date, 0) AS INTEGER) AS posting_lag_days,
         coalesce(ts.amount_tolerance_usd, td.amount_tolerance_usd) AS amount_tolerance_usd,
         coalesce(ts.timing_tolerance_days, td.timing_tolerance_days) AS timing_tolerance_days,
         CASE
           WHEN m.sl_amount_usd IS NOT NULL AND m.gl_amount_usd IS NULL THEN 'MISSING_GL_POSTING'
           WHEN m.sl_amount_usd IS NULL AND m.gl_amount_usd IS NOT NULL THEN 'MISSING_SL_POSTING'
           WHEN abs(coalesce(m.sl_amount_usd, 0) - coalesce(m.gl_amount_usd, 0))
                  > coalesce(ts.amount_tolerance_usd, td.amount_tolerance_usd)
            AND abs(coalesce(m.sl_amount_usd, 0) - coalesce(m.gl_amount_usd, 0)) < 0.10
            AND m.currency <> 'USD' THEN 'FX_ROUNDING'
           WHEN abs(coalesce(m.sl_amount_usd, 0) - coalesce(m.gl_amount_usd, 0))
                  > coalesce(ts.amount_tolerance_usd, td.amount_tolerance_usd) THEN 'AMOUNT_MISMATCH'
           WHEN abs(m.gl_posting_date - m.sl_posting_date)
                  > coalesce(ts.timing_tolerance_days, td.timing_tolerance_days) THEN 'TIMING_DIFF'
           ELSE 'UNKNOWN' END AS break_class,
         CASE WHEN abs(coalesce(m.sl_amount_usd, 0) - coalesce(m.gl_amount_usd, 0))
                     <= coalesce(ts.amount_tolerance_usd, td.amount_tolerance_usd)
               AND abs(coalesce(m.gl_posting_date - m.sl_posting_date, 0))
                     <= coalesce(ts.timing_tolerance_days, td.timing_tolerance_days)
               AND m.sl_amount_usd IS NOT NULL AND m.gl_amount_usd IS NOT NULL
              THEN 'MATCHED' ELSE 'BREAK' END AS status,
         TIMESTAMP '2024-02-01 08:00:00' AS recon_at
  FROM {p}matched m
  LEFT JOIN raw_tolerance_rules ts ON ts.account_code = m.account_code AND ts.account_code <> 'DEFAULT'
  CROSS JOIN tol_default td
)
"""


def match_ctes(prefix: str = "", postings: str = "postings", stg_gl: str = "stg_gl") -> str:
    """sl_side -> gl_side -> matched -> txn_level over the given sources, CTE names prefixed."""
    return MATCH_TEMPLATE.format(p=prefix, postings=postings, stg_gl=stg_gl)


PIPELINE_CTES = f"""
tol_default AS (SELECT * FROM raw_tolerance_rules WHERE account_code = 'DEFAULT'),
mat_default AS (SELECT * FROM raw_materiality WHERE account_code = 'DEFAULT'),
stg_gl AS (
  SELECT journal_id, journal_line_id, entity_id, business_date, posting_date, account_code, debit_usd, credit_usd,
         CAST(debit_usd - credit_usd AS DECIMAL(18,2)) AS net_amount_usd, currency, amount_currency, fx_rate,
         source_system, source_doc_id, description, created_by, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY journal_id, journal_line_id
                                     ORDER BY ingested_at DESC, debit_usd DESC, credit_usd DESC,
                                              posting_date DESC, account_code, entity_id, business_date, currency,
                                              amount_currency, fx_rate, source_system, source_doc_id,
                                              description, created_by) AS rn
        FROM raw_gl_journal) r
  WHERE rn = 1
),
post_ap_inv AS (
  SELECT 'AP' AS source_system, invoice_id AS source_doc_id, entity_id, invoice_date AS business_date, posting_date,
         currency, amount_currency, amount_usd, fx_rate, expense_account_code AS account_code,
         amount_usd AS debit_usd, CAST(0 AS DECIMAL(18,2)) AS credit_usd, 'AP_INVOICE_EXPENSE' AS posting_role
  FROM raw_ap_invoices
  UNION ALL
  SELECT 'AP', invoice_id, entity_id, invoice_date, posting_date, currency, amount_currency, amount_usd, fx_rate,
         control_account_code, CAST(0 AS DECIMAL(18,2)), amount_usd, 'AP_INVOICE_CONTROL'
  FROM raw_ap_invoices
),
post_ap_pay AS (
  SELECT 'AP' AS source_system, payment_id AS source_doc_id, entity_id, payment_date AS business_date, posting_date,
         currency, amount_currency, amount_usd, fx_rate, control_account_code AS account_code,
         amount_usd AS debit_usd, CAST(0 AS DECIMAL(18,2)) AS credit_usd, 'AP_PAYMENT_CONTROL' AS posting_role
  FROM raw_ap_payments
  UNION ALL
  SELECT 'AP', payment_id, entity_id, payment_date, posting_date, currency, amount_currency, amount_usd, fx_rate,
         cash_account_code, CAST(0 AS DECIMAL(18,2)), amount_usd, 'AP_PAYMENT_CASH'
  FROM raw_ap_payments
),
post_ar_inv AS (
  SELECT 'AR' AS source_system, invoice_id AS source_doc_id, entity_id, invoice_date AS business_date, posting_date,
         currency, amount_currency, amount_usd, fx_rate, control_account_code AS account_code,
         amount_usd AS debit_usd, CAST(0 AS DECIMAL(18,2)) AS credit_usd, 'AR_INVOICE_CONTROL' AS posting_role
  FROM raw_ar_invoices
  UNION ALL
  SELECT 'AR', invoice_id, entity_id, invoice_date, posting_date, currency, amount_currency, amount_usd, fx_rate,
         revenue_account_code, CAST(0 AS DECIMAL(18,2)), amount_usd, 'AR_INVOICE_REVENUE'
  FROM raw_ar_invoices
),
post_ar_rcp AS (
  SELECT 'AR' AS source_system, receipt_id AS source_doc_id, entity_id, receipt_date AS business_date, posting_date,
         currency, amount_currency, amount_usd, fx_rate, cash_account_code AS account_code,
         amount_usd AS debit_usd, CAST(0 AS DECIMAL(18,2)) AS credit_usd, 'AR_RECEIPT_CASH' AS posting_role
  FROM raw_ar_receipts
  UNION ALL
  SELECT 'AR', receipt_id, entity_id, receipt_date, posting_date, currency, amount_currency, amount_usd, fx_rate,
         control_account_code, CAST(0 AS DECIMAL(18,2)), amount_usd, 'AR_RECEIPT_CONTROL'
  FROM raw_ar_receipts
),
inv_resolved AS (
  SELECT txn_id, entity_id, txn_date, posting_date, txn_type, CAST(abs(amount_usd) AS DECIMAL(18,2)) AS amount_abs_usd,
         CASE WHEN txn_type IN ('RECEIPT', 'COGS') OR (txn_type = 'ADJUSTMENT' AND amount_usd >= 0)
              THEN inventory_account_code ELSE offset_account_code END AS debit_account_code,
         CASE WHEN txn_type IN ('RECEIPT', 'COGS') OR (txn_type = 'ADJUSTMENT' AND amount_usd >= 0)
              THEN offset_account_code ELSE inventory_account_code END AS credit_account_code
  FROM raw_inv_transactions
),
post_inv AS (
  SELECT 'INV' AS source_system, txn_id AS source_doc_id, entity_id, txn_date AS business_date, posting_date,
         'USD' AS currency, amount_abs_usd AS amount_currency, amount_abs_usd AS amount_usd,
         CAST(1 AS DECIMAL(18,8)) AS fx_rate, debit_account_code AS account_code, amount_abs_usd AS debit_usd,
         CAST(0 AS DECIMAL(18,2)) AS credit_usd, 'INV_' || txn_type || '_DEBIT' AS posting_role
  FROM inv_resolved
  UNION ALL
  SELECT 'INV', txn_id, entity_id, txn_date, posting_date, 'USD', amount_abs_usd, amount_abs_usd,
         CAST(1 AS DECIMAL(18,8)), credit_account_code, CAST(0 AS DECIMAL(18,2)), amount_abs_usd,
         'INV_' || txn_type || '_CREDIT'
  FROM inv_resolved
),
postings AS (
  SELECT * FROM post_ap_inv UNION ALL SELECT * FROM post_ap_pay UNION ALL SELECT * FROM post_ar_inv
  UNION ALL SELECT * FROM post_ar_rcp UNION ALL SELECT * FROM post_inv
),
sl_daily AS (
  SELECT entity_id, account_code, posting_date,
         CAST(sum(debit_usd) AS DECIMAL(38,2)) AS daily_debits_usd,
         CAST(sum(credit_usd) AS DECIMAL(38,2)) AS daily_credits_usd,
         CAST(sum(credit_usd - debit_usd) AS DECIMAL(38,2)) AS daily_net_usd
  FROM postings GROUP BY entity_id, account_code, posting_date
),
sl_tb AS (
  SELECT *, CAST(sum(daily_net_usd) OVER (PARTITION BY entity_id, account_code ORDER BY posting_date
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2))
            AS running_balance_usd
  FROM sl_daily
),
gl_daily AS (
  SELECT entity_id, account_code, posting_date,
         CAST(sum(debit_usd) AS DECIMAL(38,2)) AS daily_debits_usd,
         CAST(sum(credit_usd) AS DECIMAL(38,2)) AS daily_credits_usd,
         CAST(sum(credit_usd - debit_usd) AS DECIMAL(38,2)) AS daily_net_usd
  FROM stg_gl GROUP BY entity_id, account_code, posting_date
),
gl_tb AS (
  SELECT *, CAST(sum(daily_net_usd) OVER (PARTITION BY entity_id, account_code ORDER BY posting_date
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2))
            AS running_balance_usd
  FROM gl_daily
),
""" + match_ctes() + f""",
control_joined AS (
  SELECT coalesce(sl.entity_id, gl.entity_id) AS entity_id,
         coalesce(sl.account_code, gl.account_code) AS account_code,
         coalesce(sl.posting_date, gl.posting_date) AS posting_date,
         coalesce(sl.daily_net_usd, 0) AS sl_daily_net_usd, coalesce(gl.daily_net_usd, 0) AS gl_daily_net_usd,
         coalesce(sl.running_balance_usd, 0) AS sl_balance_usd, coalesce(gl.running_balance_usd, 0) AS gl_balance_usd
  FROM (SELECT * FROM sl_tb WHERE account_code IN (SELECT account_code FROM raw_dim_account WHERE is_control_account)) sl
  FULL OUTER JOIN
       (SELECT * FROM gl_tb WHERE account_code IN (SELECT account_code FROM raw_dim_account WHERE is_control_account)) gl
    ON sl.entity_id = gl.entity_id AND sl.account_code = gl.account_code AND sl.posting_date = gl.posting_date
),
control AS (
  SELECT j.entity_id, j.account_code, j.posting_date,
         CAST(j.sl_daily_net_usd AS DECIMAL(38,2)) AS sl_daily_net_usd,
         CAST(j.gl_daily_net_usd AS DECIMAL(38,2)) AS gl_daily_net_usd,
         CAST(j.sl_balance_usd AS DECIMAL(38,2)) AS sl_balance_usd,
         CAST(j.gl_balance_usd AS DECIMAL(38,2)) AS gl_balance_usd,
         CAST(j.sl_balance_usd - j.gl_balance_usd AS DECIMAL(18,2)) AS variance_usd,
         coalesce(ts.amount_tolerance_usd, td.amount_tolerance_usd) AS amount_tolerance_usd,
         coalesce(m.materiality_usd, md.materiality_usd) AS materiality_usd,
         coalesce(m.severity, md.severity) AS severity,
         CASE WHEN abs(j.sl_balance_usd - j.gl_balance_usd) <= coalesce(ts.amount_tolerance_usd, td.amount_tolerance_usd)
                THEN 'PASS'
              WHEN abs(j.sl_balance_usd - j.gl_balance_usd) >= coalesce(m.materiality_usd, md.materiality_usd)
                THEN 'FAIL'
              ELSE 'WARN' END AS status
  FROM control_joined j
  LEFT JOIN raw_tolerance_rules ts ON ts.account_code = j.account_code AND ts.account_code <> 'DEFAULT'
  CROSS JOIN tol_default td
  LEFT JOIN raw_materiality m ON m.account_code = j.account_code AND m.account_code <> 'DEFAULT'
  CROSS JOIN mat_default md
),
roll_fwd AS (
  SELECT ledger, entity_id, account_code, posting_date,
         CAST(coalesce(prior, 0) AS DECIMAL(38,2)) AS opening_balance_usd,
         daily_net_usd AS activity_usd, running_balance_usd AS closing_balance_usd,
         CAST(running_balance_usd - coalesce(prior, 0) - daily_net_usd AS DECIMAL(18,2)) AS roll_forward_variance_usd,
         CASE WHEN abs(running_balance_usd - coalesce(prior, 0) - daily_net_usd) <= 0.01 THEN 'PASS' ELSE 'FAIL' END
           AS status
  FROM (
    SELECT 'SUBLEDGER' AS ledger, *, lag(running_balance_usd) OVER (PARTITION BY entity_id, account_code
                                                                     ORDER BY posting_date) AS prior
    FROM sl_tb
    UNION ALL
    SELECT 'GL', *, lag(running_balance_usd) OVER (PARTITION BY entity_id, account_code ORDER BY posting_date)
    FROM gl_tb
  ) u
),
summary AS (
  SELECT 'control_account' AS check_name, max(posting_date) AS as_of_date,
         CAST(sum(CASE WHEN status = 'PASS' THEN 1 ELSE 0 END) AS BIGINT) AS pass_count,
         CAST(sum(CASE WHEN status = 'WARN' THEN 1 ELSE 0 END) AS BIGINT) AS warn_count,
         CAST(sum(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) AS BIGINT) AS fail_count,
         CAST(sum(CASE WHEN status <> 'PASS' THEN abs(variance_usd) ELSE 0 END) AS DECIMAL(38,2)) AS breaks_value_usd
  FROM control
  UNION ALL
  SELECT 'transaction_level', max(coalesce(business_date, DATE '1900-01-01')),
         CAST(sum(CASE WHEN status = 'MATCHED' THEN 1 ELSE 0 END) AS BIGINT), CAST(0 AS BIGINT),
         CAST(sum(CASE WHEN status = 'BREAK' THEN 1 ELSE 0 END) AS BIGINT),
         CAST(sum(CASE WHEN status = 'BREAK' THEN abs(amount_delta_usd) ELSE 0 END) AS DECIMAL(38,2))
  FROM txn_level
  UNION ALL
  SELECT 'roll_forward', max(posting_date),
         CAST(sum(CASE WHEN status = 'PASS' THEN 1 ELSE 0 END) AS BIGINT), CAST(0 AS BIGINT),
         CAST(sum(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) AS BIGINT),
         CAST(sum(CASE WHEN status = 'FAIL' THEN abs(roll_forward_variance_usd) ELSE 0 END) AS DECIMAL(38,2))
  FROM roll_fwd
  UNION ALL
  SELECT 'duplicate_invoices', max(invoice_date), CAST(0 AS BIGINT), CAST(count(*) FILTER (WHERE n = 2) AS BIGINT),
         CAST(count(*) FILTER (WHERE n > 2) AS BIGINT), CAST(coalesce(sum(amount_usd * (n - 1)), 0) AS DECIMAL(38,2))
  FROM (SELECT vendor_id, invoice_date, amount_usd, count(*) AS n FROM raw_ap_invoices
        WHERE status NOT IN ('VOID', 'WRITTEN_OFF') GROUP BY ALL HAVING count(*) > 1) d
),
aging AS (
  SELECT *,
         CASE WHEN age_days <= 1 THEN '0-1d' WHEN age_days <= 7 THEN '2-7d' WHEN age_days <= 30 THEN '8-30d'
              ELSE '30+d' END AS age_bucket,
         CASE WHEN age_days > 30 THEN 'CRITICAL' WHEN age_days > 7 THEN 'HIGH' WHEN age_days > 1 THEN 'MEDIUM'
              ELSE 'LOW' END AS triage_priority
  FROM (SELECT *, CAST({AS_OF} - coalesce(business_date, sl_posting_date, gl_posting_date) AS INTEGER) AS age_days
        FROM txn_level WHERE status = 'BREAK') b
),
variance AS (
  SELECT c.posting_date, c.entity_id, e.entity_code, e.functional_currency, c.account_code, a.account_name,
         a.account_type, c.sl_balance_usd, c.gl_balance_usd, c.variance_usd,
         CAST(abs(c.variance_usd) AS DECIMAL(18,2)) AS abs_variance_usd, c.materiality_usd, c.severity,
         coalesce(abs(c.variance_usd) >= c.materiality_usd, false) AS is_material,
         c.status,
         CAST(rank() OVER (PARTITION BY c.posting_date ORDER BY abs(c.variance_usd) DESC) AS BIGINT)
           AS variance_rank_in_day
  FROM control c
  LEFT JOIN raw_dim_entity e ON e.entity_id = c.entity_id
  LEFT JOIN raw_dim_account a ON a.account_code = c.account_code
  WHERE c.status <> 'PASS'
),
foreign_lines AS (
  SELECT g.*, g.debit_usd + g.credit_usd AS booked, r.rate, g.amount_currency * r.rate AS at_rate
  FROM (SELECT * FROM stg_gl WHERE currency <> 'USD') g
  LEFT JOIN (SELECT * FROM raw_fx_rate WHERE to_currency = 'USD') r
    ON r.rate_date = g.posting_date AND r.from_currency = g.currency
),
fx_reval AS (
  SELECT entity_id, posting_date, account_code, currency, amount_currency, fx_rate AS posted_fx_rate,
         rate AS eod_fx_rate, CAST(booked AS DECIMAL(18,2)) AS actual_amount_usd,
         CAST(at_rate AS DECIMAL(38,10)) AS recomputed_amount_usd,
         CAST(at_rate - booked AS DECIMAL(18,2)) AS fx_variance_usd,
         CASE WHEN at_rate IS NULL OR abs(at_rate - booked) > 5.00 THEN 'FAIL'
              WHEN abs(at_rate - booked) > 0.05 THEN 'WARN' ELSE 'PASS' END AS status
  FROM foreign_lines
),
suspense AS (
  SELECT entity_id, account_code, posting_date, daily_debits_usd, daily_credits_usd,
         running_balance_usd AS suspense_balance_usd,
         CASE WHEN running_balance_usd = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM gl_tb WHERE account_code LIKE '9%'
),
manual_je AS (
  SELECT m.journal_id, m.journal_line_id, m.entity_id, m.business_date, m.posting_date, m.account_code,
         a.account_name, a.is_control_account, CAST(m.debit_usd + m.credit_usd AS DECIMAL(18,2)) AS amount_usd,
         m.created_by, m.description, 'FAIL' AS status
  FROM stg_gl m JOIN raw_dim_account a USING (account_code)
  WHERE m.source_system = 'MANUAL' AND a.is_control_account
),
chart_hierarchy AS (
  WITH RECURSIVE w AS (
    SELECT account_code, account_name, account_type, parent_account_code, is_control_account,
           subledger_source, 0 AS level, account_code AS root_code, CAST(account_code AS VARCHAR) AS path
    FROM raw_dim_account WHERE parent_account_code IS NULL
    UNION ALL
    SELECT c.account_code, c.account_name, c.account_type, c.parent_account_code, c.is_control_account,
           c.subledger_source, p.level + 1, p.root_code, p.path || '/' || c.account_code
    FROM raw_dim_account c JOIN w p ON c.parent_account_code = p.account_code
  )
  SELECT * FROM w
)
"""


def q(body: str, extra: str = "") -> str:
    ctes = PIPELINE_CTES.strip()
    if extra.strip():
        ctes = ctes + ",\n" + extra.strip().rstrip(",")
    return with_fixture(body, ctes)
