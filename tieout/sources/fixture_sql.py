"""The fixture mapping as DuckDB CTE text, for the oracle SQL.

Mirrors `tieout.sources.fixtures` (FIXTURES.md section 2) over the driver's
pre-registered views. Every oracle query is ``WITH <these CTEs>, <its own
CTEs> SELECT ...``; the CTE names are the raw ledger tables prefixed `raw_`.
"""

from __future__ import annotations

from tieout.sources import reference_data as R
from tieout.sources.fixtures import REPEAT_STEP


def _pad(expr: str, width: int = 9) -> str:
    return f"(CASE WHEN length(CAST({expr} AS VARCHAR)) >= {width} THEN CAST({expr} AS VARCHAR) " \
           f"ELSE lpad(CAST({expr} AS VARCHAR), {width}, '0') END)"


def _pick(index: str, values: list[str], base: int = 0) -> str:
    arms = " ".join(f"WHEN {index} = {i + base} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {arms} END)"


def _entities_values() -> str:
    return ", ".join(
        f"({i}, '{c}', '{n}', '{cur}', '{co}', TIMESTAMP '2024-02-01 00:00:00')" for i, c, n, cur, co in R.ENTITIES
    )


def _accounts_values() -> str:
    rows = []
    for i, (code, name, typ, parent, ctl, sub) in enumerate(R.CHART_OF_ACCOUNTS):
        par = f"'{parent}'" if parent else "CAST(NULL AS VARCHAR)"
        sb = f"'{sub}'" if sub else "CAST(NULL AS VARCHAR)"
        rows.append(
            f"({i + 1}, '{code}', '{name}', '{typ}', {par}, {'true' if ctl else 'false'}, {sb}, "
            f"DATE '{R.ACCOUNTS_EFFECTIVE_FROM.isoformat()}', CAST(NULL AS DATE), TIMESTAMP '2024-02-01 00:00:00')"
        )
    return ", ".join(rows)


AR_REV = ["4000", "4100", "4200"]
AP_EXP = ["6000", "6100", "6200", "6300", "6400", "6500", "6600", "6900"]

FIXTURE_CTES = f"""
raw_dim_entity (entity_id, entity_code, entity_name, functional_currency, country, ingested_at) AS (
  SELECT CAST(col0 AS INTEGER), col1, col2, col3, col4, col5 FROM (VALUES {_entities_values()})
),
raw_dim_account (account_id, account_code, account_name, account_type, parent_account_code,
                 is_control_account, subledger_source, effective_from, effective_to, ingested_at) AS (
  SELECT CAST(col0 AS INTEGER), col1, col2, col3, col4, col5, col6, col7, col8, col9
  FROM (VALUES {_accounts_values()})
),
fx_days AS (
  SELECT CAST(d AS DATE) AS rate_date
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2002-01-31', INTERVAL 1 DAY)) AS d)
),
raw_fx_rate AS (
  SELECT rate_date, c.from_currency, 'USD' AS to_currency,
         CAST(CASE WHEN c.from_currency = 'USD' THEN 1
                   WHEN c.from_currency = 'EUR' THEN 1.08 + 0.001 * (dayofyear(rate_date) % 7)
                   ELSE 0.012 + 0.00001 * (dayofyear(rate_date) % 7) END AS DECIMAL(18,8)) AS rate,
         TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM fx_days CROSS JOIN (VALUES ('USD'), ('EUR'), ('INR')) AS c(from_currency)
  WHERE NOT (c.from_currency = 'INR' AND dayofyear(rate_date) = 100)
),
od AS (
  SELECT o.o_orderkey AS k, CAST(c.c_nationkey % 3 + 1 AS INTEGER) AS entity_id,
         CAST(o.o_orderdate AS DATE) AS dt, o.o_orderstatus AS st,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS px, o.o_custkey AS party
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
li_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                        l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem
),
li AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber + (l.rn - 1) * {REPEAT_STEP} AS k, CAST(s.s_nationkey % 3 + 1 AS INTEGER) AS entity_id,
         CAST(l.l_shipdate AS DATE) AS dt, l.l_returnflag AS rf, l.l_linestatus AS ls,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS px, l.l_suppkey AS party, l.l_partkey AS item,
         l.l_quantity AS q, l.l_extendedprice AS xp
  FROM li_ranked l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
docs0 AS (
  SELECT k, entity_id, 'AR-INV' AS feed, 'AR' AS system, dt AS doc_date, dt + CAST(15 + k % 45 AS INTEGER) AS due_date,
         px AS amount, '1200' AS debit_account, {_pick('k % 3', AR_REV)} AS credit_account,
         CASE st WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'PAID' WHEN 'P' THEN 'WRITTEN_OFF' END AS status,
         CAST(NULL AS VARCHAR) AS method, CAST(NULL AS VARCHAR) AS ref_id, CAST(NULL AS VARCHAR) AS reason,
         'CUST-' || {_pad('party', 7)} AS party, CAST(NULL AS VARCHAR) AS txn_type,
         CAST(NULL AS DECIMAL(18,4)) AS quantity, CAST(NULL AS DECIMAL(18,4)) AS unit_cost,
         CAST(NULL AS VARCHAR) AS inv_account, CAST(NULL AS VARCHAR) AS off_account
  FROM od
  UNION ALL
  SELECT k, entity_id, 'AR-RCP', 'AR', dt + CAST(5 + k % 45 AS INTEGER), NULL, px, '1000', '1200', NULL,
         {_pick('k % 4', R.PAYMENT_METHODS)}, 'AR-INV-' || {_pad('k')}, NULL, 'CUST-' || {_pad('party', 7)},
         NULL, NULL, NULL, NULL, NULL
  FROM od WHERE st = 'F'
  UNION ALL
  SELECT k, entity_id, 'AP-ACC', 'AP', dt, dt + CAST(15 + k % 20 AS INTEGER), px, {_pick('k % 8', AP_EXP)}, '2000',
         NULL, NULL, NULL, NULL, 'CUST-' || {_pad('party', 7)}, NULL, NULL, NULL, NULL, NULL
  FROM od WHERE k % 30 = 0
  UNION ALL
  SELECT k, entity_id, 'AR-CM', 'AR', dt + CAST(1 + k % 29 AS INTEGER), NULL, CAST(px * 0.50 AS DECIMAL(18,2)),
         {_pick('k % 3', AR_REV)}, '1200', NULL, NULL, 'AR-INV-' || {_pad('k')},
         {_pick('k % 3', R.CREDIT_MEMO_REASONS)}, 'CUST-' || {_pad('party', 7)}, NULL, NULL, NULL, NULL, NULL
  FROM od WHERE k % 50 = 1
  UNION ALL
  SELECT k, entity_id, 'AP-INV', 'AP', dt, dt + CAST(15 + k % 45 AS INTEGER), px, {_pick('k % 8', AP_EXP)}, '2000',
         CASE ls WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'OPEN' END, NULL, NULL, NULL, 'VEND-' || {_pad('party', 7)},
         NULL, NULL, NULL, NULL, NULL
  FROM li WHERE rf = 'N'
  UNION ALL
  SELECT k, entity_id, 'AP-PAY', 'AP', dt + CAST(5 + k % 40 AS INTEGER), NULL, px, '2000', '1000', NULL,
         {_pick('k % 4', R.PAYMENT_METHODS)}, 'AP-INV-' || {_pad('k')}, NULL, 'VEND-' || {_pad('party', 7)},
         NULL, NULL, NULL, NULL, NULL
  FROM li WHERE rf = 'N' AND ls = 'F'
  UNION ALL
  SELECT k, entity_id, 'INV', 'INV', dt, NULL,
         CASE WHEN rf = 'R' AND ls = 'F' THEN -amt ELSE amt END,
         CASE WHEN rf = 'R' AND ls = 'F' THEN off_col ELSE inv_col END,
         CASE WHEN rf = 'R' AND ls = 'F' THEN inv_col ELSE off_col END,
         NULL, NULL, 'ITEM-' || {_pad('item', 7)}, NULL, 'VEND-' || {_pad('party', 7)},
         CASE WHEN rf = 'A' AND ls = 'F' THEN 'COGS' WHEN rf = 'A' THEN 'RECEIPT' ELSE 'ADJUSTMENT' END,
         CAST(q AS DECIMAL(18,4)),
         CAST(CAST(CASE WHEN qn > 0 THEN cents // qn ELSE 0 END AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,4)),
         inv_col, off_col
  FROM (
    SELECT *, CASE WHEN k % 2000 = 4 THEN CAST(0 AS DECIMAL(18,2)) ELSE px END AS amt,
           CASE WHEN rf = 'A' AND ls = 'F' THEN '5000' ELSE '1300' END AS inv_col,
           CASE WHEN rf = 'A' AND ls = 'F' THEN '1300' WHEN rf = 'A' THEN '2000' ELSE '6900' END AS off_col,
           CAST(round(xp * 100) AS BIGINT) AS cents, CAST(q AS BIGINT) AS qn
    FROM li WHERE rf IN ('A', 'R')
  ) t
),
docs1 AS (
  SELECT d.*,
         CASE WHEN system = 'INV' THEN 'USD'
              WHEN k % 5 <> 0 THEN {_pick('entity_id', R.CURRENCIES, 1)}
              ELSE {_pick('(k // 5) % 3', R.CURRENCIES)} END AS currency
  FROM docs0 d
),
docs AS (
  SELECT d.*, CAST(CASE WHEN d.system = 'INV' THEN 1 ELSE coalesce(f.rate, 0.012) END AS DECIMAL(18,8)) AS fx_rate,
         CAST(d.amount * CAST(CASE WHEN d.system = 'INV' THEN 1 ELSE coalesce(f.rate, 0.012) END AS DECIMAL(18,8))
              AS DECIMAL(18,2)) AS amount_usd,
         d.feed || '-' || {_pad('d.k')} AS doc_id
  FROM docs1 d LEFT JOIN raw_fx_rate f ON f.rate_date = d.doc_date AND f.from_currency = d.currency
),
sl_docs AS (SELECT * FROM docs WHERE k % 1000 <> 9),
raw_ap_invoices AS (
  SELECT doc_id AS invoice_id, party AS vendor_id, entity_id, doc_date AS invoice_date, doc_date AS posting_date,
         due_date, currency, amount AS amount_currency, amount_usd, fx_rate,
         debit_account AS expense_account_code, credit_account AS control_account_code, status,
         'Vendor invoice ' || doc_id AS description, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM sl_docs WHERE feed = 'AP-INV'
),
raw_ap_payments AS (
  SELECT doc_id AS payment_id, ref_id AS invoice_id, entity_id, doc_date AS payment_date, doc_date AS posting_date,
         currency, amount AS amount_currency, amount_usd, fx_rate, credit_account AS cash_account_code,
         debit_account AS control_account_code, method, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM sl_docs WHERE feed = 'AP-PAY'
),
raw_ap_accruals AS (
  SELECT doc_id AS accrual_id, entity_id, doc_date AS accrual_date, doc_date AS posting_date,
         due_date AS reversal_date, currency, amount AS amount_currency, amount_usd, fx_rate,
         debit_account AS expense_account_code, credit_account AS control_account_code,
         'Month-end accrual' AS description, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM sl_docs WHERE feed = 'AP-ACC'
),
raw_ar_invoices AS (
  SELECT doc_id AS invoice_id, party AS customer_id, entity_id, doc_date AS invoice_date, doc_date AS posting_date,
         due_date, currency, amount AS amount_currency, amount_usd, fx_rate,
         credit_account AS revenue_account_code, debit_account AS control_account_code, status,
         'Customer invoice ' || doc_id AS description, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM sl_docs WHERE feed = 'AR-INV'
),
raw_ar_receipts AS (
  SELECT doc_id AS receipt_id, ref_id AS invoice_id, entity_id, doc_date AS receipt_date, doc_date AS posting_date,
         currency, amount AS amount_currency, amount_usd, fx_rate, debit_account AS cash_account_code,
         credit_account AS control_account_code, method, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM sl_docs WHERE feed = 'AR-RCP'
),
raw_ar_credit_memos AS (
  SELECT doc_id AS memo_id, ref_id AS invoice_id, entity_id, doc_date AS memo_date, doc_date AS posting_date,
         currency, amount AS amount_currency, amount_usd, fx_rate, reason,
         debit_account AS revenue_account_code, credit_account AS control_account_code,
         TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM sl_docs WHERE feed = 'AR-CM'
),
raw_inv_transactions AS (
  SELECT doc_id AS txn_id, ref_id AS item_id, entity_id, doc_date AS txn_date, doc_date AS posting_date, txn_type,
         quantity, unit_cost AS unit_cost_usd, amount AS amount_usd, inv_account AS inventory_account_code,
         off_account AS offset_account_code, 'INV ' || txn_type || ' ' || doc_id AS description,
         TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM sl_docs WHERE feed = 'INV'
),
posted_docs AS (SELECT * FROM docs WHERE feed IN ('AP-INV', 'AP-PAY', 'AR-INV', 'AR-RCP', 'INV')),
gl_live AS (
  SELECT 'GL-' || doc_id AS journal_id, CAST(ln AS INTEGER) AS journal_line_id, entity_id,
         doc_date AS business_date,
         doc_date + CAST(CASE WHEN k % 50 = 7 AND ln = (k // 50) % 2 + 1
                              THEN CASE WHEN (k // 50) % 10 < 3 THEN 2 ELSE 1 END ELSE 0 END AS INTEGER) AS posting_date,
         CASE WHEN ln = 1 THEN debit_account ELSE credit_account END AS account_code,
         CASE WHEN ln = 1 THEN val ELSE CAST(0 AS DECIMAL(18,2)) END AS debit_usd,
         CASE WHEN ln = 2 THEN val ELSE CAST(0 AS DECIMAL(18,2)) END AS credit_usd,
         currency,
         CAST(CASE WHEN system = 'INV' THEN abs(amount) ELSE amount END AS DECIMAL(18,2)) AS amount_currency,
         fx_rate, system AS source_system, doc_id AS source_doc_id,
         CASE feed WHEN 'AP-INV' THEN 'AP invoice ' || doc_id WHEN 'AP-PAY' THEN 'AP payment ' || doc_id
                   WHEN 'AR-INV' THEN 'AR invoice ' || doc_id WHEN 'AR-RCP' THEN 'AR receipt ' || doc_id
                   ELSE 'INV ' || txn_type || ' ' || doc_id END AS description,
         CASE system WHEN 'AP' THEN 'ap_subledger_feed' WHEN 'AR' THEN 'ar_subledger_feed'
                     ELSE 'inv_subledger_feed' END AS created_by,
         TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, k
  FROM (
    SELECT p.*, l.ln,
           CAST(abs(p.amount_usd)
                + CASE WHEN p.k % 200 = 21 AND l.ln = (p.k // 200) % 2 + 1
                       THEN 0.01 * CAST((p.k // 200) % 50 + 1 AS DECIMAL(10,0)) ELSE 0 END
                + CASE WHEN p.currency <> 'USD' AND p.k % 100 = 63 AND l.ln = (p.k // 100) % 2 + 1
                       THEN 0.01 * CAST((p.k // 100) % 5 + 1 AS DECIMAL(10,0)) ELSE 0 END AS DECIMAL(18,2)) AS val
    FROM posted_docs p CROSS JOIN (VALUES (1), (2)) AS l(ln)
    WHERE p.k % 333 <> 5
  ) t
),
mje AS (
  SELECT event_id, CAST(user_id % 3 + 1 AS INTEGER) AS entity_id, CAST(ts AS DATE) AS d,
         CAST(value AS DECIMAL(18,2)) AS amount,
         {_pick('event_id % 4', ['6000', '6100', '1400', '2100'])} AS dr,
         CASE WHEN event_id % 100 = 0 THEN {_pick('(event_id // 100) % 3', ['1200', '1300', '2000'])}
              WHEN event_id % 97 = 0 THEN '9999' ELSE '1000' END AS cr,
         'GL-MJE' AS prefix, 'Manual journal entry' AS descr
  FROM events
),
mje_all AS (
  SELECT * FROM mje
  UNION ALL
  SELECT event_id, entity_id, d + 1, amount, '9999', '1000', 'GL-MJR', 'Suspense clearing'
  FROM mje WHERE cr = '9999' AND entity_id <> 3
),
gl_manual AS (
  SELECT prefix || '-' || {_pad('event_id')} AS journal_id, CAST(ln AS INTEGER) AS journal_line_id, entity_id,
         d AS business_date, d AS posting_date, CASE WHEN ln = 1 THEN dr ELSE cr END AS account_code,
         CASE WHEN ln = 1 THEN amount ELSE CAST(0 AS DECIMAL(18,2)) END AS debit_usd,
         CASE WHEN ln = 2 THEN amount ELSE CAST(0 AS DECIMAL(18,2)) END AS credit_usd,
         'USD' AS currency, amount AS amount_currency, CAST(1 AS DECIMAL(18,8)) AS fx_rate,
         'MANUAL' AS source_system, prefix || '-' || {_pad('event_id')} AS source_doc_id, descr AS description,
         'j.controller' AS created_by, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM mje_all CROSS JOIN (VALUES (1), (2)) AS l(ln)
),
raw_gl_journal AS (
  SELECT journal_id, journal_line_id, entity_id, business_date, posting_date, account_code, debit_usd, credit_usd,
         currency, amount_currency, fx_rate, source_system, source_doc_id, description, created_by, ingested_at
  FROM gl_live
  UNION ALL
  SELECT journal_id, journal_line_id, entity_id, business_date, posting_date, account_code,
         CAST(CASE WHEN journal_line_id = 1 THEN debit_usd + 1.00 ELSE debit_usd END AS DECIMAL(18,2)),
         CAST(CASE WHEN journal_line_id = 2 THEN credit_usd + 1.00 ELSE credit_usd END AS DECIMAL(18,2)),
         currency, amount_currency, fx_rate, source_system, source_doc_id, description, created_by,
         TIMESTAMP '2024-01-31 00:00:00'
  FROM gl_live WHERE k % 40 = 3
  UNION ALL
  SELECT * FROM gl_manual
),
raw_breaks_log AS (
  SELECT 'GL-' || doc_id AS journal_id, -1 AS journal_line_id, 'missing_gl_posting' AS break_class,
         'entry not posted' AS detail FROM posted_docs WHERE k % 333 = 5
  UNION ALL
  SELECT 'GL-' || doc_id, -1, 'missing_sl_posting', 'document not in sub-ledger' FROM posted_docs WHERE k % 1000 = 9
  UNION ALL
  SELECT 'GL-' || doc_id, CAST((k // 50) % 2 + 1 AS INTEGER), 'timing_diff',
         'posting_date +' || CASE WHEN (k // 50) % 10 < 3 THEN '2' ELSE '1' END || 'd'
  FROM posted_docs WHERE k % 333 <> 5 AND k % 50 = 7
  UNION ALL
  SELECT 'GL-' || doc_id, CAST((k // 200) % 2 + 1 AS INTEGER), 'amount_mismatch',
         'amount +' || CAST(CAST(0.01 * CAST((k // 200) % 50 + 1 AS DECIMAL(10,0)) AS DECIMAL(14,2)) AS VARCHAR)
  FROM posted_docs WHERE k % 333 <> 5 AND k % 200 = 21
  UNION ALL
  SELECT 'GL-' || doc_id, CAST((k // 100) % 2 + 1 AS INTEGER), 'fx_rounding',
         'amount +' || CAST(CAST(0.01 * CAST((k // 100) % 5 + 1 AS DECIMAL(10,0)) AS DECIMAL(14,2)) AS VARCHAR)
  FROM posted_docs WHERE k % 333 <> 5 AND currency <> 'USD' AND k % 100 = 63
  UNION ALL
  SELECT 'GL-' || doc_id, -1, 'replayed_line', 'older copy ingested' FROM posted_docs WHERE k % 333 <> 5 AND k % 40 = 3
  UNION ALL
  SELECT journal_id, journal_line_id, 'unauthorized_manual_je', 'manual credit to control account ' || account_code
  FROM gl_manual WHERE journal_line_id = 2 AND account_code IN ('1200', '1300', '2000') AND journal_id LIKE 'GL-MJE%'
),
raw_tolerance_rules (account_code, amount_tolerance_usd, timing_tolerance_days, fx_tolerance_pct) AS (
  SELECT col0, CAST(col1 AS DECIMAL(18,4)), CAST(col2 AS INTEGER), CAST(col3 AS DECIMAL(18,6))
  FROM (VALUES {", ".join(f"('{a}', '{b}', {c}, '{d}')" for a, b, c, d in R.TOLERANCE_RULES)})
),
raw_materiality (account_code, materiality_usd, severity) AS (
  SELECT col0, CAST(col1 AS DECIMAL(18,2)), col2
  FROM (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in R.MATERIALITY)})
),
raw_part_tree AS (
  SELECT CAST(p_partkey AS VARCHAR) AS account_code, p_name AS account_name, p_type AS account_type,
         CASE WHEN p_partkey >= 10 THEN CAST(p_partkey // 10 AS VARCHAR) END AS parent_account_code,
         false AS is_control_account, CAST(NULL AS VARCHAR) AS subledger_source
  FROM part
)
"""


def with_fixture(sql_body: str, extra_ctes: str = "") -> str:
    """`WITH <fixture>[, extra] <body>`; extra_ctes is 'name AS (...), ...' text."""
    extra = f",\n{extra_ctes.strip().rstrip(',')}" if extra_ctes.strip() else ""
    return f"WITH {FIXTURE_CTES.strip()}{extra}\n{sql_body}"
