"""Fixed reference values of the ledger.

Everything in this module is a FIXED VALUE that must equal the ledger's own
definitions for results to agree: the three legal entities, the 24-account
chart of accounts (account_id = position), and the two seed configurations
(tolerance rules, materiality). They are listed plainly, in natural order.
"""

from __future__ import annotations

import datetime as _dt

# --- FIXED VALUES: legal entities (entity_id, code, name, functional currency, country)
ENTITIES = [
    (1, "US01", "Acme US Inc.", "USD", "United States"),
    (2, "EU01", "Acme Europe GmbH", "EUR", "Germany"),
    (3, "IN01", "Acme India Pvt Ltd.", "INR", "India"),
]

# --- FIXED VALUES: chart of accounts
# (code, name, type, parent code, is control account, sub-ledger source)
CHART_OF_ACCOUNTS = [
    ("1000", "Cash - Operating", "ASSET", None, False, None),
    ("1100", "Cash - Payroll", "ASSET", "1000", False, None),
    ("1200", "Accounts Receivable", "ASSET", None, True, "AR"),
    ("1300", "Inventory", "ASSET", None, True, "INV"),
    ("1400", "Prepaid Expenses", "ASSET", None, False, None),
    ("1500", "Fixed Assets", "ASSET", None, False, None),
    ("2000", "Accounts Payable", "LIABILITY", None, True, "AP"),
    ("2100", "Accrued Expenses", "LIABILITY", None, False, None),
    ("2200", "Sales Tax Payable", "LIABILITY", None, False, None),
    ("3000", "Retained Earnings", "EQUITY", None, False, None),
    ("4000", "Product Revenue", "REVENUE", None, False, None),
    ("4100", "Service Revenue", "REVENUE", None, False, None),
    ("4200", "Other Revenue", "REVENUE", None, False, None),
    ("5000", "Cost of Goods Sold", "EXPENSE", None, False, None),
    ("6000", "Salaries & Wages", "EXPENSE", None, False, None),
    ("6100", "Rent", "EXPENSE", None, False, None),
    ("6200", "Utilities", "EXPENSE", None, False, None),
    ("6300", "Software & Subscriptions", "EXPENSE", None, False, None),
    ("6400", "Travel", "EXPENSE", None, False, None),
    ("6500", "Professional Services", "EXPENSE", None, False, None),
    ("6600", "Marketing", "EXPENSE", None, False, None),
    ("6900", "Other Operating Expenses", "EXPENSE", None, False, None),
    ("7900", "FX Revaluation Gain/Loss", "EXPENSE", None, False, None),
    ("9999", "Suspense - Unmapped", "ASSET", None, False, None),
]
ACCOUNTS_EFFECTIVE_FROM = _dt.date(1990, 1, 1)

# --- FIXED VALUES: seed tolerance_rules
# (account_code, amount_tolerance_usd, timing_tolerance_days, fx_tolerance_pct)
TOLERANCE_RULES = [
    ("2000", "0.05", 1, "0.001"),
    ("1200", "0.05", 1, "0.001"),
    ("1300", "0.10", 1, "0.001"),
    ("DEFAULT", "0.01", 0, "0.0000"),
]

# --- FIXED VALUES: seed materiality (account_code, materiality_usd, severity)
MATERIALITY = [
    ("2000", "500", "HIGH"),
    ("1200", "500", "HIGH"),
    ("1300", "1000", "MEDIUM"),
    ("5000", "2000", "MEDIUM"),
    ("4000", "1000", "MEDIUM"),
    ("9999", "0", "HIGH"),
    ("DEFAULT", "1000", "LOW"),
]

DEFAULT_RULE_KEY = "DEFAULT"

# --- FIXED VALUES: enumerations used by the data-quality checks
CURRENCIES = ["USD", "EUR", "INR"]
ACCOUNT_TYPES = ["ASSET", "LIABILITY", "EQUITY", "REVENUE", "EXPENSE"]
AP_INVOICE_STATUSES = ["OPEN", "PAID", "VOID", "HOLD"]
AR_INVOICE_STATUSES = ["OPEN", "PAID", "VOID", "WRITTEN_OFF"]
PAYMENT_METHODS = ["ACH", "WIRE", "CHECK", "CARD"]
CREDIT_MEMO_REASONS = ["RETURN", "PRICE_ADJ", "WRITE_OFF"]
INV_TXN_TYPES = ["RECEIPT", "COGS", "ADJUSTMENT"]
SOURCE_SYSTEMS = ["AP", "AR", "INV", "MANUAL", "FX_REVAL"]
RUN_STATUSES = ["RUNNING", "PASS", "FAIL", "WARN", "ERROR"]
CHECK_STATUSES = ["PASS", "FAIL", "WARN"]
BREAK_CLASSES = [
    "MISSING_GL_POSTING",
    "MISSING_SL_POSTING",
    "FX_ROUNDING",
    "AMOUNT_MISMATCH",
    "TIMING_DIFF",
    "UNKNOWN",
]
TRIAGE_PRIORITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
AGE_BUCKETS = ["0-1d", "2-7d", "8-30d", "30+d"]

# --- FIXED VALUES: freshness thresholds in hours (warn, error)
SOURCE_FRESHNESS_HOURS = (26, 30)
GL_SOURCE_FRESHNESS_HOURS = (12, 24)
# GL sensor: passes up to 30 h, WARN up to 48 h, else ERROR
GL_SENSOR_HOURS = (30, 48)

# --- FIXED VALUES: check thresholds
BALANCE_TOLERANCE_USD = "0.01"  # debits vs credits, roll-forward
FX_REVAL_PASS_USD = "0.05"
FX_REVAL_WARN_USD = "5.00"
FX_ROUNDING_CEILING_USD = "0.10"
ALERT_THRESHOLD_USD = "10000"
INCREMENTAL_LOOKBACK_DAYS = 14
