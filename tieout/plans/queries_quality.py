"""Registered queries: data-quality operators over the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieout.operators import postings, quality, unique
from tieout.plans import checks
from tieout.plans.catalog import register
from tieout.plans.ledger import fixture_ledger as L
from tieout.plans.oracle_sql import q


@register("dq_not_null", q("SELECT * FROM txn_level WHERE posting_role IS NULL"))
def dq_not_null(spark, sf_dir):
    """GL-only match rows have no posting role."""
    return quality.dq_not_null(L(spark, sf_dir).txn_level(), "posting_role")


@register(
    "dq_unique",
    q("""SELECT journal_id, CAST(count(*) AS BIGINT) AS n_records FROM raw_gl_journal
         WHERE journal_id IS NOT NULL GROUP BY journal_id HAVING count(*) > 1"""),
)
def dq_unique(spark, sf_dir):
    return quality.dq_unique(L(spark, sf_dir).raw("gl_journal"), "journal_id")


@register(
    "dq_unique_sketched",
    q("""SELECT source_doc_id, CAST(count(*) AS BIGINT) AS n_records FROM stg_gl
         WHERE source_doc_id IS NOT NULL GROUP BY source_doc_id HAVING count(*) > 1"""),
)
def dq_unique_sketched(spark, sf_dir):
    """Documents with several GL lines: repeats are common here, so the plain count takes over beyond its bound."""
    return unique.dq_unique_sketched(L(spark, sf_dir).stg_gl(), "source_doc_id")


@register("dq_accepted_values", q("SELECT * FROM stg_gl WHERE source_system NOT IN ('AP', 'AR', 'INV')"))
def dq_accepted_values(spark, sf_dir):
    return quality.dq_accepted_values(L(spark, sf_dir).stg_gl(), "source_system", ["AP", "AR", "INV"])


@register(
    "dq_relationships",
    q("""SELECT * FROM stg_gl g WHERE g.source_system IN ('AP', 'AR', 'INV') AND g.source_doc_id IS NOT NULL
           AND NOT EXISTS (SELECT 1 FROM postings p WHERE p.source_doc_id = g.source_doc_id)"""),
)
def dq_relationships(spark, sf_dir):
    """GL lines whose source document is not in the sub-ledger."""
    led = L(spark, sf_dir)
    gl = led.stg_gl().filter("source_system IN ('AP', 'AR', 'INV') AND source_doc_id IS NOT NULL")
    return quality.dq_relationships(gl, "source_doc_id", led.postings(), "source_doc_id")


@register(
    "dq_expression_is_true",
    q("SELECT * FROM txn_level WHERE NOT (abs(amount_delta_usd) <= amount_tolerance_usd)"),
)
def dq_expression_is_true(spark, sf_dir):
    return quality.dq_expression_is_true(L(spark, sf_dir).txn_level(), "abs(amount_delta_usd) <= amount_tolerance_usd")


@register(
    "dq_unique_combination_sketched",
    q("""SELECT journal_id, journal_line_id, CAST(count(*) AS BIGINT) AS n_records FROM raw_gl_journal
         GROUP BY journal_id, journal_line_id HAVING count(*) > 1"""),
)
def dq_unique_combination_sketched(spark, sf_dir):
    """Replayed GL lines found through the sketch: few of many keys repeat."""
    return unique.dq_unique_combination_sketched(L(spark, sf_dir).raw("gl_journal"), ["journal_id", "journal_line_id"])


@register(
    "dq_unique_combination",
    q("""SELECT journal_id, journal_line_id, CAST(count(*) AS BIGINT) AS n_records FROM raw_gl_journal
         GROUP BY journal_id, journal_line_id HAVING count(*) > 1"""),
)
def dq_unique_combination(spark, sf_dir):
    """Replayed GL lines: the raw feed repeats (journal_id, journal_line_id)."""
    return quality.dq_unique_combination(L(spark, sf_dir).raw("gl_journal"), ["journal_id", "journal_line_id"])


@register(
    "dq_severity",
    q("""SELECT CAST(count(*) AS BIGINT) AS failures,
                CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END AS status
         FROM (SELECT journal_id FROM stg_gl GROUP BY journal_id
               HAVING abs(sum(debit_usd) - sum(credit_usd)) > 0.01) f"""),
)
def dq_severity(spark, sf_dir):
    """GL balance test at its declared severity: warn above 0, never error."""
    return quality.dq_severity(quality.test_gl_journal_balanced(L(spark, sf_dir).stg_gl()), 0, 1500, "warn")


def _contract_sql(contract, table: str) -> str:
    """Expected names and types as literals, null counts from the table."""
    return " UNION ALL ".join(
        f"SELECT '{c.name}' AS column_name, '{c.data_type.simpleString()}' AS expected_type, "
        f"'{c.data_type.simpleString()}' AS actual_type, CAST(count(*) - count({c.name}) AS BIGINT) AS null_count, "
        + (f"count(*) = count({c.name})" if c.not_null else "true") + f" AS ok FROM {table}"
        for c in contract
    )


@register("dq_contract", q(_contract_sql(quality.TXN_LEVEL_CONTRACT, "txn_level")))
def dq_contract(spark, sf_dir):
    """Contract of the transaction-level mart: names, types and null counts."""
    return quality.dq_contract(L(spark, sf_dir).txn_level(), quality.TXN_LEVEL_CONTRACT)


@register("dq_contract_control_account", q(_contract_sql(quality.CONTROL_ACCOUNT_CONTRACT, "control")))
def dq_contract_control_account(spark, sf_dir):
    return quality.dq_contract(L(spark, sf_dir).control(), quality.CONTROL_ACCOUNT_CONTRACT)


_BAL = """SELECT {g}, CAST(sum(debit_usd) AS DECIMAL(38,2)) AS total_debit,
                 CAST(sum(credit_usd) AS DECIMAL(38,2)) AS total_credit,
                 CAST(sum(debit_usd) - sum(credit_usd) AS DECIMAL(38,2)) AS variance_usd
          FROM {t} GROUP BY {g} HAVING abs(sum(debit_usd) - sum(credit_usd)) > 0.01"""


@register("assert_balanced", q(_BAL.format(g="entity_id, posting_date", t="stg_gl")))
def assert_balanced(spark, sf_dir):
    """GL balanced per (entity, day); lines posted late leave days out of balance."""
    return quality.assert_balanced(L(spark, sf_dir).stg_gl(), ["entity_id", "posting_date"])


@register("test_gl_journal_balanced", q(_BAL.format(g="journal_id", t="stg_gl")))
def test_gl_journal_balanced(spark, sf_dir):
    return quality.test_gl_journal_balanced(L(spark, sf_dir).stg_gl())


@register("clean_journal_balance", q("""SELECT journal_id, total_debit, total_credit,
         CAST(total_debit - total_credit AS DECIMAL(38,2)) AS variance_usd,
         abs(total_debit - total_credit) <= 0.01 AS balanced
  FROM (SELECT 'GL-' || source_doc_id AS journal_id, CAST(sum(debit_usd) AS DECIMAL(38,2)) AS total_debit,
               CAST(sum(credit_usd) AS DECIMAL(38,2)) AS total_credit
        FROM postings GROUP BY source_doc_id) j"""))
def clean_journal_balance(spark, sf_dir):
    """Debits and credits of every journal of the feed as posted, before any break."""
    gl = postings.post_to_gl(L(spark, sf_dir).postings(), "2024-02-01 00:00:00")
    return quality.journal_balances(gl, ["journal_id"]).withColumn(
        "balanced", F.abs("variance_usd") <= F.lit("0.01").cast("decimal(10,4)")
    )


# sub-ledger postings with a known fault: the debit lines of document ids that end in 7 are too
# high by 1.00 plus 0.01 for each unit of the digit before
_FAULTY = """faulty AS (
  SELECT * REPLACE (CAST(CASE WHEN debit_usd > 0 AND right(source_doc_id, 1) = '7'
                              THEN debit_usd + 1.00 + 0.01 * CAST(substr(source_doc_id, -2, 1) AS DECIMAL(3,0))
                              ELSE debit_usd END AS DECIMAL(18,2)) AS debit_usd)
  FROM postings
)"""


def _faulty(spark, sf_dir):
    p = L(spark, sf_dir).postings()
    digit = F.substring("source_doc_id", -2, 1).cast("decimal(3,0)")
    up = F.lit("1.00").cast("decimal(3,2)") + F.lit("0.01").cast("decimal(3,2)") * digit
    hit = (F.col("debit_usd") > 0) & F.col("source_doc_id").endswith("7")
    return p.withColumn(
        "debit_usd", F.when(hit, F.col("debit_usd") + up).otherwise(F.col("debit_usd")).cast("decimal(18,2)")
    )


@register("test_subledger_postings_balanced", q(_BAL.format(g="source_system, source_doc_id", t="faulty"), _FAULTY))
def test_subledger_postings_balanced(spark, sf_dir):
    return quality.test_subledger_postings_balanced(_faulty(spark, sf_dir))


@register("unbalanced_docs", q(
    _BAL.format(g="source_system, source_doc_id", t="faulty")
    + " ORDER BY abs(sum(debit_usd) - sum(credit_usd)) DESC, source_system, source_doc_id LIMIT 10", _FAULTY))
def unbalanced_docs(spark, sf_dir):
    """Documented diagnostic: the 10 most unbalanced sub-ledger documents (a top-k report)."""
    b = quality.test_subledger_postings_balanced(_faulty(spark, sf_dir))
    return b.orderBy(F.abs("variance_usd").desc(), "source_system", "source_doc_id").limit(10)


@register("test_no_orphan_breaks", q("""SELECT * REPLACE ('UNKNOWN' AS break_class) FROM txn_level
                                        WHERE status = 'BREAK' AND break_class = 'TIMING_DIFF'"""))
def test_no_orphan_breaks(spark, sf_dir):
    """The match with its timing breaks taken out of their class: each is an orphan."""
    unclassed = F.when(F.col("break_class") == "TIMING_DIFF", "UNKNOWN").otherwise(F.col("break_class"))
    return quality.test_no_orphan_breaks(L(spark, sf_dir).txn_level().withColumn("break_class", unclassed))


@register("dq_check_constraints", q(checks.gl_constraints_sql_body()))
def dq_check_constraints(spark, sf_dir):
    return checks.gl_constraints_spark(L(spark, sf_dir))


@register("dq_report", q(checks.dq_report_sql_body()))
def dq_report(spark, sf_dir):
    return checks.dq_report(L(spark, sf_dir))


@register(
    "classify_materiality",
    q("""SELECT c.entity_id, c.account_code, c.posting_date, abs(c.variance_usd) AS breaks_value_usd,
                coalesce(m.materiality_usd, md.materiality_usd) AS materiality_usd,
                coalesce(m.severity, md.severity) AS severity,
                CASE WHEN abs(c.variance_usd) = 0 THEN 'PASS'
                     WHEN abs(c.variance_usd) >= coalesce(m.materiality_usd, md.materiality_usd) THEN 'FAIL'
                     ELSE 'WARN' END AS status
         FROM control c
         LEFT JOIN raw_materiality m ON m.account_code = c.account_code AND m.account_code <> 'DEFAULT'
         CROSS JOIN mat_default md"""),
)
def classify_materiality(spark, sf_dir):
    """Python-classifier rule (zero PASS, >= threshold FAIL) on control variances."""
    from tieout.functions.rules import classify_by_account

    led = L(spark, sf_dir)
    c = led.control().select("entity_id", "account_code", "posting_date",
                             F.abs("variance_usd").alias("breaks_value_usd"))
    return classify_by_account(c, "account_code", "breaks_value_usd", led.materiality())


@register(
    "resolve_tolerance",
    q("""SELECT p.source_doc_id, p.account_code, p.posting_role,
                coalesce(ts.amount_tolerance_usd, td.amount_tolerance_usd) AS amount_tolerance_usd,
                coalesce(ts.timing_tolerance_days, td.timing_tolerance_days) AS timing_tolerance_days,
                coalesce(ts.fx_tolerance_pct, td.fx_tolerance_pct) AS fx_tolerance_pct
         FROM postings p
         LEFT JOIN raw_tolerance_rules ts ON ts.account_code = p.account_code AND ts.account_code <> 'DEFAULT'
         CROSS JOIN tol_default td"""),
)
def resolve_tolerance(spark, sf_dir):
    from tieout.functions.rules import resolve_tolerance as _rt

    led = L(spark, sf_dir)
    p = led.postings().select("source_doc_id", "account_code", "posting_role")
    return _rt(p, "account_code", led.tolerance_rules())


@register(
    "resolve_materiality",
    q("""SELECT t.entity_id, t.account_code, t.posting_date,
                coalesce(m.materiality_usd, md.materiality_usd) AS materiality_usd,
                coalesce(m.severity, md.severity) AS severity
         FROM gl_tb t
         LEFT JOIN raw_materiality m ON m.account_code = t.account_code AND m.account_code <> 'DEFAULT'
         CROSS JOIN mat_default md"""),
)
def resolve_materiality(spark, sf_dir):
    from tieout.functions.rules import resolve_materiality as _rm

    led = L(spark, sf_dir)
    return _rm(led.gl_tb().select("entity_id", "account_code", "posting_date"), "account_code", led.materiality())


@register(
    "categorize_break",
    q("SELECT break_class, CAST(count(*) AS BIGINT) AS n FROM txn_level WHERE status = 'BREAK' GROUP BY break_class"),
)
def categorize_break(spark, sf_dir):
    """Break classes over all BREAK rows of the match."""
    t = L(spark, sf_dir).txn_level().filter(F.col("status") == "BREAK")
    return t.groupBy("break_class").agg(F.count(F.lit(1)).alias("n"))

