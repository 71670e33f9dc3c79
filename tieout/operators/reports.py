"""Reporting queries over the marts and the audit log (the dashboard's reads).

Every top-k has a total tie-break so the limited result is deterministic.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.functions.columns import money_sum
from tieout.sources import reference_data as R


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(1)


def latest_run_checks(runs: DataFrame, checks: DataFrame) -> DataFrame:
    return checks.join(latest_run(runs).select("run_id"), "run_id", "left_semi").select(
        "check_name", "status", "breaks_count", "breaks_value_usd", "materiality_usd"
    ).orderBy("check_name")


def latest_run_row_counts(runs: DataFrame, row_counts: DataFrame) -> DataFrame:
    return row_counts.join(latest_run(runs).select("run_id"), "run_id", "left_semi").select(
        "table_name", "row_count"
    ).orderBy("table_name")


def run_history(runs: DataFrame, n: int = 30) -> DataFrame:
    return runs.select("run_id", "business_date", "status", "started_at", "finished_at", "triggered_by").orderBy(
        F.col("started_at").desc(), F.col("run_id").desc()
    ).limit(n)


def check_trend(runs: DataFrame, checks: DataFrame, now: dt.datetime | str | None = None, days: int = 60) -> DataFrame:
    """Check results of runs started in the last `days` days before `now`
    (default: the newest run's start, so the window follows the data)."""
    r = runs.select("run_id", "business_date", "started_at")
    if now is None:
        now = runs.agg(F.max("started_at")).first()[0]  # one scalar
    if now is None:
        return checks.join(r.filter(F.lit(False)), "run_id").select(
            "check_name", "status", "breaks_count", "breaks_value_usd", "business_date", "started_at"
        )
    ts = now if isinstance(now, str) else now.strftime("%Y-%m-%d %H:%M:%S")
    cond = F.col("started_at") >= F.lit(ts).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS")
    r = r.filter(cond).select("run_id", "business_date", "started_at")
    return checks.join(r, "run_id").select(
        "check_name", "status", "breaks_count", "breaks_value_usd", "business_date", "started_at"
    ).orderBy("started_at", "check_name")


def status_composition(trend: DataFrame) -> DataFrame:
    return trend.groupBy("business_date", "status").agg(F.count(F.lit(1)).alias("count"))


def break_filter_values(txn_level: DataFrame) -> DataFrame:
    """Distinct systems, accounts and (non-null) break classes as (filter, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("filter_name"), F.col(c).alias("value"))
                      for c in ("source_system", "account_code", "break_class")])
    return txn_level.select(F.explode(pairs).alias("p")).select("p.*").filter(
        F.col("value").isNotNull()).distinct().orderBy("filter_name", "value")


BREAK_DETAIL_COLUMNS = [
    "source_system", "source_doc_id", "account_code", "entity_id", "sl_posting_date", "gl_posting_date",
    "sl_amount_usd", "gl_amount_usd", "amount_delta_usd", "posting_lag_days", "break_class", "status", "journal_id",
]


def break_detail(
    txn_level: DataFrame, systems: Sequence[str], statuses: Sequence[str], accounts: Sequence[str],
    classes: Sequence[str], min_abs_delta: str = "0", limit: int = 1000,
) -> DataFrame:
    """Multi-IN filtered breaks with |delta| >= min, top `limit` by |delta|."""
    absd = F.abs(F.coalesce(F.col("amount_delta_usd"), F.lit(0)))
    f = (
        F.col("source_system").isin(*systems) & F.col("status").isin(*statuses)
        & F.col("account_code").isin(*accounts) & F.col("break_class").isin(*classes)
        & (absd >= F.lit(min_abs_delta).cast("decimal(18,2)"))
    )
    return txn_level.filter(f).orderBy(
        absd.desc(), "source_system", "source_doc_id", "account_code", F.col("posting_role").asc_nulls_first(),
        F.col("journal_id").asc_nulls_first(), F.col("journal_line_id").asc_nulls_first(),
    ).limit(limit).select(*BREAK_DETAIL_COLUMNS)


def break_totals(detail: DataFrame) -> DataFrame:
    """Total |delta| and count per break class of the shown breaks."""
    return detail.groupBy("break_class").agg(
        money_sum(F.sum(F.abs("amount_delta_usd"))).alias("total_abs_delta_usd"),
        F.count(F.lit(1)).alias("breaks"),
    )


def widest_document(postings: DataFrame, stg_gl: DataFrame) -> DataFrame:
    """The document on both sides whose sums differ most on one account (a top-1 report)."""
    keys = ["source_system", "source_doc_id", "account_code"]
    sides = [
        side.groupBy(*keys).agg(F.sum(F.col("credit_usd") - F.col("debit_usd")).alias(usd))
        for side, usd in ((postings, "sl_usd"), (stg_gl, "gl_usd"))
    ]
    gap = F.abs(F.col("sl_usd") - F.col("gl_usd"))
    return sides[0].join(sides[1], keys).orderBy(gap.desc(), *keys).limit(1).select("source_doc_id")


def aging_by_priority(aging: DataFrame, spark: SparkSession) -> DataFrame:
    """Count and |delta| per priority, every priority present (0 when none), fixed order."""
    order = spark.createDataFrame(
        [(p, i) for i, p in enumerate(R.TRIAGE_PRIORITIES)], "triage_priority STRING, priority_order INT"
    )
    agg = aging.groupBy("triage_priority").agg(
        F.count(F.lit(1)).alias("breaks"), money_sum(F.sum(F.abs("amount_delta_usd"))).alias("value_usd")
    )
    return F.broadcast(order).join(agg, "triage_priority", "left").select(
        "triage_priority", "priority_order",
        F.coalesce(F.col("breaks"), F.lit(0)).cast("bigint").alias("breaks"),
        F.coalesce(F.col("value_usd"), F.lit(0)).cast("decimal(38,2)").alias("value_usd"),
    ).orderBy("priority_order")


def aging_heatmap(aging: DataFrame) -> DataFrame:
    return aging.groupBy("account_code", "age_bucket").agg(
        money_sum(F.sum(F.abs("amount_delta_usd"))).alias("value_usd"), F.count(F.lit(1)).alias("breaks")
    ).filter(F.col("value_usd") > 0)


def triage_queue(aging: DataFrame, n: int = 200) -> DataFrame:
    return aging.filter(F.col("triage_priority").isin("HIGH", "CRITICAL")).orderBy(
        F.abs("amount_delta_usd").desc(), "source_system", "source_doc_id", "account_code",
        F.col("posting_role").asc_nulls_first(), F.col("journal_id").asc_nulls_first(),
        F.col("journal_line_id").asc_nulls_first(),
    ).limit(n).select(
        "triage_priority", "age_bucket", "source_system", "source_doc_id", "account_code", "entity_id",
        "business_date", "sl_amount_usd", "gl_amount_usd", "amount_delta_usd", "break_class",
    )


def summary_query(summary: DataFrame) -> DataFrame:
    """The documented scorecard read: sums per check, value rounded to cents."""
    return summary.groupBy("check_name").agg(
        F.sum("pass_count").cast("bigint").alias("pass"),
        F.sum("warn_count").cast("bigint").alias("warn"),
        F.sum("fail_count").cast("bigint").alias("fail"),
        F.round(F.sum("breaks_value_usd"), 2).cast("decimal(38,2)").alias("breaks_value_usd"),
    ).orderBy("check_name")
