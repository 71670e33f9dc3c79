"""Reconciliation marts built on the trial balances and the match."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tieout.functions.columns import money, money_sum
from tieout.functions.rules import resolve_materiality, resolve_tolerance, tolerance_status
from tieout.operators.balances import TB_KEYS
from tieout.plans.broadcast import checked_broadcast
from tieout.sources import reference_data as R


def _d(v: dt.date | str):
    return F.lit(v if isinstance(v, str) else v.isoformat()).cast("date")


def control_accounts(dim_account: DataFrame) -> DataFrame:
    return dim_account.filter(F.col("is_control_account")).select("account_code")


def recon_control_account(
    sl_tb: DataFrame, gl_tb: DataFrame, dim_account: DataFrame, tolerance_rules: DataFrame,
    materiality: DataFrame, carry_forward: bool = False,
) -> DataFrame:
    """SL vs GL balance per (entity, control account, day); missing side = 0.

    The control-account filter is a semi join applied to each trial balance
    before the full outer join, so only control accounts are shuffled.
    `carry_forward=True` instead carries each side's last balance across days
    that side has no activity (the documented option, off by default).
    """
    ctl = checked_broadcast(control_accounts(dim_account), 100_000)
    sl = sl_tb.join(ctl, "account_code", "left_semi").alias("sl")
    gl = gl_tb.join(ctl, "account_code", "left_semi").alias("gl")
    j = sl.join(gl, [F.col(f"sl.{k}") == F.col(f"gl.{k}") for k in TB_KEYS], "full_outer")
    zero = F.lit(0).cast("decimal(38,2)")
    out = j.select(
        *[F.coalesce(F.col(f"sl.{k}"), F.col(f"gl.{k}")).alias(k) for k in TB_KEYS],
        F.coalesce(F.col("sl.daily_net_usd"), zero).alias("sl_daily_net_usd"),
        F.coalesce(F.col("gl.daily_net_usd"), zero).alias("gl_daily_net_usd"),
        F.col("sl.running_balance_usd").alias("_slb"),
        F.col("gl.running_balance_usd").alias("_glb"),
    )
    if carry_forward:
        w = W.partitionBy("entity_id", "account_code").orderBy("posting_date").rowsBetween(W.unboundedPreceding, 0)
        out = out.withColumn("_slb", F.last("_slb", ignorenulls=True).over(w)).withColumn(
            "_glb", F.last("_glb", ignorenulls=True).over(w)
        )
    out = out.withColumn("sl_balance_usd", F.coalesce(F.col("_slb"), zero)).withColumn(
        "gl_balance_usd", F.coalesce(F.col("_glb"), zero)
    ).drop("_slb", "_glb")
    out = resolve_tolerance(out, "account_code", tolerance_rules)
    out = resolve_materiality(out, "account_code", materiality)
    var = F.col("sl_balance_usd") - F.col("gl_balance_usd")
    return out.select(
        *TB_KEYS, "sl_daily_net_usd", "gl_daily_net_usd", "sl_balance_usd", "gl_balance_usd",
        money(var).alias("variance_usd"), "amount_tolerance_usd", "materiality_usd", "severity",
        tolerance_status(F.abs(var), F.col("amount_tolerance_usd"), F.col("materiality_usd")).alias("status"),
    )


def roll_forward(tb: DataFrame, ledger: str) -> DataFrame:
    """opening = previous closing (0 first), activity, closing; PASS within 0.01.

    The lag runs on the same window spec as the running sum, so Spark reuses
    the trial balance's partitioning (no extra exchange).
    """
    w = W.partitionBy("entity_id", "account_code").orderBy("posting_date")
    prior = F.lag("running_balance_usd").over(w)
    opening = F.coalesce(prior, F.lit(0).cast("decimal(38,2)"))
    var = F.col("running_balance_usd") - opening - F.col("daily_net_usd")
    return tb.select(
        F.lit(ledger).alias("ledger"), *TB_KEYS,
        money_sum(opening).alias("opening_balance_usd"),
        F.col("daily_net_usd").alias("activity_usd"),
        F.col("running_balance_usd").alias("closing_balance_usd"),
        money(var).alias("roll_forward_variance_usd"),
        F.when(F.abs(var) <= F.lit(R.BALANCE_TOLERANCE_USD).cast("decimal(3,2)"), "PASS").otherwise("FAIL").alias(
            "status"
        ),
    )


def recon_roll_forward(sl_tb: DataFrame, gl_tb: DataFrame) -> DataFrame:
    return roll_forward(sl_tb, "SUBLEDGER").unionByName(roll_forward(gl_tb, "GL"))


def recon_variance_analysis(control: DataFrame, dim_entity: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Non-PASS control rows with entity/account attributes, materiality flag and
    rank of |variance| within the day."""
    c = control.filter(F.col("status") != "PASS")
    e = checked_broadcast(dim_entity.select("entity_id", "entity_code", "functional_currency"), 100_000)
    a = checked_broadcast(dim_account.select("account_code", "account_name", "account_type"), 1_000_000)
    j = c.join(e, "entity_id", "left").join(a, "account_code", "left")
    absv = F.abs(F.col("variance_usd"))
    w = W.partitionBy("posting_date").orderBy(absv.desc())
    return j.select(
        "posting_date", "entity_id", "entity_code", "functional_currency", "account_code", "account_name",
        "account_type", "sl_balance_usd", "gl_balance_usd", "variance_usd", money(absv).alias("abs_variance_usd"),
        "materiality_usd", "severity",
        F.coalesce(absv >= F.col("materiality_usd"), F.lit(False)).alias("is_material"),
        "status", F.rank().over(w).cast("bigint").alias("variance_rank_in_day"),
    )


def recon_aging(txn_level: DataFrame, as_of: dt.date | str) -> DataFrame:
    """BREAK rows aged from the first non-null of business, SL and GL date."""
    b = txn_level.filter(F.col("status") == "BREAK")
    age = F.datediff(_d(as_of), F.coalesce("business_date", "sl_posting_date", "gl_posting_date"))
    b = b.withColumn("age_days", age)
    a = F.col("age_days")
    return b.withColumn(
        "age_bucket",
        F.when(a <= 1, "0-1d").when(a <= 7, "2-7d").when(a <= 30, "8-30d").otherwise("30+d"),
    ).withColumn(
        "triage_priority",
        F.when(a > 30, "CRITICAL").when(a > 7, "HIGH").when(a > 1, "MEDIUM").otherwise("LOW"),
    )


def recon_fx_revaluation(stg_gl: DataFrame, stg_fx: DataFrame) -> DataFrame:
    """Non-USD GL lines re-translated at the posting date's rate; no rate -> FAIL."""
    fx = checked_broadcast(
        stg_fx.filter(F.col("to_currency") == "USD").select(
            F.col("rate_date").alias("_d"), F.col("from_currency").alias("_c"), F.col("rate").alias("eod_fx_rate")
        ),
        5_000_000,
    )
    g = stg_gl.filter(F.col("currency") != "USD")
    j = g.join(fx, (g["currency"] == fx["_c"]) & (g["posting_date"] == fx["_d"]), "left")
    recomputed = F.col("amount_currency") * F.col("eod_fx_rate")
    actual = F.col("debit_usd") + F.col("credit_usd")
    diff = F.abs(recomputed - actual)
    return j.select(
        "entity_id", "posting_date", "account_code", "currency", "amount_currency",
        F.col("fx_rate").alias("posted_fx_rate"), "eod_fx_rate",
        money(actual).alias("actual_amount_usd"),
        recomputed.cast("decimal(38,10)").alias("recomputed_amount_usd"),
        money(recomputed - actual).alias("fx_variance_usd"),
        F.when(diff <= F.lit(R.FX_REVAL_PASS_USD).cast("decimal(3,2)"), "PASS")
        .when(diff <= F.lit(R.FX_REVAL_WARN_USD).cast("decimal(3,2)"), "WARN")
        .otherwise("FAIL").alias("status"),
    )


def recon_suspense_monitor(gl_tb: DataFrame) -> DataFrame:
    """Suspense series (codes starting with 9): PASS only at a zero balance."""
    return gl_tb.filter(F.col("account_code").startswith("9")).select(
        *TB_KEYS, "daily_debits_usd", "daily_credits_usd",
        F.col("running_balance_usd").alias("suspense_balance_usd"),
        F.when(F.col("running_balance_usd") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def recon_manual_je_flag(stg_gl: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Manual GL lines on control accounts (always FAIL)."""
    a = checked_broadcast(
        dim_account.filter(F.col("is_control_account")).select("account_code", "account_name", "is_control_account"),
        1_000_000,
    )
    m = stg_gl.filter(F.col("source_system") == "MANUAL")
    j = m.join(a, "account_code", "inner")
    return j.select(
        "journal_id", "journal_line_id", "entity_id", "business_date", "posting_date", "account_code",
        "account_name", "is_control_account", money(F.col("debit_usd") + F.col("credit_usd")).alias("amount_usd"),
        "created_by", "description",
        F.lit("FAIL").alias("status"),
    )


SUMMARY_COLUMNS = ["check_name", "as_of_date", "pass_count", "warn_count", "fail_count", "breaks_value_usd"]


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def recon_summary(control: DataFrame, txn_level: DataFrame, roll_fwd: DataFrame) -> DataFrame:
    """One scorecard row per check; counts/sums are NULL on an empty input."""
    zero = F.lit(0).cast("decimal(38,2)")
    ca = control.agg(
        F.lit("control_account").alias("check_name"),
        F.max("posting_date").alias("as_of_date"),
        _count_if(F.col("status") == "PASS").alias("pass_count"),
        _count_if(F.col("status") == "WARN").alias("warn_count"),
        _count_if(F.col("status") == "FAIL").alias("fail_count"),
        money_sum(F.sum(F.when(F.col("status") != "PASS", F.abs("variance_usd")).otherwise(zero))).alias(
            "breaks_value_usd"
        ),
    )
    tl = txn_level.agg(
        F.lit("transaction_level").alias("check_name"),
        F.max(F.coalesce(F.col("business_date"), F.lit("1900-01-01").cast("date"))).alias("as_of_date"),
        _count_if(F.col("status") == "MATCHED").alias("pass_count"),
        F.lit(0).cast("bigint").alias("warn_count"),
        _count_if(F.col("status") == "BREAK").alias("fail_count"),
        money_sum(F.sum(F.when(F.col("status") == "BREAK", F.abs("amount_delta_usd")).otherwise(zero))).alias(
            "breaks_value_usd"
        ),
    )
    rf = roll_fwd.agg(
        F.lit("roll_forward").alias("check_name"),
        F.max("posting_date").alias("as_of_date"),
        _count_if(F.col("status") == "PASS").alias("pass_count"),
        F.lit(0).cast("bigint").alias("warn_count"),
        _count_if(F.col("status") == "FAIL").alias("fail_count"),
        money_sum(F.sum(F.when(F.col("status") == "FAIL", F.abs("roll_forward_variance_usd")).otherwise(zero))).alias(
            "breaks_value_usd"
        ),
    )
    return ca.unionByName(tl).unionByName(rf)


def recon_duplicate_invoices(ap_invoices: DataFrame) -> DataFrame:
    """Same vendor, date and amount under different ids (neither VOID nor WRITTEN_OFF): count, first
    and last id, >2 FAIL else WARN.

    A plain hash aggregate with map-side partials: no group's ids are ever
    collected into one array, so a hot (vendor, date, amount) stays bounded;
    `duplicate_invoice_members` lists the member invoices row by row.
    """
    g = ap_invoices.filter(~F.col("status").isin("VOID", "WRITTEN_OFF")).groupBy("vendor_id", "invoice_date", "amount_usd").agg(
        F.count(F.lit(1)).alias("duplicate_count"),
        F.min("invoice_id").alias("first_invoice_id"),
        F.max("invoice_id").alias("last_invoice_id"),
    )
    return g.filter(F.col("duplicate_count") > 1).select(
        "vendor_id", "invoice_date", "amount_usd", "duplicate_count", "first_invoice_id", "last_invoice_id",
        F.when(F.col("duplicate_count") > 2, "FAIL").otherwise("WARN").alias("status"),
    )


def duplicate_invoice_members(ap_invoices: DataFrame, dups: DataFrame) -> DataFrame:
    """Every invoice of a duplicate group, with the group's count and status."""
    keys = ["vendor_id", "invoice_date", "amount_usd"]
    inv = ap_invoices.filter(~F.col("status").isin("VOID", "WRITTEN_OFF")).select(*keys, "invoice_id")
    # few duplicate groups (the normal case) are broadcast, so invoices do not shuffle
    return inv.join(checked_broadcast(dups.select(*keys, "duplicate_count", "status"), 1_000_000), keys, "inner")


def summary_duplicate_invoices(dups: DataFrame) -> DataFrame:
    """Scorecard row of the duplicate check; value = amount x (n - 1)."""
    zero = F.lit(0).cast("decimal(38,2)")
    return dups.agg(
        F.lit("duplicate_invoices").alias("check_name"),
        F.max("invoice_date").alias("as_of_date"),
        F.lit(0).cast("bigint").alias("pass_count"),
        F.count_if(F.col("status") == "WARN").alias("warn_count"),
        F.count_if(F.col("status") == "FAIL").alias("fail_count"),
        money_sum(F.coalesce(F.sum(F.col("amount_usd") * (F.col("duplicate_count") - 1)), zero)).alias(
            "breaks_value_usd"
        ),
    )
