"""Rule resolution and classification expressions.

Config tables (tolerance, materiality) are tiny seeds; resolving a rule is a
broadcast left join on the key plus a one-row broadcast of the DEFAULT rule,
then `coalesce(specific, default)` per field.
"""

from __future__ import annotations

import weakref

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.plans.broadcast import checked_broadcast
from tieout.sources.reference_data import DEFAULT_RULE_KEY


def resolve_rule(
    df: DataFrame,
    key_col: str,
    rules: DataFrame,
    fields: Sequence[str],
    rules_key: str = "account_code",
    prefix: str = "",
) -> DataFrame:
    """Attach `fields` from the rule whose key equals df[key_col], else the DEFAULT rule.

    A rules table without a DEFAULT row leaves unmatched keys NULL (use
    `require_default` to turn that into an error up front).
    """
    specific = rules.filter(F.col(rules_key) != DEFAULT_RULE_KEY).select(
        F.col(rules_key).alias("_rule_key"), *[F.col(f).alias(f"_s_{f}") for f in fields]
    )
    default = default_rule(rules, fields, rules_key)
    out = df.join(checked_broadcast(specific, 100_000), F.col(key_col) == F.col("_rule_key"), "left")
    types = {f.name: f.dataType for f in rules.schema.fields}
    for f in fields:
        fallback = F.lit(default[f] if default else None).cast(types[f])
        out = out.withColumn(prefix + f, F.coalesce(F.col(f"_s_{f}"), fallback))
    return out.drop("_rule_key", *[f"_s_{f}" for f in fields])


# dropped with the config frame (see plans/broadcast.py)
_DEFAULTS: dict[tuple, dict | None] = {}


def default_rule(rules: DataFrame, fields: Sequence[str], rules_key: str = "account_code") -> dict | None:
    """The DEFAULT row's fields as driver-side values (a config has at most one).

    The fallback becomes typed literals in the plan instead of a join against
    a one-row side; at most two config rows are ever read.
    """
    key = (id(rules), tuple(fields), rules_key)
    if key not in _DEFAULTS:
        rows = rules.filter(F.col(rules_key) == DEFAULT_RULE_KEY).select(*fields).limit(2).collect()
        if len(rows) > 1:
            raise ValueError(f"rule config has more than one '{DEFAULT_RULE_KEY}' row")
        _DEFAULTS[key] = rows[0].asDict() if rows else None
        weakref.finalize(rules, _DEFAULTS.pop, key, None)
    return _DEFAULTS[key]


def require_default(rules: DataFrame, rules_key: str = "account_code") -> DataFrame:
    """Raise if the config has no DEFAULT row (the classifier's contract)."""
    if rules.filter(F.col(rules_key) == DEFAULT_RULE_KEY).limit(1).count() == 0:
        raise ValueError("rule config must contain a 'DEFAULT' row for fallback")
    return rules


def resolve_tolerance(df: DataFrame, key_col: str, tolerance_rules: DataFrame) -> DataFrame:
    return resolve_rule(
        df, key_col, tolerance_rules, ["amount_tolerance_usd", "timing_tolerance_days", "fx_tolerance_pct"]
    )


def resolve_materiality(df: DataFrame, key_col: str, materiality: DataFrame) -> DataFrame:
    return resolve_rule(df, key_col, materiality, ["materiality_usd", "severity"])


def categorize_break(
    sl_amount: Column, gl_amount: Column, sl_date: Column, gl_date: Column, currency: Column,
    amount_tol: Column, timing_tol: Column,
) -> Column:
    """Ordered rules; d = |coalesce(sl,0) - coalesce(gl,0)|.

    1 SL only -> MISSING_GL_POSTING; 2 GL only -> MISSING_SL_POSTING;
    3 tol < d < 0.10 and non-USD -> FX_ROUNDING; 4 d > tol -> AMOUNT_MISMATCH;
    5 |gl_date - sl_date| > timing tol -> TIMING_DIFF; else UNKNOWN.
    """
    d = F.abs(F.coalesce(sl_amount, F.lit(0)) - F.coalesce(gl_amount, F.lit(0)))
    lag = F.abs(F.datediff(gl_date, sl_date))
    return (
        F.when(sl_amount.isNotNull() & gl_amount.isNull(), "MISSING_GL_POSTING")
        .when(sl_amount.isNull() & gl_amount.isNotNull(), "MISSING_SL_POSTING")
        .when((d > amount_tol) & (d < F.lit("0.10").cast("decimal(3,2)")) & (currency != "USD"), "FX_ROUNDING")
        .when(d > amount_tol, "AMOUNT_MISMATCH")
        .when(lag > timing_tol, "TIMING_DIFF")
        .otherwise("UNKNOWN")
    )


def tolerance_status(abs_value: Column, tolerance: Column, materiality: Column) -> Column:
    """SQL marts rule: PASS within tolerance, FAIL at/above materiality, else WARN."""
    return F.when(abs_value <= tolerance, "PASS").when(abs_value >= materiality, "FAIL").otherwise("WARN")


def classify_materiality(value: Column, threshold: Column) -> Column:
    """Classifier rule: zero PASS, at/above threshold FAIL, else WARN."""
    return F.when(value == 0, "PASS").when(value >= threshold, "FAIL").otherwise("WARN")


def classify_by_account(df: DataFrame, key_col: str, value_col: str, materiality: DataFrame) -> DataFrame:
    """Per-row classification with the account's materiality (DEFAULT fallback)."""
    require_default(materiality)
    out = resolve_materiality(df, key_col, materiality)
    return out.withColumn("status", classify_materiality(F.col(value_col), F.col("materiality_usd")))


def worst_status(status: Column) -> Column:
    """Severity rank for FAIL > WARN > PASS roll-ups (max over the rank)."""
    return F.when(status == "FAIL", 2).when(status == "WARN", 1).otherwise(0)


def status_of_rank(rank: Column) -> Column:
    return F.when(rank == 2, "FAIL").when(rank == 1, "WARN").otherwise("PASS")
