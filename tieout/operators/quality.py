"""Data-quality operators. Each check returns its failing rows; `dq_report`
runs a declared list of checks and returns one row per check.

Scale notes: row-level checks (not null, accepted values, expressions) over
one model are folded into a single aggregate pass of `count_if`s; uniqueness
checks are hash aggregates with map-side partial counts, so a hot value is
pre-counted before the shuffle; relationship checks are anti joins against a
size-checked broadcast of the parent keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout.plans.broadcast import checked_broadcast, is_small


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values occurring more than once, with their count."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def dq_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the list (NULL is not tested, as NOT IN gives NULL)."""
    return df.filter(~F.col(column).isin(*values))


def dq_relationships(child: DataFrame, column: str, parent: DataFrame, field: str,
                     broadcast_rows: int = 1_000_000) -> DataFrame:
    """Child rows with a non-null key that has no parent row.

    A small parent key set is broadcast. Otherwise the distinct child keys
    (map-side combined, so a hot key travels once per task) are anti-joined
    to the parent keys, and the child rows of the orphan keys are picked out
    by a semi join that is broadcast when the orphans are few: child rows are
    then never shuffled.
    """
    keys = parent.select(F.col(field).alias("_parent_key")).distinct()
    c = child.filter(F.col(column).isNotNull())
    if is_small(keys, broadcast_rows):
        return c.join(F.broadcast(keys), F.col(column) == F.col("_parent_key"), "left_anti")
    orphans = c.select(F.col(column).alias("_orphan_key")).distinct().join(
        keys, F.col("_orphan_key") == F.col("_parent_key"), "left_anti"
    )
    return c.join(checked_broadcast(orphans, broadcast_rows), F.col(column) == F.col("_orphan_key"), "left_semi")


def dq_expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows where NOT(expression); column form `col <expr>` (e.g. '>= 0')."""
    cond = F.expr(f"{column} {expression}" if column else expression)
    return df.filter(~cond)


def dq_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def journal_balances(df: DataFrame, group_by: Sequence[str], debit: str = "debit_usd",
                     credit: str = "credit_usd") -> DataFrame:
    """Debits, credits and their difference per group."""
    g = df.groupBy(*group_by).agg(
        F.sum(debit).cast("decimal(38,2)").alias("total_debit"),
        F.sum(credit).cast("decimal(38,2)").alias("total_credit"),
    )
    return g.withColumn("variance_usd", (F.col("total_debit") - F.col("total_credit")).cast("decimal(38,2)"))


def assert_balanced(df: DataFrame, group_by: Sequence[str], debit: str = "debit_usd", credit: str = "credit_usd",
                    tolerance: str = "0.01") -> DataFrame:
    """One row per group whose debits and credits differ by more than tolerance."""
    return journal_balances(df, group_by, debit, credit).filter(
        F.abs("variance_usd") > F.lit(tolerance).cast("decimal(10,4)")
    )


def test_gl_journal_balanced(stg_gl: DataFrame) -> DataFrame:
    return assert_balanced(stg_gl, ["journal_id"])


def test_subledger_postings_balanced(postings: DataFrame) -> DataFrame:
    return assert_balanced(postings, ["source_system", "source_doc_id"])


def test_no_orphan_breaks(txn_level: DataFrame) -> DataFrame:
    return txn_level.filter((F.col("status") == "BREAK") & (F.col("break_class") == "UNKNOWN"))


def severity_status(failures: Column, warn_if: int = 0, error_if: int = 0, severity: str = "error") -> Column:
    """failures -> PASS / WARN / FAIL; with severity 'warn' a test never fails."""
    if severity == "warn":
        return F.when(failures > warn_if, "WARN").otherwise("PASS")
    return F.when(failures > error_if, "FAIL").when(failures > warn_if, "WARN").otherwise("PASS")


def dq_severity(failing_rows: DataFrame, warn_if: int = 0, error_if: int = 0, severity: str = "error") -> DataFrame:
    return failing_rows.agg(F.count(F.lit(1)).alias("failures")).withColumn(
        "status", severity_status(F.col("failures"), warn_if, error_if, severity)
    )


# ------------------------------------------------------------------ constraints
GL_CHECK_CONSTRAINTS = [
    ("gl_debit_non_negative", "debit_usd >= 0"),
    ("gl_credit_non_negative", "credit_usd >= 0"),
    ("gl_not_both_sides", "NOT (debit_usd > 0 AND credit_usd > 0)"),
    ("gl_source_system_enum", "source_system IN ('AP', 'AR', 'INV', 'MANUAL', 'FX_REVAL')"),
]


def dq_check_constraints(df: DataFrame, constraints: Sequence[tuple[str, str]] = GL_CHECK_CONSTRAINTS) -> DataFrame:
    """All CHECK constraints of a table in ONE scan: (constraint, failures)."""
    aggs = [F.count_if(~F.expr(expr)).alias(name) for name, expr in constraints]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n, _ in constraints)
    return wide.selectExpr(f"stack({len(constraints)}, {stack}) AS (constraint_name, failures)")


# ------------------------------------------------------------------ contracts
@dataclass(frozen=True)
class ContractColumn:
    name: str
    data_type: T.DataType
    not_null: bool = False


def dq_contract(df: DataFrame, contract: Sequence[ContractColumn]) -> DataFrame:
    """Compare names, types and not-null against the contract, in one null-count
    pass (Spark does not enforce nullable=False on write)."""
    spark = df.sparkSession
    actual = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in contract if c.name in actual]
    nulls = (
        df.agg(*[F.count_if(F.col(c.name).isNull()).alias(c.name) for c in present]).first().asDict()
        if present else {}
    )
    rows = []
    for c in contract:
        typ = actual.get(c.name)
        n = int(nulls.get(c.name, 0) or 0)
        type_ok = typ is not None and _type_compatible(c.data_type, typ)
        rows.append((c.name, c.data_type.simpleString(), typ.simpleString() if typ else None, n,
                     bool(type_ok and (not c.not_null or n == 0))))
    extra = [(n, None, t.simpleString(), 0, False) for n, t in actual.items() if n not in {c.name for c in contract}]
    return spark.createDataFrame(
        rows + extra,
        "column_name STRING, expected_type STRING, actual_type STRING, null_count BIGINT, ok BOOLEAN",
    )


def _type_compatible(expected: T.DataType, actual: T.DataType) -> bool:
    if isinstance(expected, T.DecimalType):  # 'numeric' in the contract: any decimal
        return isinstance(actual, T.DecimalType)
    return type(expected) is type(actual)


TXN_LEVEL_CONTRACT = [
    ContractColumn("source_system", T.StringType(), True),
    ContractColumn("source_doc_id", T.StringType()),
    ContractColumn("account_code", T.StringType(), True),
    ContractColumn("entity_id", T.IntegerType()),
    ContractColumn("business_date", T.DateType()),
    ContractColumn("currency", T.StringType()),
    ContractColumn("posting_role", T.StringType()),
    ContractColumn("sl_posting_date", T.DateType()),
    ContractColumn("gl_posting_date", T.DateType()),
    ContractColumn("sl_amount_usd", T.DecimalType(18, 2)),
    ContractColumn("gl_amount_usd", T.DecimalType(18, 2)),
    ContractColumn("amount_delta_usd", T.DecimalType(18, 2)),
    ContractColumn("posting_lag_days", T.IntegerType()),
    ContractColumn("journal_id", T.StringType()),
    ContractColumn("journal_line_id", T.IntegerType()),
    ContractColumn("amount_tolerance_usd", T.DecimalType(18, 4)),
    ContractColumn("timing_tolerance_days", T.IntegerType()),
    ContractColumn("break_class", T.StringType()),
    ContractColumn("status", T.StringType()),
    ContractColumn("recon_at", T.TimestampType()),
]

CONTROL_ACCOUNT_CONTRACT = [
    ContractColumn("entity_id", T.IntegerType(), True),
    ContractColumn("account_code", T.StringType(), True),
    ContractColumn("posting_date", T.DateType(), True),
    ContractColumn("sl_daily_net_usd", T.DecimalType(38, 2)),
    ContractColumn("gl_daily_net_usd", T.DecimalType(38, 2)),
    ContractColumn("sl_balance_usd", T.DecimalType(38, 2)),
    ContractColumn("gl_balance_usd", T.DecimalType(38, 2)),
    ContractColumn("variance_usd", T.DecimalType(18, 2)),
    ContractColumn("amount_tolerance_usd", T.DecimalType(18, 4)),
    ContractColumn("materiality_usd", T.DecimalType(18, 2)),
    ContractColumn("severity", T.StringType()),
    ContractColumn("status", T.StringType(), True),
]


# ------------------------------------------------------------------ the report
@dataclass(frozen=True)
class Check:
    """One declared test: kind in not_null | unique | accepted_values |
    relationships | expression | unique_combination | singular."""

    model: str
    kind: str
    column: str | None = None
    arg: object = None
    warn_if: int = 0
    error_if: int = 0
    severity: str = "error"

    @property
    def name(self) -> str:
        col = self.column or "table"
        if self.kind == "relationships":
            return f"relationships_{self.model}_{col}__{self.arg[0]}"
        if self.kind == "expression":
            return f"expression_is_true_{self.model}_{col}_{_slug(str(self.arg))}"
        if self.kind == "unique_combination":
            return f"unique_combination_{self.model}_{'_'.join(self.arg)}"
        if self.kind == "singular":
            return str(self.arg)
        return f"{self.kind}_{self.model}_{col}"


def _slug(s: str) -> str:
    out = "".join(ch if ch.isalnum() else "_" for ch in s.lower())
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_")


def _row_level(c: Check) -> Column | None:
    """Failure predicate of a row-level check, or None for grouped checks."""
    if c.kind == "not_null":
        return F.col(c.column).isNull()
    if c.kind == "accepted_values":
        return ~F.col(c.column).isin(*c.arg)
    if c.kind == "expression":
        return ~F.expr(f"{c.column} {c.arg}" if c.column else str(c.arg))
    return None


def dq_report(models: Mapping[str, Callable[[], DataFrame]], checks: Sequence[Check],
              singular: Mapping[str, Callable[[], DataFrame]], spark: SparkSession) -> DataFrame:
    """One row per check: (test_name, model, failures, status).

    Row-level checks of one model share a single aggregate pass; grouped
    checks run as their own aggregate or anti join. Results are unioned into
    one DataFrame that Spark evaluates as one job graph.
    """
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if _row_level(c) is not None:
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        df = models[model]()
        wide = df.agg(*[F.count_if(_row_level(c)).alias(f"c{i}") for i, c in enumerate(cs)])
        stack = ", ".join(f"'{c.name}', c{i}" for i, c in enumerate(cs))
        long = wide.selectExpr(f"stack({len(cs)}, {stack}) AS (test_name, failures)")
        parts.append(long.withColumn("model", F.lit(model)))
    # all uniqueness checks of one model share ONE shuffle: each row is expanded
    # to (check, key) pairs, counted per pair with map-side partial counts, and
    # the keys seen more than once are counted per check
    uniq: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ("unique", "unique_combination"):
            uniq.setdefault(c.model, []).append(c)
    for model, cs in uniq.items():
        df = models[model]()
        pairs = []
        for c in cs:
            cols = [c.column] if c.kind == "unique" else list(c.arg)
            # NULL-aware composite key (GROUP BY groups NULLs together)
            key = F.concat_ws("\u0001", *[F.coalesce(F.col(x).cast("string"), F.lit("\u0000")) for x in cols]) \
                if len(cols) > 1 else F.col(cols[0]).cast("string")
            keep = F.col(cols[0]).isNotNull() if c.kind == "unique" else F.lit(True)
            pairs.append(F.when(keep, F.struct(F.lit(c.name).alias("test_name"), key.alias("k"))))
        exploded = df.select(F.explode(F.array(*pairs)).alias("p")).filter(F.col("p").isNotNull())
        dup = exploded.groupBy("p.test_name", "p.k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        found = dup.groupBy("test_name").agg(F.count(F.lit(1)).alias("failures"))
        names = spark.createDataFrame([(c.name,) for c in cs], "test_name STRING")
        parts.append(F.broadcast(names).join(found, "test_name", "left").select(
            "test_name", F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
            F.lit(model).alias("model"),
        ))
    for c in checks:
        if _row_level(c) is not None or c.kind in ("unique", "unique_combination"):
            continue
        if c.kind == "relationships":
            parent_model, field = c.arg
            failing = dq_relationships(models[c.model](), c.column, models[parent_model](), field)
        elif c.kind == "singular":
            failing = singular[str(c.arg)]()
        else:
            raise ValueError(c.kind)
        parts.append(failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(c.name).alias("test_name"), "failures", F.lit(c.model).alias("model")
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    thresholds = spark.createDataFrame(
        [(c.name, c.warn_if, c.error_if, c.severity) for c in checks],
        "test_name STRING, warn_if BIGINT, error_if BIGINT, severity STRING",
    )
    out = out.join(F.broadcast(thresholds), "test_name")
    f = F.col("failures").cast("bigint")
    status = (
        F.when(F.col("severity") == "warn", F.when(f > F.col("warn_if"), "WARN").otherwise("PASS"))
        .when(f > F.col("error_if"), "FAIL").when(f > F.col("warn_if"), "WARN").otherwise("PASS")
    )
    return out.select("test_name", "model", f.alias("failures"), status.alias("status"))


def run_dq_report(models: Mapping[str, Callable[[], DataFrame]], checks: Sequence[Check],
                  singular: Mapping[str, Callable[[], DataFrame]], spark: SparkSession,
                  threads: int = 8) -> DataFrame:
    """`dq_report` with each model's checks submitted as its own concurrent job.

    The result has one row per declared check (bounded by the check list, not
    by the data), so it is gathered and returned as a small DataFrame.
    """
    from tieout.plans.parallel import run_concurrently

    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    tasks = {
        m: (lambda cs=cs: [tuple(r) for r in dq_report(models, cs, singular, spark).collect()])
        for m, cs in by_model.items()
    }
    results, _ = run_concurrently(tasks, threads)
    rows = [r for m in by_model for r in results[m]]
    return spark.createDataFrame(rows, "test_name STRING, model STRING, failures BIGINT, status STRING")
