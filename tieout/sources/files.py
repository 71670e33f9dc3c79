"""Sources and sinks: typed Parquet/CSV scans, seeds, bulk load, CSV export,
row counts and freshness."""

from __future__ import annotations

import datetime as dt
import logging
import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.sources import reference_data as R
from tieout.sources.schemas import BREAKS_LOG_DDL, RAW_DDL, RAW_TABLES, SEED_DDL, raw_columns

log = logging.getLogger(__name__)


def scan_raw_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """Read one raw table with its declared schema (no inference)."""
    return spark.read.schema(RAW_DDL[table]).parquet(os.path.join(warehouse, table))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem is the portable existence check
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001


def scan_csv_dir(spark: SparkSession, folder: str, schema_name: str = "raw") -> dict[str, DataFrame]:
    """Read `<schema>__<table>.csv` for every known raw table; a missing file is
    skipped with a warning. Empty strings read as NULL."""
    out: dict[str, DataFrame] = {}
    for t in RAW_TABLES:
        path = os.path.join(folder, f"{schema_name}__{t}.csv")
        if not _exists(spark, path):
            log.warning("missing %s, skipped", path)
            continue
        ddl = RAW_DDL[t].replace(" NOT NULL", "")
        out[t] = (
            spark.read.schema(ddl).option("header", True).option("emptyValue", None).option("nullValue", "")
            .csv(path)
        )
    return out


def seed_from_literals(spark: SparkSession, name: str) -> DataFrame:
    """The packaged seed configs as typed DataFrames (tiny, broadcastable)."""
    rows = {"tolerance_rules": R.TOLERANCE_RULES, "materiality": R.MATERIALITY}[name]
    ddl = SEED_DDL[name]
    if name == "tolerance_rules":
        df = spark.createDataFrame(
            rows, "account_code STRING, a STRING, timing_tolerance_days INT, f STRING"
        ).select(
            "account_code", F.col("a").cast("decimal(18,4)").alias("amount_tolerance_usd"), "timing_tolerance_days",
            F.col("f").cast("decimal(18,6)").alias("fx_tolerance_pct"),
        )
    else:
        df = spark.createDataFrame(rows, "account_code STRING, m STRING, severity STRING").select(
            "account_code", F.col("m").cast("decimal(18,2)").alias("materiality_usd"), "severity"
        )
    assert [f.name for f in df.schema.fields] == [c.split()[0] for c in ddl.split(", ")]
    return df


def scan_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Typed CSV config (tolerance or materiality); severity is trimmed and upper-cased."""
    df = spark.read.schema(SEED_DDL[name]).option("header", True).csv(path)
    if name == "materiality":
        df = df.withColumn("severity", F.upper(F.trim("severity")))
    return df


def conform_columns(df: DataFrame, table: str, run_ts: dt.datetime | str) -> DataFrame:
    """Keep the frame's columns that the target has, in target order; absent
    target columns become typed NULLs; `ingested_at` is always the load time."""
    from tieout.sources.schemas import raw_schema

    target = raw_schema(table)
    ts = run_ts if isinstance(run_ts, str) else run_ts.strftime("%Y-%m-%d %H:%M:%S")
    cols = []
    for f in target.fields:
        if f.name == "ingested_at":
            cols.append(F.lit(ts).cast("timestamp").alias("ingested_at"))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def load_overwrite(
    spark: SparkSession, tables: Mapping[str, DataFrame], warehouse: str, run_ts: dt.datetime | str,
    partition_by: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Replace every raw table under `warehouse` (FK order) and return
    (table_name, rows_loaded) read back from what was written.

    Each table is written with mode overwrite (the file-system equivalent of
    truncate + bulk load); the count is taken from the written files, so it is
    the number that actually landed.
    """
    partition_by = partition_by or {}
    for t in RAW_TABLES:
        if t not in tables:
            continue
        w = conform_columns(tables[t], t, run_ts).write.mode("overwrite").option("compression", "zstd")
        if t in partition_by:
            w = w.partitionBy(*partition_by[t])
        w.parquet(os.path.join(warehouse, t))
    return table_row_counts(spark, {t: scan_raw_table(spark, warehouse, t) for t in RAW_TABLES if t in tables})


def write_tables_csv(tables: Mapping[str, DataFrame], folder: str, breaks_log: DataFrame | None = None,
                     schema_name: str = "raw", compression: str = "none") -> list[str]:
    """Write each table as `<schema>__<table>.csv` (a Spark CSV folder) plus `_breaks_log.csv`.

    `compression` (e.g. gzip) packs the files inside the folders; Spark's readers unpack them.
    """
    written = []
    for t, df in tables.items():
        path = os.path.join(folder, f"{schema_name}__{t}.csv")
        df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
        written.append(path)
    if breaks_log is not None:
        path = os.path.join(folder, "_breaks_log.csv")
        breaks_log.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
        written.append(path)
    return written


def table_row_counts(spark: SparkSession, tables: Mapping[str, DataFrame], schema_name: str = "raw") -> DataFrame:
    """One (table_name, row_count) row per table, ordered by name."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(f"{schema_name}.{name}").alias("table_name"), "row_count"
        )
        for name, df in sorted(tables.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


def breaks_log_counts(breaks_log: DataFrame) -> DataFrame:
    """Log rows per break class, most frequent first."""
    return breaks_log.groupBy("break_class").agg(F.count(F.lit(1)).alias("n_breaks")).orderBy(
        F.col("n_breaks").desc(), "break_class"
    )


def source_freshness(
    tables: Mapping[str, DataFrame], as_of: dt.datetime | str,
    thresholds: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Age of max(ingested_at) per source in hours vs (warn, error) thresholds.

    Defaults: 26 h / 30 h, the GL 12 h / 24 h. An empty source has no age and
    is an error.
    """
    thresholds = dict(thresholds or {})
    ts = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")
    parts = []
    for name, df in sorted(tables.items()):
        warn, err = thresholds.get(
            name, R.GL_SOURCE_FRESHNESS_HOURS if name == "gl_journal" else R.SOURCE_FRESHNESS_HOURS
        )
        agg = df.agg(F.max("ingested_at").alias("max_loaded_at"))
        age_sec = F.unix_timestamp(F.lit(ts).cast("timestamp")) - F.unix_timestamp(F.col("max_loaded_at"))
        parts.append(agg.select(
            F.lit(name).alias("source_name"), "max_loaded_at",
            (age_sec / 3600).cast("decimal(18,2)").alias("age_hours"),
            F.lit(warn).alias("warn_after_hours"), F.lit(err).alias("error_after_hours"),
            F.when(F.col("max_loaded_at").isNull(), "error")
            .when(age_sec > err * 3600, "error").when(age_sec > warn * 3600, "warn").otherwise("pass")
            .alias("freshness_status"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gl_freshness_check(gl: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Sensor rule: passed if the GL is at most 30 h old; severity WARN up to
    48 h else ERROR; an empty GL fails with ERROR."""
    ok_h, warn_h = R.GL_SENSOR_HOURS
    ts = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")
    agg = gl.agg(F.max("ingested_at").alias("max_ingested_at"))
    age_sec = F.unix_timestamp(F.lit(ts).cast("timestamp")) - F.unix_timestamp(F.col("max_ingested_at"))
    return agg.select(
        "max_ingested_at",
        (age_sec / 3600).cast("decimal(18,2)").alias("age_hours"),
        F.when(F.col("max_ingested_at").isNull(), False).otherwise(age_sec <= ok_h * 3600).alias("passed"),
        F.when(F.col("max_ingested_at").isNull(), "ERROR").when(age_sec <= ok_h * 3600, "PASS")
        .when(age_sec <= warn_h * 3600, "WARN").otherwise("ERROR").alias("severity"),
    )


def read_breaks_log_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BREAKS_LOG_DDL).option("header", True).csv(path)


def columns_of(table: str) -> Iterable[str]:
    return raw_columns(table)
