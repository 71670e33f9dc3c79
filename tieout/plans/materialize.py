"""Materialise a frame as a Parquet table in shared storage and read it back.

Used for the shared layers of the ledger (raw feeds, staged GL, postings,
trial balances, the transaction-level mart): downstream plans then start at a
small file scan with real statistics instead of re-planning a deep lineage,
and a lost executor re-reads files instead of recomputing the graph.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tieout.plans.session import ensure_checkpoint_dir


def new_table_dir(spark: SparkSession, label: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


@contextmanager
def open_writers(spark: SparkSession, folders: int) -> Iterator[None]:
    """Partitioned writes inside keep that many folders open a task; rows are sorted by folder only beyond that.

    Spark turns to sorting as soon as the limit is reached, so it is one more.
    """
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf, None)
    spark.conf.set(conf, str(folders + 1))
    try:
        yield
    finally:
        spark.conf.unset(conf) if before is None else spark.conf.set(conf, before)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, plain: Sequence[str] = ()) -> DataFrame:
    """`plain`: columns written without a dictionary, as their values repeat only in neighbouring rows."""
    w = df.write.mode("overwrite").option("compression", "zstd")
    w = w.options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain})
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)
