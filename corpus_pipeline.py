"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. A stage works on all its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tieout.llm.common import scratch, table
from tieout.llm.decontamination import without_leaks
from tieout.llm.jaccard import one_of_each
from tieout.llm.packing import pack
from tieout.llm.quality import keep_good
from tieout.llm.secrets import redact


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; all documents stay."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences, piece by piece."""
    return pack(docs, text_bytes=PACKED_BYTES, cached=PACKED_WORDS)


#: Packing works in smaller portions than alone: workers still hold what earlier stages left them.
PACKED_BYTES, PACKED_WORDS = 1 << 20, 60_000

STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", packing),
]

#: SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
