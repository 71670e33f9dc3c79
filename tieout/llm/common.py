"""Shared helpers: the scratch folder all executors see, written tables, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most this many long keys (64 MB with overhead) may be broadcast.
BROADCAST_KEYS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets its own.

    Raises where the setting is missing on a cluster: a folder of the driver's machine would not
    be seen by the executors.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="llm-scratch-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    out = df.write.partitionBy(*partition_by) if partition_by else df.write
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_small(keys: DataFrame, most: int = BROADCAST_KEYS) -> bool:
    """Whether a table of keys has at most ``most`` rows (an exact count, not a guess)."""
    return keys.count() <= most


def semi(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``keys``; the key list is broadcast only under its bound."""
    return df.join(F.broadcast(keys) if is_small(keys) else keys, on, "left_semi")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows (id, component_id): the smallest id reachable over undirected ``edges`` (a, b).

    Alternates large-star and small-star steps; each is a partial minimum per node and a join, so
    a hub with a third of all edges is pre-aggregated and its join can be split. Ids without an
    edge don't appear. Every round is a written table.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    mark = _fingerprint(now)
    while mark[0]:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        now = written(small, "edges")
        mark, before = _fingerprint(now), mark
        if mark == before:
            break
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
