"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Conf this engine relies on; everything else is Spark's default.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lets a join on (key, seq) reuse a partitioning on key alone
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # times with minima and maxima in the footers (INT96, the default, has none)
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the SQL settings that results and plans rely on, on any session."""
    for k, v in ENGINE_CONF.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tieout") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    b = (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIEOUT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (spark.checkpoint.dir).

    Only a local session without a setting (tests, local runs) gets a fresh
    scratch folder. On a cluster the setting must name shared storage: a folder
    of the driver's machine would not be seen by the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="tieout-ckpt-", dir=os.environ.get("TIEOUT_SCRATCH", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scale_conf(
    input_bytes: int,
    split_bytes: int = 256 << 20,
    shuffle_bytes_per_partition: int = 256 << 20,
    max_partitions: int = 100_000,
) -> dict[str, str]:
    """Runtime SQL confs sized to the input (a cluster run; the local session keeps its own).

    * scans split into `split_bytes` pieces;
    * the shuffle starts with one partition per 256 MB of input (the match
      ships whole rows of both sides), and AQE coalesces to ~128 MB partitions
      from real map statistics;
    * AQE splits skewed partitions of inner/semi/anti/outer joins at 4x the
      median and above `split_bytes` (the full outer transaction match, which
      AQE cannot split, salts its hot keys itself);
    * the automatic broadcast threshold stays fixed at 64 MB whatever the
      input, and the engine's own broadcasts are probed against row bounds.
    """
    n = max(200, min(max_partitions, -(-input_bytes // shuffle_bytes_per_partition)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(split_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    conf = scale_conf(input_bytes)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
