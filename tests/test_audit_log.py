"""The audit log with snapshots: same state as the whole log, whatever was compacted or lost."""

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tieout.operators import audit_log
from tieout.operators.staging import dedup_latest
from tieout.plans import storage

DDL = "run_id STRING, status STRING, event_seq BIGINT"


def _append(spark, log, low, high, status, seq, files=1):
    runs = spark.range(low, high, 1, files).select(
        F.concat(F.lit("run-"), "id").alias("run_id"), F.lit(status).alias("status"),
        F.lit(seq).cast("bigint").alias("event_seq"))
    runs.write.mode("append").parquet(log)


def _rows(df):
    return sorted(tuple(r) for r in df.select("run_id", "status", "event_seq").collect())


def _check(spark, log):
    whole = dedup_latest(spark.read.schema(DDL).parquet(log), ["run_id"], [F.col("event_seq").desc()])
    state = audit_log.latest_events(spark, log, ["run_id"], DDL)
    assert _rows(state) == _rows(whole)
    return state


def test_state_over_ten_thousand_runs(spark, tmp_path):
    log = str(tmp_path / "recon_runs")
    assert audit_log.latest_events(spark, log, ["run_id"], DDL).count() == 0
    assert audit_log.compact(spark, log, ["run_id"], DDL, due=0) is None
    _append(spark, log, 0, 10_000, "RUNNING", 1, files=20)
    _append(spark, log, 0, 10_000, "PASS", 2, files=20)
    assert audit_log.compact(spark, log, ["run_id"], DDL, due=64) is None
    _check(spark, log)
    first = audit_log.compact(spark, log, ["run_id"], DDL, due=10)
    _append(spark, log, 9_990, 10_001, "FAIL", 3)
    state = _check(spark, log)
    read = state.inputFiles()
    assert sum(log + "/" in f for f in read) == 1 and any(first in f for f in read)
    assert len(os.listdir(log)) > 40  # the log itself stays whole

    # a late, older event changes nothing; a compaction lost half way is not read
    _append(spark, log, 0, 5, "RUNNING", 1)
    lost = audit_log.compact(spark, log, ["run_id"], DDL, due=1)
    os.remove(os.path.join(lost, "files", "_SUCCESS"))
    assert any(first in f for f in _check(spark, log).inputFiles())

    # two runs compact at once
    with ThreadPoolExecutor(2) as pool:
        both = list(pool.map(lambda _: audit_log.compact(spark, log, ["run_id"], DDL, due=1), range(2)))
    _check(spark, log)
    for path in both:
        storage.delete(spark, path)  # losing snapshots costs time only
        _check(spark, log)
    for i in range(4):
        _append(spark, log, i, i + 1, "ERROR", 4 + i)
        audit_log.compact(spark, log, ["run_id"], DDL, due=1, keep=2)
    _check(spark, log)
    assert len(audit_log._whole(spark, log)) == 3
