"""Counts and newest times from footers equal those of a scan, with and without statistics."""

import datetime as dt

from pyspark.sql import functions as F

from tieout.sources import files, footers


def _write(spark, path, times, kind="TIMESTAMP_MICROS", mode="append"):
    old = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", kind)
    rows = [(i, t) for i, t in enumerate(times)]
    spark.createDataFrame(rows, "id INT, ingested_at TIMESTAMP").coalesce(2).write.mode(mode).parquet(path)
    spark.conf.set("spark.sql.parquet.outputTimestampType", old)
    return spark.read.parquet(path)


def test_footers_equal_scans(spark, ledger, tmp_path):
    day = dt.datetime(2024, 3, 1, 12, 30, 15, 123456)
    tables = {
        "plain": _write(spark, str(tmp_path / "plain"), [day, None, day - dt.timedelta(days=2), day]),
        "old": _write(spark, str(tmp_path / "old"), [day, day + dt.timedelta(hours=1)], "INT96"),
        "nulls": _write(spark, str(tmp_path / "nulls"), [None, None]),
        "empty": _write(spark, str(tmp_path / "empty"), []),
        "gl_journal": ledger.raw("gl_journal"),
    }
    _write(spark, str(tmp_path / "mixed"), [day - dt.timedelta(days=9)])
    tables["mixed"] = _write(spark, str(tmp_path / "mixed"), [day], "INT96")
    assert footers.row_counts(spark, tables).collect() == files.table_row_counts(spark, tables).collect()
    newest = {r["table_name"]: r["ingested_at"] for r in footers.newest_times(spark, tables).collect()}
    assert newest == {n: df.agg(F.max("ingested_at")).first()[0] for n, df in tables.items()}
    known = {(r["table_name"], r["known"]) for r in footers.footer_statistics(spark, tables, "ingested_at").collect()}
    assert ("old", False) in known and ("plain", True) in known and ("plain", False) not in known
    # the feeds themselves are told by footers alone
    assert ("gl_journal", False) not in known
