"""Row counts and newest times of Parquet tables from file footers.

A footer holds the rows of its file and, per row group, the least and greatest value of a column. Tasks
read footers only; no column data leaves storage. Files whose footer has no statistics of the column
(times written as INT96, other writers) or that the worker's file system library can't open are read
exactly, and only these. A row group of nulls alone adds nothing to the newest time.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Footers that a task reads one after another.
FILES_PER_TASK = 64


def _footer_reader(column: str | None):
    def newest(meta) -> tuple[bool, int | None]:
        """(known, microseconds) over the row groups."""
        at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}.get(column)
        if at is None:
            return column is None, None
        found = []
        for g in range(meta.num_row_groups):
            chunk = meta.row_group(g).column(at)
            stats = chunk.statistics
            if stats is not None and stats.has_null_count and stats.null_count == chunk.num_values:
                continue
            if stats is None or not stats.has_min_max or not hasattr(stats.max, "timestamp"):
                return False, None
            found.append(pa.scalar(stats.max, pa.timestamp("us", "UTC")).value)
        return True, max(found, default=None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs
        import pyarrow.parquet

        for batch in batches:
            rows, known, times = [], [], []
            for uri in batch.column("path").to_pylist():
                count, seen, time = None, False, None
                try:
                    files, path = pyarrow.fs.FileSystem.from_uri(uri)
                    with files.open_input_file(path) as f:
                        meta = pyarrow.parquet.ParquetFile(f).metadata
                    count = meta.num_rows
                    seen, time = newest(meta)
                except (OSError, NotImplementedError, pa.ArrowInvalid):
                    pass  # what is missing is read exactly
                rows.append(count)
                known.append(seen)
                times.append(time)
            yield pa.RecordBatch.from_arrays(
                [batch.column("table_name"), batch.column("path"), pa.array(rows, pa.int64()),
                 pa.array(known, pa.bool_()), pa.array(times, pa.int64())],
                names=["table_name", "path", "rows", "known", "newest_us"])

    return read


def footer_statistics(spark: SparkSession, tables: Mapping[str, DataFrame], column: str | None = None) -> DataFrame:
    """(table_name, path, rows, known, newest_us) of every file of the scans; `tables` are plain file scans."""
    paths = [(name, path) for name, df in tables.items() for path in df.inputFiles()]
    files = spark.createDataFrame(paths, "table_name STRING, path STRING")
    files = files.repartition(max(1, -(-len(paths) // FILES_PER_TASK)))
    return files.mapInArrow(
        _footer_reader(column), "table_name STRING, path STRING, rows BIGINT, known BOOLEAN, newest_us BIGINT")


def _names(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in sorted(tables)], "table_name STRING")


def _exactly(tables: Mapping[str, DataFrame], unread: Mapping[str, list[str]], agg) -> DataFrame | None:
    """`agg` of the files that footers told nothing about, by table."""
    out = None
    for name, paths in unread.items():
        df = tables[name]
        part = df.sparkSession.read.schema(df.schema).parquet(*paths).agg(agg).select(
            F.lit(name).alias("table_name"), "value")
        out = part if out is None else out.unionByName(part)
    return out


def _summed(spark, tables, column, known, value, exact, how) -> DataFrame:
    """(table_name, value) per table: footers where known, the exact value of the other files."""
    stats = footer_statistics(spark, tables, column).persist()
    unread: dict[str, list[str]] = {}
    for r in stats.filter(~known).select("table_name", "path").toLocalIterator():
        unread.setdefault(r["table_name"], []).append(r["path"])
    parts = stats.filter(known).select("table_name", value.alias("value"))
    rest = _exactly(tables, unread, exact.alias("value"))
    if rest is not None:
        parts = parts.unionByName(rest)
    return _names(spark, tables).join(parts.groupBy("table_name").agg(how("value").alias("value")), "table_name", "left")


def row_counts(spark: SparkSession, tables: Mapping[str, DataFrame], schema_name: str = "raw") -> DataFrame:
    """One (table_name, row_count) row per table, ordered by name; a table without files counts 0."""
    counts = _summed(spark, tables, None, F.col("rows").isNotNull(), F.col("rows"), F.count(F.lit(1)), F.sum)
    return counts.select(
        F.concat(F.lit(f"{schema_name}."), "table_name").alias("table_name"),
        F.coalesce("value", F.lit(0)).cast("bigint").alias("row_count"),
    ).orderBy("table_name")


def newest_times(spark: SparkSession, tables: Mapping[str, DataFrame], column: str = "ingested_at") -> DataFrame:
    """One (table_name, `column`) row per table: its greatest value, null where there is none."""
    newest = _summed(spark, tables, column, F.col("known"), F.col("newest_us"), F.unix_micros(F.max(column)), F.max)
    return newest.select("table_name", F.timestamp_micros("value").alias(column))
