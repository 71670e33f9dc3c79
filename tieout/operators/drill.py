"""Look-ups of single documents in tables of any size.

`lay_out` writes a table in files that are each in the order of a 64-bit hash of the document id, so the
rows of a document lie together in each file that has any. No line is shuffled: a task sorts the lines it
read. A look-up reads a few pages, whatever the table holds:

* a Bloom filter per row group on the document id leaves out all but the files that hold it;
* the hash travels as a literal: of such a file row-group minima and maxima and the page index leave out all
  but a page or two (PAGE_ROWS each).

A document with very many lines stays where its lines were read, and files end after FILE_ROWS, so no task
writes all of it. Documents without an id (null) keep a null hash and lie first in each file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = "source_doc_id"
HASH = "_document_hash"
PAGE_ROWS = 1_000
FILE_ROWS = 5_000_000
#: Documents looked up by literals; more are found by a semi join.
MOST_LITERALS = 500


def document_hash(column: str = DOCUMENT):
    return F.when(F.col(column).isNotNull(), F.xxhash64(column))


def lay_out(df: DataFrame, path: str, rows: int, page_rows: int = PAGE_ROWS, file_rows: int = FILE_ROWS) -> DataFrame:
    """Writes `df` (about `rows` rows) in the order of the document hash and returns the table as `look_up` reads it."""
    lines = df.withColumn(HASH, document_hash())
    (
        lines.sortWithinPartitions(HASH, DOCUMENT)
        .write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", file_rows)
        .option(f"parquet.bloom.filter.enabled#{DOCUMENT}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{DOCUMENT}", str(min(rows, file_rows) or 1))
        # as large as the documents of a row group ask for
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.page.row.count.limit", str(page_rows))
        .parquet(path)
    )
    return df.sparkSession.read.schema(lines.schema).parquet(path)


def _hashes(spark: SparkSession, documents: Sequence[str]) -> list[int]:
    """Hash literals of a bounded list of ids, by the function that wrote the table."""
    ids = spark.createDataFrame([(d,) for d in documents], f"{DOCUMENT} STRING")
    return [r[0] for r in ids.select(document_hash()).collect()]


def look_up(laid_out: DataFrame, documents: Sequence[str]) -> DataFrame:
    """All rows of the documents, read through row-group and page statistics; ids that don't occur give none."""
    wanted = sorted({d for d in documents if d is not None})
    if not wanted:
        return laid_out.drop(HASH).limit(0)
    hashes = _hashes(laid_out.sparkSession, wanted)
    # one range or list of hashes prunes; the ids themselves decide
    return laid_out.filter(F.col(HASH).isin(*hashes) & F.col(DOCUMENT).isin(*wanted)).drop(HASH)


def drill(laid_out: DataFrame, documents: DataFrame, most: int = MOST_LITERALS) -> DataFrame:
    """`look_up` of a table of ids; beyond `most` of them a semi join on hash and id, which reads all pages."""
    ids = documents.select(DOCUMENT).filter(F.col(DOCUMENT).isNotNull()).distinct()
    few = [r[0] for r in ids.limit(most + 1).collect()]
    if len(few) <= most:
        return look_up(laid_out, few)
    return laid_out.join(ids.withColumn(HASH, document_hash()), [HASH, DOCUMENT], "left_semi").select(
        *[c for c in laid_out.columns if c != HASH]
    )
