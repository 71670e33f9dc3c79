"""Operator 3: quality rules with cross-document line frequency.

A pass over whole texts takes the base figures and, for each document, the hashes of its distinct
normalised lines with their words. Spark counts, for each host and line, the distinct documents
(equal documents count once, so a text that was copied whole doesn't condemn its own lines). Lines
in more than ``HOST_LIMIT`` documents of a host are removed; a document is rejected if less than
``LEAST_LEFT`` of its words is left. The host of a document is its source.

A normalised line is lower-cased (A-Z), its digits are 0 and its white space is one space. Lines
without a word don't count.

Defined cases: null and empty texts have no words and fail the base rule; a null source is a host
of its own; repeated rows are judged row by row and count once; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import is_small, written
from .textvec import hash_spans, text_bytes, word_bounds

HOST_LIMIT = 10
LEAST_LEFT = 0.1
SYMBOLS = "#*$%&|<>"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
FIGURES = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content long, lines array<struct<hash:long,words:int>>"


def repeat_words(words: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids = np.unique(words, return_inverse=True)[1].astype(np.int64)
    pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)[1:]
    again = np.concatenate([times[windows] > 1, [False, False]])
    covered = again.copy()
    covered[1:] |= again[:-1]
    covered[2:] |= again[:-2]
    return int(covered.sum())


def normalised(line: bytes) -> bytes:
    return b" ".join(line.translate(_DIGITS).lower().split())


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def figures(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, content, {line hash: words})."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    split = data.split()
    array = text_bytes(text)
    words = hash_spans(array, *word_bounds(array))
    word_chars = len(text) - sum(map(data.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    shares: dict[int, int] = {}
    for x in lines:
        line = normalised(x)
        key = _hash(line)
        shares[key] = shares.get(key, 0) + line.count(b" ") + 1
    content = _hash(data)
    return len(split), word_chars, n_symbols, len(lines) - len(set(lines)), repeat_words(words), content, shares


def judged(docs: DataFrame, host_limit: int = HOST_LIMIT, least_left: float = LEAST_LEFT) -> DataFrame:
    """Every document's figures, words in frequent lines, and verdict; ``removed`` holds those lines' hashes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in FIGURES.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int32())]))]
        for batch in batches:
            rows = [figures(t.as_py()) for t in batch.column("text")]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            columns[6] = [[{"hash": h, "words": w} for h, w in x.items()] for x in columns[6]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"), F.col("text").cast("string").alias("text"))
    all_ = written(rows.mapInArrow(count, FIGURES).withColumn("row", F.monotonically_increasing_id()), "line-figures")
    lines = all_.select("row", "host", "content", F.explode("lines").alias("line")).select("row", "host", "content", "line.hash", "line.words")
    documents = lines.select("host", "hash", "content").distinct()
    frequent = written(documents.groupBy("host", "hash").count().where(F.col("count") > host_limit).select("host", "hash"), "frequent-lines")
    if is_small(frequent):
        frequent = F.broadcast(frequent)
    removed = lines.join(frequent, ["host", "hash"]).groupBy("row").agg(F.sum("words").alias("removed_words"), F.collect_set("hash").alias("removed"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    gone = F.coalesce(F.col("removed_words"), F.lit(0).cast("long"))
    return (
        all_.drop("lines", "content")
        .join(removed, "row", "left")
        .withColumn("removed_words", gone)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - gone >= least_left * F.col("n_words")))
    )


def clean(text: str | None, removed: list[int] | None) -> str:
    """The text without the lines whose hashes are listed."""
    gone = set(removed or ())
    lines = (text or "").split("\n")
    return "\n".join(x for x in lines if not gone or not x.strip() or _hash(normalised(x.encode("utf-8", "replace"))) not in gone)


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"
    )
