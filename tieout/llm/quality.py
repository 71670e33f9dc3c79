"""Operator 4: regularised quadratic discriminant over document statistics.

Every text becomes a vector of transformed statistics. Class counts, sums and products of the
labelled rows (crc32 of the id, mod 5, not 0) are summed by Spark; each class covariance is shrunk
towards the pooled one and the identity, its Cholesky factor is cached, and the score is the
logistic of the difference of the classes' Mahalanobis log densities over ``TEMPERATURE``.

Defined cases: null and empty texts have the statistics of no words and a score like any other; a
null doc_id is held out; rows without a usable label don't count; a class without rows takes the
pooled figures, so without any label every score is 0.5; repeated rows are scored row by row;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written
from .textvec import SPACES, hash_spans, mix, text_bytes, word_bounds

SHRINK_POOLED, SHRINK_IDENTITY, TEMPERATURE, THRESHOLD = 0.1, 0.01, 4.0, 0.3
_KIND = np.zeros(256, np.int64)
for _k, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&<>=~^@_+\\{}[]", "!?", "|", ".", ",;:"), 1):
    _KIND[[ord(c) for c in _chars]] = _k
_KIND[128:] = 9
FEATURES = (
    "words", "word_length", "word_length_spread", "upper", "digits", "symbols", "shouts", "bars", "distinct_words",
    "doubled_words", "repeated_triples", "repeated_lines", "line_words", "stops", "commas", "top_word", "symbol_words",
)
D = len(FEATURES)


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one text, whole."""
    data = text_bytes(text)
    starts, ends = word_bounds(data)
    n = len(starts)
    if not n:
        return np.zeros(D)
    kinds = np.bincount(_KIND[data], minlength=10)
    chars = len(data) - int(np.count_nonzero(SPACES[data]))
    sizes = (ends - starts).astype(float)
    words = hash_spans(data, starts, ends)
    _, times = np.unique(words, return_counts=True)
    triples = mix(mix(words[:-2]) * np.uint64(3) + mix(words[1:-1]) * np.uint64(5) + words[2:])
    distinct_triples = len(np.unique(triples))
    breaks = np.concatenate([[0], np.searchsorted(starts, np.flatnonzero(data == 10)), [n]])
    begin, end = breaks[:-1], breaks[1:]
    full = end > begin
    begin, end = begin[full], end[full]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(words + np.arange(n, dtype=np.uint64) * np.uint64(0)))])
    lines = mix(sums[end] - sums[begin] + (end - begin).astype(np.uint64))
    letters = kinds[1] + kinds[2] + kinds[9]
    symbol = np.concatenate([[0], np.cumsum((_KIND[data] == 4) | (_KIND[data] == 6))])
    share = lambda x, of: np.sqrt(x / of) if of else 0.0
    return np.array(
        [
            np.log1p(n), np.log(sizes.mean()), np.log1p(sizes.std()), share(kinds[2], letters), share(kinds[3], chars), share(kinds[4], chars),
            share(kinds[5], chars), share(kinds[6], chars), np.log1p(len(times)) / np.log1p(n), share(int((words[1:] == words[:-1]).sum()), n),
            share(len(triples) - distinct_triples, max(1, len(triples))), share(len(lines) - len(np.unique(lines)), len(lines)),
            np.log1p(n / len(lines)), share(kinds[7], n), share(kinds[8], n), share(int(times.max()), n),
            share(int((symbol[ends] > symbol[starts]).sum()), n),
        ]
    )


def featured(docs: DataFrame) -> DataFrame:
    """A written table (doc_id, x): the statistics of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = [statistics(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(xs, pa.list_(pa.float64()))], names=["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(count, "doc_id long, x array<double>"), "statistics")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5, F.lit(0)) == 0


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log terms of the classes 0 and 1."""

    means: list[np.ndarray]
    inverse: list[np.ndarray]
    constant: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        density = []
        for mean, inverse, constant in zip(self.means, self.inverse, self.constant, strict=True):
            z = (x - mean) @ inverse.T
            density.append(constant - 0.5 * (z * z).sum(axis=1))
        gap = np.clip((density[1] - density[0]) / TEMPERATURE, -700, 700)
        return 1 / (1 + np.exp(-gap))


def solve(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
    """From each class's row count, sums and sums of products (class first)."""
    total = max(1.0, n.sum())
    mean_all = sums.sum(axis=0) / total
    within = np.zeros((D, D))
    covariances, means = [], []
    for c in (0, 1):
        mean = sums[c] / n[c] if n[c] else mean_all
        scatter = products[c] - n[c] * np.outer(mean, mean)
        within += scatter
        means.append(mean)
        covariances.append(scatter / n[c] if n[c] > 1 else None)
    pooled = within / total if n.sum() else np.eye(D)
    out = Discriminant(means, [], [])
    for c in (0, 1):
        own = pooled if covariances[c] is None else (1 - SHRINK_POOLED) * covariances[c] + SHRINK_POOLED * pooled
        shrunk = (1 - SHRINK_IDENTITY) * own + SHRINK_IDENTITY * max(np.trace(own) / D, 1e-6) * np.eye(D)
        lower = np.linalg.cholesky(shrunk)
        out.inverse.append(np.linalg.inv(lower))
        out.constant.append(float(np.log((n[c] + 1) / (total + 2)) - np.log(np.diag(lower)).sum()) if n.all() else 0.0)
    return out


def fit(features: DataFrame, labels: DataFrame) -> Discriminant:
    """Sums over all labelled rows that aren't held out; 2 x (1 + D + D²) numbers reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + D + D * D))
        for batch in batches:
            quality = batch.column("quality").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
            for c in (0, 1):
                own = x[quality == c]
                total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        place = np.tile(np.arange(total.shape[1]), 2)
        kind = np.repeat([0, 1], total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(place, pa.int32()), pa.array(total.ravel())], names=["c", "place", "v"])

    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)").where(~held_out())
    rows = features.join(usable, "doc_id").select("quality", "x").mapInArrow(sums, "c int, place int, v double")
    total = np.zeros((2, 1 + D + D * D))
    for c, place, v in rows.groupBy("c", "place").agg(F.sum("v")).collect():
        total[c, place] = v
    return solve(total[:, 0], total[:, 1 : 1 + D], total[:, 1 + D :].reshape(2, D, D))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) of all documents."""
    features = featured(docs)
    model = fit(features, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    out = features.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted good, with all their columns (statistics are taken again: no text is shuffled)."""
    model = fit(featured(docs), labels)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([statistics(t.as_py()) for t in batch.column(at)])
                yield batch.filter(pa.array(model.score(x) >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)


def op4_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
