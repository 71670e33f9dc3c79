"""Operator 5: packing by non-negative least squares over shallow length combinations.

1. Tokenise once and write the ids. A document of n ids gives n // window full windows and a rest.
2. The histogram of the rests, in bins of ``grain`` ids, is a bounded table. Every combination of
   at most three bins that fills a window exactly is a column; non-negative least squares gives
   repeat counts, rounded down.
3. Rests are numbered inside (bin, salt) and take their places by rank: a combination's k-th copy
   holds the k-th unused rest of each of its bins.
4. Residuals are packed greedily: combinations of the bins that are left, deepest first, as long as
   they fill a window; what remains is laid end to end and cut at the windows' edges.

No step needs a bin, length or document group in one task. Only bin counts reach the driver.

Defined cases: a null or empty text is the end id alone; repeated rows are separate documents;
an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written
from .tokens import CACHED_WORDS, default_vocabulary, encoder, text_blocks

WINDOW, GRAIN, DEPTH, SALTS = 4096, 16, 3, 128
TEXT_BYTES = 3 << 20
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, text_bytes: int = TEXT_BYTES, cached: int = CACHED_WORDS) -> DataFrame:
    """A written table (row, doc_id, n, ids); ids are unsigned 16-bit where the vocabulary allows, here always checked."""
    end = np.array([end_id], "<u4").tobytes()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary, cached)
        for batch in batches:
            for i, j, texts in text_blocks(batch.column("text"), text_bytes):
                wide = [np.frombuffer(x + end, "<u4") for x in words.batch(texts)]
                if any(x.max() > 0xFFFF for x in wide):
                    raise ValueError("the vocabulary has ids beyond 16 bits")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.array([len(x) for x in wide], pa.int64()), pa.array([x.astype("<u2").tobytes() for x in wide], pa.binary())],
                    names=["row", "doc_id", "n", "ids"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(tokens, "row long, doc_id long, n long, ids binary"), "tokens")


def combinations(bins: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All falling tuples of 1 to ``depth`` positive numbers that add up to ``bins``."""
    out: list[tuple[int, ...]] = []

    def grow(part: tuple[int, ...], left: int) -> None:
        if not left:
            out.append(part)
        elif len(part) < depth:
            for b in range(min(left, part[-1] if part else left), 0, -1):
                if b * (depth - len(part)) >= left:
                    grow((*part, b), left - b)

    grow((), bins)
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """Non-negative x with least |ax - b|, by the active-set method."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance * scale:
            break
        free[best] = True
        while True:
            own = np.flatnonzero(free)
            step = np.linalg.lstsq(a[:, own], b, rcond=None)[0]
            if (step > 0).all():
                x[:] = 0
                x[own] = step
                break
            bad = own[step <= 0]
            ratio = x[bad] / np.maximum(x[bad] - step[step <= 0], 1e-300)
            x[own] += ratio.min() * (step - x[own])
            free &= x > tolerance
            x[~free] = 0
            if not free.any():
                break
    return x


def repeats(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of bins (1 .. len(counts)-1, in grains) with repeat counts that never exceed ``counts``."""
    bins = len(counts) - 1
    columns = [c for c in combinations(bins) if all(counts[b] for b in c)]
    left, plan = counts.astype(np.int64).copy(), []
    if columns:
        rows = np.flatnonzero(counts)
        place = {int(b): k for k, b in enumerate(rows)}
        a = np.zeros((len(rows), len(columns)))
        for k, c in enumerate(columns):
            for b in c:
                a[place[b], k] += 1
        solved = nnls(a, counts[rows].astype(float))
        for k in np.argsort(-solved, kind="stable"):
            c = columns[k]
            n = min(int(solved[k]), *(int(left[b]) // c.count(b) for b in set(c)))
            if n > 0:
                plan.append((c, n))
                for b in c:
                    left[b] -= n
    while True:  # greedy: the largest bin that fits, as long as windows come out full
        part, space = [], bins
        spare = left.copy()
        while space and (fits := np.flatnonzero(spare[: space + 1])).size:
            part.append(int(fits[-1]))
            spare[fits[-1]] -= 1
            space -= int(fits[-1])
        if space or not part:
            return plan
        n = min(int(left[b]) // part.count(b) for b in set(part))
        plan.append((tuple(part), n))
        for b in part:
            left[b] -= n


def _numbered(rows: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over all rows that stand before in (keys, row).

    The sums of each (keys, salt) are a bounded table: bins times salts.
    """
    sums = rows.groupBy(*keys, "salt").agg(F.sum(amount).alias("total"))
    outer = Window.partitionBy(*keys).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*keys, "salt", F.coalesce(F.sum("total").over(outer), F.lit(0)).alias("base"))
    inner = Window.partitionBy(*keys, "salt").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("own", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
        .join(F.broadcast(bases), [*keys, "salt"])
        .withColumn("before", F.col("base") + F.col("own"))
        .drop("base", "own")
    )


def pack(
    docs: DataFrame, vocabulary: str | None = None, end_id: int = 2, window: int = WINDOW, grain: int = GRAIN, text_bytes: int = TEXT_BYTES, cached: int = CACHED_WORDS
) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids as unsigned 32-bit) of every document.

    ``text_bytes`` of texts are looked up at once, and ``cached`` words stay in a worker: less of either is less memory
    and somewhat more time, for the same pieces.
    """
    spark = docs.sparkSession
    tokens = tokenised(docs, vocabulary or default_vocabulary(), end_id, text_bytes, cached)
    slim = written(
        tokens.select(
            "row", (F.col("n") % window).alias("rest"), F.floor(F.col("n") / window).alias("full"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt")
        ).withColumn("bin", F.ceil(F.col("rest") / grain).cast("int")),
        "lengths",
    )

    counts = np.zeros(window // grain + 1, np.int64)
    for b, n in slim.where("rest > 0").groupBy("bin").count().collect():  # at most window / grain rows
        counts[b] = n
    n_full = slim.agg(F.coalesce(F.sum("full"), F.lit(0))).first()[0]

    places, cursor, base = [], np.zeros(len(counts), np.int64), int(n_full)
    for part, n in repeats(counts):
        for slot, b in zip(count(), part):
            places.append((b, int(cursor[b]), int(cursor[b]) + n, base, slot))
            cursor[b] += n
        base += n
    places += [(b, int(cursor[b]), int(counts[b]), None, None) for b in range(len(counts)) if cursor[b] < counts[b]]
    placed = spark.createDataFrame(places, "bin int, from long, to long, sequence long, slot int")

    full = _numbered(slim.where("full > 0").withColumn("all", F.lit(0)), ["all"], "full")
    whole = full.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("k"), "before").select(
        "row", (F.col("k") * window).alias("start"), F.lit(window).cast("long").alias("length"), (F.col("before") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )

    ranked = _numbered(slim.where("rest > 0").withColumn("one", F.lit(1)), ["bin"], "one").withColumnRenamed("before", "rank")
    at = written(
        ranked.join(F.broadcast(placed), "bin")
        .where("rank >= from and rank < to")
        .select("row", "salt", "rest", (F.col("full") * window).alias("start"), (F.col("sequence") + F.col("rank") - F.col("from")).alias("sequence_id"), "slot", "bin"),
        "places",
    )
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    joined = at.where("sequence_id is not null").select(
        "row", "start", F.col("rest").alias("length"), "sequence_id", F.coalesce(F.sum("rest").over(inside), F.lit(0)).alias("offset")
    )
    laid = _numbered(at.where("sequence_id is null").withColumn("all", F.lit(0)), ["all"], "rest")
    first, last = F.floor(F.col("before") / window), F.floor((F.col("before") + F.col("rest") - 1) / window)
    begin, end = F.greatest("before", F.col("w") * window), F.least(F.col("before") + F.col("rest"), (F.col("w") + 1) * window)
    cut = laid.withColumn("w", F.explode(F.sequence(first, last))).select(
        "row", (F.col("start") + begin - F.col("before")).alias("start"), (end - begin).alias("length"), (F.lit(base) + F.col("w")).alias("sequence_id"), (begin - F.col("w") * window).alias("offset")
    )
    per_row = whole.unionByName(joined).unionByName(cut).groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, ids in text_blocks(batch.column("ids"), text_bytes):
                docs_, ns, pieces = (batch.column(c).slice(i, j - i).to_pylist() for c in ("doc_id", "n", "pieces"))
                rows: dict[str, list] = {c.split()[0]: [] for c in PIECES.split(", ")}
                for doc, n, own, parts in zip(docs_, ns, ids, pieces, strict=True):
                    wide = np.frombuffer(own, "<u2").astype("<u4")
                    for p in parts:
                        rows["doc_id"].append(doc)
                        rows["doc_tokens"].append(n)
                        for c in ("start", "length", "sequence_id", "offset"):
                            rows[c].append(p[c])
                        rows["ids"].append(wide[p["start"] : p["start"] + p["length"]].tobytes())
                kinds = [pa.binary() if c == "ids" else pa.int64() for c in rows]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=list(rows))

    return tokens.join(per_row, "row").select("doc_id", "n", "ids", "pieces").mapInArrow(sliced, PIECES)


def op5_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
