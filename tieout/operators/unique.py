"""Uniqueness checks that don't shuffle the keys of a table, where few of them repeat.

1. Each key becomes a position, some bits of its 64-bit hash; so many that about SPURIOUS different keys
   of the whole table share a position by chance, whatever its size. A task sorts its positions, keeps at
   most two of a kind and sends them as differences in 7-bit groups: two to five bytes a key instead of a
   row with the key. A key with a third of all rows is sent twice by each task.
2. Positions that arrive twice, from one task or several, are suspects. A repeated key is always one.
3. Rows at suspect positions, picked by a broadcast semi join, are counted exactly by key. If the suspects
   are too many for a broadcast, repeats aren't rare and all keys are counted as `quality.dq_unique` does.

So the result is exact, whatever the sketch says. The key columns are read twice (and counted once).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.plans.broadcast import is_small
from tieout.plans.materialize import new_table_dir, write_table

#: Keys expected to share a position with another one by chance.
SPURIOUS = 1_024
#: Positions that a task holds before it sends them, and that a bucket of the second step gets.
HELD, BUCKET = 4_000_000, 2_000_000
#: Suspects (longs) that may be broadcast.
MOST_SUSPECTS = 1_000_000


def pack(positions: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences, seven bits a byte, the high bit where more follow."""
    gaps = np.diff(positions, prepend=positions.dtype.type(0))
    length = np.ones(len(gaps), np.int64)
    for k in range(1, 10):
        length += gaps >= np.uint64(1 << 7 * k)
    start = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), np.uint8)
    for k in range(int(length.max(initial=0))):
        at = length > k
        more = (length[at] - 1 > k).astype(np.uint8) << 7
        out[start[at] + k] = (gaps[at] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8)
    end = np.flatnonzero(raw < 128)
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    length = end - start + 1
    gaps = np.zeros(len(end), np.uint64)
    for k in range(int(length.max(initial=0))):
        at = length > k
        gaps[at] |= (raw[start[at] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
    return np.cumsum(gaps, dtype=np.uint64)


def position_bits(rows: int) -> int:
    """Bits at which about SPURIOUS pairs of `rows` different keys share a position."""
    return min(62, max(16, (rows * rows // (2 * SPURIOUS)).bit_length()))


def _sender(bits: int, buckets: int):
    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        found = np.sort(np.concatenate(held))
        third = np.zeros(len(found), bool)
        third[2:] = found[2:] == found[:-2]
        found = found[~third]
        # buckets are ranges, so that differences stay small
        edges = [np.uint64((b << bits) // buckets) for b in range(1, buckets)]
        parts = np.split(found, np.searchsorted(found, np.array(edges, np.uint64)))
        some = [(b, pack(p)) for b, p in enumerate(parts) if len(p)]
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in some], pa.int32()), pa.array([p for _, p in some], pa.binary())],
            names=["bucket", "positions"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))
            n += batch.num_rows
            if n >= HELD:
                yield send(held)
                held, n = [], 0
        if n:
            yield send(held)

    return stream


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions that occur twice in a bucket; rows come sorted by bucket, one bucket is held."""

    def result(parts: list[np.ndarray]) -> pa.RecordBatch:
        found = np.sort(np.concatenate(parts))
        twice = np.unique(found[1:][found[1:] == found[:-1]])
        return pa.RecordBatch.from_arrays([pa.array(twice.astype(np.int64), pa.int64())], names=["position"])

    now, parts = None, []
    for batch in batches:
        for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("positions"), strict=True):
            if bucket != now and parts:
                yield result(parts)
                parts = []
            now = bucket
            parts.append(unpack(packed.as_py()))
    if parts:
        yield result(parts)


def _position(columns: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - bits)


def suspects(df: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """Positions that more than one of the (about `rows`) rows take."""
    bits, buckets = position_bits(rows), max(1, -(-rows // BUCKET))
    sent = df.select(_position(columns, bits).alias("position")).mapInArrow(
        _sender(bits, buckets), "bucket INT, positions BINARY")
    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_repeated, "position BIGINT")


def repeated_keys(df: DataFrame, columns: Sequence[str], most: int = MOST_SUSPECTS) -> DataFrame:
    """Keys that occur more than once, with `n_records`; nulls count as values."""
    rows = df.count()
    found = write_table(suspects(df, columns, rows), new_table_dir(df.sparkSession, "repeated-positions"))
    keys = df.select(*columns)
    if is_small(found, most):
        at = _position(columns, position_bits(rows))
        keys = keys.join(F.broadcast(found), at == F.col("position"), "left_semi")
    return keys.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def dq_unique_sketched(df: DataFrame, column: str, most: int = MOST_SUSPECTS) -> DataFrame:
    """As `quality.dq_unique`: non-null values that occur more than once, with their count."""
    return repeated_keys(df.filter(F.col(column).isNotNull()), [column], most)


def dq_unique_combination_sketched(df: DataFrame, columns: Sequence[str], most: int = MOST_SUSPECTS) -> DataFrame:
    """As `quality.dq_unique_combination`: combinations that occur more than once, nulls included."""
    return repeated_keys(df, list(columns), most)
