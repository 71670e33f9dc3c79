"""Operator 1: histogram sort into shards of near equal bytes.

Documents are ordered by (hash of the text, doc_id, position): equal texts stand together. Splitters
are sought among text hashes first: each round counts the exact bytes below all candidate boundaries
in every partition and adds them up, keeps the two candidates around each target, and probes between
them, until a boundary is within ``TOLERANCE`` of its target or nothing lies between. Groups of equal
texts that are larger than that are refined over doc_ids, and groups that share text and doc_id over
positions, all groups of a level in the same rounds, each from its own least to its own greatest key;
a group of one row ends the search. Then rows are exchanged once, each to the piece of its shard, and
the exact counts below the splitters give every piece its first slot.

A position parts rows that nothing else parts. It is needed only where the rows of one text and doc_id
span a boundary; then the rows are written once more with a number each, so that both passes see the same.

Law: ``bytes`` (shards near equal in bytes).

Defined cases: a null text has no bytes and stands first; a null doc_id counts as the smallest
number; rows equal in text and id are dealt over shards like all others; an empty table gives no row;
the written shards keep every column but ``shard`` and ``slot``, which are set anew; no other name is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import scratch, written

SHARDS = 8
#: A splitter may miss its target by this share of a piece's bytes.
TOLERANCE = 0.005
PROBES, ALL_PROBES = 255, 200_000
PIECE_BYTES = 128 << 20
#: Beyond MOST_PIECES pieces grow, and a task sorts its piece through spill files.
LEAST_PIECES, MOST_PIECES = 32, 16_384
_LOW, _HIGH = -(2**63), 2**63 - 1


KEYS = ("hash", "id", "position")
Group = tuple[int, ...]


def _sums(rows: DataFrame, probes: dict[Group, np.ndarray]) -> dict[Group, np.ndarray]:
    """Exact (bytes, rows) of each group below each of its probes, and in all: a histogram in every partition, added up
    by Spark. A group is the values of the first keys; probes are values of the next one."""
    groups = sorted(probes)
    level = len(groups[0])
    first = np.cumsum([0, *(len(probes[g]) + 1 for g in groups)])

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, first[-1]), np.int64)
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in range(level + 1)]
            size = batch.column(level + 1).to_numpy()
            for k, own in _members(groups, keys[:level], len(size)):
                place = first[k] + np.searchsorted(probes[groups[k]], keys[level][own], "right")
                np.add.at(total[0], place, size[own])
                total[1] += np.bincount(place, minlength=total.shape[1])
        full = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(total[0][full]), pa.array(total[1][full])], names=["place", "bytes", "n"])

    own = rows.select(*KEYS[: level + 1], "size")
    if level:
        own = own.where(F.col("hash").isin(sorted({g[0] for g in groups})))  # at most one group a splitter
    out = np.zeros((2, first[-1]), np.int64)
    for place, size, n in own.mapInArrow(histogram, "place int, bytes long, n long").groupBy("place").agg(F.sum("bytes"), F.sum("n")).collect():
        out[:, place] = size, n  # one row a probe
    return {g: out[:, first[k] : first[k + 1]].cumsum(axis=1) for k, g in enumerate(groups)}


def _members(groups: list[Group], keys: list[np.ndarray], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the group, its rows) for every one of the sorted groups that has rows."""
    if not keys:
        yield 0, np.arange(n)
        return
    heads = np.array([g[0] for g in groups], np.int64)
    low, high = np.searchsorted(heads, keys[0], "left"), np.searchsorted(heads, keys[0], "right")
    near = np.flatnonzero(high > low)
    near = near[np.argsort(low[near], kind="stable")]
    for some in np.split(near, np.flatnonzero(np.diff(low[near])) + 1) if len(near) else []:
        for k in range(low[some[0]], high[some[0]]):
            rows = some
            for level in range(1, len(keys)):
                rows = rows[keys[level][rows] == groups[k][level]]
            if len(rows):
                yield k, rows


@dataclass
class _Sought:
    """A target in bytes from the start of its group; a row is below a boundary if its key is smaller. ``low`` and
    ``high`` are the nearest boundaries on either side, with the bytes and rows of the group below them."""

    number: int
    group: Group
    target: float
    low: int
    below: int
    rows_below: int
    high: int
    upto: int
    rows_upto: int

    @property
    def rows(self) -> int:
        return self.rows_upto - self.rows_below

    def miss(self) -> float:
        return min(abs(self.target - self.below), abs(self.upto - self.target))


def _search(rows: DataFrame, sought: list[_Sought], slack: float) -> None:
    """Narrows every one until a boundary is within ``slack``, one row is left, or no key lies between."""
    share = max(1, ALL_PROBES // max(1, len(sought)))
    while True:
        probes: dict[Group, set[int]] = {}
        for s in sought:
            if s.miss() > slack and s.rows > 1 and s.high - s.low > 1:
                n = min(PROBES, share, s.high - s.low - 1)
                probes.setdefault(s.group, set()).update(s.low + (s.high - s.low) * (i + 1) // (n + 1) for i in range(n))
        if not probes:
            return
        order = {g: np.array(sorted(x), np.int64) for g, x in probes.items()}
        sums = _sums(rows, order)
        for s in sought:
            if s.group not in order:
                continue
            edges, (size, count) = order[s.group], sums[s.group]
            first, end = int(np.searchsorted(edges, s.low, "right")), int(np.searchsorted(edges, s.high, "left"))
            cut = first + int(np.searchsorted(size[first:end], s.target, "right"))
            if cut < end:
                s.high, s.upto, s.rows_upto = int(edges[cut]), int(size[cut]), int(count[cut])
            if cut > first:
                s.low, s.below, s.rows_below = int(edges[cut - 1]), int(size[cut - 1]), int(count[cut - 1])


def splitters(rows: DataFrame, parts: int) -> tuple[list[tuple[int, ...]], bool]:
    """parts - 1 boundaries (hash, id, position) that cut the rows into near equal bytes, in order; and whether rows
    that no key parts span a boundary, so that positions are needed and missing."""
    count, total, least, most = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.min("hash"), F.max("hash")).first()
    if not count:
        return [(_HIGH, _HIGH, _HIGH)] * (parts - 1), False
    levels = [k for k in KEYS if k in rows.columns]
    slack = TOLERANCE * total / parts
    out: list[tuple[int, ...]] = [()] * (parts - 1)
    sought = [_Sought(k, (), total * (k + 1) / parts, least, 0, 0, most + 1, total, count) for k in range(parts - 1)]
    open_: list[_Sought] = []
    for level in range(len(levels)):
        _search(rows, sought, slack)
        open_ = []
        for s in sought:
            best = s.low if s.target - s.below <= s.upto - s.target else s.high
            out[s.number] = (*s.group, best, *[_LOW] * (len(KEYS) - level - 1))
            if s.miss() > slack and s.rows > 1:  # all rows between share the key ``low``
                open_.append(s)
        if not open_ or level + 1 == len(levels):
            break
        wanted = sorted({(*s.group, s.low) for s in open_})
        ends = rows.where(F.col("hash").isin(sorted({g[0] for g in wanted}))).groupBy(*KEYS[: level + 1])
        ends = ends.agg(F.min(levels[level + 1]), F.max(levels[level + 1]), F.count("*"), F.sum("size"))
        if level:
            ends = ends.where(F.col("id").isin(sorted({g[1] for g in wanted})))
        at = {tuple(r)[: level + 1]: tuple(r)[level + 1 :] for r in ends.collect() if tuple(r)[: level + 1] in set(wanted)}
        sought = []
        for s in open_:
            low, high, n, size = at[(*s.group, s.low)]
            sought.append(_Sought(s.number, (*s.group, s.low), s.target - s.below, low, 0, 0, high + 1, size, n))
    return sorted(out), bool(open_)


def _places(cuts: list[tuple[int, ...]], keys: list[np.ndarray]) -> np.ndarray:
    """The piece of each row: how many splitters are at or below it."""
    edges = np.array(cuts, np.int64).reshape(-1, len(KEYS))
    out = np.searchsorted(edges[:, 0], keys[0], "right")
    groups = sorted({(c[0],) for c in cuts})
    for k, own in _members(groups, keys[:1], len(out)):
        first = np.searchsorted(edges[:, 0], groups[k][0], "left")
        inner = [c for c in cuts if c[0] == groups[k][0]]
        ids = np.array([c[1] for c in inner], np.int64)
        out[own] = first + np.searchsorted(ids, keys[1][own], "right")
        if len(keys) < len(KEYS):
            continue
        parted = sorted({(c[1],) for c in inner if c[2] != _LOW})
        for j, some in _members(parted, [keys[1][own]], len(own)) if parted else ():
            start = np.searchsorted(ids, parted[j][0], "left")
            places = np.array([c[2] for c in inner if c[1] == parted[j][0]], np.int64)
            out[own[some]] = first + start + np.searchsorted(places, keys[2][own[some]], "right")
    return out


def sharded(docs: DataFrame, folder: str, shards: int = SHARDS) -> DataFrame:
    """Writes all rows, with ``shard`` and ``slot``, in order as Parquet under ``folder``; returns them as read back."""
    spark = docs.sparkSession
    plain = [c for c in docs.columns if c not in ("shard", "slot")]
    free = _free_names(docs.columns)
    text = F.col("text").cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    hash_ = F.when(text.isNull(), F.lit(_LOW)).otherwise(F.greatest(F.xxhash64(text), F.lit(_LOW + 1)))
    keys = {"hash": hash_, "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW))}

    def slim(frame: DataFrame) -> DataFrame:
        return written(frame.select(*(c.alias(k) for k, c in keys.items()), size.alias("size")), "shard-keys")

    source, rows = docs, slim(docs)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    each = -(-min(MOST_PIECES, max(LEAST_PIECES, -(-total // PIECE_BYTES))) // shards)
    cuts, parted = splitters(rows, shards * each)
    if parted:
        source = written(docs.select(*plain, F.monotonically_increasing_id().alias(free("position"))), "numbered")
        keys["position"] = F.xxhash64(F.col(free("position")))
        rows = slim(source)
        cuts, _ = splitters(rows, shards * each)
    names = list(keys)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(cuts) + 1, np.int64)
        for batch in batches:
            total += np.bincount(_places(cuts, [c.to_numpy() for c in batch.columns]), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["piece", "n"])

    rows_in = np.zeros(len(cuts) + 1, np.int64)
    for piece, n in rows.select(*names).mapInArrow(pieces, "piece int, n long").groupBy("piece").agg(F.sum("n")).collect():
        rows_in[piece] = n
    by_shard = rows_in.reshape(shards, each)
    bases = np.concatenate([np.zeros((shards, 1), np.int64), by_shard.cumsum(axis=1)[:, :-1]], axis=1).ravel()

    keyed = source.select(*plain, *(c.alias(free(k)) for k, c in keys.items()))
    at = range(len(plain), len(plain) + len(keys))
    piece, base, own = free("piece"), free("base"), free("own")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            placed = pa.array(_places(cuts, [batch.column(k).to_numpy() for k in at]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, placed], names=[*batch.schema.names, piece])

    dealt = keyed.mapInArrow(deal, StructType([*keyed.schema.fields, StructField(piece, IntegerType())]))
    starts = spark.createDataFrame([(k, k // each, int(b)) for k, b in enumerate(bases)], f"`{piece}` int, shard int, `{base}` long")
    order = Window.partitionBy(piece).orderBy(*(free(k) for k in keys))
    dealt.withColumn(own, F.row_number().over(order)).join(F.broadcast(starts), piece).withColumn(
        "slot", F.col(base) + F.col(own) - 1
    ).select(*plain, "slot", "shard").write.partitionBy("shard").parquet(folder)
    return spark.read.schema(StructType([*docs.select(*plain).schema.fields, StructField("slot", LongType()), StructField("shard", IntegerType())])).parquet(folder)


def _free_names(columns: list[str]) -> Callable[[str], str]:
    """Helper names that no column has, in any case."""
    taken, mark = {c.lower() for c in columns}, "__"
    while any(c.startswith(mark) for c in taken):
        mark += "_"
    return lambda name: mark + name


def op1_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = sharded(docs, scratch(spark, "shards"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
