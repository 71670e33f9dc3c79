"""Operator 10: n-gram Jaccard join with PartEnum signatures.

A document's set are its distinct five-word shingles; two sets link at Jaccard 0.8 or more.

* Size bands: band c holds the sizes LO[c] .. LO[c+1]-1, each a quarter wider than the last. A set
  signs in its own band, and in the next one if it is large enough to link with a set there.
* In a band with largest size h, linked sets differ in at most k = 2h/9 elements. The hashed domain
  is dealt into n1 groups of n2 cells with n1 = ceil((k+1)/(k2+1)): some group then holds at most
  k2 of the differences, so some n2-k2 of its cells agree whole. Each choice of n2-k2 cells of a
  group is one signature: the sum of its elements' hashes.
* An empty projection says nothing. Bands with fewer than DROP_EMPTY groups keep it; larger bands
  leave it out: a pair would need all its agreeing groups empty, less likely than 1e-10.
* Signatures are dealt by hash as packed arrays. Equal sets sign alike and count once.
* Sets that share a signature link first to the one their bucket starts with (a star, not all
  pairs): the best such link of each set, then the others that would join two components. Buckets
  whose members are then still in several components give the pairs across them.
* A parity sketch of each set bounds the difference of two sets from below, so it drops only pairs
  that can't link. Every pair that is left is verified on whole texts.

Defined cases: null, empty or white texts have no shingles and their own doc_id as component;
fewer than five words make one shingle; repeated doc_ids are kept row by row and link by their
texts; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, is_small, written
from .textvec import mix, shingles

WORDS = 5
PERCENT = 80
NO_ID = -(2**63)
DROP_EMPTY = 32
SKETCH_BITS = 1024
#: Packed signatures are handed on when a task holds so many.
HELD = 600_000
_ODD = [np.array([x], np.uint64) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_POSITIONS = np.concatenate(_ODD)


def band_edges(largest: int = 1 << 40) -> list[int]:
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4 + (out[-1] * 5 % 4 > 0)))
    return out


LO = band_edges()


class Band:
    """Groups, cells and cell choices of one size band."""

    def __init__(self, c: int):
        k = 2 * (LO[c + 1] - 1) // 9
        k2, n2 = (0, 1) if k == 0 else (min(k, 3), 7) if k <= 20 else (2, 5) if k < 64 else (1, 3)
        self.n1, self.n2 = math.ceil((k + 1) / (k2 + 1)), n2
        self.choices = [list(c) for c in combinations(range(n2), n2 - k2)]
        self.drop_empty = self.n1 >= DROP_EMPTY
        self.seed = np.array([c + 1], np.uint64) * _ODD[1]

    def sign(self, items: np.ndarray) -> np.ndarray:
        h = mix(items + self.seed)
        cell = ((h >> np.uint64(32)) * np.uint64(self.n1 * self.n2) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(self.n1 * self.n2, np.uint64)
        np.add.at(sums, cell, h)
        sums = sums.reshape(self.n1, self.n2)
        group = np.arange(self.n1, dtype=np.uint64) * _ODD[2] + self.seed
        mixed, empty = mix(sums + _POSITIONS[: self.n2]), sums == 0
        out = []
        for j, choice in enumerate(self.choices):
            total = mix(mixed[:, choice].sum(axis=1, dtype=np.uint64) + group + np.array([j], np.uint64) * _ODD[3])
            out.append(total[~empty[:, choice].all(axis=1)] if self.drop_empty else total)
        return np.concatenate(out)


_BANDS: dict[int, Band] = {}


def signatures(items: np.ndarray) -> np.ndarray:
    """All signatures of a set (sorted distinct hashes, not empty)."""
    n = len(items)
    c = int(np.searchsorted(LO, n, "right")) - 1
    out = []
    for b in (c, c + 1) if 100 * n >= PERCENT * LO[c + 1] else (c,):
        if b not in _BANDS:
            _BANDS[b] = Band(b)
        out.append(_BANDS[b].sign(items))
    return np.concatenate(out)


def set_key(items: np.ndarray) -> int:
    """A 63-bit key of a set; -1 for the empty set."""
    if not len(items):
        return -1
    total = mix(mix(items).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(items)))
    return int(total[0] >> np.uint64(1))


def _rows(docs: DataFrame) -> DataFrame:
    """Id and text; a null doc_id counts as the smallest number until the result."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def shingled(docs: DataFrame) -> DataFrame:
    """A written table (doc_id, text_hash, n_shingles, key) of every document."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, keys = [], []
            for text in batch.column("text"):
                items = shingles(text.as_py(), WORDS)
                ns.append(len(items))
                keys.append(set_key(items))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(ns, pa.int64()), pa.array(keys, pa.int64())], names=["doc_id", "text_hash", "n_shingles", "key"]
            )

    return written(_rows(docs).mapInArrow(sets, "doc_id long, text_hash long, n_shingles long, key long"), "sets")


def _packed(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, sigs, keys): a task's signatures dealt by hash, as two arrays of 64-bit numbers."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs: list[np.ndarray] = []
        keys: list[int] = []
        held = 0

        def out() -> pa.RecordBatch:
            all_sigs = np.concatenate(sigs)
            all_keys = np.repeat(np.array(keys, np.int64), [len(s) for s in sigs])
            bucket = (all_sigs % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            all_sigs, all_keys = all_sigs[order], all_keys[order]
            at = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(at))
            cuts = [(int(at[b]), int(at[b + 1])) for b in full]
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([all_sigs[i:j].tobytes() for i, j in cuts], pa.binary()), pa.array([all_keys[i:j].tobytes() for i, j in cuts], pa.binary())],
                names=["bucket", "sigs", "keys"],
            )

        seen: set[int] = set()
        for batch in batches:
            for text in batch.column("text"):
                items = shingles(text.as_py(), WORDS)
                key = set_key(items)
                if key < 0 or key in seen:  # copies within a task sign once; others meet in their bucket
                    continue
                if len(seen) < 200_000:
                    seen.add(key)
                sigs.append(signatures(items))
                keys.append(key)
                held += len(sigs[-1])
                if held >= HELD:
                    yield out()
                    sigs, keys, held = [], [], 0
        if sigs:
            yield out()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(sign, "bucket int, sigs binary, keys binary")


def _collisions(pdf: pd.DataFrame) -> pd.DataFrame:
    """Member sets of size two and more of one bucket's signatures, each once, with how many share it."""
    sigs = np.frombuffer(b"".join(pdf["sigs"]), np.uint64)
    keys = np.frombuffer(b"".join(pdf["keys"]), np.int64)
    order = np.lexsort((keys, sigs))
    sigs, keys = sigs[order], keys[order]
    fresh = np.ones(len(sigs), bool)
    fresh[1:] = (sigs[1:] != sigs[:-1]) | (keys[1:] != keys[:-1])
    sigs, keys = sigs[fresh], keys[fresh]
    begin = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
    sizes = np.diff(np.concatenate([begin, [len(sigs)]]))
    many = sizes > 1
    found: dict[bytes, int] = {}
    for i, n in zip(begin[many].tolist(), sizes[many].tolist(), strict=True):
        members = keys[i : i + n].tobytes()
        found[members] = found.get(members, 0) + 1
    members = pd.Series([np.frombuffer(m, np.int64).tolist() for m in found], dtype=object)
    return pd.DataFrame({"members": members, "shared": pd.Series(list(found.values()), dtype="int64")})


def sketch(items: np.ndarray) -> np.ndarray:
    """For each of SKETCH_BITS hash classes, whether the set has an odd number of elements there, as 64-bit words.

    Sets that differ in d elements have sketches that differ in at most d bits.
    """
    odd = np.bincount((mix(items ^ _ODD[4]) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _of_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds sketches; drops texts that only share a repeated doc_id with the set's own text."""
    for batch in batches:
        sets = [shingles(t.as_py(), WORDS) for t in batch.column("text")]
        own = [set_key(x) == k for x, k in zip(sets, batch.column("key").to_pylist(), strict=True)]
        out = pa.RecordBatch.from_arrays([*batch.columns, pa.array([sketch(x) for x in sets], pa.list_(pa.int64()))], names=[*batch.schema.names, "sketch"])
        yield out.filter(pa.array(own, pa.bool_()))


def _can_link(a: str, b: str) -> Column:
    """Exact bounds: linked sets differ in at most (n_a + n_b) / 9 elements, and in size by a fifth."""
    words = [F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH_BITS // 64)]
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (100 * small >= PERCENT * large) & (9 * sum(words[1:], words[0]) <= small + large)


def _verified(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of keys those with Jaccard >= 0.8; ``keyed`` has (key, text), one row a key."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            left, right = batch.column("text_a"), batch.column("text_b")
            good = []
            for x, y in zip(left, right, strict=True):
                x = x.as_py()
                if x != last[0]:
                    last = (x, shingles(x, WORDS))
                other = shingles(y.as_py(), WORDS)
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                good.append(100 * both >= PERCENT * (len(last[1]) + len(other) - both))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    a = keyed.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    b = keyed.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def linked(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, text_hash, component) of all documents; the last is a key of the component."""
    spark = docs.sparkSession
    slim = shingled(docs)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = written(
        _packed(docs, buckets).groupBy("bucket").applyInPandas(_collisions, "members array<long>, shared long"), "collisions"
    )
    stars = written(
        shared.select(F.col("members")[0].alias("a"), F.explode(F.slice("members", 2, F.size("members"))).alias("b"), "shared")
        .groupBy("a", "b")
        .agg(F.sum("shared").alias("shared")),
        "stars",
    )

    # texts of the sets that met another one, one row a set
    met = written(stars.select(F.col("a").alias("key")).union(stars.select(F.col("b").alias("key"))).distinct(), "met")
    first = slim.where("key >= 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    chosen = first.join(met, "key", "left_semi")
    if is_small(met):
        chosen = F.broadcast(chosen)
    candidates = _rows(docs).join(chosen, "doc_id").select("key", "n", "text").mapInArrow(_of_key, "key long, n long, text string, sketch array<long>")
    keyed = written(candidates.dropDuplicates(["key"]), "candidate-texts")

    sketched = keyed.select("key", "n", "sketch")
    hopeful = written(
        stars.join(sketched.alias("x"), F.col("a") == F.col("x.key"))
        .join(sketched.alias("y"), (F.col("b") == F.col("y.key")) & _can_link("x", "y"))
        .select("a", "b", "shared"),
        "hopeful-stars",
    )
    best = hopeful.groupBy("b").agg(F.max_by("a", F.struct("shared", F.col("a") * -1)).alias("a")).select("a", "b")
    tried, edges = best, written(_verified(best, keyed), "links")
    parts = components(edges)

    def label(keys: DataFrame, key: str, name: str) -> DataFrame:
        named = parts.select(F.col("id").alias(key), F.col("component_id").alias(name))
        return keys.join(named, key, "left").withColumn(name, F.coalesce(name, key))

    # the other star links, where they would join two components
    others = label(label(hopeful.join(tried, ["a", "b"], "left_anti"), "a", "part_a"), "b", "part_b").where("part_a <> part_b").select("a", "b")
    others = written(others, "other-stars")
    if not others.isEmpty():
        tried, edges = tried.union(others), written(edges.union(_verified(others, keyed)), "links")
        parts = components(edges)

    # pairs of different components in one bucket
    open_ = shared.where(F.size("members") > 2).withColumn("bucket", F.xxhash64("members")).dropDuplicates(["bucket"])
    rows = label(open_.select("bucket", F.explode("members").alias("key")), "key", "part")
    mixed = rows.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("bucket")
    left = written(rows.join(mixed, "bucket", "left_semi").join(sketched, "key"), "open-buckets")
    x, y = left.alias("x"), left.alias("y")
    across = (
        x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & F.expr("x.part < y.part") & _can_link("x", "y"))
        .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))
        .distinct()
        .join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    )
    more = written(_verified(across, keyed), "links")
    whole = parts if more.isEmpty() else components(edges.union(more))

    grouped = slim.join(whole.withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component_id", "key"))
    lowest = grouped.where("key >= 0").groupBy("component").agg(F.min("doc_id").alias("low"))
    component = F.when(F.col("key") >= 0, F.col("low")).otherwise(F.col("doc_id"))
    return (
        grouped.drop("component_id")
        .join(lowest, "component", "left")
        .select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif(component, F.lit(NO_ID)).alias("component_id"), "text_hash", "component")
    )


def op10_partenum_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash", "component")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, the one that names it, with all columns; wordless documents stay.

    Of repeated doc_ids that name a component, the text with the smallest hash stays, once.
    """
    rows = written(linked(docs), "components").where("n_shingles > 0")
    names = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = rows.where(names).groupBy("component").agg(F.min("text_hash").alias("first"))
    stays = names & (F.col("text_hash") == F.col("first"))
    gone = written(rows.join(first, "component").where(~stays).select("doc_id", "text_hash").distinct(), "copies")
    again = written(rows.where(names).groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash"), "repeats")

    keyed = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__hash", F.xxhash64(F.col("text").cast("string")))
    on = lambda right: F.col("__id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col("__hash") == F.col(f"{right}.text_hash"))
    small = lambda keys, name: (F.broadcast(keys) if is_small(keys) else keys).alias(name)
    left = keyed.join(small(gone, "gone"), on("gone"), "left_anti")
    if not again.isEmpty():
        twice = small(again, "again")
        left = left.join(twice, on("again"), "left_anti").unionByName(left.join(twice, on("again"), "left_semi").dropDuplicates(["__id", "__hash"]))
    return left.drop("__id", "__hash")
