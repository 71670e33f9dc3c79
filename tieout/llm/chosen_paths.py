"""Operator 12: MinHash near-duplicates by a chosen-path similarity join.

A document's set are its distinct five-word shingles; two sets link at Jaccard 0.85 or more.

* Every set is read once for its key and its minwise tokens (the least element under each of POOL
  hashes, LEVELS times). Equal sets count once from here on.
* TREES independent trees are grown level by level over all sets. A root branches by ROOT hashes of
  its own, an inner node by INNER of its level's hashes, chosen by its id; each of its sets goes to the
  children that its minwise tokens of those hashes name. At Jaccard s a pair shares a child with
  probability s. At 0.85 a branch of a root loses a pair with 0.15 + 0.85 * 0.0286 = 0.174 (down to
  the last level), all twelve of the four trees with 0.174^12 = 8e-10.
* A node of up to LEAF sets compares all its pairs. A larger one compares its sets with one of them
  (the least hash of node and set) and branches again, unless its sets are one component already.
  What is still larger after LEVELS levels compares all its pairs too, block by block.
* A comparison bounds the difference of two sets from below by sizes and parity sketches, exactly, and
  counts equal minwise tokens of all 48: under AGREE a pair at 0.85 falls with a probability of 2e-9.
* Of the pairs that may link, a node first hands on a forest, the most alike first, not all of a group.
  They are confirmed on whole sets; then nodes that still hold several components hand on every pair
  across them. So no pair is lost, and a group of copies costs a multiple of its size.

Keys and components that many rows share are named by a broadcast table that can't be large (each of
its entries stands for a millionth of all rows and more), the others by a plain join.

Defined cases: null, empty or white texts have no shingles and their own doc_id as component; fewer
than five words make one shingle; repeated doc_ids are kept row by row and link by their texts; a
null doc_id counts as the smallest number; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, table, written
from .jaccard import set_key, sketch
from .textvec import mix, shingles

WORDS, PERCENT = 5, 85
NO_ID = -(2**63)
#: Trees, hashes a tree's root branches by, those an inner node branches by, and levels.
TREES, ROOT, INNER, LEVELS = 4, 3, 2, 4
POOL = TREES * ROOT
HASHES = POOL * LEVELS
AGREE = 24
#: Sets of a node that are compared together, of one that is compared in blocks, and of a block.
SMALL, LEAF, BLOCK = 32, 1_024, 2_048
#: Odd multipliers, one a hash.
_TURNS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def tokens(items: np.ndarray) -> np.ndarray:
    """The minwise token of a set under each hash, 32 bits of it, and the set's parity sketch; nothing for the empty set."""
    if not len(items):
        return np.zeros(0, np.int32)
    out = np.array([(items * _TURNS[k : k + 1]).min() for k in range(HASHES)], np.uint64)
    return np.concatenate([mix(out).astype(np.uint32).view(np.int32), sketch(items).view(np.int32)])


def signed(docs: DataFrame) -> DataFrame:
    """A written table (doc_id, text_hash, n, key, tokens) of every document; key -1 without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, keys, mins = [], [], []
            for text in batch.column("text"):
                items = shingles(text.as_py(), WORDS)
                ns.append(len(items))
                keys.append(set_key(items))
                mins.append(tokens(items).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(ns, pa.int64()), pa.array(keys, pa.int64()), pa.array(mins, pa.binary())],
                names=["doc_id", "text_hash", "n", "key", "tokens"],
            )

    return written(_rows(docs).mapInArrow(sign, "doc_id long, text_hash long, n long, key long, tokens binary"), "signed")


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _token(k: Column) -> Column:
    return F.substring("tokens", 4 * k + 1, F.lit(4))


def _children(members: DataFrame, level: int) -> DataFrame:
    """Rows (node, ...) one level down; ``members`` has (node, tokens, ...), of level 0 no node."""
    if not level:
        chosen, above = [F.lit(k) for k in range(POOL)], F.lit(0).cast("long")
    else:
        start = F.pmod(F.col("node"), F.lit(POOL // INNER)).cast("int") + POOL * level
        chosen, above = [start + POOL // INNER * b for b in range(INNER)], F.col("node")
    names = F.array(*(F.xxhash64(above, k, _token(k)) for k in chosen))
    return members.withColumn("node", F.explode(names))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), -1)


def _alike(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which rows may link, equal tokens): sizes and sketches bound the difference, tokens estimate the rest."""
    same = (left[:, :HASHES] == right[:, :HASHES]).sum(axis=1)
    odd = np.bitwise_count((left[:, HASHES:] ^ right[:, HASHES:]).view(np.uint32)).sum(axis=1, dtype=np.int64)
    sized = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    return sized & (same >= AGREE) & ((100 + PERCENT) * odd <= (100 - PERCENT) * (n + m)), same


def _batch(a: np.ndarray, b: np.ndarray, same: np.ndarray) -> pa.RecordBatch:
    columns = (np.minimum(a, b), np.maximum(a, b), same)
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["a", "b", "same"])


class _Forest:
    """Names of groups that grow together; of pairs it tells those that join two groups."""

    def __init__(self):
        self.above: dict[tuple, tuple] = {}

    def name(self, x: tuple) -> tuple:
        while x in self.above:
            x = self.above[x]
        return x

    def joins(self, x: tuple, y: tuple) -> bool:
        x, y = self.name(x), self.name(y)
        if x == y:
            return False
        self.above[x] = y
        return True


def _node_pairs(every: bool):
    """Pairs (a, b, same) of the sets of each node, sorted by node and at most SMALL of one: all that may
    link across components, or of each node so many, the most alike first, that they hold it together."""

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        node, key, n, part = (rows.column(c).to_numpy() for c in ("node", "key", "n", "part"))
        signs = _matrix(rows.column("tokens"))
        left, right, sames = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(1, SMALL):
            at = np.flatnonzero(node[:-step] == node[step:])
            if not len(at):
                break
            at = at[part[at] != part[at + step]]
            good, same = _alike(signs[at], signs[at + step], n[at], n[at + step])
            left.append(at[good])
            right.append(at[good] + step)
            sames.append(same[good])
        i, j, same = (np.concatenate(x) for x in (left, right, sames))
        if not every:
            order = np.argsort(-same, kind="stable")
            i, j, same = i[order], j[order], same[order]
            forest = _Forest()
            ends = zip(node[i].tolist(), part[i].tolist(), part[j].tolist(), strict=True)
            keep = np.fromiter((forest.joins((v, x), (v, y)) for v, x, y in ends), bool, len(i))
            i, j, same = i[keep], j[keep], same[keep]
        return _batch(key[i], key[j], same)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, rows]) if held else rows
            node = held.column("node").to_numpy()
            cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
            if cut:
                yield pairs(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
        if held and held.num_rows:
            yield pairs(held)

    return stream


def _with_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, pivot, n, m = (batch.column(c).to_numpy() for c in ("key", "pivot", "n", "pivot_n"))
        good, same = _alike(_matrix(batch.column("tokens")), _matrix(batch.column("pivot_tokens")), n, m)
        good &= key != pivot
        yield _batch(key[good], pivot[good], same[good])


_PAIRS = "a long, b long, same long"


def _named(rows: DataFrame, names: DataFrame, on: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` join ``names`` (on, ..., rows); names of very many rows by broadcast, at most a million of ``total``."""
    many = F.col("rows") > max(1_000, total // 1_000_000)
    hot, cold = names.where(many).drop("rows"), names.where(~many).drop("rows")
    split = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(cold, on, how)
    return rows.join(F.broadcast(hot), on).unionByName(split)


def _mixed(members: DataFrame, total: int) -> DataFrame:
    """Members (node, key, part) of the nodes with several components, with the node's size and pivot."""
    least = F.min(F.struct(F.xxhash64("node", "key").alias("h"), "key")).getField("key")
    sizes = members.groupBy("node").agg(F.count("*").alias("rows"), least.alias("pivot"), F.min("part").alias("low"), F.max("part").alias("high"))
    sizes = written(sizes.where("low < high").select("node", "rows", "pivot", F.col("rows").alias("size")), "node-sizes")
    return written(_named(members, sizes, "node", total, "inner"), "open-nodes")


def _in_nodes(open_: DataFrame, sets: DataFrame, every: bool) -> DataFrame:
    rows = open_.where(F.col("size") <= SMALL).join(sets, "key").select("node", "key", "part", "n", "tokens")
    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(_node_pairs(every), _PAIRS)


def _with_pivots(open_: DataFrame, sets: DataFrame, total: int) -> DataFrame:
    large = open_.where(F.col("size") > LEAF)
    pivots = large.groupBy("node", "pivot").agg(F.count("*").alias("rows"))
    pivots = pivots.join(sets.select(F.col("key").alias("pivot"), F.col("n").alias("pivot_n"), F.col("tokens").alias("pivot_tokens")), "pivot")
    star = _named(large.select("node", "key").join(sets, "key"), pivots, "node", total, "inner")
    return star.select("key", "n", "tokens", "pivot", "pivot_n", "pivot_tokens").mapInArrow(_with_pivot, _PAIRS)


def _against_blocks(every: bool):
    """Pairs (a, b, same) of each block's own rows, which come first, with the rows that pass by."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, own, forest = None, {}, _Forest()
        for batch in batches:
            node, number = batch.column("node").to_numpy(), batch.column("block").to_numpy()
            cuts = np.flatnonzero((node[1:] != node[:-1]) | (number[1:] != number[:-1])) + 1
            for i, j in zip([0, *cuts], [*cuts, len(node)], strict=True):
                if i == j:
                    continue
                some = batch.slice(i, j - i)
                here = {c: some.column(c).to_numpy() for c in ("key", "n", "part", "met")} | {"signs": _matrix(some.column("tokens"))}
                if block != (node[i], number[i]):
                    block, forest = (node[i], number[i]), _Forest()
                    own = {c: x[:0] for c, x in here.items()}
                first = here["met"] == 0
                own = {c: np.concatenate([x, here[c][first]]) for c, x in own.items()}
                out = [(own["key"][:0],) * 3]
                for k in np.flatnonzero(~first):
                    now = int(here["part"][k])
                    at = np.flatnonzero(own["part"] != now)
                    good, same = _alike(own["signs"][at], here["signs"][k : k + 1], own["n"][at], here["n"][k : k + 1])
                    at, same = at[good], same[good]
                    if not every:
                        keep = np.fromiter((forest.joins((now,), (x,)) for x in own["part"][at].tolist()), bool, len(at))
                        at, same = at[keep], same[keep]
                    out.append((own["key"][at], np.full(len(at), here["key"][k]), same))
                yield _batch(*(np.concatenate(c) for c in zip(*out, strict=True)))

    return stream


def _in_blocks(open_: DataFrame, sets: DataFrame, total: int, every: bool) -> DataFrame:
    """Pairs of different components in nodes of more than SMALL sets, in blocks of about BLOCK sets.

    A block of sets stands in memory, the sets of its own and the later blocks pass by. Nodes with equal
    members count once.
    """
    open_ = open_.where(F.col("size") > SMALL).drop("size")
    once = open_.groupBy("node").agg(F.count("*").alias("size"), F.sum(F.xxhash64("key").cast("decimal(20,0)")).alias("members"))
    once = written(once.groupBy("size", "members").agg(F.min("node").alias("node")).select("node", "size", F.col("size").alias("rows")), "block-nodes")
    rows = _named(open_, once, "node", total, "inner").join(sets, "key").withColumn("own", F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / BLOCK)).cast("int"))
    kept = ["node", "key", "part", "n", "tokens"]
    own = rows.select(*kept, F.col("own").alias("block"), F.lit(0).alias("met"))
    met = rows.select(*kept, F.explode(F.sequence(F.lit(0), "own")).alias("block"), F.lit(1).alias("met"))
    dealt = own.union(met).repartition("node", "block").sortWithinPartitions("node", "block", "met")
    return dealt.mapInArrow(_against_blocks(every), _PAIRS)


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops texts that only share a repeated doc_id and text hash with the set's own text."""
    for batch in batches:
        own = [set_key(shingles(t.as_py(), WORDS)) == k for t, k in zip(batch.column("text"), batch.column("key").to_pylist(), strict=True)]
        yield batch.filter(pa.array(own, pa.bool_()))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
    for batch in batches:
        good = []
        for x, y in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
            x = x.as_py()
            if x != last[0]:
                last = (x, shingles(x, WORDS))
            other = shingles(y.as_py(), WORDS)
            both = len(np.intersect1d(last[1], other, assume_unique=True))
            good.append(100 * both >= PERCENT * (len(last[1]) + len(other) - both))
        yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])


class _Links:
    """Confirmed links so far and the components they make."""

    def __init__(self, docs: DataFrame, bases: DataFrame):
        self.docs, self.bases, self.edges, self.parts, self.tried = docs, bases, None, None, None

    def part(self, keys: DataFrame, key: str = "key", name: str = "part") -> DataFrame:
        keys = keys.drop(name)
        if self.parts is None:
            return keys.withColumn(name, F.col(key))
        named = self.parts.select(F.col("id").alias(key), F.col("component_id").alias(name))
        return keys.join(named, key, "left").withColumn(name, F.coalesce(name, key))

    def add(self, pairs: DataFrame, every: bool = True) -> None:
        """Confirms the pairs (a, b, same) that weren't tried before, or one pair, the most alike, of two components."""
        if not every:
            best = F.max_by(F.struct("a", "b"), F.struct("same", "a", "b")).alias("pair")
            pairs = self.part(self.part(pairs, "a", "part_a"), "b", "part_b").groupBy(F.least("part_a", "part_b"), F.greatest("part_a", "part_b")).agg(best).select("pair.*")
        pairs = pairs.select("a", "b").distinct()
        pairs = written(pairs if self.tried is None else pairs.join(self.tried, ["a", "b"], "left_anti"), "candidate-pairs")
        if pairs.isEmpty():
            return
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        met = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
        chosen = self.bases.join(met, "key", "left_semi").select("key", "doc_id", "text_hash")
        texts = _rows(self.docs).join(chosen, ["doc_id", "text_hash"]).select("key", "text").mapInArrow(_own_text, "key long, text string")
        texts = written(texts.dropDuplicates(["key"]), "candidate-texts")
        a, b = (texts.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
        found = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long")
        found = written(found, "links")
        if not found.isEmpty():
            self.edges = found if self.edges is None else self.edges.union(found)
            self.parts = written(components(self.edges), "components")


def linked(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) of all documents."""
    slim = signed(docs)
    total = slim.count()
    first = F.min(F.struct("doc_id", "text_hash", "n", "tokens")).alias("first")
    bases = slim.where("key >= 0").groupBy("key").agg(first, F.count("*").alias("rows"))
    bases = written(bases.select("key", "first.*", "rows"), "distinct-sets")
    links, sets = _Links(docs, bases), bases.select("key", "n", "tokens")

    def pairs(nodes: DataFrame, every: bool) -> DataFrame:
        return _in_nodes(nodes, sets, every).union(_in_blocks(nodes, sets, POOL * total, every))

    # what holds each node together, level by level
    members = _children(sets.select("key", "tokens", F.col("key").alias("part")), 0).select("node", "key", "part")
    leaf, leaves = F.col("size") <= LEAF, []
    for level in range(1, LEVELS + 1):
        nodes = _mixed(members, POOL * total)
        leaves.append(nodes.where(leaf).select("node", "key"))
        links.add(pairs(nodes if level == LEVELS else nodes.where(leaf), False).union(_with_pivots(nodes, sets, POOL * total)), every=False)
        large = nodes.where(~leaf).select("node", "key")
        if large.isEmpty():
            break
        if level == LEVELS:
            leaves.append(large)
            break
        large = _mixed(links.part(large), POOL * total).select("node", "key", "part")
        members = written(_children(large.join(sets, "key"), level).select("node", "key", "part").distinct(), "members")

    # what may still link between components
    links.add(pairs(_mixed(links.part(reduce(DataFrame.union, leaves)), POOL * total), True))

    keys = links.part(bases.select("key", F.col("doc_id").alias("low"), "rows"))
    whole = keys.groupBy("part").agg(F.min("low").alias("component"), F.count("*").alias("rows"))
    names = _named(keys.withColumnRenamed("rows", "copies"), whole, "part", total).select("key", "component", F.col("copies").alias("rows"))
    named = _named(slim.select("doc_id", "n", "key"), names, "key", total)
    component, null = F.coalesce("component", "doc_id"), F.lit(NO_ID)
    return named.select(F.nullif("doc_id", null).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif(component, null).alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def op12_chosen_path_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))
