"""Operator 7: benchmark decontamination by latent semantic retrieval.

1. Passage frequencies: words (runs of letters, digits and non-ASCII, lower-cased; single characters in
   scripts without spaces) are hashed into TERMS terms; Spark counts in how many passages of every document each term occurs.
2. A randomised SVD of the TF-IDF passages, as Spark jobs: A'AG for a seeded Gaussian G is summed in blocks of
   terms and orthonormalised, a second pass sums the small Gram matrix, whose eigenvectors turn the
   basis. It takes every passage of every document and every benchmark item; the items weigh
   BENCHMARK_SHARE together.
3. Search: sliding windows of every document, fitted to the items' lengths, against every item. The latent
   product with an item, in units of the item's product with itself, estimates the share of the item's weight
   that stands in the window; from REACH on it is a candidate, that is from a cosine of
   REACH * sqrt(weight of the item / weight of the window). The bound lies below what step 4 accepts at least.
   Windows with less than REACH of the lightest item's weight on the items' terms are passed over. Items
   longer than the longest window takes are searched by overlapping parts, any of which makes a candidate.
   Items with fewer than LEAST_WORDS words are searched exactly: all their words in a row.
4. Candidates are confirmed on words: the longest common subsequence of item and surroundings, with the
   item's answer (its last sentence, else its last third) checked where that is only middling.

Items are a stated query set; they go to the tasks in blocks of ITEMS, and memory never grows with documents.

Defined cases: null, empty and wordless texts and items match nothing; an item of one word leaks wherever
that word stands; repeated rows are searched row by row; an empty table or benchmark gives no row; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written
from .textvec import LOWER, hash_spans, mix, text_bytes

TERMS, RANK, OVER, BLOCK = 1 << 16, 64, 16, 1024
#: Words of a window, its stride, and the longest item that is searched by it: any whole copy of it stands in one window.
FITTED = ((16, 4, 13), (24, 8, 17), (32, 8, 25), (48, 8, 41), (64, 16, 49), (80, 16, 65))
#: Words of a passage of the basis; words and windows of a document that are looked up at once.
PASSAGE, ROWS = 32, 1 << 13
SEED, ITEMS, BENCHMARK_SHARE = 7, 4096, 0.8
#: Common subsequence that settles a leak; one that needs the answer; share of the answer.
SURE, MIDDLING, ANSWER = 0.7, 0.5, 0.8
#: Items with fewer words leak where all their words stand in a row.
LEAST_WORDS = 8
#: Share of an item, by latent weight, that makes a window a candidate; below MIDDLING, as words weigh unequally.
REACH = 0.3
LEAK = "doc_id long, item_id long, cosine double, overlap double"
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: First bytes of the characters of scripts without spaces, and those characters: Thai and Lao, Myanmar, Khmer, signs
#: and letters of Chinese and Japanese. The punctuation of these scripts, in full width too, parts words.
_LEAD = np.zeros(256, bool)
_LEAD[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True
_ALONE = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
_PARTING = ((0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))


def _in(points: np.ndarray, ranges: tuple) -> np.ndarray:
    return np.any([(points >= a) & (points <= b) for a, b in ranges], axis=0)


def words(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, in order; a character of a script without spaces is a word."""
    data = LOWER[text_bytes(text)]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[data]
    lead = np.flatnonzero(_LEAD[data])
    alone, sizes = lead[:0], lead[:0]
    if len(lead):
        four = data[lead] >= 0xF0
        sizes = np.where(four, 4, 3)
        b = [data[np.minimum(lead + j, len(data) - 1)].astype(np.int64) & 0x3F for j in range(1, 4)]
        points = np.where(four, (data[lead].astype(np.int64) & 7) << 18 | b[0] << 12 | b[1] << 6 | b[2], (data[lead].astype(np.int64) & 15) << 12 | b[0] << 6 | b[1])
        parting = _in(points, _PARTING)
        single = _in(points, _ALONE) & ~parting
        out = single | parting
        for j in range(4):
            inside[1 + lead[out & (sizes > j)] + j] = 0
        alone, sizes = lead[single], sizes[single]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if len(alone):
        starts, ends = np.concatenate([starts, alone]), np.concatenate([ends, alone + sizes])
        order = np.argsort(starts)
        starts, ends = starts[order], ends[order]
    return hash_spans(data, starts, ends)


def sequences(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row."""
    total = np.full(len(hashes) - size + 1, np.uint64(size))
    for j in range(size):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : len(hashes) - size + 1 + j])
    return total


def terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64) if TERMS == 1 << 16 else (hashes % np.uint64(TERMS)).astype(np.int64)


def _summed(parts: DataFrame, kind: str) -> np.ndarray:
    """Adds up rows (block, data) of BLOCK terms each; TERMS rows in all reach the driver."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, kind) for x in pdf["data"])
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "data": [total.tobytes()]})

    found = dict(parts.groupBy("block").applyInPandas(add, "block int, data binary").collect())
    width = max((len(x) for x in found.values()), default=0)
    return np.concatenate([np.frombuffer(found.get(b, bytes(width)), kind) for b in range(TERMS // BLOCK)])


def _blocked(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (block, data), a few blocks at a time, so the sums never leave a task in one piece."""
    for first in range(0, TERMS // BLOCK, 4):
        parts = [x.tobytes() for x in np.split(total[first * BLOCK : (first + 4) * BLOCK], 4)]
        blocks = pa.array(range(first, first + 4), pa.int32())
        yield pa.RecordBatch.from_arrays([blocks, pa.array(parts, pa.binary())], names=["block", "data"])


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages of all texts each term occurs, and how many passages there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, passages = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            own = []
            for text in batch.column("text"):
                t = terms(words(text.as_py()))
                if len(t):
                    own.append(np.unique((np.arange(len(t)) // PASSAGE) * TERMS + t) % TERMS)
                    passages += -(-len(t) // PASSAGE)
            if own:
                total += np.bincount(np.concatenate(own), minlength=TERMS)
        yield from _blocked(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([np.array([passages]).tobytes()], pa.binary())], names=["block", "data"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in pdf["data"])
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "data": [total.tobytes()]})

    found = dict(texts.select("text").mapInArrow(count, "block int, data binary").groupBy("block").applyInPandas(add, "block int, data binary").collect())
    passages = int(np.frombuffer(found.pop(-1, bytes(8)), np.int64)[0])
    zero = bytes(8 * BLOCK)
    return np.concatenate([np.frombuffer(found.get(b, zero), np.int64) for b in range(TERMS // BLOCK)]), passages


def _gaussian() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((TERMS, RANK + OVER), dtype=np.float32)


def _weighted(held: list[np.ndarray], scales: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights) of passages, a row each of its own scale as length; a term that repeats in a row has its weight once."""
    term = np.sort(np.concatenate(held).reshape(-1, PASSAGE), axis=1)
    first = np.ones(term.shape, bool)
    first[:, 1:] = term[:, 1:] != term[:, :-1]
    at, weight = np.flatnonzero(first), np.zeros(term.shape, np.float32)
    weight.ravel()[at] = np.add.reduceat(idf[term].ravel(), at)
    size = np.sqrt((weight * weight).sum(axis=1))
    weight *= (np.concatenate(scales) / np.where(size > 0, size, 1))[:, None]
    return np.where(term < TERMS, term, 0), weight


def _rows(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All passages of rows (text, scale), some ROWS words at a time; the last one of a text is filled up with weight 0."""
    idf = np.append(idf, np.float32(0))
    held, scales, n = [], [], 0
    for batch in batches:
        for text, scale in zip(batch.column("text"), batch.column("scale").to_pylist(), strict=True):
            t = terms(words(text.as_py()))
            for k in range(0, len(t), ROWS):
                own = t[k : k + ROWS]
                rows = -(-len(own) // PASSAGE)
                filled = np.full(rows * PASSAGE, TERMS, np.int64)
                filled[: len(own)] = own
                held.append(filled)
                scales.append(np.full(rows, scale, np.float32))
                n += len(filled)
                if n >= ROWS:
                    yield _weighted(held, scales, idf)
                    held, scales, n = [], [], 0
    if held:
        yield _weighted(held, scales, idf)


def _projected(term: np.ndarray, weight: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The passages in the columns of ``table``."""
    return np.matmul(weight[:, None, :], table[term])[:, 0, :]


def orthonormal(columns: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns by their Gram matrix, in place of a factorisation of the tall matrix."""
    values, vectors = np.linalg.eigh((columns.T @ columns).astype(np.float64))
    scale = np.where(values > 1e-9 * values[-1], 1 / np.sqrt(np.maximum(values, 1e-300)), 0)
    return columns @ (vectors * scale).astype(np.float32)


def basis(passages: DataFrame, idf: np.ndarray) -> np.ndarray:
    """TERMS x RANK right singular vectors of the TF-IDF passages of rows (text, scale)."""
    spark = passages.sparkSession
    shared_idf = spark.sparkContext.broadcast(idf)

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, total = _gaussian(), np.zeros((TERMS, RANK + OVER), np.float32)
        for term, weight in _rows(batches, shared_idf.value):
            y = _projected(term, weight, g)
            order = np.argsort(term, axis=None, kind="stable")
            own = term.ravel()[order]
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            total[own[starts]] += np.add.reduceat(weight.ravel()[order][:, None] * y[order // PASSAGE], starts, axis=0)
        del g
        yield from _blocked(total)

    stretched = _summed(passages.mapInArrow(stretch, "block int, data binary"), "<f4")
    if not stretched.size or not np.abs(stretched).max():
        return np.zeros((TERMS, RANK), np.float32)
    q = orthonormal(stretched.reshape(TERMS, RANK + OVER))
    shared_q = spark.sparkContext.broadcast(q)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((RANK + OVER, RANK + OVER))
        for term, weight in _rows(batches, shared_idf.value):
            y = _projected(term, weight, shared_q.value).astype(np.float64)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["place", "v"])

    total = np.zeros((RANK + OVER) ** 2)
    for place, v in passages.mapInArrow(gram, "place int, v double").groupBy("place").agg(F.sum("v")).collect():
        total[place] = v
    shared_idf.unpersist()
    shared_q.unpersist()
    turn = np.linalg.eigh(total.reshape(RANK + OVER, RANK + OVER))[1][:, ::-1][:, :RANK]
    return q @ turn.astype(np.float32)


@dataclass
class Item:
    item_id: int
    words: list[int]
    answer: list[int]


def item(item_id: int, text: str | None) -> Item:
    all_ = words(text).tolist()
    sentences = [s for s in (words(x).tolist() for x in re.split(r"(?<=[.!?])\s+|(?<=[。！？])|\n", text or "")) if s]
    answer = sentences[-1] if len(sentences) > 1 and len(sentences[-1]) >= 3 else all_[-max(3, len(all_) // 3) :]
    return Item(item_id, all_, answer)


def common(masks: dict[int, int], size: int, other: list[int]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each word of the first, of ``size`` words."""
    full = (1 << size) - 1
    v = full
    for w in other:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def places(sequence: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(sequence):
        out[w] = out.get(w, 0) | 1 << k
    return out


def parts(sequence: list[int], size: int) -> list[list[int]]:
    """Stretches of ``size`` words, each half over the next; the last one ends the sequence."""
    last = len(sequence) - size
    return [sequence[k : k + size] for k in [*range(0, last, size // 2), last]]


def overlap(one: Item, masks: dict[int, int], near: list[int]) -> float:
    """Share of the item that stands in order in the words ``near`` it; 0 where it isn't a leak."""
    share = common(masks, len(one.words), near) / len(one.words)
    if share >= SURE:
        return share
    if share >= MIDDLING and common(places(one.answer), len(one.answer), near) >= ANSWER * len(one.answer):
        return share
    return 0.0


@dataclass
class Fitted:
    """What is searched by windows of one size."""

    of: np.ndarray  # place of the item
    unit: np.ndarray  # RANK x n; the product with the vector of the words themselves is 1
    sizes: np.ndarray  # length of the whole vector
    grid: np.ndarray  # terms, filled up with TERMS
    needed: np.ndarray  # so many of them stand near a leak
    known: np.ndarray  # squared weight of the terms that stand in any of them
    least: float  # squared weight of the lightest
    window: int
    stride: int
    margin: int


class Search:
    """Latent vectors and words of a block of items."""

    def __init__(self, items: list[Item], table: np.ndarray, idf: np.ndarray):
        self.items, self.table, self.energy = items, table, idf * idf
        self.masks = [places(x.words) for x in items]
        self.fitted, below = [], LEAST_WORDS - 1
        for window, stride, longest in FITTED:
            own = [(k, x.words) for k, x in enumerate(items) if below < len(x.words) <= longest]
            if longest == FITTED[-1][2]:  # longer items as overlapping parts of that length
                own += [(k, part) for k, x in enumerate(items) if len(x.words) > longest for part in parts(x.words, longest)]
            below = longest
            if own:
                self.fitted.append(self._fitted(own, window, stride, longest))
        short: dict[int, dict[int, list[int]]] = {}
        for k, x in enumerate(items):
            if len(x.words) < LEAST_WORDS:
                short.setdefault(len(x.words), {}).setdefault(int(sequences(np.array(x.words, np.uint64), len(x.words))[0]), []).append(k)
        self.short = [(n, np.array(sorted(own), np.uint64), own) for n, own in sorted(short.items())]
        self.step = min((f.stride for f in self.fitted), default=FITTED[-1][1])

    def _fitted(self, own: list[tuple[int, list[int]]], window: int, stride: int, longest: int) -> Fitted:
        sequences = [terms(np.array(x, np.uint64)) for _, x in own]
        vectors = np.stack([self.table[t].sum(axis=0) for t in sequences])
        unit = (vectors / np.maximum((vectors * vectors).sum(axis=1), 1e-12)[:, None]).astype(np.float32).T.copy()
        energies = np.array([self.energy[t].sum() for t in sequences])
        grid, known = np.full((len(own), max(map(len, sequences))), TERMS, np.int64), np.zeros(TERMS, np.float32)
        for row, t in zip(grid, sequences, strict=True):
            row[: len(t)] = t
            known[t] = self.energy[t]
        needed = np.array([(MIDDLING if len(t) == len(self.items[k].words) else REACH) * len(t) for (k, _), t in zip(own, sequences, strict=True)])
        return Fitted(np.array([k for k, _ in own]), unit, np.sqrt(energies), grid, needed, known, float(energies.min()), window, stride, stride + longest // 2)

    def confirmed(self, k: int, near: list[int]) -> float:
        """The largest share of item k found in order within one and a half times its length."""
        one, there = self.items[k], set(near)
        if sum(w in there for w in one.words) < MIDDLING * len(one.words):
            return 0.0
        size, found = len(one.words) + len(one.words) // 2, 0.0
        for at in range(0, max(1, len(near) - size + len(one.words) // 4 + 1), max(1, len(one.words) // 4)):
            found = max(found, overlap(one, self.masks[k], near[at : at + size]))
        return found

    def candidates(self, t: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
        """(place of the item, cosine, begin, end) of windows that may hold a leak."""
        at = np.arange(0, len(t), self.step)
        hopeful, needed = [], np.zeros(len(at), bool)
        for f in self.fitted:
            size = min(f.window // self.step, len(at))
            begins = np.arange(0, len(at) - size + f.stride // self.step, f.stride // self.step)
            begins[-1] = len(at) - size
            part = np.convolve(np.add.reduceat(f.known[t], at), np.ones(size, np.float32), "valid")
            begins = begins[part[begins] >= REACH * f.least]
            hopeful.append((f, size, begins))
            for j in range(size):
                needed[begins + j] = True
        if not needed.any():
            return
        own = t[np.repeat(needed, self.step)[: len(t)]]
        steps = [np.add.reduceat(self.table[own[k : k + ROWS]], np.arange(0, len(own[k : k + ROWS]), self.step), axis=0) for k in range(0, len(own), ROWS)]  # only the last step can be short
        sums = np.zeros((int(needed.sum()) + 1, self.table.shape[1]))
        np.cumsum(np.concatenate(steps), axis=0, dtype=np.float64, out=sums[1:])
        place, order = np.cumsum(needed) - 1, None
        for f, size, begins in hopeful:
            for k in range(0, len(begins), ROWS):
                first = place[begins[k : k + ROWS]]
                share = (sums[first + size] - sums[first]).astype(np.float32) @ f.unit
                hits, rows = np.nonzero(share >= REACH)
                if len(hits) and order is None:
                    order = np.sort(t * len(t) + np.arange(len(t)))  # by term, then place
                for j in range(0, len(hits), ROWS):
                    hit, row = hits[j : j + ROWS], rows[j : j + ROWS]
                    begin = begins[k + hit] * self.step
                    end = begin + size * self.step
                    good = self._near(order, len(t), f.grid[row], np.maximum(begin - f.margin, 0), np.minimum(end + f.margin, len(t))) >= f.needed[row]
                    for x, y, i, e in zip(hit[good].tolist(), row[good].tolist(), begin[good].tolist(), end[good].tolist(), strict=True):
                        length = np.sqrt(max(1e-12, self.energy[t[i:e]].sum()))
                        yield int(f.of[y]), float(share[x, y] * f.sizes[y] / length), i, e

    @staticmethod
    def _near(order: np.ndarray, n: int, grid: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many terms of each row of ``grid`` stand from ``begin`` to ``end`` of a text of n terms."""
        at = order[np.minimum(np.searchsorted(order, grid * n + begin[:, None]), n - 1)] - grid * n
        return ((at >= begin[:, None]) & (at < end[:, None])).sum(axis=1)

    def leaks(self, hashes: np.ndarray) -> Iterator[tuple[int, float, float]]:
        """(item_id, cosine, overlap) of the items that a document holds."""
        if not len(hashes):
            return
        for size, keys, own in self.short:
            if size <= len(hashes):
                found = sequences(hashes, size)
                for key in np.unique(found[keys[np.minimum(np.searchsorted(keys, found), len(keys) - 1)] == found]).tolist():
                    yield from ((self.items[k].item_id, 1.0, 1.0) for k in own[key])
        seen: dict[int, list[tuple[int, int, float]]] = {}
        for k, cosine, begin, end in self.candidates(terms(hashes)):
            size = len(self.items[k].words)
            margin = self.step + (size // 2 if size <= FITTED[-1][2] else size + size // 2)
            seen.setdefault(k, []).append((max(0, begin - margin), end + margin, cosine))
        for k, stretches in sorted(seen.items()):
            stretches.sort()
            found, (begin, end, _) = 0.0, stretches[0]
            for b, e, _ in [*stretches[1:], (len(hashes) * 2 + end, 0, 0)]:
                if b <= end:
                    end = max(end, e)
                    continue
                found = max(found, self.confirmed(k, hashes[begin:end].tolist()))
                if found >= SURE:
                    break
                begin, end = b, e
            if found:
                yield self.items[k].item_id, max(c for _, _, c in stretches), found


def fitted(docs: DataFrame, benchmark: DataFrame) -> tuple[list[Item], np.ndarray, np.ndarray]:
    """The items, the weighted basis (the vector of a passage is the sum of its words' rows), and the terms' weights."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = [item(i, t) for i, t in benchmark.where("item_id is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator()]
    items = [x for x in items if x.words]
    if not items:
        return [], np.zeros((TERMS, RANK), np.float32), np.zeros(TERMS, np.float32)
    df, passages = frequencies(texts)
    idf = np.log((passages + 1) / (df + 1)).astype(np.float32) + 1e-3
    scale = float(np.sqrt(BENCHMARK_SHARE / (1 - BENCHMARK_SHARE) * passages / len(items)))
    weighed = texts.select("text", F.lit(1.0).alias("scale")).union(benchmark.select(F.col("text").cast("string"), F.lit(scale)))
    table = basis(weighed, idf)
    return items, table * idf[:, None], idf


def _blocks(shared: tuple) -> list[Search]:
    items, table, idf = shared
    return [Search(items[k : k + ITEMS], table, idf) for k in range(0, len(items), ITEMS)]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, cosine, overlap): every document that holds an item, with that item."""
    spark = docs.sparkSession
    model = fitted(docs, benchmark)
    if not model[0]:
        return spark.createDataFrame([], LEAK)
    shared = spark.sparkContext.broadcast(model)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks(shared.value)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                hashes = words(text.as_py())
                for block in blocks:
                    out += [(doc, *x) for x in block.leaks(hashes)]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "cosine", "overlap"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(search, LEAK)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    model = fitted(docs, benchmark)
    if not model[0]:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks(shared.value)
        for batch in batches:
            clean = []
            for text in batch.column(at):
                hashes = words(text.as_py())
                clean.append(not any(True for block in blocks for _ in block.leaks(hashes)))
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op7_latent_semantic_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
