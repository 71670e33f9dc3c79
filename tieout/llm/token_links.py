"""Operator 13: alignment of two tokenizers' ids, split at white-space anchors.

Each text is tokenised whole by both vocabularies: by A, a byte-level BPE, with a space put before it,
and by B, a piece model with byte fallback that puts the space there itself. Both sides are bytes with
an end after each token. An anchor is an end of both, verified on the running byte counts, where the
next token of each side begins with its mark of a space. Anchors split a document into windows; what
the groups and links of a window are depends on its ids alone, so they are worked out once per worker
for a pair of id tuples (a bounded cache; beyond it again). Where no anchor is, a window is as long as
the text; its alignment walks both sides once.

Links are packed in a written table, one number (A id times B's size plus B id) for each. Their corpus
count is a partial sum per task and one shuffle of id pairs; the highest count of a B id is one more
over id pairs. The pair table has one row for each pair that occurs, so it is bounded by the
vocabularies, not by the corpus. Up to ``MOST_PAIRS`` rows (40 MB) it goes to all tasks as two sorted arrays in which
each document looks up its links. Beyond that the distinct links of each document are rows, joined with the pair
table; pairs that very many documents hold are joined by broadcast.

Defined cases: null and empty texts, and those whose joined token bytes on either side differ from
space and text (normalised or unknown characters), have no tokens: zeros and an empty string. Repeated
rows count each; a null doc_id is kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .tokens import text_blocks

#: A pair table of at most this many rows (20 bytes a row) is sent to all tasks.
MOST_PAIRS = 2_000_000
BLOCK_BYTES, CACHED_WINDOWS, CACHED_IDS = 1_000_000, 250_000, 24

# Fixed values of the vocabularies: the mark of a space in pieces, and the pattern that splits a text before byte merges.
SPACE_MARK = "▁"
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the windows met so far."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(a_path)
        special = {t.content for t in library.get_added_tokens_decoder().values()}
        letters = _byte_letters()
        pieces = library.get_vocab()
        ranks = {bytes(letters[c] for c in piece): k for piece, k in pieces.items() if piece not in special}
        # the same merges, as each token has the rank of its merge; several times as fast on new words
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(pieces.values()) + 1)
        for piece, k in ranks.items():
            self.a_bytes[k] = piece
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_MARK, " ").encode())
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([x[:1] == b" " for x in side]) for side in (self.a_bytes, self.b_bytes))
        #: Each id as text, and what follows it: ids 0, 2, ... of A with a comma, 1, 3, ... with a bar; then B's with a comma or semicolon.
        self.words = [f"{k}{end}".encode() for ends, n in ((",|", len(self.a_bytes)), (",;", len(self.b_bytes))) for k in range(n) for end in ends]
        self.windows: dict[tuple[bytes, bytes], tuple[bytes, bytes]] = {}

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(A ids, B ids) of each text; None where either side's bytes aren't space and text."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            whole = b" " + text.encode()
            same = text and b"".join(map(self.b_bytes.__getitem__, b)) == whole
            a = self.a.encode_ordinary(" " + text) if same else []
            same = same and b"".join(map(self.a_bytes.__getitem__, a)) == whole
            out.append((np.array(a, "<u4"), np.array(b, "<u4")) if same else None)
        return out

    def _windows(self, keys: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
        """(groups, each with a semicolon after it; links packed) of windows, aligned end to end.

        Between two ends of either side one token of each side lies, which is a link; an end of both
        sides ends a group.
        """
        a, b = (np.frombuffer(b"".join(k[side] for k in keys), "<u4").astype(np.int64) for side in (0, 1))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        again = ends[1:] == ends[:-1]
        shared, ends = ends[1:][again], ends[np.concatenate([[True], ~again])]
        links = (a[np.searchsorted(a_end, ends)] * len(self.b_bytes) + b[np.searchsorted(b_end, ends)]).astype("<u8")

        a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        a_upto, b_upto = np.searchsorted(a_group, np.arange(len(shared)), "right"), np.searchsorted(b_group, np.arange(len(shared)), "right")
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], b_upto])[a_group]] = 2 * a + (a_end == shared[a_group])
        order[np.arange(len(b)) + a_upto[b_group]] = 2 * (len(self.a_bytes) + b) + (b_end == shared[b_group])
        words = list(map(self.words.__getitem__, order.tolist()))

        a_cut = np.cumsum([len(k[0]) // 4 for k in keys])
        cuts = (a_cut + np.cumsum([len(k[1]) // 4 for k in keys])).tolist()
        at = (8 * (np.searchsorted(ends, a_end[a_cut - 1]) + 1)).tolist()
        raw = links.tobytes()
        return [(b"".join(words[i:j]), raw[k:m]) for i, j, k, m in zip([0, *cuts], cuts, [0, *at], at, strict=False)]

    def align(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[bytes, bytes]]:
        """(groups, links packed) of documents that ``encode`` let pass, window by window.

        Each text begins with a space on both sides, so documents end at anchors like windows.
        """
        if not documents:
            return []
        a, b = (np.concatenate([d[side] for d in documents]) for side in (0, 1))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_at = np.append(np.flatnonzero(self.a_space[a[1:]]), len(a) - 1)
        b_at = np.append(np.flatnonzero(self.b_space[b[1:]]), len(b) - 1)
        anchors, x, y = np.intersect1d(a_end[a_at], b_end[b_at], assume_unique=True, return_indices=True)
        a_cuts, b_cuts = (4 * (a_at[x] + 1)).tolist(), (4 * (b_at[y] + 1)).tolist()
        a_raw, b_raw = a.tobytes(), b.tobytes()
        keys = [(a_raw[i:j], b_raw[k:m]) for i, j, k, m in zip([0, *a_cuts], a_cuts, [0, *b_cuts], b_cuts, strict=False)]
        found = list(map(self.windows.get, keys))
        fresh = list(dict.fromkeys(k for k, f in zip(keys, found, strict=True) if f is None))
        if fresh:
            new = dict(zip(fresh, self._windows(fresh), strict=True))
            found = [new[k] if f is None else f for k, f in zip(keys, found, strict=True)]
            if len(self.windows) < CACHED_WINDOWS:
                self.windows.update((k, w) for k, w in new.items() if len(k[0]) + len(k[1]) <= 4 * CACHED_IDS)
        ends = a_end[np.cumsum([len(d[0]) for d in documents]) - 1]
        cuts = (np.searchsorted(anchors, ends) + 1).tolist()
        texts, links = [f[0] for f in found], [f[1] for f in found]
        return [(b"".join(texts[i:j])[:-1], b"".join(links[i:j])) for i, j in zip([0, *cuts], cuts, strict=False)]


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    """One pair of vocabularies in each Python worker."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Vocabularies(a_path, b_path)
    return _LOADED[a_path, b_path]


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A written table (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times): the distinct links
    of a document as sorted 64-bit numbers and how often each stands there, packed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(a_path, b_path)
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
        for batch in batches:
            for i, j, texts in text_blocks(batch.column("text"), BLOCK_BYTES):
                rows = []
                encoded = both.encode([t or "" for t in texts])
                found = iter(both.align([ids for ids in encoded if ids]))
                for ids in encoded:
                    if ids is None:
                        rows.append((0, 0, 0, 0, "", b"", b""))
                        continue
                    groups, links = next(found)
                    pairs, times = np.unique(np.frombuffer(links, "<u8"), return_counts=True)
                    rows.append((len(ids[0]), len(ids[1]), groups.count(b";") + 1, len(links) // 8, hashlib.sha256(groups).hexdigest(), pairs.tobytes(), times.astype("<u4").tobytes()))
                columns = list(zip(*rows, strict=True))
                types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
    return written(rows.mapInArrow(work, schema), "aligned")


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All distinct links of a batch: the row, the pair, how often."""
    pairs = [np.frombuffer(x, "<u8") for x in batch.column("pairs").to_pylist()]
    times = [np.frombuffer(x, "<u4") for x in batch.column("times").to_pylist()]
    none = [np.zeros(0, np.int64)]
    return np.repeat(np.arange(len(pairs)), [len(p) for p in pairs]), np.concatenate(none + pairs).astype(np.int64), np.concatenate(none + times).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, pair, times = _links(batch)
        pairs, place = np.unique(pair, return_inverse=True)
        sums = np.bincount(place, times, len(pairs)).astype(np.int64)  # exact: sums of a batch stay far below 2^53
        docs = np.bincount(place, minlength=len(pairs))
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(sums), pa.array(docs.astype(np.int64))], names=["pair", "count", "rows"])


def pair_counts(documents: DataFrame, b_width: int) -> DataFrame:
    """A written table (pair, count, rows, best): how many links hold a pair, in how many documents, and
    whether no other pair of its B id is held more often."""
    counts = documents.select("pairs", "times").mapInArrow(_counted, "pair long, count long, rows long").groupBy("pair").agg(F.sum("count").alias("count"), F.sum("rows").alias("rows"))
    counts = written(counts, "pair-counts")
    highest = counts.groupBy((F.col("pair") % b_width).alias("b")).agg(F.max("count").alias("highest"))
    return written(counts.join(F.broadcast(highest), F.col("pair") % b_width == F.col("b")).select("pair", "count", "rows", (F.col("count") == F.col("highest")).alias("best")), "pairs")


def _scored_by_lookup(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    held = pairs.select("pair", "count", "best").toArrow().sort_by("pair")
    known = documents.sparkSession.sparkContext.broadcast(tuple(held.column(c).to_numpy() for c in ("pair", "count", "best")))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = known.value
        for batch in batches:
            row, mine, times = _links(batch)
            at = np.searchsorted(pair, mine)
            sums, hits = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, row, count[at] * times)
            np.add.at(hits, row, best[at] * times)
            kept = [batch.column(c) for c in _KEPT]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(hits), pa.array(sums)], names=[*_KEPT, "n_best", "count_sum"])

    return documents.mapInArrow(score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


_KEPT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _scored_by_join(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pair, times = _links(batch)
            ids = batch.column("id").to_numpy()
            for k in range(0, len(row), 100_000):
                part = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row[part]]), pa.array(pair[part]), pa.array(times[part])], names=["id", "pair", "times"])

    numbered = written(documents.withColumn("id", F.monotonically_increasing_id()), "numbered")
    links = numbered.select("id", "pairs", "times").mapInArrow(rows, "id long, pair long, times long")
    total = documents.count()
    many = F.col("rows") > max(1_000, total // 1_000)  # a document has about a thousand links, so there are under a million
    hot, cold = pairs.where(many).drop("rows"), pairs.where(~many).drop("rows")
    found = links.join(F.broadcast(hot), "pair").unionByName(links.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(cold, "pair"))
    sums = found.groupBy("id").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("count") * F.col("times")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return numbered.join(sums, "id", "left").select(*_KEPT, zero("n_best"), zero("count_sum"))


def token_links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, most_pairs: int = MOST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(documents with their digests, pairs with their corpus counts)"""
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path, b_path = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    documents = aligned(docs, a_path, b_path)
    pairs = pair_counts(documents, len(vocabularies(a_path, b_path).b_bytes))
    small = pairs.count() <= most_pairs
    return (_scored_by_lookup if small else _scored_by_join)(documents, pairs), pairs


def op13_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links(table(spark, sf_dir, "documents"))[0]
