"""Operator 8: token ids in seekable zstandard files.

A file is a row of independent zstandard frames (each with its own content checksum), a skippable
frame that names the documents of each frame, and the public seekable-format trailer: a skippable
frame with compressed size, plain size and XXH64 checksum of every frame. A reader takes the
trailer, then decompresses only the frames that hold the documents it wants.

Documents are dealt by ranges of doc_id and sorted inside a range; each task writes one file and
returns a manifest row. Only files of the written manifest count, so a task that runs twice leaves
an unused file behind and nothing else. Starts follow from the manifest's totals.

Defined cases: a null or empty text is the end id alone; a null doc_id sorts first; equal doc_ids
are ordered by a hash of their text; an empty table gives no file; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, written
from .tokens import default_vocabulary, encoder, text_blocks

# Fixed values of the public zstandard seekable format.
SKIPPABLE_SEEK, SKIPPABLE_INDEX, SEEKABLE_MAGIC = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")
SKIPPABLE = struct.Struct("<II")
DOCS = struct.Struct("<qqI")  # first and last doc_id, documents

FRAME_BYTES = 1 << 20
TEXT_BYTES = 3 << 20
NO_ID = -(2**63)
MANIFEST = "part int, path string, n_docs long, n_ids long"
RESULT = "doc_id long, start long, n_tokens long, ids binary"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class FrameWriter:
    """Collects documents and writes a frame whenever ``FRAME_BYTES`` of ids are there."""

    def __init__(self, sink):
        import zstandard

        self.zstd = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
        self.sink, self.entries, self.index = sink, [], []
        self.docs: list[int] = []
        self.ids: list[bytes] = []
        self.held = self.n_docs = self.n_ids = 0

    def add(self, doc_id: int, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.ids.append(ids)
        self.held += len(ids)
        self.n_docs += 1
        self.n_ids += len(ids) // 4
        if self.held >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        import xxhash

        if not self.docs:
            return
        sizes = np.array([len(x) // 4 for x in self.ids], "<i8")
        plain = struct.pack("<I", len(sizes)) + np.array(self.docs, "<i8").tobytes() + sizes.tobytes() + b"".join(self.ids)
        frame = self.zstd.compress(plain)
        self.sink.write(frame)
        self.entries.append((len(frame), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.index.append((self.docs[0], self.docs[-1], len(sizes)))
        self.docs, self.ids, self.held = [], [], 0

    def close(self) -> None:
        self.flush()
        index = b"".join(DOCS.pack(*x) for x in self.index)
        self.sink.write(SKIPPABLE.pack(SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(ENTRY.pack(*x) for x in self.entries)
        self.sink.write(SKIPPABLE.pack(SKIPPABLE_SEEK, len(table) + FOOTER.size) + table)
        self.sink.write(FOOTER.pack(len(self.entries), 0x80, SEEKABLE_MAGIC))
        self.sink.close()


class FrameReader:
    """Reads the trailer of a file, then frames on demand; every checksum is held against its frame."""

    def __init__(self, path: str):
        system, name = _open(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        self.file.seek(size - FOOTER.size)
        n, flags, magic = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & 0x80:
            raise ValueError(f"no seek table in {path}")
        begin = size - FOOTER.size - n * ENTRY.size
        index_at = begin - 2 * SKIPPABLE.size - n * DOCS.size
        self.file.seek(index_at + SKIPPABLE.size)
        self.index = list(DOCS.iter_unpack(self.file.read(n * DOCS.size)))
        self.file.seek(begin)
        self.entries = list(ENTRY.iter_unpack(self.file.read(n * ENTRY.size)))
        self.offsets = np.concatenate([[0], np.cumsum([x[0] for x in self.entries], dtype=np.int64)]).tolist()

    def frame(self, k: int) -> Iterator[tuple[int, bytes]]:
        import xxhash
        import zstandard

        size, plain_size, check = self.entries[k]
        self.file.seek(self.offsets[k])
        plain = zstandard.ZstdDecompressor().decompress(self.file.read(size), max_output_size=plain_size)
        if len(plain) != plain_size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        (n,) = struct.unpack_from("<I", plain)
        docs = np.frombuffer(plain, "<i8", n, 4)
        sizes = np.frombuffer(plain, "<i8", n, 4 + 8 * n)
        at = 4 + 16 * n
        for doc, ids in zip(docs.tolist(), (4 * sizes).tolist(), strict=True):
            yield doc, plain[at : at + ids]
            at += ids

    def documents(self, wanted: set[int]) -> Iterator[tuple[int, bytes]]:
        """Only the wanted documents; frames without any stay compressed."""
        order = sorted(wanted)
        for k, (first, last, _) in enumerate(self.index):
            at = np.searchsorted(order, first)
            if at < len(order) and order[at] <= last:
                yield from (x for x in self.frame(k) if x[0] in wanted)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 1) -> DataFrame:
    """Writes the ids of every text and returns the manifest (part, path, n_docs, n_ids), one row a file."""
    vocabulary = vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, out, path = encoder(vocabulary), None, ""
        part = TaskContext.get().partitionId()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, j, texts in text_blocks(batch.column(1), TEXT_BYTES):
                for doc, got in zip(ids[i:j], words.batch(texts), strict=True):
                    if out is None:
                        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zst"
                        system, name = _open(path)
                        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                        out = FrameWriter(system.open_output_stream(name, compression=None))
                    out.add(NO_ID if doc is None else doc, got + end)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([path]), pa.array([out.n_docs]), pa.array([out.n_ids])],
                names=["part", "path", "n_docs", "n_ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) from the files; ``start`` counts the ids of all documents before."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                reader, start = FrameReader(path), base
                for k in range(len(reader.entries)):
                    docs, ids = zip(*reader.frame(k), strict=True)
                    sizes = np.array([len(x) // 4 for x in ids], np.int64)
                    starts = start + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
                    start += int(sizes.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if d == NO_ID else d for d in docs], pa.int64()), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    many = max(1, manifest.count())
    return files.select("part", "path", "base").repartitionByRange(many, "part").mapInArrow(read, RESULT)


def op8_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = write_token_files(docs, scratch(spark, "token-files"))
    back = read_token_files(spark, manifest)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
