"""Operator 2: secret scans with structural confirmation.

Base spans are the regular matches of three kinds. The method adds spans whose content proves to
be a key: private-key blocks (escaped line breaks and header lines removed) and long base64 (standard or
URL-safe, also wrapped over lines) or hex runs (either case) are decoded, and must hold a key encoding
whose nested lengths add up to the last byte (DER of PKCS#1, PKCS#8, SEC 1 and DSA keys, or the
OpenSSH private-key container); signed tokens must have a JSON header that names an algorithm and
a JSON payload.

Defined cases: null and empty texts have no spans; spans are in code points of the whole text;
repeated rows are scanned row by row; an empty table gives no row; other columns pass through.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "block", "token", "key64", "keyhex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
CUES = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a match of the base pattern is a whole run
HEX_ANY = re.compile(r"[0-9A-Fa-f]{64,}")
BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
#: Line breaks of a block, also as JSON or code writes them, and what code puts around its lines.
BREAK = re.compile(r"\\+(?:[rn]|u000[adAD])|\\*\r?\n|\\*\r")
AROUND = re.compile(r"^\s*[\"']\s*[+,;.]*\s*$|^[\s\"'#>*|]+|[\"']\s*[+,;.]*\s*$|\s+$")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
KEY64 = re.compile(r"[A-Za-z0-9+/]{60,}={0,2}")
#: Runs of the URL-safe alphabet, and runs wrapped into lines: real or escaped breaks, indented, quoted or commented.
URL64 = re.compile(r"[A-Za-z0-9_-]{60,}={0,2}")
WRAP = r"(?:[\"']?[\x20\t]*(?:[+,][\x20\t]*)?(?:\\+r|\\*\r)?(?:\\+n|\\*\n)(?:[\s\"'#>*|,]|\+(?=\s)|\\+[rn])*)"
LINES64 = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}(?:{WRAP}[A-Za-z0-9+/_-]+)+={{0,2}}")
LINE64 = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
GAP64 = re.compile(WRAP)
MASK = "[SECRET]"
OPENSSH = b"openssh-key-v1\0"


def elements(data: bytes, begin: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, begin, end) of the DER elements that fill ``data[begin:end]`` exactly, or None."""
    out = []
    while begin < end:
        if begin + 2 > end:
            return None
        tag, size, begin = data[begin], data[begin + 1], begin + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or begin + n > end:
                return None
            size, begin = int.from_bytes(data[begin : begin + n], "big"), begin + n
        if begin + size > end:
            return None
        out.append((tag, begin, begin + size))
        begin += size
    return out


def is_der_key(data: bytes) -> bool:
    top = elements(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inner = elements(data, *top[0][1:])
    if not inner or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return False
    tags = [x[0] for x in inner]
    if set(tags) == {0x02} and len(tags) in (6, 9):  # DSA, PKCS#1
        return True
    if tags[:3] == [0x02, 0x30, 0x04]:  # PKCS#8: version, algorithm with its identifier, key
        algorithm = elements(data, *inner[1][1:])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return tags[:2] == [0x02, 0x04] and set(tags[2:]) <= {0xA0, 0xA1}  # SEC 1


def openssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH private-key container that ``data`` begins with."""
    if not data.startswith(OPENSSH):
        return None
    at = len(OPENSSH)

    def field() -> bool:
        nonlocal at
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at <= len(data)

    if not all(field() for _ in range(3)):  # cipher, derivation, its options
        return None
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    return at if 1 <= keys <= 16 and all(field() for _ in range(keys + 1)) else None


def is_openssh_key(data: bytes) -> bool:
    return openssh_size(data) == len(data)


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def from64(text: str) -> bytes | None:
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_json_object(part: str, key: str | None = None) -> bool:
    data = from64(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and (key is None or isinstance(value.get(key), str))


def block_is_key(header: str, body: str) -> bool:
    lines = [AROUND.sub("", x) for x in BREAK.sub("\n", body.replace("\\/", "/")).split("\n")]
    data = from64("".join(x for x in lines if ":" not in x))
    if "ENCRYPTED" in header or any("ENCRYPTED" in x for x in lines if ":" in x):
        return bool(data)
    return bool(data) and is_key(data)


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Key blocks: each BEGIN line up to the first END line of its kind, unless another block begins before it."""
    begins = list(BEGIN.finditer(text))
    for k, m in enumerate(begins):
        last = f"-----END {m[1]}-----"
        end = text.find(last, m.end(), begins[k + 1].start() if k + 1 < len(begins) else len(text))
        if end >= 0 and block_is_key(m[1], text[m.end() : end]):
            yield m.start(), end + len(last)


def der_size(data: bytes) -> int | None:
    """Bytes of the DER sequence that ``data`` begins with, by its outer length."""
    if len(data) < 8 or data[0] != 0x30:
        return None
    n = data[1] & 0x7F
    if not data[1] & 0x80:
        return 2 + n
    return 2 + n + int.from_bytes(data[2 : 2 + n], "big") if 1 <= n <= 4 else None


class _Lines:
    """Base64 over lines, read at any byte without joining them."""

    def __init__(self, text: str, spans: list[tuple[int, int]]):
        self.text, self.spans = text, spans
        sizes = (j - i - (text[i:j].endswith("=") and len(text[i:j]) - len(text[i:j].rstrip("="))) for i, j in spans)
        self.upto = [0, *accumulate(sizes)]  # characters before each line, without padding

    def joined(self, first: int, end: int) -> str:
        return "".join(self.text[i:j] for i, j in self.spans[first:end])

    def bytes_from(self, first: int) -> int:
        return (self.upto[-1] - self.upto[first]) * 3 // 4

    def read(self, first: int, at: int, n: int) -> bytes:
        """``n`` bytes from byte ``at`` of what begins with line ``first``; fewer at the end."""
        low = self.upto[first] + at // 3 * 4
        high = min(self.upto[first] + -(-(at + n) // 3) * 4, self.upto[-1])
        k, chars = bisect_right(self.upto, low) - 1, []
        while low < high:
            size = min(high, self.upto[k + 1]) - low
            start = self.spans[k][0] + low - self.upto[k]
            chars.append(self.text[start : start + size])
            low, k = low + size, k + 1
        got = "".join(chars)
        return (from64(got[: len(got) - (len(got) % 4 == 1)]) or b"")[at % 3 : at % 3 + n]

    def line_after(self, first: int, chars: int) -> int | None:
        """The line that begins when just so many characters have passed."""
        end = bisect_left(self.upto, self.upto[first] + chars)
        return end if end < len(self.upto) and self.upto[end] == self.upto[first] + chars else None

    def openssh_size(self, first: int) -> int | None:
        """As ``openssh_size`` of all lines from ``first`` on, from the lengths alone."""
        whole = self.bytes_from(first)
        if self.read(first, 0, len(OPENSSH)) != OPENSSH:
            return None
        at, left, counted = len(OPENSSH), 3, False
        while left:
            at += 4 + int.from_bytes(self.read(first, at, 4), "big")
            if at > whole:
                return None
            left -= 1
            if not left and not counted:
                keys, at, counted = int.from_bytes(self.read(first, at, 4), "big"), at + 4, True
                if not 1 <= keys <= 16:
                    return None
                left = keys + 1
        return at


def wrapped_keys(text: str) -> Iterator[tuple[int, int]]:
    """Keys in base64 that runs over lines; the lengths in it tell the line that ends it, so that text is only joined
    where a line ends just there."""
    for m in LINES64.finditer(text):
        at, spans_ = m.start(), []
        while at < m.end() and (line := LINE64.match(text, at, m.end())):
            spans_.append(line.span())
            gap = GAP64.match(text, line.end(), m.end())
            at = gap.end() if gap else m.end()
        lines, k = _Lines(text, spans_), 0
        while k < len(spans_):
            size = None
            start = text[spans_[k][0] : min(spans_[k][1], spans_[k][0] + 16)]
            if start.startswith("M"):  # 0x30, a DER sequence
                size = der_size(from64(start) or b"")
            elif start.startswith("b3BlbnNzaC1rZXkt"):  # openssh-key-
                size = lines.openssh_size(k)
            end = lines.line_after(k, -(-size * 4 // 3)) if size else None
            if end and end > k + 1 and (data := from64(lines.joined(k, end))) and is_key(data):
                yield spans_[k][0], spans_[end - 1][1]
                k = end
            else:
                k += 1


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(cue in low for cue in CUES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    for m in HEX.finditer(text):
        found.append(("hex", m.start(), m.end()))
    runs = {m.span() for pattern in (HEX, HEX_ANY) for m in pattern.finditer(text) if len(m[0]) >= 64 and len(m[0]) % 2 == 0}
    found += [("keyhex", i, j) for i, j in runs if is_key(bytes.fromhex(text[i:j]))]
    if "-----BEGIN " in text:
        found += [("block", *x) for x in blocks(text)]
    if "eyJ" in text:
        found += [("token", m.start(), m.end()) for m in TOKEN.finditer(text) if is_json_object(m[1], "alg") and is_json_object(m[2])]
    keys = set()
    for pattern in (KEY64, URL64):
        for m in pattern.finditer(text):
            data = from64(m[0])
            if data and is_key(data):
                keys.add(m.span())
    keys.update(wrapped_keys(text))
    found += [("key64", *x) for x in keys]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def redacted(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    """The text with every stretch of touching spans replaced by ``MASK``."""
    out, at = [], 0
    for _, start, end in found:
        if start >= at or not out:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


FOUND = "array<struct<kind:string,start:long,end:long>>"


def scanned(docs: DataFrame) -> DataFrame:
    """Every document with all its columns and ``secrets``, its confirmed spans."""
    name = "secrets"
    while name in docs.columns:
        name += "_found"
    at = docs.columns.index("text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans(t.as_py())] for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, name])

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(FOUND))]))


def redact(docs: DataFrame) -> DataFrame:
    """All documents and columns, secrets masked in the text; ``n_chars``, where there, follows a changed text."""
    at = docs.columns.index("text")
    sizes = [k for k, f in enumerate(docs.schema.fields) if f.name == "n_chars"]

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [redacted(t, spans(t)) for t in old]
            columns[at] = pa.array(new, columns[at].type)
            for k in sizes:
                columns[k] = pa.array([n if a == b else len(b) for a, b, n in zip(old, new, columns[k].to_pylist(), strict=True)], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(mask, docs.schema)


def op2_structural_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    text = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    base = F.filter("secrets", lambda x: x["kind"].isin(*BASE))
    kinds = F.transform("secrets", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(F.concat_ws(",", F.transform(base, text)), 256).alias("base_sha256"), F.concat_ws(",", F.transform("secrets", text)).alias("spans")
    )
