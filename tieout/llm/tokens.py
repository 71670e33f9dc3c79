"""Token ids of whole texts with the ``tokenizers`` library, one call for each new word.

The vocabulary's normaliser and splitter never look across white space (NFC, lower case and the
word pattern all stop there), so the ids of a text are those of its words, one after another. The
same holds between a letter or digit and ASCII punctuation after it, so a word's trailing
punctuation is looked up on its own. Bounded caches in each Python worker keep what was met; words
beyond them are encoded again in their batch. Inside a batch each word is looked up once, by a
64-bit hash. Tests hold the result against encoding whole texts.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .textvec import hash_spans, word_bounds

#: Words, and words without their trailing punctuation, that a worker keeps (some 250 bytes each).
CACHED_WORDS = 300_000
CACHED_BYTES = 40
#: Punctuation that may be taken off the end of a word; no pattern of the vocabulary begins with it.
_TRAIL = b".,;:!?*%$&#|"
_MARK = "\x01"


class WordEncoder:
    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.cached = cached
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = False
        self.mark = self.library.encode(_MARK, add_special_tokens=False).ids
        self.words: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        """The word without its trailing punctuation, ASCII lower-cased, and that punctuation."""
        if b"<|" in word:
            return word, b""
        word = word.lower()
        core = word.rstrip(_TRAIL)
        if len(core) == len(word) or not core:
            return word, b""
        last = core[-1:]
        if not last.isalnum():  # of bytes: ASCII letters and digits
            char = core[-4:].decode("utf-8", "ignore")[-1:]
            if not ("\xc0" <= char < "\u0250" and char.isalpha() and len(char.lower()) == 1):
                return word, b""
        return core, word[len(core) :]

    def _alone(self, word: bytes) -> bytes:
        return np.array(self.library.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words in one call: a mark that no word holds stands between them."""
        out = {}
        plain = [w for w in words if b"\x01" not in w and b"<|" not in w]
        for w in set(words).difference(plain):
            out[w] = self._alone(w)
        for k in range(0, len(plain), 2000):
            part = plain[k : k + 2000]
            text = f" {_MARK} ".join(w.decode("utf-8", "replace") for w in part)
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark[0]) if len(self.mark) == 1 else []
            if len(cuts) != len(part) - 1:
                out.update((w, self._alone(w)) for w in part)
                continue
            begin = 0
            for w, cut in zip(part, [*cuts.tolist(), len(ids)], strict=True):
                out[w] = ids[begin:cut].tobytes()
                begin = cut + 1
        return out

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers; none for a null text."""
        encoded = [(t or "").encode("utf-8", "replace") for t in texts]
        data = b"\n".join(encoded)
        array = np.frombuffer(data, np.uint8)
        starts, ends = word_bounds(array)
        _, first, place = np.unique(hash_spans(array, starts, ends), return_index=True, return_inverse=True)
        words = [data[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        known, cores = self.words, self.cores
        found = list(map(known.get, words))
        fresh = {w for w, x in zip(words, found, strict=True) if x is None}
        once = {}
        if fresh:
            parts = {w: self._parts(w) for w in fresh}
            wanted = {p for pair in parts.values() for p in pair}.difference(cores, [b""])
            got = self._encode(sorted(wanted)) if wanted else {}
            core_of, got_of = cores.get, got.get
            for w, (core, trail) in parts.items():
                ids = core_of(core) or got_of(core, b"")
                if trail:
                    ids += core_of(trail) or got_of(trail, b"")
                once[w] = ids
            if len(known) < self.cached:
                known.update((w, ids) for w, ids in once.items() if len(w) <= CACHED_BYTES)
            if len(cores) < self.cached:
                cores.update((p, ids) for p, ids in got.items() if len(p) <= CACHED_BYTES)
            found = [once[w] if x is None else x for w, x in zip(words, found, strict=True)]

        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        n = sizes[place]  # of every word, in order
        upto = np.concatenate([[0], np.cumsum(n)])
        out = ids[np.arange(upto[-1]) + np.repeat(begins[place] - upto[:-1], n)].tobytes()
        edges = np.cumsum([0, *(len(x) + 1 for x in encoded)])
        cuts = (4 * upto[np.searchsorted(starts, edges)]).tolist()
        return [out[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, cached: int = CACHED_WORDS) -> WordEncoder:
    """One encoder in each Python worker, with at most about ``cached`` words of either kind in its caches."""
    if (path, cached) not in _ENCODERS:
        _ENCODERS[path, cached] = WordEncoder(path, cached)
    return _ENCODERS[path, cached]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def text_blocks(texts: pa.Array, most: int):
    """(first, after last, texts) of an Arrow column, at most ``most`` bytes at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for i, j in blocks(sizes, most):
        yield i, j, texts.slice(i, j - i).to_pylist()


def blocks(sizes: np.ndarray, most: int):
    """Row ranges of at most ``most`` units together (a single larger row stands alone)."""
    begin, total = 0, 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > most:
            yield begin, k
            begin, total = k, 0
        total += int(size)
    if len(sizes) > begin:
        yield begin, len(sizes)


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
