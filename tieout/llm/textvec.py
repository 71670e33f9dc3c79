"""Words and word hashes of whole texts, as numpy arrays.

A word is a maximal run of bytes other than space and \\t to \\r; UTF-8 keeps those bytes out of
multi-byte characters, so words of bytes are words of characters.
"""

from __future__ import annotations

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix); equal in, equal out, on every machine."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words in the bytes ``data``."""
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~SPACES[data]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes at a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) * _M3)
    at, left = np.arange(len(starts)), sizes
    offset = 0
    while len(at):
        lane = lanes[starts[at] + offset] & _MASKS[np.minimum(left, 8)]
        out[at] = mix((out[at] ^ lane) * _M3 + np.uint64(offset + 1))
        offset += 8
        more = left > 8
        at, left = at[more], left[more] - 8
    return out


def text_bytes(text: str | None, lower: bool = False) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return LOWER[data] if lower else data


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    data = text_bytes(text, lower)
    return hash_spans(data, *word_bounds(data))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles, A-Z lower-cased; of fewer words, one for all."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    span = min(n, size)
    total = np.full(n - span + 1, np.uint64(span))
    for j in range(span):
        total = mix(total * _M3 + words[j : n - span + 1 + j])
    return np.unique(total)
