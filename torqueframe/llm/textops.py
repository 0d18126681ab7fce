"""Numpy kernels over whole Arrow batches of text.

A batch is one byte buffer plus document offsets, so no step loops over
characters, words or shingles in Python. Batches are cut into runs of whole
documents of about ``CHUNK`` bytes; a longer document is a run by itself, so
memory is bounded by that or by one document.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    out = []
    for b in (_BASE, _INVERSE):
        a = np.full(n, b, dtype=np.uint64)
        a[0] = 1
        out.append(np.multiply.accumulate(a))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << 20
    while size < n:
        size *= 2
    return _powers(size)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def runs(texts: pa.Array, chunk: int = CHUNK, lower: bool = False):
    """Yield (first row, byte buffer, offsets) for runs of whole documents,
    in lower case (Unicode) on request; null counts as empty. Offsets start at
    0 and have one entry more than there are documents."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    binary = pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)
    texts = texts.fill_null(b"" if binary else "")
    n = len(texts)
    if not n:
        return
    _, off = _buffers(texts)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + chunk, side="right")) - 1)
        j = min(j, n)
        own = texts.slice(i, j - i)
        yield (i, *_buffers(pc.utf8_lower(own) if lower else own))
        i = j


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span [start, end)."""
    power, inverse = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that cross no document border.

    Returns starts, ends and, per document, the index of its first run (with
    one entry more)."""
    n = len(inside)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < n)]
    first[borders] = inside[borders]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[borders - 1] = inside[borders - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


# bytes of a word: digits, lower-case letters and every non-ASCII character
_WORD = np.zeros(256, dtype=bool)
_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of lower-cased text, and the index
    of each document's first word (with one entry more)."""
    start, end, at = spans(_WORD[data], offsets)
    return span_hashes(data, start, end), start, end, at


_MULT = mix(np.arange(1, 65, dtype=np.uint64) * _BASE) | np.uint64(1)


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a document, and the index of each
    document's first. A document of 1 to k-1 words has one shingle, all of its
    words; one without words has none."""
    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    first = np.zeros(len(at), dtype=np.int64)
    np.cumsum(count, out=first[1:])
    which = np.repeat(np.arange(len(n)), count)
    pos = at[:-1][which] + (np.arange(first[-1]) - first[:-1][which])
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    total = np.zeros(len(pos), dtype=np.uint64)
    size = np.minimum(n, k)[which]
    short = bool((size < k).any())
    for i in range(k):
        part = padded[pos + i] * _MULT[i]
        total += np.where(size > i, part, np.uint64(0)) if short else part
    return mix(total + size.astype(np.uint64)), first
