"""Static binary fuse filters (three-wise, 8-bit fingerprints) in numpy.

Built once for a fixed key set and never changed: about 9 bits a key, no false
negatives, one false positive in 256."""

from __future__ import annotations

import math
import struct

import numpy as np

from .textops import mix

_HEAD = struct.Struct("<qqqq")  # seed, segment length, segments that h0 covers, slots


def _positions(keys: np.ndarray, seed: int, seg: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64(seg - 1)
    h0 = (h >> np.uint64(32)) * np.uint64(span) >> np.uint64(32)
    h1 = (h0 + np.uint64(seg)) ^ ((h >> np.uint64(18)) & mask)
    h2 = (h0 + np.uint64(2 * seg)) ^ (h & mask)
    print_ = ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)
    return np.stack([h0, h1, h2], axis=1).astype(np.int64), print_


def build(keys: np.ndarray) -> bytes:
    """The filter of distinct 64-bit keys, as bytes."""
    keys = np.unique(np.asarray(keys).view(np.uint64))
    n = len(keys)
    seg = 1 << min(18, max(2, int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    for seed in range(1, 200):
        segments = max(1, math.ceil(n * factor * (1 + seed // 20 * 0.1) / seg) - 2)
        span, slots = segments * seg, (segments + 2) * seg
        pos, prints = _positions(keys, seed, seg, span)
        order, alive = [], np.arange(n)
        while len(alive):  # peel the slots that a single key is left in
            at = pos[alive]
            count = np.bincount(at.ravel(), minlength=slots)
            index = np.bincount(at.ravel(), weights=np.repeat(np.arange(len(alive)), 3), minlength=slots)
            lone = np.flatnonzero(count == 1)
            if not len(lone):
                break
            which, first = np.unique(index[lone].astype(np.int64), return_index=True)
            order.append((alive[which], lone[first]))
            alive = np.delete(alive, which)
        if len(alive):
            continue
        table = np.zeros(slots, dtype=np.uint8)
        for key, slot in reversed(order):
            rest = table[pos[key, 0]] ^ table[pos[key, 1]] ^ table[pos[key, 2]] ^ table[slot]
            table[slot] = prints[key] ^ rest
        return _HEAD.pack(seed, seg, span, slots) + table.tobytes()
    raise RuntimeError("no binary fuse filter found for these keys")


def contains(data: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the filter, and for about one other in 256."""
    seed, seg, span, slots = _HEAD.unpack_from(data)
    table = np.frombuffer(data, dtype=np.uint8, offset=_HEAD.size, count=slots)
    pos, prints = _positions(np.asarray(keys).view(np.uint64), seed, seg, span)
    return (table[pos[:, 0]] ^ table[pos[:, 1]] ^ table[pos[:, 2]]) == prints
