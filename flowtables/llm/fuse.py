"""Binary-fuse filters: static approximate sets with 8 bits a slot, about 9 bits a key.

A filter answers "certainly absent" or "maybe present" (wrong for about 1 key in 256).
Building peels a 3-uniform hypergraph in parallel rounds of numpy operations.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from flowtables.llm.common import GOLDEN, mix64

_HEAD = struct.Struct("<QII")  # seed, segment length, segments


def _slots(keys: np.ndarray, seed: int, length: int, segments: int):
    with np.errstate(over="ignore"):
        h = mix64(keys + np.uint64(seed) * GOLDEN)
    first = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    print_ = ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)
    return np.stack([first, second, third], 1).astype(np.int64), print_


def _peel(slots: np.ndarray, size: int):
    """Rounds of (keys, their free slots), or None when the graph has a core."""
    n = len(slots)
    degree = np.bincount(slots.ravel(), minlength=size)
    total = np.zeros(size, np.int64)
    np.add.at(total, slots.ravel(), np.repeat(np.arange(n), 3))
    rounds, left = [], n
    free = np.flatnonzero(degree == 1)
    while len(free):
        keys, at = np.unique(total[free], return_index=True)
        rounds.append((keys, free[at]))
        left -= len(keys)
        touched = slots[keys].ravel()
        np.subtract.at(degree, touched, 1)
        np.subtract.at(total, touched, np.repeat(keys, 3))
        touched = np.unique(touched)
        free = touched[degree[touched] == 1]
    return None if left else rounds


def build(keys: np.ndarray) -> bytes:
    """The filter of distinct 64-bit keys as bytes; no keys give a filter that holds nothing."""
    keys = np.unique(np.asarray(keys, np.uint64))
    n = len(keys)
    if not n:
        return b""
    length = 1 << min(18, max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25)))) if n > 1 else 4
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(room / length) - 2)
    for seed in range(1, 1000):
        if seed % 20 == 0:
            segments += max(1, segments // 10)
        slots, prints = _slots(keys, seed, length, segments)
        rounds = _peel(slots, (segments + 2) * length)
        if rounds is not None:
            break
    else:
        raise ValueError("no seed peels these keys")
    table = np.zeros((segments + 2) * length, np.uint8)
    for chosen, at in reversed(rounds):
        of = slots[chosen]
        # The chosen slot is still zero, so it takes no part in the sum of the three.
        table[at] = prints[chosen] ^ table[of[:, 0]] ^ table[of[:, 1]] ^ table[of[:, 2]]
    return _HEAD.pack(seed, length, segments) + table.tobytes()


def maybe(data: bytes, keys: np.ndarray) -> np.ndarray:
    """For each key: False if it is certainly not in the filter."""
    keys = np.asarray(keys, np.uint64)
    if not data or not len(keys):
        return np.zeros(len(keys), bool)
    seed, length, segments = _HEAD.unpack_from(data)
    table = np.frombuffer(data, np.uint8, offset=_HEAD.size)
    slots, prints = _slots(keys, seed, length, segments)
    return (table[slots[:, 0]] ^ table[slots[:, 1]] ^ table[slots[:, 2]]) == prints
