"""Static 3-wise binary fuse filters over 64-bit keys (Graf and Lemire, 2022).

A filter answers "maybe in the set" or "surely not in the set" with about
9 bits a key and one false positive in 256. It is built once over an
immutable key set and never changed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

_U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Finaliser of a 64-bit avalanche hash of key plus seed."""
    with np.errstate(over="ignore"):
        h = keys.astype(_U) + _U(seed)
        for mul in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ (h >> _U(33))) * _U(mul)
        return h ^ (h >> _U(33))


@dataclass
class FuseFilter:
    seed: int
    segment: int     # slots in a segment, a power of two
    segments: int    # first-slot segments; two more follow them
    prints: np.ndarray

    def _slots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        span = _U(self.segment * self.segments)
        first = ((h >> _U(32)) * span) >> _U(32)     # scaled into the span without division
        low = _U(self.segment - 1)
        second = (first + _U(self.segment)) ^ ((h >> _U(18)) & low)
        third = (first + _U(2 * self.segment)) ^ (h & low)
        return first, second, third

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> _U(32))).astype(np.uint8)

    def may_contain(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.prints):
            return np.zeros(len(keys), dtype=bool)
        h = _mix(np.asarray(keys).view(_U), self.seed)
        a, b, c = self._slots(h)
        p = self.prints
        return (p[a] ^ p[b] ^ p[c]) == self._print(h)


def build(keys: np.ndarray) -> FuseFilter:
    """Filter over the distinct ``keys`` (64-bit integers)."""
    keys = np.unique(np.asarray(keys, dtype=np.int64)).view(_U)
    n = len(keys)
    if n == 0:
        return FuseFilter(0, 1, 1, np.zeros(0, dtype=np.uint8))
    segment = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25))) if n > 1 else 4
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    for seed in range(1, 200):
        f = FuseFilter(seed * 0x9E3779B9, segment, segments,
                       np.zeros(segment * (segments + 2), dtype=np.uint8))
        if _fill(f, keys):
            return f
        if seed % 20 == 0:   # tiny or unlucky sets: a little more room
            segments += max(1, segments // 8)
    raise RuntimeError("no seed peels the key set")


def _fill(f: FuseFilter, keys: np.ndarray) -> bool:
    """Peel slots that one key alone uses, round by round, then assign the
    fingerprints in reverse. Keys of a round are independent of one another
    but for those that share a freed slot; one of them is taken."""
    h = _mix(keys, f.seed)
    slots = np.stack(f._slots(h)).astype(np.int64)            # 3 x n
    size, n = len(f.prints), len(keys)
    count = np.bincount(slots.ravel(), minlength=size)
    which = np.zeros(size, dtype=np.int64)                    # xor of the keys at a slot
    ids = np.arange(n, dtype=np.int64)
    for row in slots:
        np.bitwise_xor.at(which, row, ids)
    rounds, left = [], n
    ready = np.flatnonzero(count == 1)
    while len(ready):
        own, first = np.unique(which[ready], return_index=True)
        at = ready[first]
        rounds.append((own, at))
        left -= len(own)
        touched = slots[:, own]
        for row in touched:
            np.subtract.at(count, row, 1)
            np.bitwise_xor.at(which, row, own)
        touched = np.unique(touched)
        ready = touched[count[touched] == 1]
    if left:
        return False
    prints = f._print(h)
    for own, at in reversed(rounds):
        a, b, c = slots[:, own]
        f.prints[at] = 0
        f.prints[at] = prints[own] ^ f.prints[a] ^ f.prints[b] ^ f.prints[c]
    return True
