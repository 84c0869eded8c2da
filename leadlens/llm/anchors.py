"""Rolling hashes and content-chosen anchors of byte strings, in numpy.

Of the grams (``GRAM`` bytes) inside a window the one with the smallest hash is
the window's anchor, so equal windows have the same anchor at the same offset
wherever they occur. Runs of windows with one anchor form a unit.
"""

from __future__ import annotations

import numpy as np

GRAM = 32
_U = np.uint64
_POS = _U((1 << 24) - 1)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Rolling:
    """64-bit hashes of any substrings, from prefix sums of table[byte] * base^i."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
        self.base = int(rng.integers(1 << 60, 1 << 63)) * 8 + 5 & (1 << 64) - 1
        self._up = self._down = np.ones(1, dtype=_U)

    def _powers(self, n: int) -> None:
        if len(self._up) < n:
            n = max(n, 2 * len(self._up))
            with np.errstate(over="ignore"):
                up, down = np.full(n, self.base, dtype=_U), np.full(n, _inverse(self.base), dtype=_U)
                up[0] = down[0] = 1
                self._up, self._down = np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=_U)
        with np.errstate(over="ignore"):
            np.cumsum(self.table[data] * self._up[:len(data)], dtype=_U, out=out[1:])
        return out

    def of(self, sums: np.ndarray, start, end) -> np.ndarray:
        """Hashes of data[start:end], well mixed."""
        with np.errstate(over="ignore"):
            h = (sums[end] - sums[start]) * self._down[start]
            h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
            return h ^ (h >> _U(32))

    def runs(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hashes of all substrings of a size, by start."""
        n = max(0, len(sums) - size)
        with np.errstate(over="ignore"):
            h = (sums[size:] - sums[:n]) * self._down[:n]
            h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
            return h ^ (h >> _U(32))


GRAMS, WHOLE = Rolling(11), Rolling(23)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(_U).max, dtype=_U)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def units(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, anchor position, first and last window start of each unit."""
    if len(data) < window:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(_U), none, none, none
    if len(data) > _POS:
        raise ValueError("cut longer texts into overlapping parts")
    grams = GRAMS.runs(GRAMS.sums(data), GRAM)
    keyed = (grams & ~_POS) | np.arange(len(grams), dtype=_U)
    anchor = (_sliding_min(keyed, window - GRAM + 1) & _POS).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(first[1:], len(anchor)) - 1
    at = anchor[first]
    return grams[at], at, first, last
