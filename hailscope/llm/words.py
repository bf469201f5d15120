"""Words of many texts at once as numpy arrays, with rolling hashes over runs of words."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[32, *range(9, 14)]] = True
#: A random odd-looking 64-bit value per byte, from a fixed seed.
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=_U)
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _Powers:
    def __init__(self, base: np.uint64):
        self.base, self.table = base, np.ones(1, _U)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.table):
            grown = np.full(max(n, 2 * len(self.table)), self.base, _U)
            grown[0] = 1
            self.table = np.cumprod(grown)
        return self.table[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each range; equal runs have equal hashes wherever they are."""
    total = np.concatenate([np.zeros(1, _U), np.cumsum(values * _UP.upto(len(values)))])
    down = _DOWN.upto(len(values) + 1)
    return _mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


class Words:
    """Words of several texts; word i of text t is at ``first[t] + i``."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        self.data = b"\n".join([*raw, b""])
        data = np.frombuffer(self.data, np.uint8)
        inside = np.concatenate([[False], ~_IS_WHITE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
        self.first = np.searchsorted(self.starts, bounds)
        self.hashes = _ranges(_BYTES[data], self.starts, self.ends)

    def runs(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on."""
        at = np.arange(max(0, len(self.hashes) - size + 1))
        return _ranges(self.hashes, at, at + size)


def sliding_argmin(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the first smallest of each ``size`` values in a row."""
    if len(values) < size:
        return np.zeros(0, np.int64)
    best, reach = np.arange(len(values)), 1
    while reach < size:
        step = min(reach, size - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        reach += step
    return best
