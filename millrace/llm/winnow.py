"""Winnowed window hashes of texts, vectorised over code points.

A text of n code points has n - span + 1 windows of ``span`` code points.  Every window picks the
``gram``-long substrings of smallest hash inside it as its anchors (all of them on a tie), so two
equal windows, wherever they stand, pick anchors at the same places.  Hashes are polynomials over
Z/2^64 of scrambled code points, read from one prefix sum, then mixed.
"""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the polynomial; its inverse modulo 2^64 follows from it.
BASE = 0x9E3779B97F4A7C15
#: Code points handled at once: bounds the memory of one step whatever the texts' lengths.
PIECE = 1 << 20

_U = np.uint64
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (finaliser of a public hash family)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x = x * _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_LOW = mix(np.arange(1 << 16, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(0x632BE59BD9B4E019))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i up to n; kept for the largest n asked for."""
    have = next(iter(_tables), 0)
    if have < n:
        _tables.clear()
        inverse = pow(BASE, -1, 1 << 64)
        out = []
        for b in (BASE, inverse):
            a = np.full(n + 1, b, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _tables[n] = (out[0], out[1])
    return next(iter(_tables.values()))


def codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Hashed:
    """Prefix sums over code points; ``of(a, b)`` hashes the substrings [a, b)."""

    def __init__(self, points: np.ndarray) -> None:
        n = len(points)
        up, self._down = powers(max(n, PIECE + 4096))
        if n and int(points.max()) >= 1 << 16:
            wide = mix(points.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(0x632BE59BD9B4E019))
            scrambled = np.where(points < (1 << 16), _LOW[np.minimum(points, (1 << 16) - 1)], wide)
        else:
            scrambled = _LOW[points]
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(scrambled * up[:n], out=self._sum[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self._sum[b] - self._sum[a]) * self._down[a])

    def every(self, length: int) -> np.ndarray:
        """The hash of the substring of that length at every place."""
        n = len(self._sum) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sum[length:] - self._sum[:n]) * self._down[:n])


def sliding(x: np.ndarray, w: int, op: np.ufunc, fill: int) -> np.ndarray:
    """op over each run of w consecutive values: two accumulations over blocks of w."""
    n = len(x)
    blocks = -(-n // w)
    p = np.full(blocks * w, fill, x.dtype)
    p[:n] = x
    grid = p.reshape(blocks, w)
    ahead = op.accumulate(grid, axis=1).ravel()
    back = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - w + 1], ahead[w - 1 : n])


def anchors(h: np.ndarray, valid: np.ndarray, w: int) -> np.ndarray:
    """Places that are a smallest hash of some valid window of w consecutive places."""
    least = sliding(h, w, np.minimum, np.iinfo(np.uint64).max)
    least[~valid[: len(least)]] = 0
    padded = np.zeros(len(least) + 2 * (w - 1), np.uint64)
    padded[w - 1 : w - 1 + len(least)] = least
    reach = sliding(padded, w, np.maximum, 0)
    # reach[i] is the largest minimum among the valid windows that hold place i
    return np.flatnonzero((reach == h[: len(reach)]) & (reach > 0))
