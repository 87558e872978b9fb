"""Vectorised hashes of words and of byte strings, for use inside tasks."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Space and the ASCII controls tab to carriage return separate words.
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; up to two million are remembered."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        out = np.cumprod(out)
        if n > 2 << 20:
            return out[:n]
        _powers[base] = out
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Substrings:
    """Hashes of substrings of one byte string from prefix sums: polynomials modulo 2**64 over random byte values."""

    def __init__(self, data: np.ndarray, base: int = _BASE):
        self.up = powers(base, len(data) + 1)
        self.down = powers(pow(base, -1, 1 << 64), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * self.up[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes at each position."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n] + np.uint64(size))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the words of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_GAP[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def word_hashes(texts: list[bytes], base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each text."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    start, stop = word_spans(data)
    first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    counts = np.diff(np.append(np.searchsorted(start, first), len(start)))
    return Substrings(data, base)(start, stop), counts


def sequences(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` consecutive hashes at each position."""
    n = max(0, len(h) - size + 1)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out ^ h[k : k + n])
    return out


def slices(texts: list, size: int = 1_000_000):
    """Index ranges of ``texts`` (strings or bytes, None is empty) that hold about ``size`` or one text."""
    at = 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held < size):
            held += len(texts[to] or "")
            to += 1
        yield at, to
        at = to


def sub_batches(batch, column: str, size: int = 1_000_000):
    """Row ranges of an Arrow batch whose texts hold about ``size`` bytes, or one row: only those become Python objects."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(lengths):
        n = max(1, int(np.searchsorted(np.cumsum(lengths[at : at + 20_000], dtype=np.int64), size, side="right")))
        yield batch.slice(at, n)
        at += n
