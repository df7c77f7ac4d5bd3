"""Words of whole batches of texts as arrays, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as compute

from tidewright.llm.common import kept

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; kept for the next piece of the stage."""
    powers = kept("powers", dict)
    if len(powers.get(base, ())) >= n:
        return powers[base][:n]
    out = powers[base] = np.ones(n, np.uint64)
    filled, factor = 1, np.uint64(base)
    while filled < n:
        take = min(filled, n - filled)
        out[filled:filled + take] = out[:take] * factor
        factor, filled = np.uint64(int(factor) ** 2 % (1 << 64)), filled * 2
    return out


class Stretches:
    """Hashes of any stretch of a byte string, the same wherever the stretch stands."""

    def __init__(self, data: bytes):
        self.data, self.raw = data, np.frombuffer(data, np.uint8)
        self.back = _powers(_INVERSE, len(data) + 1)
        terms = (self.raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


#: ASCII punctuation, digits excepted, and control characters become spaces; A-Z become a-z; other bytes stay.
PLAIN = bytes(
    32 if c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128 else c + 32 if 65 <= c < 91 else c
    for c in range(256))


class Tokens(Stretches):
    """Lower-cased words of several texts: start, end and text number of each."""

    def __init__(self, texts: list[bytes]):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        super().__init__(b"\n".join(texts).translate(PLAIN))
        inside = self.raw != 32
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.of = np.searchsorted(np.cumsum(lengths), self.starts, side="right")

    def words(self) -> np.ndarray:
        return self.hash(self.starts, self.ends)

    def stems(self, n: int) -> np.ndarray:
        """Hashes of the first ``n`` bytes of each word."""
        return self.hash(self.starts, np.minimum(self.ends, self.starts + n))


def pieces(batches: Iterator[pa.RecordBatch], limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of column ``text`` each, or one longer text."""
    for batch in batches:
        sizes = compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, stop in zip(cuts, [*cuts[1:], len(sizes)]):
            yield batch.slice(start, stop - start)


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value in the sorted ``keys``, or len(keys)."""
    at = np.searchsorted(keys, wanted)
    if len(keys):
        at[keys[np.minimum(at, len(keys) - 1)] != wanted] = len(keys)
    return at


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50):
    """Weights (bias last) of a ridge-penalised logistic regression on standardised columns, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    weight = weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        move = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + penalty, gradient)
        w = w - move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return w
