"""Hashed word n-gram features, FTRL-proximal training and sparse scoring on numpy arrays."""

from __future__ import annotations

from zlib import crc32

import numpy as np

BITS = 18
DIM = 1 << BITS
BIAS = DIM  # one slot past the hashed ones
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape_table() -> bytes:
    """Byte -> class: A upper, a lower or above ASCII, 9 digit, each other byte itself."""
    out = bytearray(range(256))
    for b in range(256):
        c = chr(b)
        out[b] = ord("A") if "A" <= c <= "Z" else ord("a") if "a" <= c <= "z" or b >= 128 else ord("9") if "0" <= c <= "9" else b
    return bytes(out)


SHAPES = _shape_table()


def _slots(h: np.ndarray, salt: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((h + salt) * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


class _Cache(dict):
    """bytes -> 32-bit hash, emptied when large; words of a language repeat."""

    def __missing__(self, key: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        self[key] = h = crc32(key[-4:]) ^ (min(len(key), 31) >> 2)
        return h


_shape_hash = _Cache()


def occurrences(text: str | None) -> np.ndarray:
    """A slot for each hashed word, word shape, adjacent pair of words and pair of shapes.

    Words are split on ASCII white space; two equal words in a row make one feature whatever
    the word. A shape is the class of the last four bytes and the length in steps of four.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(crc32, words), np.uint64, len(words))
    shape = np.fromiter(map(_shape_hash.__getitem__, data.translate(SHAPES).split()), np.uint64, len(words))
    with np.errstate(over="ignore"):
        pair = np.where(h[:-1] == h[1:], np.uint64(7), (h[:-1] * np.uint64(0x100000001B3)) ^ h[1:])
        steps = (shape[:-1] * np.uint64(0x100000001B3)) ^ shape[1:]
    return np.concatenate([_slots(x, np.uint64(salt)) for salt, x in enumerate((h, shape, pair, steps), 1)])


SCALE = 16.0  # a text's counts are relative frequencies times this


def score(weights: np.ndarray, text: str | None) -> float:
    """Chance of label 1: the sparse dot product of relative frequencies and weights."""
    slots = occurrences(text)
    z = float(weights[BIAS]) + (SCALE * float(weights[slots].mean(dtype=np.float64)) if len(slots) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct slots, values) with the bias last."""
    slots, counts = np.unique(occurrences(text), return_counts=True)
    return np.append(slots, BIAS), np.append(SCALE * counts / max(counts.sum(), 1), 1.0)


def train(rows: list[tuple[str | None, int]], epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3) -> np.ndarray:
    """FTRL-proximal logistic regression over ``rows`` in order; classes weigh the same in sum."""
    z, n, w = np.zeros(DIM + 1), np.zeros(DIM + 1), np.zeros(DIM + 1)
    seen = [(*features(t), y) for t, y in rows]
    ones = sum(y for *_, y in seen)
    weigh = {1: len(seen) / (2 * max(ones, 1)), 0: len(seen) / (2 * max(len(seen) - ones, 1))}
    for _ in range(epochs):
        for slots, values, y in seen:
            zi, ni = z[slots], n[slots]
            wi = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            g = weigh[y] * (1 / (1 + np.exp(-np.clip(wi @ values, -30, 30))) - y) * values
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[slots] += g - sigma * wi
            n[slots] += g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w.astype(np.float32)
