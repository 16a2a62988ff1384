"""Words of many texts at once: places and 64-bit hashes by array operations."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WIDE = 1 << 16
TURN = 1 << 16  # bytes of text hashed at once
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


_POWER = _powers(_BASE, _WIDE)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def lowered(texts: list[bytes]) -> np.ndarray:
    """Bytes of the texts, A-Z lowered, a space before, between and behind."""
    return _LOW[np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)]


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, A-Z lowered, a space before, between and behind; and where each begins."""
    parts = [t.encode("utf-8", "replace") for t in texts]
    return lowered(parts), np.cumsum([1, *(len(p) + 1 for p in parts)])


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and hash of every run without white space; ``raw`` ends and begins with a space."""
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    first, end = edge[::2], edge[1::2]
    if not len(first):
        return first, end, np.empty(0, np.uint64)
    h = np.empty(len(first), np.uint64)
    cuts = np.unique(np.searchsorted(first, np.arange(0, len(raw), TURN))).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(first)], strict=True):
        if a < b:
            to = int(first[b]) if b < len(first) else len(raw)
            h[a:b] = _sums(raw[first[a] : to], space[first[a] : to], first[a:b] - first[a], int((end[a:b] - first[a:b]).max()))
    return first, end, mix(h ^ (end - first).astype(np.uint64))


def _sums(raw: np.ndarray, space: np.ndarray, first: np.ndarray, longest: int) -> np.ndarray:
    """Of each word, its bytes' codes times the powers of their places; ``raw`` begins with a word."""
    code = _BYTE[raw]
    place = np.arange(len(raw), dtype=np.int64)
    place -= np.repeat(first, np.diff(first, append=len(raw)))
    if longest >= _WIDE:
        high = place >> 16
        code *= _powers(pow(_BASE, _WIDE, 1 << 64), int(high.max()) + 1)[np.maximum(high, 0)]
        place &= _WIDE - 1
    code *= _POWER[np.minimum(place, _WIDE - 1)]
    code[space] = 0
    return np.add.reduceat(code, first)


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ascending distinct keys, a place of each, and which of them every key is."""
    order = np.argsort(key)
    ascending = key[order]
    new = np.ones(len(key), bool)
    np.not_equal(ascending[1:], ascending[:-1], out=new[1:])
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    return ascending[new], order[new], which
