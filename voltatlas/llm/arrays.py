"""Numpy helpers on the bytes of many texts at once: words, lines, hashes, sort-based grouping."""

from __future__ import annotations

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTE_CODE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 20)
        _POWERS[:] = []
        for b in (_BASE, _INVERSE):
            p = np.full(size, U(b))
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Spans:
    """Hashes of any stretch of a sequence of codes, each in constant time."""

    def __init__(self, codes: np.ndarray) -> None:
        up, self.down = powers(len(codes))
        self.sums = np.zeros(len(codes) + 1, U)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a line feed after each, and where each begins (one entry more than texts)."""
    sizes = np.fromiter((len(t) + 1 if t is not None else 1 for t in texts), np.int64, len(texts))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    return np.frombuffer(b"".join((t or b"") + b"\n" for t in texts), np.uint8), starts


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every ``[^\\x20\\x09-\\x0D]+``; ``buf`` ends with a separator."""
    gap = SPACE[buf]
    change = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(buf) and not gap[0]:
        change = np.concatenate([[0], change])
    return change[::2], change[1::2]


def line_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every line; the separator after each text ends its last one."""
    end = np.flatnonzero(buf == 10)
    start = np.zeros_like(end)
    start[1:] = end[:-1] + 1
    return start, end


def owner(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of the text that holds each byte position."""
    return np.searchsorted(starts, at, side="right") - 1


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` neighbours, for the positions where one fits."""
    if len(hashes) < n:
        return np.zeros(0, U)
    out = np.zeros(len(hashes) - n + 1, U)
    for k in range(n):
        out += hashes[k : len(hashes) - n + 1 + k] * U(((2 * k + 1) * 0xA0761D6478BD642F) % (1 << 64) | 1)
        out = mix(out + U(k + 1))
    return out


def in_one(own: np.ndarray, n: int) -> np.ndarray:
    """Whether the run of ``n`` neighbours that begins here stays within one text."""
    return own[n - 1 :] == own[: len(own) - n + 1] if len(own) >= n else np.zeros(0, bool)


def keyed(own: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes made different for different texts."""
    return mix(hashes ^ (own.astype(U) * U(0xE7037ED1A0B428DB)))


def repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def cover(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any of the stretches."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, end, -1)
    return np.cumsum(edges[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
