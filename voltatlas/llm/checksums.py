"""CRC-32 of many stretches of a byte buffer at once."""

from __future__ import annotations

import zlib

import numpy as np

_BYTE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _BYTE = np.where(_BYTE & 1, (_BYTE >> 1) ^ np.uint32(0xEDB88320), _BYTE >> 1)

# Stretches of more bytes are left to zlib, one by one.
LONG = 64


def crc32(buf: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Unsigned CRC-32 of ``buf[start:end]`` for each stretch; ``before`` is the checksum of what stands in front of it."""
    size = end - start
    out = np.zeros(len(start), np.uint32) if before is None else before.astype(np.uint32)
    for k in np.flatnonzero(size > LONG):
        out[k] = zlib.crc32(buf[start[k] : end[k]].tobytes(), int(out[k]))
    at = np.flatnonzero(size <= LONG)
    at = at[np.argsort(-size[at].astype(np.int8), kind="stable")]
    begin = start[at]
    state = ~out[at]
    live = len(at) - np.concatenate([[0], np.cumsum(np.bincount(size[at], minlength=LONG + 1))])
    for k in range(LONG):
        n = int(live[k + 1])  # stretches of more than k bytes
        if not n:
            break
        state[:n] = _BYTE[(state[:n] ^ buf[begin[:n] + k]) & 255] ^ (state[:n] >> 8)
    out[at] = ~state
    return out
