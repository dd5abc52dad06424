"""SHA-256 over many messages at once, with states that can be stored.

``hashlib`` can copy a running hash but not write it down.  Here a state
between two blocks of 64 bytes is 32 plain bytes, so that it can be kept in a
table and resumed by another task.  A digest as hex text is one block exactly.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

#: Messages worked on at once: their words stay in a core's cache.
LANES = 8192
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _primes(n: int) -> list[int]:
    out: list[int] = []
    at = 2
    while len(out) < n:
        if all(at % p for p in out):
            out.append(at)
        at += 1
    return out


def _cube_root(x: int) -> int:
    lo, hi = 0, 1 << (x.bit_length() // 3 + 1)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if mid**3 <= x else (lo, mid - 1)
    return lo


# the standard's constants by its own rule: 32 bits behind the point of roots of primes
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], ">u4").view(np.uint8)


def _turned(x: np.ndarray, *by: int) -> np.ndarray:
    """Exclusive or of ``x`` rotated to the right by each of ``by``."""
    out = None
    for n in by:
        one = (x >> np.uint32(n)) | (x << np.uint32(32 - n))
        out = one if out is None else np.bitwise_xor(out, one, out=out)
    return out


def _absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = [block[:, i].astype(np.uint32) for i in range(16)]
    a, b, c, d, e, f, g, h = start = [state[:, i].astype(np.uint32) for i in range(8)]
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + (_turned(x, 7, 18) ^ (x >> np.uint32(3))) + w[i - 7] + (_turned(y, 17, 19) ^ (y >> np.uint32(10))))
        t = h + _turned(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + (w[i] + ROUND[i])
        h, g, f, e, d, c, b, a = g, f, e, d + t, c, b, a, t + _turned(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
    return np.stack([x + y for x, y in zip(start, (a, b, c, d, e, f, g, h))], axis=1).astype(">u4")


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States after one more block each: (n, 32) and (n, 64) bytes to (n, 32) bytes."""
    out = np.empty_like(states)
    for lo in range(0, len(states), LANES):
        some = slice(lo, lo + LANES)
        s, b = np.ascontiguousarray(states[some]).view(">u4"), np.ascontiguousarray(blocks[some]).view(">u4")
        out[some] = _absorb(s, b).view(np.uint8)
    return out


def finish(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of ``blocks`` whole blocks each that ended in ``states``."""
    last = np.zeros((len(states), 64), np.uint8)
    last[:, 0] = 0x80
    last[:, 56:] = (np.asarray(blocks, np.uint64) * np.uint64(512)).astype(">u8")[:, None].view(np.uint8)
    return absorb(states, last)


def hex_text(digests: np.ndarray) -> np.ndarray:
    """(..., 32) bytes to the (..., 64) bytes of their lowercase hex text."""
    return _HEX[np.stack([digests >> 4, digests & 15], axis=-1)].reshape(*digests.shape[:-1], 64)
