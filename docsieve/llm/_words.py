"""Vectorised word kernels over UTF-8 bytes.

All word classes used here are complements of ASCII ranges, and every byte of a
multi-byte UTF-8 character is >= 0x80, so splitting bytes equals splitting code
points.  Words get 64-bit polynomial hashes (odd base, modulo 2**64, finalised by
a bijective mixer); where a decision hangs on equal hashes the caller verifies the
bytes or carries two independent hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ._util import buffers

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE2 = 0xC2B2AE3D27D4EB4F | 1
_MASK = (1 << 64) - 1


def _lut(pred) -> np.ndarray:
    return np.array([pred(b) for b in range(256)], dtype=bool)


#: bytes of words that white space (space, \t..\r) ends
NOT_SPACE = _lut(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] words (digits, a-z, beyond ASCII)
ALNUM_LOW = _lut(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inv = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inv):
            p = np.full(size, b, dtype=U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[base] = have = (out[0], out[1])
        if n > (1 << 24):  # an odd giant text must not pin memory
            _powers.pop(base)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser."""
    h = h.astype(U, copy=True)
    h ^= h >> U(33)
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


class Words:
    """The words of some texts: byte spans, row boundaries and hashes."""

    def __init__(self, col: pa.Array, word_bytes: np.ndarray, lower: bool, hashes: int = 1):
        offsets, raw = buffers(col)
        self.raw = LOWER[raw] if lower else raw
        n = len(raw)
        mask = word_bytes[self.raw]
        prev = np.empty(n, bool)
        nxt = np.empty(n, bool)
        if n:
            prev[0] = nxt[-1] = False
            prev[1:] = mask[:-1]
            nxt[:-1] = mask[1:]
            starts_ends = offsets[1:-1]
            inner = starts_ends[(starts_ends > 0) & (starts_ends < n)]
            prev[inner] = False
            nxt[inner - 1] = False
        self.offsets = offsets
        self.start = np.flatnonzero(mask & ~prev)
        self.end = np.flatnonzero(mask & ~nxt) + 1
        #: row r has the words rows[r] .. rows[r + 1]
        self.rows = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.rows)
        self.hash = self._hash(_BASE) if hashes else None
        self.hash2 = self._hash(_BASE2) if hashes > 1 else None

    def _hash(self, base: int) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, U)
        pw, inv = _powers_of(base, len(self.raw) + 1)
        pref = np.empty(len(self.raw) + 1, U)
        pref[0] = 0
        c = self.raw.astype(U)
        c += U(1)
        c *= pw[: len(c)]
        np.cumsum(c, out=pref[1:])
        h = pref[self.end] - pref[self.start]
        h *= inv[self.start]
        return mix(h)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def windows(self, k: int, hashes: np.ndarray | None = None, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every k-word window inside one row."""
        h = self.hash if hashes is None else hashes
        n = len(h)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, U)
        left = np.repeat(self.rows[1:], self.count)
        at = np.flatnonzero(np.arange(n) + k <= left)
        if k <= 16:
            g = np.full(n - k + 1, salt, dtype=U)
            for j in range(k):
                g *= U(_BASE2)
                g += h[j : n - k + 1 + j]
            return at, mix(g[at])
        pw, inv = _powers_of(_BASE2, n + 1)
        pref = np.empty(n + 1, U)
        pref[0] = 0
        np.cumsum(h * pw[:n], out=pref[1:])
        return at, mix((pref[at + k] - pref[at]) * inv[at] + U(salt))

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]].tobytes()


def row_bytes(w: Words, i: int, k: int) -> bytes:
    """k words from the i-th on, joined by one space."""
    return b" ".join(w.raw[s:e].tobytes() for s, e in zip(w.start[i : i + k], w.end[i : i + k]))


def covered(at: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n words lie in a k-word window that starts at one of ``at``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, at, 1)
    np.add.at(d, np.minimum(at + k, n), -1)
    return np.cumsum(d[:-1]) > 0
