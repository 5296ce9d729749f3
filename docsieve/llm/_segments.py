"""Token ids of texts by way of their distinct segments.

Most text repeats its words, so a block is cut into segments at places no token can
cross, each distinct segment is encoded once, and the ids of every row are gathered
from those of its segments.  Segments are told apart by two independent 64-bit
hashes.  Encoded segments are kept from block to block in two generations of bounded
size; the cache changes the cost of a block, never its result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from ._util import buffers
from ._words import _BASE, _BASE2, U, _powers_of, mix

CACHE = 500_000


class SegmentEncoder:
    """``encode(list of bytes)`` gives each segment's ids as bytes of ``dtype``; ``cuts(bytes, offsets)`` marks bytes that begin a segment."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], cuts: Callable[[np.ndarray, np.ndarray], np.ndarray], dtype, cache: int = CACHE):
        self.encode, self.cuts, self.dtype, self.cache = encode, cuts, dtype, cache
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _known(self, segments: list[bytes]) -> list[bytes]:
        out: list = [None] * len(segments)
        todo = []
        for i, s in enumerate(segments):
            got = self.new.get(s)
            if got is None:
                got = self.old.get(s)
                if got is None:
                    todo.append(i)
                    continue
                self.new[s] = got
            out[i] = got
        for i, ids in zip(todo, self.encode([segments[i] for i in todo]) if todo else []):
            out[i] = ids
            if len(segments[i]) <= 64:
                self.new[segments[i]] = ids
        if len(self.new) > self.cache:
            self.old, self.new = self.new, {}
        return out

    def rows(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in order, offsets of the rows in them)."""
        offsets, raw = buffers(col)
        begins = self.cuts(raw, offsets)
        filled = offsets[:-1][np.diff(offsets) > 0]
        begins[filled] = True
        start = np.flatnonzero(begins)
        if not len(start):
            return np.zeros(0, self.dtype), np.zeros(len(col) + 1, np.int64)
        end = np.append(start[1:], len(raw))
        h1, h2 = (self._hash(raw, start, end, b) for b in (_BASE, _BASE2))
        _, first, inverse = np.unique(h1, return_index=True, return_inverse=True)
        if not np.array_equal(h2[first][inverse], h2):  # a clash of the first hash: tell apart by both
            _, first, inverse = np.unique(np.stack([h1, h2], 1), axis=0, return_index=True, return_inverse=True)
            inverse = inverse.reshape(-1)
        data = raw.tobytes()
        parts = self._known([data[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())])
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(self.dtype).itemsize
        flat = np.frombuffer(b"".join(parts), self.dtype)
        at = np.concatenate([[0], np.cumsum(size)[:-1]])
        n = size[inverse]
        cum = np.concatenate([[0], np.cumsum(n)])
        take = np.arange(cum[-1]) + np.repeat(at[inverse] - cum[:-1], n)
        return flat[take], cum[np.searchsorted(start, offsets)]

    @staticmethod
    def split(ids: np.ndarray, size: np.ndarray) -> list[bytes]:
        """The bytes of consecutive runs of ids."""
        raw, width = ids.tobytes(), ids.dtype.itemsize
        ends = (np.cumsum(size) * width).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    @staticmethod
    def _hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
        pw, inv = _powers_of(base, len(raw) + 1)
        pref = np.empty(len(raw) + 1, U)
        pref[0] = 0
        c = raw.astype(U)
        c += U(1)
        c *= pw[: len(c)]
        np.cumsum(c, out=pref[1:])
        return mix((pref[end] - pref[start]) * inv[start])
