"""SentencePiece encoding and decoding by suffix-array matching.

A block's texts, escaped as the model asks, are cut into segments no piece can cross;
the distinct segments new to the worker are joined to one text.  Its suffixes are
sorted to the depth of the longest piece, every piece is binary-searched for its range
of occurrences, and the occurrences, sorted by position, are the edges of a lattice
over each segment.  For unigram models the edges are relaxed in order of position
(the path of the best total score); byte-pair models define their result by the order
of merges, so there the edges are relaxed in merge order: as long as two neighbouring
symbols span an edge, the edge of the best score, leftmost first, is taken.
Characters outside the vocabulary become byte pieces, or the unknown id.

Defined cases: a null or empty text has no ids and decodes to the empty text; U+2581
in a text is a space, as in the library; other columns are ignored or passed on.  Rows
are independent, nothing is shuffled, and a task holds one block.  A column that has the name
of the result stays under that name with ``_given`` behind it.

A segment of more than ``_WINDOW`` characters (text without any space) is encoded in windows for
byte-pair models.  Each window begins at a boundary of the one before, and the two pieces at
the seam must be what the two encode to by themselves: a sequence of pieces of which every
two neighbours have that property is the encoding of the whole, as the first merge across
a boundary would be one of just two neighbours.  Where a seam does not hold, an earlier
boundary is taken, or a larger window.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._segments import SegmentEncoder
from ._util import chunks, column, keyed, read_table, trim, trimmed

_SPACE = "▁"
_BLOCK = 512 << 10  # bytes of text cut and gathered at once
_JOINED = 1 << 17  # characters whose suffixes are sorted at once
_CACHE = 250_000
_WINDOW = 1 << 16  # characters of a segment that are merged at once
_SEAM = 1 << 10  # characters at a window's end that the next one reads again
_LONG = 48  # characters from which a segment is merged with a heap of its own
_models: dict[str, "PieceModel"] = {}


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            b = data[i]
            i += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while i < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: object = varint()
        elif kind == 2:
            n = varint()
            value, i = data[i : i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = data[i : i + n], i + n
        yield tag >> 3, value


class PieceModel:
    """Pieces, scores and flags of a model file."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], bpe: bool, prefix: bool = True, squeeze: bool = False):
        self.pieces, self.scores, self.kinds, self.bpe, self.prefix = pieces, np.array(scores), kinds, bpe, prefix
        if squeeze:
            raise ValueError("models that remove extra white space are not supported")
        usable = [i for i, k in enumerate(kinds) if k in (1, 4)]  # normal, user-defined
        self.ids = {pieces[i]: i for i in usable}
        self.unknown = next((i for i, k in enumerate(kinds) if k == 2), 0)
        self.bytes = {int(pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == 6}
        many = [p for p in self.ids if len(p) > 1]
        self.depth = max((len(p) for p in many), default=1)
        many.sort()
        self.size = np.array([len(p) for p in many], np.int64)
        self.piece = np.array([self.ids[p] for p in many], np.int64)
        #: the longer pieces as a matrix of ranks among their own characters, filled up with -1
        self.chars = np.unique(np.array([ord(c) for p in many for c in p], np.int64))
        self.spelled = np.full((len(many), self.depth), -1, np.int32)
        inside = np.arange(self.depth) < self.size[:, None]
        self.spelled[inside] = np.searchsorted(self.chars, np.array([ord(c) for p in many for c in p], np.int64))
        #: no piece has a space behind another character, and these characters are in no longer piece
        self.cut_spaces = not any(_SPACE in p.lstrip(_SPACE) for p in many)
        joined = {c for p in many for c in p}
        self.alone = [c for c in "\n\t\r" if c not in joined]
        self.encoder = SegmentEncoder(self._encode, self._cuts, np.int32, _CACHE)
        table = [b"" if k in (2, 3) else bytes([int(p[3:5], 16)]) if k == 6 else p.replace(_SPACE, " ").encode() for p, k in zip(pieces, kinds)]
        table[self.unknown] = " ⁇ ".encode()
        self.surface = table

    @classmethod
    def load(cls, path: str) -> PieceModel:
        if path not in _models:
            with open(path, "rb") as f:
                data = f.read()
            import struct

            pieces, scores, kinds, bpe, prefix, squeeze = [], [], [], False, True, True
            for n, v in _fields(data):
                if n == 1:
                    p = {1: b"", 2: struct.pack("<f", 0.0), 3: 1} | dict(_fields(v))
                    pieces.append(p[1].decode())
                    scores.append(struct.unpack("<f", p[2])[0])
                    kinds.append(p[3])
                elif n == 2:
                    bpe = dict(_fields(v)).get(3, 1) == 2
                elif n == 3:
                    spec = dict(_fields(v))
                    prefix, squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                    if spec.get(2) or not spec.get(5, 1):
                        raise ValueError("models that rewrite characters are not supported")
            _models[path] = cls(pieces, scores, kinds, bpe, prefix, squeeze)
        return _models[path]

    # ------------------------------------------------------------ segments
    def _cuts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        begins = np.zeros(len(raw), bool)
        if self.cut_spaces:
            space = raw == 0x20
            begins = space.copy()
            begins[1:] &= ~space[:-1]
        for c in self.alone:
            at = np.flatnonzero(raw == ord(c))
            begins[at] = True
            begins[at[at + 1 < len(raw)] + 1] = True
        return begins

    def rows(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row offsets) of a block of texts."""
        col = pc.replace_substring(col, _SPACE, " ")
        if self.prefix:
            col = pc.if_else(pc.equal(pc.binary_length(col), 0), col, pc.binary_join_element_wise(" ", col, ""))
        return self.encoder.rows(col)

    # ------------------------------------------------------------ matching
    def edges(self, text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, id) of every occurrence of every longer piece, by start."""
        alphabet, code = np.unique(text, return_inverse=True)
        order = _suffixes(code.astype(np.int64), depth)
        width = np.dtype(">u2") if len(alphabet) < 0xFFFF else np.dtype(">u4")
        padded = np.zeros(len(text) + depth, width)
        padded[: len(text)] = code + 1
        keys = np.lib.stride_tricks.sliding_window_view(padded, depth)[order]
        keys = np.ascontiguousarray(keys).view(f"S{depth * width.itemsize}").ravel()
        # The text's code of each character of the pieces, 0 where the text lacks it.
        near = np.minimum(np.searchsorted(alphabet, self.chars), len(alphabet) - 1)
        codes = np.append(np.where(alphabet[near] == self.chars, near + 1, 0), -1)
        spelled = codes[self.spelled]
        found = np.flatnonzero((spelled != 0).all(1))
        if not len(found):
            return (np.zeros(0, np.int64),) * 3
        spelled = spelled[found]
        low = np.maximum(spelled, 0).astype(width)
        high = np.where(spelled < 0, np.iinfo(width.newbyteorder("=")).max, spelled).astype(width)
        lo = np.searchsorted(keys, low.view(keys.dtype).ravel(), side="left")
        hi = np.searchsorted(keys, high.view(keys.dtype).ravel(), side="right")
        n = hi - lo
        size, ids = self.size[found], self.piece[found]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        start, length, piece = order[at], np.repeat(size, n), np.repeat(ids, n)
        by = np.argsort(start, kind="stable")
        return start[by], length[by], piece[by]

    def _encode(self, segments: list[bytes]) -> list[bytes]:
        texts = [s.decode().replace(" ", _SPACE) for s in segments]
        out: list[bytes] = []
        i = 0
        while i < len(texts):  # blocks of bounded size
            if self.bpe and len(texts[i]) > _WINDOW:
                out.append(self._windows(texts[i]))
                i += 1
                continue
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= _JOINED) and not (self.bpe and len(texts[j]) > _WINDOW):
                size += len(texts[j])
                j += 1
            out += self._block(texts[i:j])
            i = j
        return out

    def _windows(self, text: str, window: int = _WINDOW, seam: int = _SEAM) -> bytes:
        """The ids of one long segment, a window at a time."""
        out: list[np.ndarray] = []
        at, ids, joined = self._spans(text[:window])
        begin, size = 0, window
        while begin + size < len(text):
            k = int(np.searchsorted(at, size - seam, side="right")) - 1
            while k > 0:
                cut = begin + int(at[k])
                after = self._spans(text[cut : cut + window])
                own = int(after[0][1]) if len(after[0]) > 1 else len(text) - cut
                there = int(at[k + 1] - at[k]) if k + 1 < len(at) else -1
                if own == there or self._spans(text[begin + int(at[k - 1]) : cut + own])[0].tolist() == [0, int(at[k] - at[k - 1])]:
                    break
                k -= max(1, len(at) // 64)
            if k <= 0:  # no seam holds: a larger window
                size *= 2
                at, ids, joined = self._spans(text[begin : begin + size])
                continue
            out.append(self._ids(joined, at[:k], ids[:k]))
            begin, size = cut, window
            at, ids, joined = after
        out.append(self._ids(joined, at, ids))
        return np.concatenate(out).astype(np.int32).tobytes()

    def _spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts of the pieces, their ids or -1, characters) of one segment."""
        joined, _, size, (at, ids) = self._lattice([text])
        n = int(np.searchsorted(at, size[0]))
        return at[:n], ids[:n], joined

    def _lattice(self, texts: list[str]):
        """(characters of all segments, starts, sizes, (starts of pieces, ids))."""
        size = np.array([len(t) for t in texts])
        # A character of its own kind ends each segment, so no match leaves one.
        joined = np.frombuffer("\0".join(texts).encode("utf-32-le") + b"\0\0\0\0", "<u4").astype(np.int64)
        first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        joined[first + size] = 0x110000
        start, length, piece = self.edges(joined, self.depth)
        alphabet = np.unique(joined)
        single = np.array([self.ids.get(chr(c), -1) if c < 0x110000 else -1 for c in alphabet.tolist()])
        one = single[np.searchsorted(alphabet, joined)]
        relax = self._merge if self.bpe else self._shortest
        return joined, first, size, relax(*((joined,) if self.bpe else ()), first, size, start, length, piece, one)

    def _block(self, texts: list[str]) -> list[bytes]:
        joined, first, size, spans = self._lattice(texts)
        low, high = np.searchsorted(spans[0], first), np.searchsorted(spans[0], first + size)
        if (spans[1] >= 0).all():
            return SegmentEncoder.split(spans[1].astype(np.int32), high - low)
        return [self._ids(joined, spans[0][a:b], spans[1][a:b]).tobytes() for a, b in zip(low, high)]

    def _ids(self, text: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        if (ids >= 0).all():
            return ids.astype(np.int32)
        out: list[int] = []
        was = False
        for a, i in zip(at.tolist(), ids.tolist()):
            if i >= 0:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in chr(int(text[a])).encode()]
            elif not was:
                out.append(self.unknown)
            was = i < 0
        return np.array(out, np.int32)

    # ------------------------------------------------------------ relaxing
    def _merge(self, text, first, size, start, length, piece, one):
        """Byte-pair order: (starts of the final symbols, their ids)."""
        grid = np.full((len(text), self.depth + 1), -1, np.int32)
        grid[start, length] = piece
        grid[:, 1] = one
        rank = np.full(len(self.scores) + 1, -np.inf)
        rank[:-1] = self.scores
        stops = np.zeros(len(text) + 1, bool)
        stops[first + size] = True
        symbol = np.ones(len(text), bool)
        symbol[first + size] = False
        for s, n in zip(first[size > _LONG].tolist(), size[size > _LONG].tolist()):
            _merge_long(grid, rank, symbol, s, n, self.depth)
        short = size <= _LONG
        owner = np.repeat(np.arange(len(size)), size + 1)
        live = np.flatnonzero(symbol & short[owner])
        done = []
        while len(live):
            seg = owner[live]
            follows = np.zeros(len(live), bool)
            follows[:-1] = seg[1:] == seg[:-1]
            nxt = np.append(live[1:], 0)
            end_at = np.where(follows, np.append(nxt[1:], 0), 0)
            # the end of the following symbol: the next symbol's start, or the segment's end
            after = np.zeros(len(live), bool)
            after[:-2] = seg[2:] == seg[:-2]
            end_at = np.where(after, end_at, first[seg] + size[seg])
            span = np.where(follows, end_at - live, 0)
            merged = np.where(follows & (span <= self.depth), grid[live, np.minimum(span, self.depth)], -1)
            score = rank[merged]
            head = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            best = np.maximum.reduceat(score, head)
            each = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(live))))
            hit = np.flatnonzero((score == best[each]) & (merged >= 0))
            active = best > -np.inf
            if not active.all():
                done.append(live[~active[each]])
            if not len(hit):
                break
            leftmost = hit[np.concatenate([[True], each[hit][1:] != each[hit][:-1]])]
            keep = active[each]
            keep[leftmost + 1] = False
            live = live[keep]
        final = np.zeros(len(text), bool)
        for d in done:
            final[d] = True
        final |= symbol & ~short[owner]
        at = np.flatnonzero(final)
        ends = np.append(at[1:], len(text))
        stop = first[owner[at]] + size[owner[at]]
        ends = np.minimum(ends, stop)
        return at, grid[at, ends - at]

    def _shortest(self, first, size, start, length, piece, one):
        """Best total score: relaxes the edges in order of their start."""
        low = float(self.scores.min()) - 10.0
        at_out, id_out = [], []
        cut = np.searchsorted(start, np.append(first, first[-1:] + size[-1:] + 1 if len(first) else []))
        for k, (s, n) in enumerate(zip(first.tolist(), size.tolist())):
            best, back = [-np.inf] * (n + 1), [(0, -1)] * (n + 1)
            best[0] = 0.0
            e, stop = int(cut[k]), int(cut[k + 1])
            for i in range(n):
                c = int(one[s + i])
                ways = [(1, c, self.scores[c] if c >= 0 else low)]
                while e < stop and start[e] == s + i:
                    ways.append((int(length[e]), int(piece[e]), self.scores[piece[e]]))
                    e += 1
                for ln, p, sc in ways:
                    if best[i] + sc > best[i + ln]:
                        best[i + ln], back[i + ln] = best[i] + sc, (i, p)
            i, path = n, []
            while i:
                j, p = back[i]
                path.append((s + j, p))
                i = j
            at_out += [a for a, _ in path[::-1]]
            id_out += [p for _, p in path[::-1]]
        return np.array(at_out, np.int64), np.array(id_out, np.int64)

    # ------------------------------------------------------------ decoding
    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join([self.surface[i] for i in ids.tolist()])
        if self.prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode(errors="replace")


def _suffixes(code: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols (at least), by prefix doubling."""
    n, k, rank = len(code), 1, code
    order = np.argsort(rank, kind="stable")
    while k < depth:
        second = np.zeros(n, np.int64)
        second[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + int(rank.max()) + 2) + second
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        k *= 2
    return order


def _merge_long(grid, rank, symbol, s: int, n: int, depth: int) -> None:
    """Merges one long segment with a heap over its edges."""
    nxt = list(range(1, n + 1))
    prv = list(range(-1, n - 1))
    heap: list[tuple[float, int, int, int]] = []

    def push(i: int) -> None:
        if i < 0 or nxt[i] >= n:
            return
        end = nxt[nxt[i]]
        if end - i <= depth and (p := int(grid[s + i, end - i])) >= 0:
            heapq.heappush(heap, (-float(rank[p]), i, nxt[i], end))

    for i in range(n):
        push(i)
    while heap:
        _, i, j, end = heapq.heappop(heap)
        if not symbol[s + i] or nxt[i] != j or j >= n or nxt[j] != end:
            continue
        symbol[s + j] = False
        nxt[i] = end
        if end < n:
            prv[end] = i
        push(i)
        push(prv[i])


def _around(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with any column of that name (in any case) under another one."""
    taken = {c.lower() for c in docs.columns}
    for c in docs.columns:
        if c.lower() == name.lower():
            free = f"{c}_given"
            while free.lower() in taken:
                free += "_given"
            docs = docs.withColumnRenamed(c, free)
    return docs


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None, crc: str | None = None) -> DataFrame:
    """``docs`` with the ids of every text (array<int>) as one more column.

    Asked by name, also what the ids decode to (from the ids alone), and their CRC-32 as 32-bit
    little-endian integers; all in one pass, so that a task needs one worker."""
    new = [(ids, T.ArrayType(T.IntegerType(), False)), *([(decoded, T.StringType())] if decoded else []), *([(crc, T.LongType())] if crc else [])]
    for name, _ in new:
        docs = _around(docs, name)
    keep = docs.columns
    schema = T.StructType([*docs.schema, *[T.StructField(*f) for f in new]])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        m = PieceModel.load(model)
        for batch in it:
            for part, col in chunks(batch, text, _BLOCK):
                flat, rows = m.rows(col)
                trim()
                out = [pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(flat, pa.int32()))]
                own = [flat[a:b] for a, b in zip(rows[:-1], rows[1:], strict=True)]
                if decoded:
                    out.append(pa.array([m.decode(x) for x in own], pa.string()))
                if crc:
                    out.append(pa.array([zlib.crc32(x.astype("<i4").tobytes()) for x in own], pa.int64()))
                yield pa.record_batch([*[column(part, c) for c in keep], *out], names=[*keep, *[n for n, _ in new]])

    return docs.mapInArrow(trimmed(run), schema)


def decode(docs: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids stand for; the empty one for null ids."""
    docs = _around(docs, text)
    keep = docs.columns
    schema = T.StructType([*docs.schema, T.StructField(text, T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = PieceModel.load(model)
        for batch in it:
            lists = column(batch, ids)
            texts = [m.decode(np.asarray(x.values)) if x.is_valid else "" for x in lists]
            yield pa.record_batch([*[column(batch, c) for c in keep], pa.array(texts, pa.string())], names=[*keep, text])

    return docs.mapInArrow(trimmed(run), schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9(spark, sf_dir: str) -> DataFrame:
    """Query over all of ``documents``: encoded, decoded again, and both compared."""
    docs = keyed(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    both = encode(docs, default_model(), decoded="decoded", crc="ids_crc32")
    same = F.col("decoded") == F.coalesce(F.replace("text", F.lit(_SPACE), F.lit(" ")), F.lit(""))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids_crc32", same.alias("round_trip"))
