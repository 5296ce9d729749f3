"""N-gram Jaccard join with count-vector R-trees.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a document's set
is its distinct ``k``-word shingles (the whole sequence if it has fewer words).  Two
documents link when |A & B| / |A | B| >= ``numer`` / ``denom``.

1.  Equal sets (two 64-bit set hashes and the size) become one node, so copies cost
    one row each.  The rows are kept in a compressed store.  Shingles are hashed into
    ``_POINT`` groups; a set's group counts are its point.
2.  Sets that can link are brought together by shingles: of a set of n, the first
    n - ceil(t n) + 1 in any one order of all shingles hold one of every linked set.
    The order puts shingles found often last (``heavy``: those seen often in single
    tasks, at most ``HEAVY`` of them), so that shared passages bring few sets together.
    The sets of one shingle, cut where sizes differ too much to link, are a cell.
3.  Each cell's points go into a packed R-tree.  The summed coordinate minima of a point
    and a node's upper corner bound the overlap; descent follows nodes, then points,
    whose bound still allows a link.  Sets that pass are tied by a spanning forest, never
    by all their pairs.  Connected components of the ties hold every link.
4.  Texts of tied sets are fetched from the store (the only texts that are shuffled).
    A component's points go into an R-tree once more; what survives is verified on the
    shingles.  Sets already connected are not compared again.  A component too large for
    a task is cut into leaves that all share some pivots; what the pivots leave
    unconnected is compared leaf by leaf, for documents outside the component's largest
    part only.

A shingle that very many sets of one task (``STAR``) put first sends one row with ties
to it instead of all its rows, so no cell grows with the data; such a cell is tied
whole, which adds candidates and loses none.  No pair list is ever built: cells give a row per member, tasks give a spanning
forest of links.  Shingles are told apart by 64-bit hashes.

Defined cases: a null text or one without words has an empty set and links with
nothing; null ids are carried and ignored as component ids unless nothing else is
there; rows that repeat an id are separate members; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _store
from ._graph import components
from ._util import chunks, column, discard, materialise, new_folder, read_table, trimmed
from ._words import NOT_SPACE, U, Words, mix

K = 3
NUMER, DENOM = 90, 100
_POINT = 256  # coordinates of the points
_NODE = 32  # entries of an R-tree node
LEAF_DOCS = 1000
LEAF_BYTES = 12 << 20
PIVOTS = 16
#: shingles whose frequency is known to all tasks, at most (nine bytes each)
HEAVY = 1 << 20
#: times a shingle is seen in one task before it is reported
SEEN = 4
#: sets of one task, or of one cell, from which they are tied without a look at their points
STAR = 20_000


# ---------------------------------------------------------------- sets and points
def shingles(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted within every row; offsets of the rows)."""
    w = Words(col, NOT_SPACE, lower=True)
    at, g = w.windows(k, salt=k)
    owner = np.searchsorted(w.rows, at, side="right") - 1
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(short):
        whole = []
        for r in short.tolist():
            n, first = int(w.count[r]), int(w.rows[r])
            h = U(n)
            for x in w.hash[first : first + n]:
                h = mix(np.array([h ^ x]))[0]
            whole.append(h)
        owner, g = np.concatenate([owner, short]), np.concatenate([g, np.array(whole, U)])
    order = np.lexsort((g, owner))
    owner, g = owner[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
    owner, g = owner[new], g[new]
    return g, np.searchsorted(owner, np.arange(len(col) + 1))


def shingle_sets(col: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    g, cut = shingles(col, k)
    return [g[s:e] for s, e in zip(cut[:-1], cut[1:])]


def _row_sums(x: np.ndarray, cut: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, U), np.cumsum(x, dtype=U)])
    return (total[cut[1:]] - total[cut[:-1]]).view(np.int64)


def points(g: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The point of every row: how many of its shingles lie in each group."""
    rows = len(cut) - 1
    owner = np.repeat(np.arange(rows), np.diff(cut))
    group = (g >> U(20)).astype(np.int64) % _POINT
    return np.bincount(owner * _POINT + group, minlength=rows * _POINT).reshape(rows, _POINT)


def _pack_point(x: np.ndarray) -> bytes:
    return x.astype(np.uint8 if x.max() < 256 else np.uint32).tobytes()


def _open_points(col: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.uint8 if len(x) == _POINT else np.uint32) for x in col]).astype(np.uint32)


class _Often:
    """Shingles a task has seen ``SEEN`` times, in bounded memory."""

    def __init__(self):
        self.token, self.count, self.held = [], [], 0

    def add(self, g: np.ndarray) -> None:
        token, count = np.unique(g, return_counts=True)
        some = count > 1
        self.token.append(token[some])
        self.count.append(count[some])
        self.held += int(some.sum())
        if self.held > 1 << 21:
            self.fold(SEEN)

    def fold(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        token = np.concatenate([np.zeros(0, U), *self.token])
        count = np.concatenate([np.zeros(0, np.int64), *self.count])
        token, at = np.unique(token, return_inverse=True)
        count = np.bincount(at, count, len(token)).astype(np.int64)
        some = count >= least
        self.token, self.count, self.held = [token[some]], [count[some]], int(some.sum())
        return token[some], count[some]


def features(docs: DataFrame, doc_id: str, text: str, k: int, folder: str) -> DataFrame:
    """Writes the store; rid, doc_id, set size n, set hashes h1, h2 and point of every row.

    Rows without rid tell shingles (h1) the task has often seen, and how often (n)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = _Often()

        def of(col: pa.Array) -> dict:
            g, cut = shingles(col, k)
            often.add(g)
            h1, h2 = _row_sums(mix(g), cut), _row_sums(mix(g ^ U(0xA24BAED4963EE407)), cut)
            return {"n": pa.array(np.diff(cut), pa.int64()), "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()), "point": pa.array([_pack_point(x) for x in points(g, cut)], pa.binary())}

        yield from _store.write(it, folder, of, doc_id, text)
        token, count = often.fold(SEEN)
        none = pa.nulls(len(token))
        yield pa.record_batch([none.cast(pa.int64()), none.cast(pa.int64()), pa.array(count, pa.int64()), pa.array(token.view(np.int64)), none.cast(pa.int64()), none.cast(pa.binary())], names=["rid", "doc_id", "n", "h1", "h2", "point"])

    return docs.mapInArrow(trimmed(run), "rid long, doc_id long, n long, h1 long, h2 long, point binary")


def _heavy(often: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles seen most often (``most`` at most), sorted, with the logarithm of their counts."""
    often = often.groupBy("token").agg(F.sum("n").alias("n")).withColumn("level", F.floor(F.log2("n")).cast("int"))
    least, left = 64, most
    for level, n in sorted(often.groupBy("level").count().collect(), reverse=True):  # 64 rows at most
        if n > left:
            break
        least, left = level, left - n
    rows = often.where(F.col("level") >= least).select("token", "level").toArrow()  # bounded by ``most``
    token, level = np.asarray(rows["token"].combine_chunks()).view(U), np.asarray(rows["level"].combine_chunks())
    order = np.argsort(token)
    return token[order], level[order].astype(np.uint8)


# ---------------------------------------------------------------- cells
def first_shingles(g: np.ndarray, cut: np.ndarray, heavy: tuple[np.ndarray, np.ndarray], numer: int, denom: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of those shingles of every set of which linked sets share one."""
    n = np.diff(cut)
    owner = np.repeat(np.arange(len(n)), n)
    level = np.zeros(len(g), np.uint8)
    token, levels = heavy
    if len(token):
        at = np.minimum(np.searchsorted(token, g), len(token) - 1)
        level = np.where(token[at] == g, levels[at], 0)
    order = np.lexsort((mix(g), level, owner))
    take = np.arange(len(g)) - np.repeat(cut[:-1], n) < np.repeat(n - -(-numer * n // denom) + 1, n)
    return owner[take], g[order][take]


def _deal(folder: str, text: str, k: int, numer: int, denom: int, parts: int, heavy, star: int):
    """Sorted row numbers -> (part, blob): the first shingles of their sets, sorted, as
    differences beside row numbers and sizes, compressed - a quarter of plain rows."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for rids, rows in _store.take(it, folder):
            for _, col in chunks(rows, text):
                g, cut = shingles(col, k)
                row, token = first_shingles(g, cut, heavy.value, numer, denom)
                held.append((mix(token) >> U(16), rids[row], np.diff(cut)[row]))
                rids = rids[len(col) :]
                count += len(row)
                if count > 1 << 20:
                    yield _blobs(*map(np.concatenate, zip(*held)), parts, star)
                    held, count = [], 0
        if held:
            yield _blobs(*map(np.concatenate, zip(*held)), parts, star)

    return run


def _blobs(keys: np.ndarray, nodes: np.ndarray, size: np.ndarray, parts: int, star: int) -> pa.RecordBatch:
    part, local = (keys % U(parts)).astype(np.int64), keys // U(parts)
    order = np.lexsort((nodes, local, part))
    part, local, nodes, size = part[order], local[order], nodes[order], size[order]
    ties = np.zeros((0, 2), np.int64)
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (local[1:] != local[:-1])
    begin = np.flatnonzero(new)
    many = np.diff(np.append(begin, len(part))) > star
    if many.any():
        of = np.cumsum(new) - 1
        first = nodes[begin][of]
        ties = np.unique(np.stack([first, nodes], 1)[many[of] & ~new], axis=0)
        size = np.where(many[of], 0, size)  # no size: a row that stands for many
        stay = new | ~many[of]
        part, local, nodes, size = part[stay], local[stay], nodes[stay], size[stay]
    cut = np.searchsorted(part, np.arange(parts + 1))
    which, blobs = [], []
    for p in np.flatnonzero(np.diff(cut)).tolist():
        s, e = cut[p], cut[p + 1]
        which.append(p)
        blobs.append(_blob(local[s:e], nodes[s:e], size[s:e]))
    for s in range(0, len(ties), 1 << 16):  # ties are spread over the parts as they are
        some = ties[s : s + (1 << 16)]
        which.append(int(some[0, 0]) % parts)
        blobs.append(_blob(np.zeros(0, U), some[:, 0], some[:, 1]))
    return pa.record_batch({"part": pa.array(which, pa.int64()), "blob": pa.array(blobs, pa.binary())})


def _blob(keys: np.ndarray, nodes: np.ndarray, size: np.ndarray) -> bytes:
    columns, head, body = (np.diff(keys, prepend=U(0)), nodes, size), [len(keys), len(nodes)], b""
    for c in columns:
        c = c.astype(np.int64)
        low = int(c.min()) if len(c) else 0
        wide = len(c) > 0 and int(c.max()) - low >= 1 << 32
        head += [low, int(wide)]
        body += (c - low).astype("<i8" if wide else "<u4").tobytes()
    return np.array(head, "<i8").tobytes() + zstandard.ZstdCompressor(level=1).compress(body)


def _open_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """keys, nodes, sizes; or no keys and two columns of ties."""
    n, m, *rest = np.frombuffer(blob, "<i8", 8).tolist()
    body, out, at = zstandard.ZstdDecompressor().decompress(blob[64:]), [], 0
    for count, low, wide in zip((n, m, m), rest[::2], rest[1::2]):
        c = np.frombuffer(body, "<i8" if wide else "<u4", count, at)
        at += c.nbytes
        out.append(c.astype(np.int64) + low)
    return np.cumsum(out[0].astype(U)), out[1], out[2]


def _meet(numer: int, denom: int, star: int):
    """(part, blob) sorted by part -> members (cell, a) of every different cell, and ties (null, a, b)."""

    def cells(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, node, size = map(np.concatenate, zip(*held))
        order = np.lexsort((node, size, key))
        key, node, size = key[order], node[order], size[order]
        other = np.ones(len(key), bool)
        other[1:] = key[1:] != key[:-1]
        # A gap in the sizes is a cut, except where a row stands for many.
        gap = np.zeros(len(key), bool)
        gap[1:] = (size[:-1] * denom < size[1:] * numer) & (size[:-1] > 0)
        begin = np.flatnonzero(other)
        whole = (size[begin] == 0) | (np.diff(np.append(begin, len(key))) > star)
        whole = whole[np.cumsum(other) - 1]
        new = other | gap & ~whole
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(key)))
        of = np.cumsum(new) - 1
        tied = whole & ~new
        pairs = np.unique(np.stack([node[begin][of], node], 1)[tied], axis=0)
        if len(pairs):
            yield _tie_batch(pairs)
        ident = np.add.reduceat(mix(node.view(U) ^ U(0x5851F42D4C957F2D)), begin).view(np.int64)
        good = np.flatnonzero((count > 1) & ~whole[begin])
        good = good[np.unique(ident[good], return_index=True)[1]]  # cells of equal members count once
        begin, count, ident = begin[good], count[good], ident[good]
        done = np.concatenate([[0], np.cumsum(count)])
        step = 0
        while step < len(begin):
            stop = max(step + 1, int(np.searchsorted(done, done[step] + (1 << 18), side="right")) - 1)
            n = count[step:stop]
            at = np.repeat(begin[step:stop] - (done[step:stop] - done[step]), n) + np.arange(n.sum())
            yield pa.record_batch({"cell": np.repeat(ident[step:stop], n), "a": node[at], "b": pa.nulls(len(at), pa.int64())})
            step = stop

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        current = None
        for batch in it:
            for part, blob in zip(column(batch, "part").to_pylist(), column(batch, "blob")):
                key, a, b = _open_blob(blob.as_py())
                if not len(key):
                    yield _tie_batch(np.stack([a, b], 1))
                    continue
                if held and part != current:
                    yield from cells(held)
                    held = []
                current = part
                held.append((key, a, b))
        if held:
            yield from cells(held)

    return run


def _tie_batch(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"cell": pa.nulls(len(pairs), pa.int64()), "a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


# ---------------------------------------------------------------- R-trees
def needed(a, b, numer: int, denom: int):
    """Least overlap of linked sets of sizes a and b: ceil(t (a + b) / (1 + t))."""
    return -(-(numer * (a + b)) // (numer + denom))


def minima(p: np.ndarray, i: np.ndarray, q: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of p[i] and q[j], in steps of bounded memory."""
    return np.concatenate([np.zeros(0, np.int64), *(np.minimum(p[i[s : s + 8192]], q[j[s : s + 8192]]).sum(1, dtype=np.int64) for s in range(0, len(i), 8192))])


class RTree:
    """Points packed by size, then by the two coordinates that vary most; a node has an
    upper corner, the least and the largest size, and ``_NODE`` nodes or points below."""

    def __init__(self, pts: np.ndarray, size: np.ndarray, numer: int, denom: int):
        vary = np.argsort(-pts.var(0), kind="stable")[:2]
        octave = np.floor(np.log2(size) * 4)
        self.order = np.lexsort((size, pts[:, vary[1]], pts[:, vary[0]], octave))
        self.pts, self.size, self.numer, self.denom = pts[self.order], size[self.order], numer, denom
        self.levels = []
        corner, low, high = self.pts, self.size, self.size
        while len(corner) > _NODE:
            at = np.arange(0, len(corner), _NODE)
            corner, low, high = np.maximum.reduceat(corner, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((corner, low, high))

    def search(self, q: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs of places in packed order whose bound allows a link, ``alive`` points only."""
        lively = [alive]
        for corner, _, _ in self.levels:
            lively.append(np.logical_or.reduceat(lively[-1], np.arange(0, len(lively[-1]), _NODE)))
        top = len(lively[-1])
        i, j = np.repeat(q, top), np.tile(np.arange(top), len(q))
        for depth in range(len(self.levels), -1, -1):
            corner, low, high = self.levels[depth - 1] if depth else (self.pts, self.size, self.size)
            own = self.size[i]
            fit = lively[depth][j] & (own * self.numer <= high[j] * self.denom) & (low[j] * self.numer <= own * self.denom)
            i, j = i[fit], j[fit]
            # A linked partner in the node has the node's least size at least, and t times the query's.
            least = np.maximum(low[j], -(-self.numer * self.size[i] // self.denom))
            fit = minima(self.pts, i, corner, j) >= needed(self.size[i], least, self.numer, self.denom)
            i, j = i[fit], j[fit]
            if depth:
                below = len(lively[depth - 1])
                n = np.minimum((j + 1) * _NODE, below) - j * _NODE
                i = np.repeat(i, n)
                j = np.repeat(j * _NODE - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return i, j


def grow(tree: RTree, linked=None, part: list | None = None, left: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """A spanning forest over the pairs that survive the tree's bound and ``linked(i, j)``.

    Points of equal ``part`` are one to start with; with ``left``, pairs without a marked
    point do not count.  Every point looks only for those not reached yet."""
    order = tree.order.tolist()
    fresh = np.ones(len(order), bool)
    mates: dict = {}
    if part is not None:
        for x, i in enumerate(order):
            if part[i] is not None:
                mates.setdefault(part[i], []).append(x)

    def reach(x: int) -> list[int]:
        p = part[order[x]] if part is not None else None
        new = [x] if p is None else [y for y in mates[p] if fresh[y]]
        fresh[new] = False
        return new

    marked = None if left is None else left[tree.order]
    for seed in range(len(order)):
        if not fresh[seed]:
            continue
        front = reach(seed)
        while front and fresh.any():
            queries, front = np.array(front[:_NODE]), front[_NODE:]
            if marked is None:
                i, j = tree.search(queries, fresh)
            else:
                own = marked[queries]
                found = [tree.search(queries[own], fresh), tree.search(queries[~own], fresh & marked)]
                i, j = (np.concatenate(x) for x in zip(*found))
            for x, y in zip(i.tolist(), j.tolist()):
                if fresh[y] and (linked is None or linked(order[x], order[y])):
                    yield order[x], order[y]
                    front += reach(y)


def _survivors(numer: int, denom: int):
    """Members (cell, node, n, point) sorted by cell -> ties (a, b) of sets whose points allow a link."""

    def small(node, size, pts, begin, count) -> np.ndarray:
        out = [np.zeros((0, 2), np.int64)]
        for m in np.unique(count).tolist():
            i, j = np.triu_indices(m, 1)
            at = begin[count == m][:, None]
            i, j = (at + i).ravel(), (at + j).ravel()
            ok = np.minimum(size[i], size[j]) * denom >= np.maximum(size[i], size[j]) * numer
            i, j = i[ok], j[ok]
            ok = minima(pts, i, pts, j) >= needed(size[i], size[j], numer, denom)
            out.append(np.stack([node[i[ok]], node[j[ok]]], 1))
        return np.concatenate(out)

    def ties(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        cell, node, size = (np.asarray(t[c].combine_chunks()) for c in ("cell", "node", "n"))
        pts = _open_points(t["point"].to_pylist())
        begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        count = np.diff(np.append(begin, len(cell)))
        leaf = count <= _NODE // 2  # no more than a node: its pairs are looked at at once
        found = [small(node, size, pts, begin[leaf], count[leaf])]
        for s, m in zip(begin[~leaf].tolist(), count[~leaf].tolist()):
            own = node[s : s + m]
            pairs = np.array(list(grow(RTree(pts[s : s + m], size[s : s + m], numer, denom))), np.int64).reshape(-1, 2)
            found.append(own[pairs])
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.record_batch({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = last = 0
        for batch in it:
            cell = np.asarray(column(batch, "cell"))
            if not len(cell):
                continue
            if size >= 8192:
                goes_on = int(np.searchsorted(cell, last, side="right"))
                held.append(batch.slice(0, goes_on))
                if goes_on == len(cell):
                    continue
                yield ties(held)
                held, size, batch = [], 0, batch.slice(goes_on)
            held.append(batch)
            size, last = size + batch.num_rows, int(cell[-1])
        if held:
            yield ties(held)

    return run


# ---------------------------------------------------------------- verification
def _verify(k: int, numer: int, denom: int):
    """Cells (cell, node, part, minor, text), sorted by cell, to links between nodes."""

    def group(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        rows = t.to_batches()
        node, part = t["node"].to_pylist(), t["part"].to_pylist()
        minor = np.asarray(t["minor"].combine_chunks())
        sets: list[np.ndarray] = []
        for b in rows:
            for _, col in chunks(b, "text"):
                sets += shingle_sets(col, k)
        # A minor document can come twice, from its own leaf and from the leaf of all.
        keep = [i for i in range(len(node)) if i == 0 or node[i] != node[i - 1]]
        mark = np.maximum.reduceat(minor, keep)
        sets, node, part = [sets[i] for i in keep], [node[i] for i in keep], [part[i] for i in keep]
        size = np.array([len(s) for s in sets])

        def linked(i: int, j: int) -> bool:
            both = int(np.isin(sets[i], sets[j], assume_unique=True, kind="sort").sum())
            return denom * both >= numer * int(size[i] + size[j] - both)

        found = []
        if len(sets) > 1:
            tree = RTree(points(np.concatenate(sets), np.concatenate([[0], np.cumsum(size)])).astype(np.uint32), size, numer, denom)
            found = list(grow(tree, linked, part, mark if mark.any() else None))
        return pa.record_batch({"a": pa.array([node[i] for i, _ in found], pa.int64()), "b": pa.array([node[j] for _, j in found], pa.int64())})

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in it:
            cell = column(batch, "cell").to_pylist()
            begin = 0
            for i in range(1, len(cell) + 1):
                if i == len(cell) or cell[i] != cell[begin]:
                    if held and cell[begin] != current:
                        yield group(held)
                        held = []
                    current = cell[begin]
                    held.append(batch.slice(begin, i - begin))
                    begin = i
        if held:
            yield group(held)

    return run


def _fetch(folder: str, text: str):
    """Members sorted by node get their texts, in the order of the store."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row, batches in _store.visits(it, folder, "node"):
            for b in batches:
                texts = pa.chunked_array([column(row, text)] * b.num_rows).combine_chunks()
                yield pa.RecordBatch.from_arrays([*b.columns, texts.cast(pa.string())], names=[*b.schema.names, "text"])

    return run


def _cells(members: DataFrame, folder: str, text: str, k: int, numer: int, denom: int, copies: bool = False) -> DataFrame:
    """members: cell, node, part, minor.  A node is the number of its row in the store.

    With ``copies`` (a node is in many cells) each cell's task reads its texts from the store itself, so that
    no text is shuffled once for each cell; else texts are read in the store's order, once, and dealt out."""
    cell = "cell struct<root:long,i:long,j:long>, node long, part long, minor boolean"
    placed = members.select(F.struct(F.col("cell.root").alias("root"), F.col("cell.i").cast("long").alias("i"), F.col("cell.j").cast("long").alias("j")).alias("cell"), "node", "part", "minor")
    # Row numbers are narrow, reading what they stand for is not: a set count keeps tasks apart.
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fetch, verify = _fetch(folder, text), _verify(k, numer, denom)
    if copies:
        rows = placed.repartition(n, "cell").sortWithinPartitions("cell", "node")
        return rows.mapInArrow(trimmed(lambda it: verify(fetch(it))), "a long, b long")
    rows = placed.repartition(n, F.shiftright("node", 33)).sortWithinPartitions("node").mapInArrow(trimmed(fetch), f"{cell}, text string")
    return rows.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(trimmed(verify), "a long, b long")


# ---------------------------------------------------------------- the join
#: keys that meet in one task when cells are looked at
PART_KEYS = 2 << 20


def _members(docs: DataFrame, folder: str, doc_id: str, text: str, k: int, numer: int, denom: int) -> DataFrame:
    """rid, doc_id, n, node and root per row of ``docs``, whose rows are kept in the store."""
    spark = docs.sparkSession
    told = materialise(features(docs, doc_id, text, k, folder), "sets")
    f = told.where("rid is not null")
    reps = materialise(f.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("rid").alias("node")), "set-nodes")
    # 2: cells
    heavy = spark.sparkContext.broadcast(_heavy(told.where("rid is null").select(F.col("h1").alias("token"), "n"), HEAVY))
    volume = (reps.agg(F.sum("n")).first()[0] or 0) * (denom - numer) // denom
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // PART_KEYS))
    rids = reps.select(F.col("node").alias("rid"))
    blobs = rids.repartition(parts, F.shiftright("rid", 33)).sortWithinPartitions("rid").mapInArrow(trimmed(_deal(folder, text, k, numer, denom, parts, heavy, STAR)), "part long, blob binary")
    met = materialise(blobs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(trimmed(_meet(numer, denom, STAR)), "cell long, a long, b long"), "cells")
    # 3: what the R-trees let pass
    members = met.where("cell is not null").select("cell", F.col("a").alias("node")).distinct()
    members = members.join(f.select(F.col("rid").alias("node"), "n", "point"), "node")
    passed = members.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(trimmed(_survivors(numer, denom)), "a long, b long")
    ties = materialise(passed.unionByName(met.where("cell is null").select("a", "b")), "ties")
    discard(met)
    roots = components(ties)
    tied = materialise(roots.join(reps.select("node", "n"), "node").select("node", "root", "n"), "tied")
    discard(ties, roots)
    # 4: leaves of bounded size; a root of one leaf is a whole component
    sizes = tied.groupBy("root").agg(F.count("*").alias("c"), F.sum("n").alias("volume")).select("root", F.greatest(F.ceil(F.col("c") / LEAF_DOCS), F.ceil(F.col("volume") * 8 / LEAF_BYTES)).alias("leaves"))
    spread = materialise(tied.join(sizes, "root").withColumn("leaf", F.pmod(F.xxhash64("node"), F.col("leaves"))), "leaves")
    no = {"part": F.lit(None).cast("long"), "minor": F.lit(False)}
    whole = spread.select(F.struct("root", F.lit(-1).cast("long").alias("i"), F.col("leaf").alias("j")).alias("cell"), "node").withColumns(no)
    large = spread.where("leaves > 1")
    pivots = large.withColumn("o", F.row_number().over(Window.partitionBy("root", "leaf").orderBy("n", "node"))).where("o = 1")
    pivots = pivots.where(F.pmod(F.xxhash64("node", F.lit(1)), F.greatest(F.col("leaves") / PIVOTS, F.lit(1)).cast("long")) == 0)
    shared = pivots.select("root", "node", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("leaves") - 1)).alias("j")).where("j != leaf")
    shared = shared.select(F.struct("root", F.lit(-1).cast("long").alias("i"), F.col("j")).alias("cell"), "node").withColumns(no)
    linked = materialise(_cells(whole.unionByName(shared), folder, text, k, numer, denom), "links")
    if large.limit(1).count():
        linked = materialise(linked.unionByName(_rest(large, linked, folder, text, k, numer, denom)), "links")
    roots = components(linked)
    discard(tied, spread, linked)
    # Every row: its node and the node's component.
    rows = f.select("doc_id", "n", "h1", "h2", "rid").join(reps.select("n", "h1", "h2", "node"), ["n", "h1", "h2"], "left")
    rows = rows.withColumn("node", F.coalesce("node", "rid"))
    rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    out = materialise(rows.select("rid", "doc_id", "n", "node", "root"), "members")
    discard(told, reps, roots)
    return out


def link_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, numer: int = NUMER, denom: int = DENOM) -> DataFrame:
    """doc_id, n_shingles, component_id, node per row of ``docs``; rows of one node have equal sets."""
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias(doc_id), F.col(f"`{text}`").alias(text))
    rows = _members(docs, new_folder(docs.sparkSession, "texts"), doc_id, text, k, numer, denom)
    # Written, so that the join is one of two tables, whose large keys adaptive execution splits.
    ids = materialise(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return rows.join(ids, "root").select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id", "node")


def _rest(large: DataFrame, linked: DataFrame, folder: str, text: str, k: int, numer: int, denom: int) -> DataFrame:
    """Links of documents outside the largest linked part of a large component."""
    part = components(linked).select("node", F.col("root").alias("part"))
    rows = large.join(part, "node", "left").withColumn("part", F.coalesce("part", "node"))
    per = rows.groupBy("root", "part").agg(F.count("*").alias("size"))
    main = per.groupBy("root").agg(F.max_by("part", F.struct("size", "part")).alias("main"))
    rows = rows.join(main, "root").withColumn("minor", F.col("part") != F.col("main"))
    minors = rows.where("minor").groupBy("root").agg(F.ceil(F.count("*") / LEAF_DOCS).alias("minor_leaves"))
    rows = rows.join(minors, "root").withColumn("own", F.when(F.col("minor"), F.pmod(F.xxhash64("node", F.lit(2)), F.col("minor_leaves"))))
    # Cell (i, j): the i-th leaf of the minor documents against the j-th leaf of all.
    everyone = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("minor_leaves") - 1)).alias("i")).select("root", "i", F.col("leaf").alias("j"), "node", "part", F.col("minor") & (F.col("own") == F.col("i")))
    own = rows.where("minor").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("leaves") - 1)).alias("j")).select("root", F.col("own").alias("i"), "j", "node", "part", F.lit(True))
    cells = everyone.unionAll(own).toDF("root", "i", "j", "node", "part", "minor")
    return _cells(cells.select(F.struct("root", "i", "j").alias("cell"), "node", "part", F.coalesce("minor", F.lit(False)).alias("minor")), folder, text, k, numer, denom, copies=True)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, numer: int = 80, denom: int = 100) -> DataFrame:
    """``docs`` with one row (the smallest id) of every group of near-duplicates, all columns kept.

    One of the rows that share the smallest id stays, as does one of a group without ids.
    """
    folder = new_folder(docs.sparkSession, "rows")
    found = _members(docs, folder, doc_id, text, k, numer, denom)
    # Rows without shingles have roots of their own, so all of them stay.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("first")
    stay = found.groupBy("root").agg(first).select("first.rid")

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kept in _store.take(it, folder):
            yield kept

    # Whole rows come back from the store, so the documents are never shuffled.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stay.repartition(n, F.shiftright("rid", 33)).sortWithinPartitions("rid").mapInArrow(trimmed(rows), docs.schema)


def op5(spark, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return link_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
