"""Substring deduplication with FM-indexes over shards of the corpus.

Words are ``[^\\x20\\x09-\\x0D]+`` of the unchanged text; a window is ``window``
consecutive words of one document.  Every word under a window whose words also start
in a document with a smaller id is removed, judged on the input.

1.  Texts are stored once, compressed, in the shared folder.  Minimisers over
    ``GRAM``-word grams (every window holds one, chosen by its content alone) are
    counted over the corpus with map-side aggregation; windows with a minimiser that
    only one document has cannot repeat.
2.  The other windows go to shards by the smallest of their 5-word grams, as runs of
    words that share it, so all occurrences of a window meet in one shard.
3.  A shard builds a compressed FM-index - suffix array, Burrows-Wheeler transform and
    a wavelet matrix of packed bits with sampled ranks - block by block, and streams
    its runs through it: backward search extends every window word by word, windows
    that only occur once drop out, and the others look up the smallest document in
    their interval.  Runs equal as a whole are indexed once.
4.  Covered words are collected per document and the kept words read from the store.

Texts are never shuffled: only their repeated runs are.  A block of the index holds
``BLOCK_WORDS`` words or one gram's runs; a gram whose runs exceed that is indexed in
several blocks in ascending document order, later ones looking up earlier windows by
their 64-bit hash.

Defined cases: a null text has no words; texts shorter than a window stay whole; null
ids count as larger than any other, and equal ids never remove from one another;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _store
from ._util import column, materialise, new_folder, read_table
from ._words import NOT_SPACE, U, Words, covered

WINDOW = 50
GRAM = 25
_SHORT = 5
BLOCK_WORDS = 600_000
_MAX = U((1 << 64) - 1)


# ---------------------------------------------------------------- minimisers
def slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over every w consecutive values, by doubling."""
    size = 1
    while size * 2 <= w and len(x) > size:
        x = f(x[:-size], x[size:])
        size *= 2
    if size < w:
        d = w - size
        x = f(x[:-d], x[d:]) if len(x) > d else x[:0]
    return x


def _window_minima(w: Words, gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash at each word, smallest gram of the window at each word, whether a window starts there)."""
    n = len(w.start)
    g = np.full(n, _MAX, U)
    at, h = w.windows(gram, salt=gram)
    g[at] = h
    low = slide(g, window - gram + 1, np.minimum)
    left = np.repeat(w.rows[1:], w.count)
    ok = np.arange(n) + window <= left
    out = np.full(n, _MAX, U)
    out[: len(low)] = low
    return g, out, ok


def anchors(w: Words, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of grams that are the smallest of some window."""
    g, low, ok = _window_minima(w, gram, window)
    span = window - gram + 1
    low = np.where(ok, low, U(0))
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros(0, U)
    pad = np.concatenate([np.zeros(span - 1, U), low])
    high = slide(np.concatenate([pad, np.zeros(span, U)]), span, np.maximum)[: len(g)]
    at = np.flatnonzero((high == g) & (high > 0))
    return at, g[at]


def store_and_scan(docs: DataFrame, doc_id: str, text: str, folder: str, window: int, gram: int) -> DataFrame:
    """Writes the store; per document rid, doc_id, n_words, the digest of all words, distinct anchors."""
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def of(col: pa.Array) -> dict:
        w = Words(col, NOT_SPACE, lower=False)
        where, h = anchors(w, gram, window)
        cut = np.searchsorted(where, w.rows)
        own = [np.unique(h[s:e]).view(np.int64) for s, e in zip(cut[:-1], cut[1:])]
        digest = [hashlib.sha256(b" ".join(t.encode().split())).hexdigest() for t in col.to_pylist()]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in own])]), pa.int32()), pa.array(np.concatenate(own), pa.int64()))
        return {"n_words": pa.array(w.count, pa.int64()), "digest": digest, "anchors": lists}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _store.write(it, folder, of)

    return docs.mapInArrow(run, "rid long, doc_id long, n_words long, digest string, anchors array<long>")


def _runs(folder: str, window: int, gram: int):
    """(rid, anchor) sorted by rid -> runs of candidate windows by their smallest short gram."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {k: [] for k in ("key", "rid", "doc_id", "first", "h1", "h2", "words")}
        size = 0
        for rid, row, batches in _store.visits(it, folder):
            repeated = np.concatenate([np.asarray(column(b, "anchor")) for b in batches]).view(U)
            doc, col = row.column(0)[0].as_py(), row.column(1)
            doc = _store.NO_ID if doc is None else doc
            w = Words(col, NOT_SPACE, lower=False, hashes=2)
            starts = np.arange(len(w.start) - window + 1)
            good = np.isin(_window_minima(w, gram, window)[1][: len(starts)], repeated)
            _, low, _ = _window_minima(w, _SHORT, window)
            low = low[: len(starts)]
            begin = np.flatnonzero(good & ~(np.concatenate([[False], good[:-1] & (low[1:] == low[:-1])])))
            end = np.flatnonzero(good & ~(np.concatenate([good[1:] & (low[1:] == low[:-1]), [False]])))
            for s, e in zip(begin.tolist(), end.tolist()):
                stop = e + window
                words = w.raw[w.start[s] : w.end[stop - 1]].tobytes()
                joined = b" ".join(words.split())
                digest = hashlib.blake2b(joined, digest_size=16).digest()
                held["key"].append(int(low[s].view(np.int64)))
                held["rid"].append(rid)
                held["doc_id"].append(doc)
                held["first"].append(s)
                held["h1"].append(int.from_bytes(digest[:8], "little", signed=True))
                held["h2"].append(int.from_bytes(digest[8:], "little", signed=True))
                held["words"].append(joined)
                size += len(joined)
            if size > 4 << 20:
                yield _run_batch(held)
                held, size = {k: [] for k in held}, 0
        if held["key"]:
            yield _run_batch(held)

    return run


def _run_batch(held: dict) -> pa.RecordBatch:
    kinds = {k: pa.int64() for k in held} | {"words": pa.binary()}
    return pa.record_batch({k: pa.array(v, kinds[k]) for k, v in held.items()})


# ---------------------------------------------------------------- the index
def suffix_array(text: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of every suffix by its first ``keep`` symbols) by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    kept, k = rank, 1
    while True:
        if k == keep:
            kept = rank
        second = np.full(n, 0, np.int64)
        if k < n:
            second[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        k *= 2
        if k > keep and (new[-1] == n - 1 or k >= n):
            return order, kept


class WaveletMatrix:
    """Packed bits per level with ranks sampled every 64 positions."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.n, self.sigma = len(seq), sigma
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.ranks, self.zeros = [], [], []
        for b in range(self.levels - 1, -1, -1):
            bit = (seq >> b) & 1
            padded = np.zeros((len(seq) // 64 + 1) * 64, np.uint8)
            padded[: len(seq)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.bits.append(words)
            self.ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.origin = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for lv in range(self.levels):
            words, word = self.bits[lv], i >> 6
            ones = self.ranks[lv][word] + np.bitwise_count(words[word] & ((U(1) << (i & 63).astype(U)) - U(1)))
            i = np.where((c >> (self.levels - 1 - lv)) & 1, self.zeros[lv] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c occurs before position i."""
        return self._down(c, i) - self.origin[c]


class FMIndex:
    def __init__(self, text: np.ndarray, keep: int = 32):
        self.text = text
        self.sa, self.prefix = suffix_array(text, keep)
        self.keep = keep
        sigma = int(text.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.bwt = WaveletMatrix(text[self.sa - 1], sigma)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of c followed by what they match."""
        return self.before[c] + self.bwt.rank(c, lo), self.before[c] + self.bwt.rank(c, hi)

    def repeated(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the substrings of ``length`` symbols at ``starts``, those that occur again: (which, lo, hi)."""
        # The suffixes in order have their ``keep``-symbol prefixes in order: first intervals for free.
        order = self.prefix[self.sa]
        at = starts + length - self.keep
        lo = np.searchsorted(order, self.prefix[at], side="left")
        hi = np.searchsorted(order, self.prefix[at], side="right")
        which = np.flatnonzero(hi - lo > 1)
        lo, hi, at = lo[which], hi[which], at[which]
        for _ in range(length - self.keep):
            at = at - 1
            lo, hi = self.extend(self.text[at], lo, hi)
            alive = hi - lo > 1
            which, lo, hi, at = which[alive], lo[alive], hi[alive], at[alive]
        return which, lo, hi


def _block(runs: list[tuple], window: int, seen: dict | None) -> list[tuple[int, int, int]]:
    """Runs (rid, doc, first word, words) of one block, all different, to covered (rid, start, end).

    ``seen``: smallest document by window hash of earlier blocks of the same gram, kept up to date."""
    col = pa.array([r[3] for r in runs], pa.binary()).cast(pa.string())
    w = Words(col, NOT_SPACE, lower=False, hashes=2)
    _, ident = np.unique(w.hash, return_inverse=True)
    pairs = np.unique(np.stack([ident.astype(U), w.hash2], 1), axis=0)
    if len(pairs) != ident.max() + 1:
        ident = np.unique(np.stack([w.hash, w.hash2], 1), axis=0, return_inverse=True)[1].reshape(-1)
    # One symbol 0 behind every run keeps matches inside runs.
    row = w.row_of_word()
    text = np.zeros(len(ident) + len(runs), np.int64)
    place = np.arange(len(ident)) + row
    text[place] = ident + 1
    begin = w.rows[:-1] + np.arange(len(runs))
    count = w.count - window + 1
    starts = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    owner = np.repeat(np.arange(len(runs)), count)
    docs = np.array([r[1] for r in runs])
    index = FMIndex(text)
    which, lo, hi = index.repeated(starts, window)
    dup = np.zeros(len(starts), bool)
    if len(which):
        run_of = np.repeat(np.arange(len(runs)), w.count + 1)
        by_suffix = docs[run_of[index.sa]]
        ends = np.stack([lo, hi], 1).ravel()
        ends[ends == len(by_suffix)] -= 1
        # reduceat over [lo, hi): the last element is added where the clip above cut it off
        least = np.minimum.reduceat(by_suffix, ends)[::2]
        least = np.where(hi == len(by_suffix), np.minimum(least, by_suffix[-1]), least)
        dup[which] = least < docs[owner[which]]
    if seen is not None:
        _, g = w.windows(window, salt=window)
        for i, h in enumerate(g.tolist()):
            d = int(docs[owner[i]])
            first = seen.setdefault(h, d)
            dup[i] |= first < d
    out = []
    offset = starts - begin[owner]
    for i in _edges(dup, owner, offset):
        r = runs[owner[i[0]]]
        out.append((r[0], r[2] + int(offset[i[0]]), r[2] + int(offset[i[1]]) + window))
    return out


def _edges(dup: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> list[tuple[int, int]]:
    """First and last of the stretches of marked windows in one run."""
    at = np.flatnonzero(dup)
    if not len(at):
        return []
    new = np.concatenate([[True], (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])])
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(at) - 1)
    return list(zip(at[first].tolist(), at[last].tolist()))


def _search(window: int):
    """Runs sorted by (key, doc_id) -> covered words (rid, start, end)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        block: list[tuple] = []
        words = 0
        key = None
        known: dict[tuple[int, int], int] = {}
        seen: dict | None = None  # for a gram of several blocks
        since = 0  # runs of the present key in the block

        def flush() -> None:
            nonlocal block, words, since
            if block:
                out.extend(_block(block, window, seen))
            block, words, since = [], 0, 0

        for batch in it:
            for k, rid, doc, first, h1, h2, text in zip(*(column(batch, c).to_pylist() for c in ("key", "rid", "doc_id", "first", "h1", "h2", "words"))):
                if k != key:
                    if seen is not None:
                        flush()
                        seen = None
                    key, known, since = k, {}, 0
                n = text.count(b" ") + 1
                if words + n > BLOCK_WORDS and block:
                    if since:  # the gram goes on in another block: its part of this one stands alone
                        rest, own = block[: len(block) - since], block[len(block) - since :]
                        if rest:
                            out.extend(_block(rest, window, None))
                        seen = {} if seen is None else seen
                        out.extend(_block(own, window, seen))
                        block, words, since = [], 0, 0
                    else:
                        flush()
                smallest = known.setdefault((h1, h2), doc)
                if smallest < doc:
                    out.append((rid, first, first + n))
                else:  # runs come by doc_id, so this one's text is new
                    block.append((rid, doc, first, text))
                    words, since = words + n, since + 1
                if len(out) > 50_000:
                    yield _covered_batch(out)
                    out = []
        flush()
        if out:
            yield _covered_batch(out)

    return run


def _covered_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    a = np.array(rows, np.int64)
    return pa.record_batch({"rid": a[:, 0], "start": a[:, 1], "end": a[:, 2]})


def _cut(folder: str):
    """Covered words sorted by rid -> what is left of the document."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rid, row, batches in _store.visits(it, folder):
            words = row.column(1)[0].as_py().encode().split()
            d = np.zeros(len(words) + 1, np.int64)
            for b in batches:
                np.add.at(d, np.asarray(column(b, "start")), 1)
                np.add.at(d, np.asarray(column(b, "end")), -1)
            gone = np.cumsum(d[:-1]) > 0
            kept = b" ".join(x for x, g in zip(words, gone.tolist()) if not g)
            yield pa.record_batch({"rid": pa.array([rid], pa.int64()), "n_removed": pa.array([int(gone.sum())], pa.int64()), "digest": [hashlib.sha256(kept).hexdigest()], "kept": [kept.decode()]})

    return run


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept text, null where nothing was removed)."""
    if not _SHORT <= gram <= window or window < 32:
        raise ValueError("grams have 5 to window words, windows 32 at least")
    spark = docs.sparkSession
    folder = new_folder(spark, "texts")
    rows = materialise(store_and_scan(docs, doc_id, text, folder, window, gram), "anchors")
    each = rows.select("rid", F.coalesce("doc_id", F.lit(_store.NO_ID)).alias("d"), F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most").select("anchor")
    found = each.select("rid", "anchor").join(shared, "anchor").withColumn("part", F.shiftright("rid", 33))
    runs = found.repartition("part").sortWithinPartitions("rid").select("rid", "anchor").mapInArrow(_runs(folder, window, gram), "key long, rid long, doc_id long, first long, h1 long, h2 long, words binary")
    spans = runs.repartition("key").sortWithinPartitions("key", "doc_id", "rid", "first").mapInArrow(_search(window), "rid long, start long, end long")
    spans = materialise(spans, "spans")
    cut = spans.withColumn("part", F.shiftright("rid", 33)).repartition("part").sortWithinPartitions("rid").drop("part").mapInArrow(_cut(folder), "rid long, n_removed long, digest string, kept string")
    cut = cut.select("rid", "n_removed", F.col("digest").alias("less"), *(["kept"] if with_text else []))
    out = rows.select("rid", "doc_id", "n_words", "digest").join(cut, "rid", "left")
    return out.select(F.col("doc_id").alias(doc_id), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("less", "digest").alias("kept_sha256"), *(["kept"] if with_text else []))


def op8(spark, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return dedup_substrings(read_table(spark, sf_dir, "documents"))
