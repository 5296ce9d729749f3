"""Benchmark decontamination: a hash set of normalised test n-grams scanned over training text.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
Every benchmark item gives its windows of ``n`` words (one window, the whole item,
if it has fewer; none without words).  The window hashes go to all tasks: as a
broadcast while the benchmark texts are within ``broadcast_limit`` bytes, else as
block files in the shared folder that each task reads one after the other for every
``_BUFFER`` bytes of its texts, so memory stays bounded by one block and one buffer
(a block takes some four times ``broadcast_limit``).  A hash hit counts only after the words
themselves compare equal.  No shuffle of the documents takes place.

Defined cases: a null or empty text has no words, is never contaminated; a null
item_id takes part under the empty string; items that share an id count once;
rows with equal doc_id are judged one by one; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import RangeReader, chunks, column, keyed, new_folder, text_column, trimmed, write_file
from ._words import ALNUM_LOW, U, Words, covered, row_bytes

WINDOW = 13
BROADCAST_LIMIT = 16 << 20
_FILTER_BITS = 22
#: bytes of document text held while block files are read
_BUFFER = 16 << 20


class NgramSet:
    """Windows of some items, by length: sorted hashes, and where in the items' words each
    begins.  The words stand once, so a set takes some four times the bytes of its texts."""

    def __init__(self, n: int, ids: list, col: pa.Array):
        w = Words(col, ALNUM_LOW, lower=True)
        self.raw = b" ".join(w.raw[s:e].tobytes() for s, e in zip(w.start.tolist(), w.end.tolist()))
        self.end = np.cumsum(w.end - w.start + 1) - 1
        self.start = self.end - (w.end - w.start)
        self.ids = ["" if x is None else str(x) for x in ids]
        row = np.searchsorted(w.rows, np.arange(len(w.start)), side="right") - 1
        self.item = row.astype(np.int32)
        self.by_len: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in np.unique(np.minimum(w.count[w.count > 0], n)).tolist():
            at, g = w.windows(k, salt=k)
            own = np.minimum(w.count, n)[row[at]] == k
            at, g = at[own], g[own]
            order = np.argsort(g, kind="stable")
            self.by_len[k] = g[order], at[order].astype(np.int32)

    def window(self, i: int, k: int) -> bytes:
        return self.raw[self.start[i] : self.end[i + k - 1]]

    def find(self, w: Words, hit: np.ndarray, items: list[set]) -> None:
        """Mark in ``hit`` the words under occurring windows; add the ids to each row's set."""
        for k, (hashes, first) in self.by_len.items():
            at, g = w.windows(k, salt=k)
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[(hashes & U((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
            maybe = np.flatnonzero(bits[(g & U((1 << _FILTER_BITS) - 1)).astype(np.int64)])
            if not len(maybe):
                continue
            low = np.searchsorted(hashes, g[maybe])
            high = np.searchsorted(hashes, g[maybe], side="right")
            some = high > low
            maybe, low, high = maybe[some], low[some], high[some]
            rows = np.searchsorted(w.rows, at[maybe], side="right") - 1
            good = []
            for i, a, b, r in zip(at[maybe].tolist(), low.tolist(), high.tolist(), rows.tolist()):
                text = row_bytes(w, i, k)
                own = {self.ids[self.item[x]] for x in first[a:b].tolist() if self.window(x, k) == text}
                if own:
                    items[r] |= own
                    good.append(i)
            if good:
                hit |= covered(np.array(good), k, len(w.start))


def _sets(benchmark: DataFrame, item_id: str, text: str, n: int, limit: int):
    """A function for tasks that yields the n-gram sets of all items, block by block."""
    spark = benchmark.sparkSession
    items = keyed(benchmark, item_id, text)
    size = items.select(F.sum(F.octet_length(F.col(f"`{text}`")) + 16)).first()[0] or 0
    if size <= limit:
        rows = items.collect()  # at most ``limit`` bytes of text
        shared = spark.sparkContext.broadcast(NgramSet(n, [r[0] for r in rows], pa.array([r[1] or "" for r in rows], pa.string())))
        return lambda: iter((shared.value,))
    folder = new_folder(spark, "ngrams")
    blocks = -(-size // limit)

    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, texts = [], []
        for b in it:
            ids += column(b, item_id).to_pylist()
            texts += text_column(b, text).to_pylist()
        if ids:
            path = f"{folder}/block-{TaskContext.get().partitionId():06d}"
            write_file(path, [pickle.dumps(NgramSet(n, ids, pa.array(texts, pa.string())), protocol=5)])
            yield pa.record_batch({"path": [path]})

    # Items are spread by a hash of the whole row, so no block holds more than its share.
    paths = [r[0] for r in items.repartition(int(blocks), F.xxhash64(*items.columns)).mapInArrow(build, "path string").collect()]

    def load():
        for p in paths:
            with RangeReader(p) as f:
                yield pickle.loads(f.read(0, f.size()))

    return load


def _judged(it: Iterator[pa.RecordBatch], text: str, sets) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray, list[set]]]:
    """Pieces of batches with their words, the words hit and the items found in each row.

    All pieces of ``_BUFFER`` bytes of text meet one block of n-grams before the next is read."""

    def judge(held: list) -> Iterator[tuple]:
        pieces = []
        for part, col in held:
            w = Words(col, ALNUM_LOW, lower=True)
            pieces.append((part, w, np.zeros(len(w.start), bool), [set() for _ in range(len(col))]))
        for s in sets():
            for _, w, hit, items in pieces:
                s.find(w, hit, items)
        yield from pieces

    held, size = [], 0
    for batch in it:
        for part, col in chunks(batch, text):
            held.append((part, col))
            size += col.nbytes
            if size > _BUFFER:
                yield from judge(held)
                held, size = [], 0
    if held:
        yield from judge(held)


def scan(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = WINDOW, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """One row per document: words, words hit, items found (ids as sorted strings), hit spans in words."""
    sets = _sets(benchmark, item_id, item_text, n, broadcast_limit)
    docs = keyed(docs, doc_id, text)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, w, hit, items in _judged(it, text, sets):
            cum = np.concatenate([[0], np.cumsum(hit)])
            yield pa.record_batch(
                [
                    column(part, doc_id),
                    pa.array(w.count, pa.int64()),
                    pa.array(cum[w.rows[1:]] - cum[w.rows[:-1]], pa.int64()),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array([_runs(hit[a:b]) for a, b in zip(w.rows[:-1], w.rows[1:])], pa.list_(pa.int32())),
                ],
                names=[doc_id, "n_words", "n_hit", "items", "hit_spans"],
            )

    return docs.mapInArrow(trimmed(run), f"`{doc_id}` {kind}, n_words long, n_hit long, items array<string>, hit_spans array<int>")


def _runs(hit: np.ndarray) -> list[int]:
    """start, end, start, end ... of the runs of True."""
    if not hit.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edge.tolist()


def is_contaminated(n_hit, n_words, share: int = 20):
    return (n_hit > 0) & (n_hit * share >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = WINDOW, share: int = 20, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``docs`` (all columns) without contaminated documents, or, with ``remove="spans"``, with the hit spans cut out of every text."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    sets = _sets(benchmark, item_id, item_text, n, broadcast_limit)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, w, hit, _ in _judged(it, text, sets):
            cum = np.concatenate([[0], np.cumsum(hit)])
            n_hit = cum[w.rows[1:]] - cum[w.rows[:-1]]
            if remove == "documents":
                yield part.filter(pa.array(~((n_hit > 0) & (n_hit * share >= w.count))))
                continue
            texts = column(part, text).to_pylist()
            for r in np.flatnonzero(n_hit).tolist():
                a, b, base = w.rows[r], w.rows[r + 1], w.offsets[r]
                raw, out, last = texts[r].encode(), [], 0
                runs = _runs(hit[a:b])
                for s, e in zip(runs[::2], runs[1::2]):
                    out.append(raw[last : w.start[a + s] - base])
                    last = int(w.end[a + e - 1] - base)
                texts[r] = b"".join([*out, raw[last:]]).decode()
            i = part.schema.get_field_index(text)
            yield part.set_column(i, part.schema.field(i), pa.array(texts, part.schema.field(i).type))

    return docs.mapInArrow(trimmed(run), docs.schema)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def op2(spark, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents`` and ``benchmark``."""
    from ._util import read_table

    found = scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


SQL = r"""
with dw as (
  select doc_id, row_number() over () as rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
bw as (
  select coalesce(cast(item_id as varchar), '') as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark),
grams as (
  select distinct item, least(13, len(ws)) as k, unnest([array_to_string(ws[i : i + least(13, len(ws)) - 1], ' ') for i in range(1, len(ws) - least(13, len(ws)) + 2)]) as g
  from bw where len(ws) > 0),
lens as (select distinct k from grams),
wins as (
  select rid, k, unnest(range(1, len(ws) - k + 2)) as i, unnest([array_to_string(ws[i : i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) as g
  from dw, lens where len(ws) >= k),
hits as (select w.rid, w.i, w.k, g.item from wins w join grams g on w.k = g.k and w.g = g.g),
pos as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + k)) as p from (select distinct rid, i, k from hits)) group by rid),
its as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct rid, item from hits) group by rid)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from dw left join pos using (rid) left join its using (rid)
"""
