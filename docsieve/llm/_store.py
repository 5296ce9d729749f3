"""Texts once more in the shared folder: compressed blocks in one file per scan task.

A row's number says where it is (file << 33 | row), so later steps shuffle numbers and
read the texts they need in file order, instead of shuffling every text again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

from ._util import RangeReader, chunks, column, write_file

NO_ID = (1 << 63) - 1


def _pack(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())


class Store:
    """Rows of one store file by their number, block by block."""

    def __init__(self, folder: str, part: int):
        self.file = RangeReader(f"{folder}/texts-{part:06d}")
        size = self.file.size()
        n = int(np.frombuffer(self.file.read(size - 8, 8), "<i8")[0])
        table = np.frombuffer(self.file.read(size - 8 - 24 * n, 24 * n), "<i8").reshape(n, 3)
        self.first, self.offset, self.length = table[:, 0], table[:, 1], table[:, 2]
        self.block, self.rows = -1, None

    def block_of(self, row: int) -> int:
        return int(np.searchsorted(self.first, row, side="right")) - 1

    def load(self, b: int) -> pa.RecordBatch:
        if b != self.block:
            raw = zstandard.ZstdDecompressor().decompress(self.file.read(int(self.offset[b]), int(self.length[b])))
            self.rows, self.block = pa.ipc.open_stream(raw).read_next_batch(), b
        return self.rows

    def get(self, row: int) -> pa.RecordBatch:
        b = self.block_of(row)
        return self.load(b).slice(row - int(self.first[b]), 1)

    def close(self) -> None:
        self.file.__exit__()


def visits(it: Iterator[pa.RecordBatch], folder: str, name: str = "rid"):
    """Batches sorted by row number -> (number, its store row, slices of its batch rows)."""
    store, part, held, current = None, None, [], None

    def fetch(rid: int) -> pa.RecordBatch:
        nonlocal store, part
        if rid >> 33 != part:
            if store is not None:
                store.close()
            part = rid >> 33
            store = Store(folder, part)
        return store.get(rid & ((1 << 33) - 1))

    for batch in it:
        rid = np.asarray(column(batch, name))
        if not len(rid):
            continue
        edges = np.flatnonzero(np.diff(rid)) + 1
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(rid)]):
            if held and rid[s] != current:
                yield current, fetch(current), held
                held = []
            current = int(rid[s])
            held.append(batch.slice(s, e - s))
    if held:
        yield current, fetch(current), held
    if store is not None:
        store.close()


def take(it: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Batches of sorted distinct ``rid`` -> (row numbers, their whole rows), block by block."""
    store, part = None, None
    for batch in it:
        rids = np.asarray(column(batch, "rid"))
        while len(rids):
            if rids[0] >> 33 != part:
                if store is not None:
                    store.close()
                part = int(rids[0] >> 33)
                store = Store(folder, part)
            b = store.block_of(int(rids[0]) & ((1 << 33) - 1))
            rows = store.load(b)
            begin = (part << 33) + int(store.first[b])
            n = int(np.searchsorted(rids, begin + rows.num_rows))
            yield rids[:n], rows.take(pa.array(rids[:n] - begin))
            rids = rids[n:]
    if store is not None:
        store.close()


def write(it: Iterator[pa.RecordBatch], folder: str, of: Callable[[pa.Array], dict], doc_id: str = "doc_id", text: str = "text") -> Iterator[pa.RecordBatch]:
    """In a scan task: writes its store file (whole rows), then yields rid, doc_id and the
    columns that ``of(texts)`` gives, block by block."""
    from pyspark import TaskContext

    part, out, row, index, at = TaskContext.get().partitionId(), [], 0, [], 0

    def frames():
        nonlocal row, at
        for batch in it:
            for piece, col in chunks(batch, text):
                frame = _pack(piece)
                rid = np.arange(row, row + len(col)) + (part << 33)
                out.append(pa.record_batch({"rid": pa.array(rid, pa.int64()), "doc_id": column(piece, doc_id).cast(pa.int64())} | of(col)))
                index.append((row, at, len(frame)))
                row, at = row + len(col), at + len(frame)
                yield frame
        yield np.array(index, "<i8").tobytes() + np.array([len(index)], "<i8").tobytes()

    write_file(f"{folder}/texts-{part:06d}", frames())
    yield from out
