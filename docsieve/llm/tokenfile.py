"""Token-id files with a minimal-perfect-hash index.

``write`` encodes every text, appends an end id, and writes raw little-endian ids
(two bytes each where the vocabulary allows it, else four) into shard files in
ascending document order, then an index: keys are spread over buckets, and each
bucket file holds a minimal perfect hash (levels of collision-free bit vectors with
ranks) from key to a slot with a stored 64-bit fingerprint, shard, offset, length and
global start.  ``read`` looks keys up in the index in constant time each (a few words of
its file, or the whole file for many keys) and reads their byte ranges from the shards.
Special strings of the tokenizer in a text become their own ids, as in the library.

Scale: texts are range-partitioned by document id once (composite key, so repeated
ids cannot pile up) and encoded where they are written; index and look-ups move a
few numbers per document.  A task holds one block of texts or one index bucket.
Files are written whole and renamed, so a retried task leaves the same file.

Defined cases: a null or empty text has just the end id; a null document id sorts
first; rows that repeat an id are ordered by a hash of their text and told apart by their ordinal;
an empty table gives no files; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._segments import SegmentEncoder
from ._util import RangeReader, chunks, column, input_bytes, materialise, new_folder, partitions_for, read_table, write_file
from ._words import U, mix

END_ID = 2
_BLOCK = 2 << 20
BUCKET_KEYS = 1 << 20
_encoders: dict[str, SegmentEncoder] = {}

# Bytes that are white space by themselves, and first bytes of longer white space.
_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
_LONG_SPACE = np.array([b in (0xC2, 0xE1, 0xE2, 0xE3) for b in range(256)])


def _byte_level_cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Cut where a run of white space begins: the byte-level pattern never joins a
    character that is not white space to white space after it.  Texts with white space
    beyond ASCII, or control separators, stay whole."""
    space = _SPACE[raw]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    odd = (raw >= 0x1C) & (raw <= 0x1F)
    lead = np.flatnonzero(_LONG_SPACE[raw])
    if len(lead):
        b0, b1 = raw[lead], raw[np.minimum(lead + 1, len(raw) - 1)]
        odd[lead[((b0 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | ((b0 == 0xE1) & (b1 == 0x9A)) | ((b0 == 0xE2) & ((b1 == 0x80) | (b1 == 0x81))) | ((b0 == 0xE3) & (b1 == 0x80))]] = True
    if odd.any():
        for r in np.unique(np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1).tolist():
            begins[offsets[r] : offsets[r + 1]] = False
    return begins


def byte_bpe(path: str) -> tuple[SegmentEncoder, int]:
    """The encoder of a byte-level tokenizer file, and its vocabulary size (one per worker process)."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        for token in t.get_added_tokens_decoder().values():
            if any(c.isspace() for c in token.content) or token.lstrip or token.rstrip:
                raise ValueError("added tokens that take white space would cross segments")
        size = t.get_vocab_size()
        dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")

        def encode(segments: list[bytes]) -> list[bytes]:
            out: list[bytes] = []
            for i in range(0, len(segments), 4096):
                ids = [e.ids for e in t.encode_batch_fast([s.decode() for s in segments[i : i + 4096]], add_special_tokens=False)]
                size = np.fromiter(map(len, ids), np.int64, len(ids))
                out += SegmentEncoder.split(np.fromiter(chain.from_iterable(ids), dtype, int(size.sum())), size)
            return out

        _encoders[path] = SegmentEncoder(encode, _byte_level_cuts, dtype)
        _encoders[path].vocabulary = size
    return _encoders[path], _encoders[path].vocabulary


# ---------------------------------------------------------------- minimal perfect hash
def _level(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + U(0x9E3779B97F4A7C15 * (level + 1) & ((1 << 64) - 1))) % U(size)).astype(np.int64)


_WORD = np.dtype([("bits", "<u8"), ("rank", "<u8")])


class PerfectHash:
    """Levels of bit vectors: a key's slot is the rank of its bit on the first level where it stood alone."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        #: per level, pairs of 64 bits and how many bits stand before them on all levels
        self.levels, self.rest = levels, rest
        self.base = int(levels[-1]["rank"][-1]) + int(np.bitwise_count(levels[-1]["bits"][-1])) if levels else 0

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 1.6, most: int = 40) -> PerfectHash:
        keys = np.asarray(keys, U)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("keys repeat")
        levels, total = [], 0
        while len(keys) and len(levels) < most:
            size = max(64, -(-int(len(keys) * gamma) // 64) * 64)
            at = _level(keys, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            level = np.zeros(size // 64, _WORD)
            level["bits"] = np.packbits(alone, bitorder="little").view("<u8")
            count = np.cumsum(np.bitwise_count(level["bits"]), dtype=np.int64)
            level["rank"] = total + np.concatenate([[0], count[:-1]])
            total += int(count[-1])
            levels.append(level)
            keys = keys[~alone[at]]
        return cls(levels, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys; a key never indexed may get any slot or -1, so callers check fingerprints."""
        keys = np.asarray(keys, U)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            at = _level(keys[left], i, len(level) * 64)
            got = level[at >> 6]
            bit = U(1) << (at & 63).astype(U)
            hit = (got["bits"] & bit) != 0
            inside = np.bitwise_count(got["bits"] & (bit - U(1))).astype(np.int64)
            out[left[hit]] = (got["rank"].astype(np.int64) + inside)[hit]
            left = left[~hit]
        if len(left) and len(self.rest):
            pos = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            hit = self.rest[pos] == keys[left]
            out[left[hit]] = self.base + pos[hit]
        return out

    def dump(self) -> bytes:
        head = np.array([*[len(b) for b in self.levels], len(self.rest)], "<i8")
        return np.array([len(head)], "<i8").tobytes() + head.tobytes() + b"".join(b.tobytes() for b in self.levels) + self.rest.astype("<u8").tobytes()

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, int]:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        head = np.frombuffer(data, "<i8", n, 8)
        pos, levels = 8 + 8 * n, []
        for size in head[:-1].tolist():
            levels.append(np.frombuffer(data, _WORD, size, pos))
            pos += size * _WORD.itemsize
        return cls(levels, np.frombuffer(data, "<u8", int(head[-1]), pos)), pos + 8 * int(head[-1])


class _InFile:
    """An array in a file of which single elements are read, for look-ups of a few keys."""

    def __init__(self, f: RangeReader, dtype: np.dtype, n: int, at: int):
        self.f, self.dtype, self.n, self.at = f, dtype, n, at

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        size = self.dtype.itemsize
        return np.frombuffer(b"".join(self.f.read(self.at + size * k, size) for k in i.tolist()), self.dtype)


def open_index(f: RangeReader, keys: int) -> tuple[PerfectHash, np.ndarray | _InFile]:
    """(perfect hash, entries) of an index file: read whole for many keys, else by the few words each key needs."""
    size = f.size()
    if keys * 4096 > size:
        data = f.read(0, size)
        perfect, at = PerfectHash.load(data)
        return perfect, np.frombuffer(data, _ENTRY, offset=at)
    n = int(np.frombuffer(f.read(0, 8), "<i8")[0])
    head = np.frombuffer(f.read(8, 8 * n), "<i8").tolist()
    at, levels = 8 + 8 * n, []
    for words in head[:-1]:
        levels.append(_InFile(f, _WORD, words, at))
        at += words * _WORD.itemsize
    perfect = PerfectHash.__new__(PerfectHash)
    rest = np.frombuffer(f.read(at, 8 * head[-1]), "<u8")
    at += 8 * head[-1]
    perfect.levels, perfect.rest, perfect.base = levels, rest, (size - at) // _ENTRY.itemsize - len(rest)
    return perfect, _InFile(f, _ENTRY, (size - at) // _ENTRY.itemsize, at)


_ENTRY = np.dtype([("fingerprint", "<u8"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u8"), ("start", "<u8")])


def _keys(doc_id: pa.Array, ordinal: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash key, fingerprint): the key is a bijection of the id for first occurrences."""
    ids = np.nan_to_num(np.asarray(doc_id.fill_null(0)), nan=0).astype(np.int64).view(U)
    o = np.asarray(ordinal).astype(U)
    null = np.asarray(doc_id.is_null()).astype(U)
    extra = mix(o + U(1)) * (o > 0) ^ mix(null + U(7)) * null
    return mix(ids ^ extra), mix(ids + U(0x632BE59BD9B4E019)) ^ mix(o * U(0x9E3779B97F4A7C15) + null)


# ---------------------------------------------------------------- writing and reading
class TokenFiles:
    """What ``write`` left: the folder, its id width, and a table of keys."""

    def __init__(self, folder: str, dtype: str, buckets: int, keys: DataFrame):
        self.folder, self.dtype, self.buckets, self.keys = folder, dtype, buckets, keys


def write(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID, folder: str | None = None) -> TokenFiles:
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    n = partitions_for(spark, input_bytes(docs))
    tie = F.xxhash64("text")
    placed = docs.repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    from tokenizers import Tokenizer

    dtype = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, _ = byte_bpe(tokenizer)
        shard, found, at = TaskContext.get().partitionId(), [], 0

        def blocks():
            nonlocal at
            for batch in it:
                for part, col in chunks(batch, "text", _BLOCK):
                    ids, rows = encoder.rows(col)
                    out = np.empty(len(ids) + len(col), dtype)
                    ends = rows[1:] + np.arange(len(col))
                    body = np.ones(len(out), bool)
                    body[ends] = False
                    out[body] = ids
                    out[ends] = end_id
                    size = np.diff(rows) + 1
                    found.append((column(part, "doc_id"), at + np.concatenate([[0], np.cumsum(size)[:-1]]), size))
                    at += len(out)
                    yield out.tobytes()

        write_file(f"{folder}/shard-{shard:06d}.ids", blocks())
        for ids, offset, size in found:
            yield pa.record_batch({"doc_id": ids, "shard": pa.array(np.full(len(size), shard), pa.int32()), "offset": pa.array(offset, pa.int64()), "n_tokens": pa.array(size, pa.int64())})

    table = materialise(placed.mapInArrow(encode, "doc_id long, shard int, offset long, n_tokens long"), "token-rows")
    # One row per shard file: shards follow the range order, so starts are running sums.
    per = table.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    begins = per.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"))
    # Ordinals of repeated ids, numbered only where ids do repeat.
    if table.groupBy("doc_id").count().where("count > 1").limit(1).count():
        order = Window.partitionBy("doc_id").orderBy("shard", "offset")
        table = table.withColumn("ordinal", (F.row_number().over(order) - 1).cast("long"))
    else:
        table = table.withColumn("ordinal", F.lit(0).cast("long"))
    buckets = max(1, -(-table.count() // BUCKET_KEYS))
    spread = max(int(buckets), min(int(spark.conf.get("spark.sql.shuffle.partitions")), 64))
    entries = table.join(F.broadcast(begins), "shard").select("doc_id", "ordinal", "shard", "offset", "n_tokens", (F.col("begin") + F.col("offset")).alias("start"))
    entries = entries.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "ordinal"), F.lit(spread)).cast("int"))

    def index(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_value(it, "bucket"):
            key, mark = _keys(column(rows, "doc_id"), column(rows, "ordinal"))
            perfect = PerfectHash.build(key)
            entry = np.zeros(len(key), _ENTRY)
            slot = perfect.slots(key)
            entry["fingerprint"][slot] = mark
            for c, name in (("shard", "shard"), ("offset", "offset"), ("n", "n_tokens"), ("start", "start")):
                entry[c][slot] = np.asarray(column(rows, name))
            write_file(f"{folder}/index-{bucket:06d}", [perfect.dump(), entry.tobytes()])
            yield pa.record_batch({"bucket": pa.array([bucket], pa.int32()), "keys": pa.array([len(key)], pa.int64())})

    entries.repartition(spread, "bucket").sortWithinPartitions("bucket").mapInArrow(index, "bucket int, keys long").agg(F.sum("keys")).collect()
    return TokenFiles(folder, dtype, spread, table.select("doc_id", "ordinal"))


def _by_value(it: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of equal ``name`` from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in it:
        values = np.asarray(column(batch, name))
        if not len(values):
            continue
        edges = np.flatnonzero(np.diff(values)) + 1
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(values)]):
            if held and values[s] != current:
                yield int(current), _one(held)
                held = []
            current = values[s]
            held.append(batch.slice(s, e - s))
    if held:
        yield int(current), _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def locate(files: TokenFiles, keys: DataFrame) -> DataFrame:
    """doc_id, ordinal, shard, offset, n_tokens and start of keys, from the index; unknown keys are left out."""
    folder = files.folder

    def look_up(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_value(it, "bucket"):
            key, mark = _keys(column(rows, "doc_id"), column(rows, "ordinal"))
            with RangeReader(f"{folder}/index-{bucket:06d}") as f:
                perfect, entry = open_index(f, len(key))
                slot = perfect.slots(key)
                got = entry[np.maximum(slot, 0)]
            known = (slot >= 0) & (got["fingerprint"] == mark)
            out = {c: column(rows, c).filter(pa.array(known)) for c in ("doc_id", "ordinal")}
            out |= {name: pa.array(got[c][known].astype(np.int64)) for c, name in (("shard", "shard"), ("offset", "offset"), ("n", "n_tokens"), ("start", "start"))}
            yield pa.record_batch(out)

    keyed_rows = keys.select("doc_id", "ordinal", F.pmod(F.xxhash64("doc_id", "ordinal"), F.lit(files.buckets)).cast("int").alias("bucket"))
    return keyed_rows.repartition(files.buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(look_up, "doc_id long, ordinal long, shard long, offset long, n_tokens long, start long")


def _visit(files: TokenFiles, keys: DataFrame, schema: str, of) -> DataFrame:
    folder, width, dtype = files.folder, np.dtype(files.dtype).itemsize, files.dtype

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            values = [column(batch, c).to_pylist() for c in ("doc_id", "shard", "offset", "n_tokens", "start")]
            rows, f, current = [], None, None
            for d, s, o, n, b in zip(*values):
                if s != current:
                    if f is not None:
                        f.__exit__()
                    f, current = RangeReader(f"{folder}/shard-{s:06d}.ids"), s
                rows.append(of(d, b, np.frombuffer(f.read(o * width, n * width), dtype)))
            if f is not None:
                f.__exit__()
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    placed = locate(files, keys)
    return placed.repartition("shard").sortWithinPartitions("shard", "offset").mapInArrow(read, schema)


def read(files: TokenFiles, keys: DataFrame | None = None) -> DataFrame:
    """doc_id, start and ids (array<long>) of ``keys`` (doc_id, ordinal), all by default."""
    keys = files.keys if keys is None else keys
    return _visit(files, keys, "doc_id long, start long, ids array<long>", lambda d, b, ids: {"doc_id": d, "start": b, "ids": ids.tolist()})


def checksums(files: TokenFiles) -> DataFrame:
    """Per document what the files hold: start, n_tokens, and the CRC of its ids as 32-bit integers."""
    return _visit(files, files.keys, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda d, b, ids: {"doc_id": d, "start": b, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})


def op1(spark, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    import public_tokenizers

    return checksums(write(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
