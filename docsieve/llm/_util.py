"""Shared plumbing of the training-data operators.

Scratch tables and files live under ``spark.checkpoint.dir`` (read from the
session; a folder of our own is set only where that setting is absent, as in
tests), so every executor sees them and a lost executor costs a task retry only.
"""

from __future__ import annotations

import atexit
import ctypes
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once by the vectorised kernels (one longer text is one chunk).
CHUNK_BYTES = 2 << 20


# ---------------------------------------------------------------- scratch space
def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = getattr(spark, "_docsieve_scratch", None)
        if root is None:
            root = "file://" + tempfile.mkdtemp(prefix="docsieve-")
            spark._docsieve_scratch = root
    return root.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended: the folder is left to its owner
        return


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_root(spark)}/docsieve-{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._docsieve_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote and nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_docsieve_path", None):
            _delete(df.sparkSession, path)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a frame's size, for choosing partition counts."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def partitions_for(spark: SparkSession, size: int, per_task: int = 16 << 20) -> int:
    """Partitions of about ``per_task`` bytes, never fewer than the session's shuffle setting
    (that setting alone where Catalyst knows no size, as for frames made from objects)."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // per_task)) if size < 1 << 55 else least


# ---------------------------------------------------------------- files from tasks
def _fs(path: str):
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return None, path
    return pafs.FileSystem.from_uri(path)


def write_file(path: str, chunks) -> int:
    """Write byte chunks to ``path``; a retried task replaces the file whole."""
    fs, local = _fs(path)
    size = 0
    if fs is None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = f"{local}.{uuid.uuid4().hex}.part"
        with open(part, "wb") as out:
            for c in chunks:
                size += out.write(c)
        os.replace(part, local)
        return size
    part = f"{local}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        for c in chunks:
            out.write(c)
            size += len(c)
    fs.move(part, local)
    return size


class RangeReader:
    """Random access to one file by absolute offsets."""

    def __init__(self, path: str):
        fs, local = _fs(path)
        self._f = (fs or pafs.LocalFileSystem()).open_input_file(local)

    def read(self, offset: int, length: int) -> bytes:
        return self._f.read_at(length, offset)

    def size(self) -> int:
        return self._f.size()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self._f.close()


# ---------------------------------------------------------------- memory of workers
def trim() -> None:
    """Gives freed memory back to the system, where the C library can.

    Python workers live on from stage to stage, and what one stage freed would stay
    reserved beside what the next one needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library: nothing to trim
        return


def trimmed(run):
    """A function of batches that leaves a worker as small as it found it: freed memory is given back at the task's end."""

    def whole(it):
        try:
            yield from run(it)
        finally:
            trim()

    return whole


# ---------------------------------------------------------------- Arrow helpers
def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column, nulls as empty texts."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.type not in (pa.string(), pa.large_string()):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0, int64) and the UTF-8 bytes they cut."""
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES):
    """Slices of ``batch`` of about ``limit`` text bytes, in order, each with its text column."""
    col = text_column(batch, text)
    offsets, _ = buffers(col)
    i = 0
    while i < len(col):
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), len(col))
        yield batch.slice(i, j - i), col.slice(i, j - i)
        i = j


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, whatever else (or however cased) the frame carries."""
    return df.select(*[F.col(f"`{c}`") for c in cols])
