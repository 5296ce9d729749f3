"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to ``BITS`` bits (categories by rank, in
order; magnitudes by octaves), a Hilbert index orders
the rows, and the order is cut into runs, so each shard covers a compact region of
all dimensions at once and a manifest of per-shard minima and maxima prunes files
for predicates on any of them.

The order is a range-partitioned sort of a few numbers per row (never of texts when
only the assignment is asked for), with the row's own key behind the curve index, so
a source with a third of all rows spreads over many partitions.  Row numbers come
from one small table, a row per sorted partition.

Law: ``rows`` - shard sizes differ by one row at most.  Defined cases: a null text
has size 1 and the CRC of the empty text; null dimensions take bucket 0; repeated
rows sit next to each other; an empty table gives no rows; other columns are ignored
unless carried.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import discard, input_bytes, keyed, materialise, new_folder, partitions_for, read_table

SHARDS = 16
BITS = 8
_LOW = (1 << 33) - 1


def hilbert(coordinates: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve through a grid of 2**bits cells a side (any number of dimensions)."""
    x = [np.asarray(c, dtype=np.int64).copy() for c in coordinates]
    n, top = len(x), 1 << (bits - 1)
    # Undo the excess work of reflections and exchanges, from the highest bit down.
    q = top
    while q > 1:
        p = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(up, p, 0) ^ swap
            x[i] ^= swap
        q >>= 1
    # Gray code of the transposed index.
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ t) >> b) & 1)
    return out


def bucketed(docs: DataFrame, c: str, name: str) -> DataFrame:
    """``docs`` with the cell of category ``c`` as column ``name``: its rank among the distinct
    values, scaled to 2**BITS cells, so cells keep the order that minima and maxima prune by.

    Null takes cell 0.  Distinct values, however many, are numbered in a range-partitioned sort;
    the values at which a new cell begins (fewer than 2**BITS) say every value's cell, so rows
    meet no table and a frequent value stays where its rows are."""
    value = F.col(f"`{c}`").cast("string")
    values = docs.select(value.alias("v")).where("v is not null").distinct()
    values = values.repartitionByRange("v").sortWithinPartitions("v").withColumn("at", F.monotonically_increasing_id())
    values = materialise(values, "categories")
    per = values.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # a row per sorted partition
    n, begin = sum(r.n for r in per), 0
    starts = []
    for r in per:
        starts.append((r.part, begin))
        begin += r.n
    table = docs.sparkSession.createDataFrame(starts, "part long, begin long")
    ranked = values.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(table), "part").withColumn("r", F.col("begin") + F.col("at").bitwiseAND(_LOW))
    cell = lambda r: F.floor(r * (1 << BITS) / n) if n else F.lit(0)
    cuts = sorted(((r.cell, r.v) for r in ranked.where((F.col("r") > 0) & (cell(F.col("r")) > cell(F.col("r") - 1))).select("v", cell(F.col("r")).alias("cell")).collect()), key=lambda x: x[0])
    discard(values)
    first = F.array(*[F.lit(v) for _, v in cuts]).cast("array<string>")
    cells = F.array(F.lit(0), *[F.lit(int(k)) for k, _ in cuts])
    found = F.element_at(cells, F.size(F.filter(first, lambda x: x <= value)) + 1)
    return docs.withColumn(name, F.when(value.isNull(), 0).otherwise(found).cast("int"))


def octaves(c: Column, steps: int = 8) -> Column:
    """A magnitude on a logarithmic scale, ``steps`` cells an octave."""
    return F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(F.greatest(F.coalesce(c, F.lit(1)), F.lit(1))) * steps)).cast("int")


def ordered(docs: DataFrame, dimensions: list[Column], key: list[Column], carry: list[Column]) -> DataFrame:
    """The ``carry`` columns as ``row`` with hilbert and ``at``, a number that rises along the curve; written.

    ``key`` orders rows within one cell; rows equal in it must be equal in what is carried."""

    @F.pandas_udf("long")
    def index(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert([cells[c].to_numpy() for c in cells.columns]))

    rows = docs.select(F.struct(*carry).alias("row"), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key)]).alias("key"), F.struct(*[d.alias(f"d{i}") for i, d in enumerate(dimensions)]).alias("cells"))
    rows = rows.select("row", "key", index("cells").alias("hilbert"))
    n = partitions_for(docs.sparkSession, input_bytes(docs))
    placed = rows.repartitionByRange(n, "hilbert", "key").sortWithinPartitions("hilbert", "key").select("row", "hilbert", F.monotonically_increasing_id().alias("at"))
    return materialise(placed, "hilbert")


def numbered(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``ordered`` with hilbert, shard and slot."""
    per = placed.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("begin"), F.sum("n").over(Window.partitionBy()).alias("total"))
    # One row per sorted partition: bounded by the partition count, so it is broadcast.
    ranked = placed.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(starts), "part")
    ranked = ranked.withColumn("rank", F.col("begin") + F.col("at").bitwiseAND(_LOW))
    q, r = F.expr(f"total div {shards}"), F.col("total") % shards
    large = r * (q + 1)  # rows in the shards that get one more
    shard = F.when(F.col("rank") < large, F.expr(f"rank div (total div {shards} + 1)")).otherwise(r + F.expr(f"(rank - (total % {shards}) * (total div {shards} + 1)) div greatest(total div {shards}, 1)"))
    ranked = ranked.withColumn("shard", shard.cast("int"))
    begin = F.least(F.col("shard"), r) * (q + 1) + F.greatest(F.col("shard") - r, F.lit(0)) * q
    return ranked.select("row.*", "hilbert", "shard", (F.col("rank") - begin).cast("long").alias("slot"))


def assign(docs: DataFrame, dimensions: list[Column], key: list[Column], carry: list[Column], shards: int = SHARDS) -> DataFrame:
    """The ``carry`` columns with hilbert, shard and slot."""
    return numbered(ordered(docs, dimensions, key, carry), shards)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores behind it until no column is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", shards: int = SHARDS) -> DataFrame:
    """Writes all columns as Parquet, a folder ``__shard=N`` per shard; returns the manifest for pruning.

    Columns ``__slot`` and ``__hilbert`` are added.  Where the input has columns of these three
    names, underscores are added to the new ones.  Texts cross the network once, in the sort
    along the curve: its partitions are runs of that order already, so each is cut at the shard
    boundaries where it lies and written as files sorted by slot."""
    size = F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))) + 1
    shard, slot, curve = (free_name(n, docs.columns) for n in ("__shard", "__slot", "__hilbert"))
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(doc.alias("doc"), F.col(f"`{source}`").alias("source"), F.col(f"`{lang}`").alias("lang"), size.alias("bytes"))
    rows = bucketed(bucketed(rows, "source", "source_cell"), "lang", "lang_cell")
    placed = ordered(rows, [F.col("source_cell"), F.col("lang_cell"), octaves(F.col("bytes"))], [F.col(f"doc.`{doc_id}`"), F.xxhash64("doc")], [F.col("doc"), F.col("bytes")])
    out = numbered(placed, shards)
    out.sortWithinPartitions("shard", "slot").select("doc.*", F.col("hilbert").alias(curve), F.col("shard").alias(shard), F.col("slot").alias(slot)).write.partitionBy(shard).parquet(path)
    stats = [f(F.col(f"doc.`{c}`")).alias(f"{n}_{c}") for c in (source, lang) for n, f in (("min", F.min), ("max", F.max))]
    manifest = materialise(out.groupBy("shard").agg(F.count("*").alias("rows"), F.min("bytes").alias("min_bytes"), F.max("bytes").alias("max_bytes"), *stats), "manifest")
    discard(placed)
    return manifest


def op6(spark, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``: the shards are written, and every column comes from the files read back."""
    docs = keyed(read_table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source")
    path = new_folder(spark, "shards")
    write_shards(docs, path)
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"{c} {t}" for c, t in types.items()), "__hilbert long, __slot long, __shard int"])
    text = F.coalesce(F.col("text"), F.lit(""))
    columns = [F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law")]
    columns += [F.col("__shard").alias("shard"), F.col("__slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("__hilbert").alias("hilbert")]
    return spark.read.schema(schema).parquet(path).select(*columns)
