"""Streaming forms: bundles of files, and the path inventory as running state (inventory R6, R8-R10)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import xpaths
from ..sources import scratch


def in_bundles(files: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Each trigger's files through a whole chain of stages; what is there is done, then it ends."""
    writer = files.writeStream.queryName(name) if name else files.writeStream
    return writer.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def path_counts(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """The running inventory over a stream of documents: state is a row per distinct path."""
    rows = xpaths.paths(docs, xml)
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_set("attributes"))))
    return rows.groupBy("xpath").agg(F.sum("countElement").alias("countElement"), names.alias("attributes"))


def run_inventory(docs: DataFrame, table: str, checkpoint: str, xml: str = "xml") -> StreamingQuery:
    """Runs the inventory to the end of what is there, into an in-memory table of its final state."""
    return path_counts(docs, xml).writeStream.outputMode("complete").format("memory").queryName(table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# ---------------------------------------------------------------- the inventory of all bundles
def merge_paths(found: DataFrame, folder: str, batch: int) -> None:
    """Keeps one bundle's inventory under its number; a bundle that is done again replaces its own."""
    found.select("xpath", "countElement", "attributes").write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def _versions(spark: SparkSession, folder: str) -> tuple[int, list[int]]:
    """(the last bundle of the newest merged table or -1, bundles behind it)."""
    names = scratch.names(spark, folder)
    merged = max((int(n.removeprefix("merged=")) for n in names if n.startswith("merged=") and scratch.names(spark, f"{folder}/{n}").count("_SUCCESS")), default=-1)
    return merged, sorted(b for n in names if n.startswith("batch=") and (b := int(n.removeprefix("batch="))) > merged)


def path_state(spark: SparkSession, folder: str) -> DataFrame:
    """The inventory of all bundles so far, each counted once."""
    merged, batches = _versions(spark, folder)
    parts = [f"{folder}/batch={b}" for b in batches] + ([f"{folder}/merged={merged}"] if merged >= 0 else [])
    schema = "xpath string, countElement long, attributes array<string>"
    rows = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    return xpaths.summed(rows)


def compact_paths(spark: SparkSession, folder: str, least: int = 100) -> None:
    """Merges the bundles' inventories into one table where there are ``least`` of them.

    The table carries the number of its last bundle: that one and those before it are not read
    any more, also if one of them is done again.  What it replaces goes when it is complete."""
    merged, batches = _versions(spark, folder)
    if len(batches) < least:
        return
    path_state(spark, folder).write.mode("overwrite").parquet(f"{folder}/merged={batches[-1]}")
    for b in batches:
        scratch.remove(spark, f"{folder}/batch={b}")
    if merged >= 0:
        scratch.remove(spark, f"{folder}/merged={merged}")
