"""Categories by identifier: look-ups in category tables (inventory J4, A15, U1, J11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def look_up(identified: DataFrame, tables: DataFrame) -> DataFrame:
    """All categories of (doc_id, ord, table_id, identifier) in ``tables`` (table_id, identifier, categories array).

    Tables apply in order of ``ord``; the first one without an identifier ends the document
    with ``missing``.  doc_id, categories (concatenated in order), missing, matched."""
    first = F.min(F.when(F.coalesce(F.col("identifier"), F.lit("")) == "", F.col("ord"))).over(Window.partitionBy("doc_id"))
    marked = identified.withColumn("gap", first)
    found = marked.join(tables, ["table_id", "identifier"], "left")
    lists = F.array_sort(F.collect_list(F.when(F.col("categories").isNotNull(), F.struct("ord", "categories"))))
    out = found.groupBy("doc_id").agg(lists.alias("lists"), F.bool_or(F.col("gap").isNotNull()).alias("missing"))
    categories = F.flatten(F.transform("lists", lambda x: x["categories"]))
    none = F.slice(categories, 1, 0)
    out = out.withColumn("categories", F.when(F.col("missing"), none).otherwise(categories)).drop("lists")
    return out.withColumn("matched", F.size("categories") > 0)


def match_folder(names: DataFrame, folders: DataFrame) -> DataFrame:
    """The first folder (by name) that is part of each corpus name; null where none is.

    Folders are configuration directories, few by nature, so they are folded into one array first."""
    every = folders.agg(F.array_sort(F.collect_set("folder")).alias("folders"))
    return names.join(F.broadcast(every), F.lit(True), "left").select(*names.columns, F.try_element_at(F.filter("folders", lambda f: F.contains(F.col("corpusname"), f)), F.lit(1)).alias("folder"))
