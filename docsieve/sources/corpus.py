"""Corpora: folders of files, tables of texts, resources (inventory S1-S11)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def extension(name: Column) -> Column:
    """The last part of a name from its dot on, '' without one; a leading dot is no extension."""
    return F.coalesce(F.regexp_extract(name, r"^.+?(\.[^.]*)$", 1), F.lit(""))


def file_info(files: DataFrame, corpusname: str, started: int, path: str = "path", length: str = "length") -> DataFrame:
    """corpusname, startAt, extension, path, name, size, and whatever else the frame carries."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    info = files.withColumns({"corpusname": F.lit(corpusname), "startAt": F.lit(started).cast("long"), "name": name, "size": F.col(length).cast("long")})
    return info.withColumn("extension", extension(F.col("name")))


def walk(spark: SparkSession, folder: str, corpusname: str = "default", started: int = 0, glob: str | None = None) -> DataFrame:
    """Every file under a folder with its content, which Catalyst drops where no stage reads it.

    Hidden and empty files are left out, as Spark's file sources do."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return file_info(reader.load(folder), corpusname, started).drop("modificationTime", "length")


def stream(spark: SparkSession, folder: str, corpusname: str = "default", started: int = 0, bundle: int = 1000) -> DataFrame:
    """The same as a stream of bundles of at most ``bundle`` files."""
    schema = spark.read.format("binaryFile").load(folder).schema
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", bundle).load(folder)
    return file_info(files, corpusname, started).drop("modificationTime", "length")


def from_table(docs: DataFrame, corpusname: str = "default", started: int = 0, doc_id: str = "doc_id", text: str = "text", suffix: str = ".txt") -> DataFrame:
    """A table of texts in the shape of a walked corpus: its rows are the files."""
    name = F.concat(F.lit("doc-"), F.col(doc_id).cast("string"), F.lit(suffix))
    files = docs.withColumns({"path": F.concat(F.lit(f"/{corpusname}/"), name), "length": F.octet_length(F.coalesce(F.col(text), F.lit("")))})
    return file_info(files, corpusname, started).drop("length")


def text_of(content: Column) -> Column:
    """UTF-8 content as text; invalid bytes are replaced."""
    return F.make_valid_utf8(content.cast("string"))


def training_lines(spark: SparkSession, path: str, separator: str = "\t") -> DataFrame:
    """label and text of delimited lines; a line without separator has a null text."""
    parts = F.split(F.col("value"), F.concat(F.lit("\\Q"), F.lit(separator), F.lit("\\E")), 3)
    return spark.read.text(path).select(parts[0].alias("pool"), F.try_element_at(parts, F.lit(2)).alias("text"))


def read_resource(spark: SparkSession, path: str):
    """A JSON resource (stop-words, dictionary, labels, tables), read once on the driver."""
    rows = spark.read.text(path, wholetext=True).head()
    return json.loads(rows[0])


def mapping_table(spark: SparkSession, mapping: dict, key: str, value: str, kind: str) -> DataFrame:
    """A resource map as a table to join with."""
    return spark.createDataFrame([(str(k), v) for k, v in mapping.items()], f"{key} string, {value} {kind}")


def category_table(spark: SparkSession, tables: dict[str, dict]) -> DataFrame:
    """table_id, identifier, categories array<array<struct<level, value>>> from nested maps."""
    rows = [(t, i, [[(c["level"], c["value"]) for c in path] for path in paths]) for t, table in tables.items() for i, paths in table.items()]
    return spark.createDataFrame(rows, "table_id string, identifier string, categories array<array<struct<level:int,value:string>>>")


def training_table(spark: SparkSession, trainings: dict[str, dict]) -> DataFrame:
    """training, pool, pool_ord, word, p from saved trainings: integer-like pools first, then as they come."""
    rows = []
    for name, pools in trainings.items():
        order = sorted(pools, key=lambda p: (0, int(p)) if p.isdigit() else (1, 0))
        for i, pool in enumerate(order):
            rows += [(name, pool, i, w, float(p)) for w, p in pools[pool]["pool"].items()]
    return spark.createDataFrame(rows, "training string, pool string, pool_ord int, word string, p double")
