"""The corpus pipeline: five stages over ``documents``, each written before the next reads it.

quality: documents the quality rules reject go.  near_duplicates: of every group of
near-duplicates (five-word shingles, similarity 0.8 or more) the smallest id stays.
decontamination: documents that benchmark passages contaminate go.  secrets: spans found
by the secret rules are replaced by their kind.  pieces: every text gets its piece ids,
and the text they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.llm._util import materialise, read_table
from docsieve.llm.decontaminate import decontaminate
from docsieve.llm.ngram_join import keep_one
from docsieve.llm.pieces import default_model, encode
from docsieve.llm.quality import filter_quality
from docsieve.llm.secrets import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, default_model(), decoded="decoded")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("pieces", pieces)]

#: Robust covariances, links and piece ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs, name)
    return docs
