"""Small groups are judged by the passing documents of all groups."""

import random

from pyspark.sql import functions as F

from docsieve.llm import quality

from .test_operators import prose


def test_lone_junk_of_a_rare_source(spark):
    rng = random.Random(12)
    junk = lambda i: " ".join(w + "#$%" for w in prose(random.Random(i), 60).split())
    clean = [(i, prose(rng, 150), "en", "web") for i in range(120)]
    spam = [(1000 + i, junk(i), "fr", "spam") for i in range(6)]
    rare = [(2000, junk(99), "de", "rare"), (2001, prose(rng, 150), "it", "rare")]
    docs = spark.createDataFrame([*clean, *spam, *rare], "doc_id long, text string, lang string, source string").repartition(3)
    kept = {r.d: r.kept for r in quality.judge(docs, carry=["doc_id"]).select(F.col("row.doc_id").alias("d"), "kept").collect()}
    assert not kept[2000] and not any(kept[d] for d, *_ in spam)
    assert kept[2001] and all(kept[d] for d, *_ in clean)
    alone = docs.where("doc_id = 2000 or lang = 'en'")
    assert quality.judge(alone, carry=["doc_id"]).where("row.doc_id = 2000 and not kept").count() == 1
