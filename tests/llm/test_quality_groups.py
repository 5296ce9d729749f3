"""Outliers of every group are found, whatever the group's size."""

import random

import pytest
from pyspark.sql import functions as F

from docsieve.llm import quality

from . import brute
from .test_operators import prose


def test_consistency_factor():
    assert quality.consistency(0.75) == pytest.approx(1.4863, abs=1e-3)


def test_planted_outliers_per_group(spark):
    rng = random.Random(31)
    docs, bad = [], set()
    for g, n in enumerate([5, 6, 8, 11, 16, 25, 40, 130]):
        docs += [(1000 * g + i, prose(rng, 150), "en", f"s{g}") for i in range(n)]
        for i in range(max(1, n // 12)):
            bad.add(1000 * g + 900 + i)
            docs.append((1000 * g + 900 + i, " ".join(w + "#$" for w in prose(rng, 80).split()), "en", f"s{g}"))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.d: r for r in quality.judge(df, carry=["doc_id"]).select(F.col("row.doc_id").alias("d"), "d2", "kept").collect()}
    assert {d for d, r in got.items() if not r.kept} == bad
    for (d, *_), d2 in zip(docs, brute.outliers(docs)):
        assert (d2 <= quality.CUTOFF) == got[d].kept
