"""The k largest keys where all or many are equal."""

import pytest
from pyspark.sql import functions as F

from docsieve.llm import resample


@pytest.mark.parametrize("k", [0, 1, 17, 50, 100])
def test_all_equal(spark, k):
    rows = spark.createDataFrame([(None, 3, 1.5)] * 100, "doc_id long, n_grams long, key double").repartition(4)
    out = resample.top_k(rows, "key", k, ["doc_id", "n_grams"])
    assert out.where("selected").count() == k and out.count() == 100


@pytest.mark.parametrize("k", [0, 3, 10, 25, 40])
def test_order_of_ties(spark, k):
    data = [(i if i % 7 else None, i % 3, 1.0 + (i % 4) * 1e-12 if i < 30 else float(i)) for i in range(40)]
    rows = spark.createDataFrame(data, "doc_id long, n_grams long, key double").repartition(3)
    out = resample.top_k(rows, "key", k, ["doc_id", "n_grams"])
    want = sorted(data, key=lambda r: (-r[2], r[0] is not None, r[0] or 0, r[1]))[:k]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, out.where("selected").drop("selected").collect()), key=key) == sorted(want, key=key)
    assert out.agg(F.count("*")).first()[0] == 40
