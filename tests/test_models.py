"""Matrices, Bayes, categories and languages against known numbers."""

import math

import pytest
from pyspark.sql import functions as F

from docsieve.functions import language
from docsieve.operators import bayes, categories, segments
from docsieve.sources import corpus


def cells(spark):
    # Segments by terms [[1,1,0,2],[0,1,0,1],[0,1,1,2],[1,3,1,0]].
    m = [[1, 1, 0, 2], [0, 1, 0, 1], [0, 1, 1, 2], [1, 3, 1, 0]]
    rows = [(1, f"s{i}", i, f"term{j}", 1, float(v)) for i, r in enumerate(m) for j, v in enumerate(r) if v]
    return spark.createDataFrame(rows, "doc_id long, segment string, ord int, term string, strength int, value double")


def test_matrix(spark):
    stats = segments.f_measures(cells(spark))
    rows = {(r.segment, r.term): r for r in stats.collect()}
    assert rows["s0", "term0"].fr == 0.5 and rows["s0", "term0"].fp == 0.25
    assert rows["s3", "term1"].ff == pytest.approx(2 * 0.5 * 0.6 / 1.1)
    m = [[1, 1, 0, 2], [0, 1, 0, 1], [0, 1, 1, 2], [1, 3, 1, 0]]
    ff = [[0 if not v else 2 * (v / sum(x[j] for x in m)) * (v / sum(r)) / (v / sum(x[j] for x in m) + v / sum(r)) for j, v in enumerate(r)] for r in m]
    mean = lambda v: sum(v) / sum(x != 0 for x in v)
    every = [mean(r) for r in ff] + [mean(c) for c in zip(*ff)]
    assert rows["s0", "term0"].mean == pytest.approx(sum(every) / len(every))


def test_select_boosts_titles(spark):
    title = spark.createDataFrame([(1, "term2")], "doc_id long, term string")
    out = {r.term: r for r in segments.select_terms(segments.f_measures(cells(spark)), title).collect()}
    assert out["term2"].rank == 1 and out["term2"].n == 2 and out["term2"].factor > 100
    assert out["term2"].total == 3.0 and out["term2"].segments == ["s2", "s3"]


def test_bayes_score(spark):
    model = spark.createDataFrame([("entry", "letter", 0, c, 0.9999) for c in "abc"] + [("letter", "vowel", 0, "a", 0.9), ("letter", "other", 1, "b", 0.2), ("letter", "other", 1, "a", 0.2)], "training string, pool string, pool_ord int, word string, p double")
    docs = spark.createDataFrame([(1, "a b c"), (2, "test"), (3, None), (4, "")], "doc_id long, text string")
    verb = spark.createDataFrame([("letter", "A letter")], "code string, verbalization string")
    out = {(r.doc_id, r.level): r for r in bayes.cascade(docs, model, verb, depth=3).collect()}
    assert set(out) == {(1, 1), (1, 2)}
    assert out[1, 1].probability == pytest.approx(0.9999) and out[1, 1].verbalization == "A letter"
    assert out[1, 2].code == "vowel" and out[1, 2].verbalization is None


def test_bayes_limit(spark):
    model = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.3)], "pool string, word string, p double")
    docs = spark.createDataFrame([(1, "x x x y y")], "doc_id long, text string")
    row = bayes.score(docs, model, limit=4).first()
    p = 1 - math.exp((3 * math.log(0.1) + math.log(0.7)) / 4)
    q = 1 - math.exp((3 * math.log(0.9) + math.log(0.3)) / 4)
    assert row.n == 4 and row.score == pytest.approx((1 + (p - q) / (p + q)) / 2)


def test_self_naming_category_ends(spark):
    model = spark.createDataFrame([("entry", "entry", 0, "a", 0.9)], "training string, pool string, pool_ord int, word string, p double")
    out = bayes.cascade(spark.createDataFrame([(1, "a")], "doc_id long, text string"), model, depth=3).collect()
    assert sorted(r.level for r in out) == [1, 2, 3]


def test_categories(spark):
    tables = corpus.category_table(spark, {"t": {"2718-2818": [[{"level": 1, "value": "x"}], [{"level": 1, "value": "y"}]]}})
    ids = spark.createDataFrame([(1, 0, "t", "2718-2818"), (2, 0, "t", "bad"), (3, 0, "t", ""), (3, 1, "t", "2718-2818"), (4, 0, "t", None)], "doc_id long, ord int, table_id string, identifier string")
    out = {r.doc_id: r for r in categories.look_up(ids, tables).collect()}
    assert len(out[1].categories) == 2 and out[1].matched
    assert not out[2].matched and not out[2].missing
    assert out[3].missing and out[3].categories == [] and out[4].missing


def test_folder_match(spark):
    names = spark.createDataFrame([("my-elsevier-2019",), ("other",)], "corpusname string")
    folders = spark.createDataFrame([("elsevier",), ("2019",)], "folder string")
    assert {r.corpusname: r.folder for r in categories.match_folder(names, folders).collect()} == {"my-elsevier-2019": "2019", "other": None}


def test_language(spark):
    docs = spark.createDataFrame([("the cat is on the mat and that was it",), ("",), (None,), ("zzz",)], "t string")
    out = [r[0] for r in docs.select(language.detect(F.col("t"))).collect()]
    assert out[0].reliable and out[0].languages[0].name == "ENGLISH"
    assert not any(x.reliable for x in out[1:])
    gate = docs.select(language.passes_gate(language.detect(F.col("t")), "en", 70)).collect()
    assert [r[0] for r in gate] == [True, False, False, False]
