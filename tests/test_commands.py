"""The command line: sessions with resources, training and trying models, stop-word tables."""

import json

from pyspark.sql import functions as F

from docsieve import __main__ as command
from docsieve.operators import bayes

LINES = ["trees\toak maple birch oak", "trees\tbirch maple ash", "fish\tcod trout pike", "fish\ttrout perch cod", "\tnone", "fish"]


def test_train_test_and_a_session_by_that_model(spark, tmp_path, capsys):
    lines, model, out = tmp_path / "lines.tsv", str(tmp_path / "model"), str(tmp_path / "guesses")
    lines.write_text("\n".join(LINES) + "\n")
    command.main(["train", str(lines), "-o", model])
    rows = spark.read.parquet(model).collect()
    assert {r.training for r in rows} == {"entry"} and {r.pool for r in rows} == {"trees", "fish"} and {r.word for r in rows} >= {"oak", "cod"}
    command.main(["test", str(lines), "-m", model, "-o", out])
    assert capsys.readouterr().out.strip() == "4 of 5"  # the empty label is none, and the line without text is never guessed
    found = [x for f in (tmp_path / "guesses").glob("part-*") for x in f.read_text().splitlines()]
    assert sorted(x.rsplit(";", 1)[0] for x in found if x.startswith("trees")) == ["trees;trees", "trees;trees"]
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.xml").write_text('<?xml version="1.0"?><a><b>maple and oak</b></a>')
    command.main([str(src), "-n", "corp", "-o", str(tmp_path / "o"), "-m", model, "-s", "filetype", "-s", "xml", "-s", "bayes", "-s", "out"])
    record = json.loads(next(x for f in (tmp_path / "o" / "analyse-corp.json").glob("part-*") for x in f.read_text().splitlines()))
    assert [g["code"] for g in record["bayes"]] == ["trees"] and "bayes: 1 of 1" in capsys.readouterr().out


def test_stop_words(spark, tmp_path):
    (tmp_path / "w.txt").write_text("Leaves\nleaf\n\n oaks \nthe\n")
    (tmp_path / "lexicon.json").write_text('{"leaves": "NNS", "oaks": "NNS", "the": "DT"}')
    (tmp_path / "lemmas.json").write_text('{"leaves": {"noun": ["leave", "leaf"]}, "oaks": {"noun": ["oak"]}}')
    command.main(["stopwords", str(tmp_path / "w.txt"), "-o", str(tmp_path / "stop"), "--lexicon", str(tmp_path / "lexicon.json"), "--lemmas", str(tmp_path / "lemmas.json")])
    assert {r.lemma for r in spark.read.parquet(str(tmp_path / "stop")).collect()} == {"leaf", "oak", "the"}


def test_a_cascade_does_not_pile_up_plans(spark):
    n = 8
    model = spark.createDataFrame([(f"t{i}" if i else "entry", f"t{i + 1}", "oak", 0.9) for i in range(n)], "training string, pool string, word string, p double")
    docs = spark.createDataFrame([(1, "oak oak"), (2, "ash")], "doc_id long, text string")
    out = bayes.cascade(docs, model)
    assert sorted((r.doc_id, r.level, r.code) for r in out.collect()) == [(1, i + 1, f"t{i + 1}") for i in range(n)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Window") == 0
    assert out.agg(F.max("level")).first()[0] == n
