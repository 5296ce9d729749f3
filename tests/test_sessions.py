"""Stages, hooks, bundles and the command line of sessions."""

import json

import pytest
from pyspark.sql import functions as F

from docsieve import __main__ as command
from docsieve.operators import bayes
from docsieve.plans import session

LEAF = '<?xml version="1.0"?><leaf><name>oak maple</name><body>oak oak maple birch</body><body>maple oak</body></leaf>'
DTD = "<!ELEMENT leaf (name, body+)><!ELEMENT name (#PCDATA)><!ELEMENT body (#PCDATA)>"
SHORT = DTD.replace("body+", "body")
XSD = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="leaf"><xs:complexType><xs:sequence><xs:element name="name" type="xs:string"/><xs:element name="body" type="xs:{}" maxOccurs="unbounded"/></xs:sequence></xs:complexType></xs:element></xs:schema>'


@pytest.fixture
def folder(tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.xml").write_text(LEAF)
    (src / "b.xml").write_text('<?xml version="1.0"?><leaf><name></leaf>')
    (src / "c.txt").write_text("oak maple")
    return src


def lines(path):
    return [json.loads(x) for f in path.glob("part-*") for x in f.read_text().splitlines()]


def test_stages_over_sound_xml_only(spark, folder, tmp_path):
    good, bad = tmp_path / "good.xsd", tmp_path / "bad.xsd"
    good.write_text(XSD.format("string"))
    bad.write_text(XSD.format("integer"))
    model = spark.createDataFrame([("entry", "tree", "oak", 0.9), ("tree", "leafy", "maple", 0.8)], "training string, pool string, word string, p double")
    config = session.SessionConfig(
        "c", str(folder), str(tmp_path / "out"), stages=("walk", "filetype", "xml", "validation", "bayes", "segments", "enrich", "xpaths", "out"),
        dtds=(("short", SHORT), ("full", DTD)), schemas=(("bad", str(bad)), ("good", str(good))), bayes_model=model, bayes_selector="leaf > body",
        segments=(("body", "leaf > body"),), title="leaf > name",
        templates=({"label": "guess", "kind": "xml", "column": "bayes", "template": "{{doc.name}}:{{#result}}{{code}},{{/result}}"}, {"label": "none", "kind": "txt", "column": "absent", "template": "x"}),
    )
    records = session.run(spark, config)
    rows = {r.name: r for r in records.collect()}
    a = rows["a.xml"]
    assert a.validDTD == "full" and [(e.name, len(e.errors)) for e in a.DTDErrors] == [("short", 1)]
    assert a.validSchema == "good" and [e.name for e in a.schemaErrors] == ["bad"]
    assert [(g.level, g.code) for g in a.bayes] == [(1, "tree"), (2, "leafy")]
    assert {k.term for k in a.segmentKeywords} >= {"maple"} and a.segmentKeywords[0].rank == 1
    assert [(e.label, e.enrichment.output) for e in a.enrichments] == [("guess", "a.xml:tree,leafy,")]
    for name in ("b.xml", "c.txt"):
        r = rows[name]
        assert r.validDTD is None and r.DTDErrors is None and r.schemaErrors is None and r.bayes is None and r.segmentKeywords is None and r.enrichments == []
    assert [(x["label"], x["rendered"]) for x in lines(tmp_path / "out" / "enrichments")] == [("guess", "a.xml:tree,leafy,")]
    assert len(lines(tmp_path / "out" / "analyse-c.json")) == 3
    done = {r.stage: (r.records, r.treated) for r in session.progress(records, config).collect()}
    assert done["filetype"] == (3, 3) and done["xml"] == (3, 2) and done["validation"] == (3, 1) and done["bayes"] == (3, 1)


def test_hooks_and_errors(spark, monkeypatch, tmp_path):
    for table in (session.STAGES, session.PREPARE, session.FINISH):
        monkeypatch.setattr(session, {id(session.STAGES): "STAGES", id(session.PREPARE): "PREPARE", id(session.FINISH): "FINISH"}[id(table)], dict(table))
    seen = []

    @session.stage("odd", prepare=lambda s, c: session.replace(c, now=7))
    def odd(docs, config):
        return docs.withColumns({"now": F.lit(config.now), "error": F.when(F.col("path") == "2", "even")})

    @session.stage("later", finish=lambda records, c: seen.append(records.count()))
    def later(docs, config):
        return docs.withColumn("late", F.lit(True))

    docs = spark.createDataFrame([("1",), ("2",)], "path string")
    out = session.run(spark, session.SessionConfig("c", "p", str(tmp_path / "o"), stages=("odd", "later")), docs)
    assert {(r.path, r.now, r.error, r.late) for r in out.collect()} == {("1", 7, None, True), ("2", 7, "even", None)}
    assert seen == [2]


def test_bundles_through_a_session(spark, folder, tmp_path):
    config = session.SessionConfig("c", str(folder), str(tmp_path / "out"), stages=("walk", "filetype", "out"), bundle=2)
    done = session.launch(spark, config)
    assert len(done) == 2
    assert sum(len(lines(p)) for p in (tmp_path / "out").glob("bundle=*/analyse-c.json")) == 3


def test_no_model_no_segments_and_an_empty_corpus(spark, tmp_path):
    empty = spark.createDataFrame([], "path string, name string, text string")
    config = session.SessionConfig("c", "p", str(tmp_path / "o"), stages=("filetype", "xml", "validation", "bayes", "segments", "enrich", "out"))
    out = session.run(spark, config, empty)
    assert out.count() == 0 and "bayes" not in out.columns and "segmentKeywords" not in out.columns


def test_levels_of_a_cascade(spark):
    def of(*edges):
        return bayes.levels(spark.createDataFrame([(t, p, "w", 0.9) for t, p in edges], "training string, pool string, word string, p double"), "entry")

    assert of(("entry", "a")) == 1
    assert of(*[(f"t{i}" if i else "entry", f"t{i + 1}") for i in range(12)]) == 12
    assert of(("entry", "a"), ("a", "entry"), ("a", "b")) == 2
    assert of(("other", "a")) == 1


def test_configuration_file_and_options(tmp_path, capsys):
    file = tmp_path / "c.json"
    file.write_text(json.dumps({"dtds": {"full": DTD}, "segments": {"body": "leaf > body"}, "title": "leaf > name", "bundle": 5}))
    config = session.parse(["in", "-n", "c", "-c", str(file)])
    assert config.dtds == (("full", DTD),) and config.segments == (("body", "leaf > body"),) and config.bundle == 5
    assert session.parse(["in", "-n", "c", "-c", str(file), "-b", "0"]).bundle == 0
    file.write_text('{"titel": "x"}')
    with pytest.raises(ValueError, match="titel"):
        session.parse(["in", "-n", "c", "-c", str(file)])
    with pytest.raises(SystemExit):
        session.parse(["in"])
    command.main(["--list"])
    assert "bayes" in capsys.readouterr().out.split()
