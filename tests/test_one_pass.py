"""Sessions scan and parse once, keep repeated paths, hold errors per record, and load resources from files."""

import json

import pytest
from pyspark.sql import functions as F

from docsieve import __main__ as command
from docsieve.functions import language
from docsieve.plans import session
from docsieve.sources import corpus

LEAF = '<?xml version="1.0"?><leaf no="7"><name>oak maple</name><body>oak oak maple birch</body><body>maple oak</body></leaf>'
ALL = ("walk", "filetype", "lang", "pdf", "xml", "validation", "keyterms", "categories", "bayes", "segments", "enrich", "xpaths", "out")


def full(spark, folder, out, **more):
    model = spark.createDataFrame([("entry", "tree", "oak", 0.9)], "training string, pool string, word string, p double")
    tables = corpus.category_table(spark, {"t": {"7": [[{"level": 1, "value": "v"}]]}})
    given = dict(stages=ALL, metadata=({"name": "no", "type": "Number", "xpath": "/leaf/@no"},), category_tables=tables, categorizations=({"id": "t", "identifier": "leaf > none"}, ), bayes_model=model, bayes_selector="leaf > body", segments=(("body", "leaf > body"),), title="leaf > name")
    return session.SessionConfig("c", str(folder), str(out), **(given | more))


@pytest.fixture
def folder(tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.xml").write_text(LEAF)
    (src / "b.xml").write_text('<?xml version="1.0"?><leaf><name></leaf>')
    (src / "c.txt").write_text("maple birch and the maple of the birch")
    return src


def test_one_scan_and_one_parse(spark, folder, tmp_path):
    config = full(spark, folder, tmp_path / "out", dtds=())
    plan = session.prepared(config, corpus.walk(spark, str(folder), "c"))._jdf.queryExecution()
    scans, parses = plan.executedPlan().toString().count("FileScan binaryFile"), plan.optimizedPlan().toString()
    assert scans == 1 or plan.executedPlan().toString().count("Scan binaryFile") == 1
    # one reading of every document, one sniffing of files that are not plain, one reader of PDF files
    assert parses.count("ArrowEvalPython") == 3 and "Join" not in parses and "Aggregate" not in parses
    records = session.run(spark, config)
    final = records._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in final and {r.name: r.isWellFormed for r in records.collect()} == {"a.xml": True, "b.xml": False, "c.txt": None}
    a = next(r for r in records.collect() if r.name == "a.xml")
    assert a.no == 7 and [g.code for g in a.bayes] == ["tree"] and {k.term for k in a.segmentKeywords} >= {"maple"}
    assert not [c for c in records.columns if c.startswith("__")]


def test_records_meet_side_tables_once(spark):
    docs = spark.createDataFrame([(str(i), f"{i}.xml", LEAF) for i in range(4)], "path string, name string, text string")
    config = full(spark, "p", "o", stages=("filetype", "xml", "bayes", "segments"))
    out = session.run(spark, config, docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "LeftOuter, (__rid" in x]
    assert len(joins) == 2 and "path" not in "".join(joins)
    assert out.where(F.size("bayes") > 0).count() == 4


def test_repeated_paths_keep_their_rows(spark):
    docs = spark.createDataFrame([("p", "n", LEAF), ("p", "n", LEAF.replace("oak", "elm")), ("p", "n", "maple birch maple"), (None, None, LEAF), ("q", "n", None)], "path string, name string, text string")
    config = full(spark, "p", "o", stages=("filetype", "xml", "keyterms", "categories", "bayes", "segments"))
    out = session.run(spark, config, docs).collect()
    assert len(out) == 5
    assert sorted((r.path or "", r.bayes is not None, r.segmentKeywords is not None, r.keywords is not None) for r in out) == [("", True, True, False), ("p", False, False, True), ("p", False, True, False), ("p", True, True, False), ("q", False, False, False)]


def test_a_bad_path_gives_errors_and_ends_the_record(spark, folder, tmp_path):
    config = full(spark, folder, tmp_path / "out", metadata=({"name": "x", "type": "String", "xpath": "//leaf[["},))
    rows = {r.name: r for r in session.run(spark, config).collect()}
    assert "//leaf[[" in json.loads(rows["a.xml"].error)["message"] and rows["b.xml"].error is None and rows["c.txt"].error is None
    assert rows["a.xml"].isWellFormed and rows["a.xml"].bayes is None and rows["a.xml"].segmentKeywords is None and rows["a.xml"].mimetype == "application/xml"
    assert rows["c.txt"].keywords
    names = {json.loads(x)["name"] for f in (tmp_path / "out" / "analyse-c.json").glob("part-*") for x in f.read_text().splitlines()}
    assert names == {"b.xml", "c.txt"}
    assert [r.path.rsplit("/", 1)[1] for r in spark.read.parquet(str(tmp_path / "out" / "errors")).collect()] == ["a.xml"]
    assert {r.status for r in spark.read.parquet(str(tmp_path / "out" / "records")).select("status").collect()} == {"ok", "error"}


def test_a_bad_template_gives_errors(spark, folder, tmp_path):
    good = {"label": "g", "kind": "txt", "column": "bayes", "template": "{{doc.name}}"}
    config = full(spark, folder, tmp_path / "out", templates=({"label": "w", "kind": "txt", "column": "bayes", "template": "{{#open}}"}, good))
    rows = {r.name: r for r in session.run(spark, config).collect()}
    assert "open" in json.loads(rows["a.xml"].error)["message"] and rows["c.txt"].error is None


def test_paths_of_the_engine_and_a_namespace(spark, folder, tmp_path):
    (folder / "n.xml").write_text(LEAF.replace("<leaf ", '<leaf xmlns="urn:x" '))
    config = full(spark, folder, tmp_path / "out", stages=("filetype", "xml"), namespace=' xmlns="urn:x"', metadata=({"name": "last", "type": "String", "xpath": "//body[last()]"}, {"name": "name", "type": "String", "xpath": ["//none", "/leaf/name"]}))
    config = session.replace(config, metadata=({"name": "last", "type": "String", "xpath": "//body[last()]"}, {"name": "called", "type": "String", "xpath": ["//none", "/leaf/name"]}))
    rows = {r.name: r for r in session.run(spark, config).collect()}
    assert rows["a.xml"].last == "maple oak" and rows["a.xml"].called == rows["n.xml"].called == "oak maple" and rows["b.xml"].last is None


def test_encodings_come_as_text(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "u.txt").write_bytes("﻿lângoare été".encode("utf-16-le"))
    (src / "l.txt").write_bytes("déjà vu à la forêt".encode("latin-1"))
    (src / "p.txt").write_bytes(b"%PDF-1.4 broken")
    rows = {r.name: r for r in session.run(spark, session.SessionConfig("c", str(src), stages=("walk", "filetype", "lang"))).collect()}
    assert (rows["u.txt"].text, rows["u.txt"].mimedetails.encoding, rows["u.txt"].mimetype) == ("lângoare été", "utf-16le", "text/plain")
    assert (rows["l.txt"].text, rows["l.txt"].mimedetails.encoding) == ("déjà vu à la forêt", "iso-8859-1")
    assert rows["p.txt"].mimetype == "application/octet-stream" and rows["p.txt"].filetypeError and rows["p.txt"].langDetect is None


def test_languages_of_a_session(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    russian = "Съешь же ещё этих мягких французских булок, да выпей чаю"
    (src / "r.xml").write_text(f'<?xml version="1.0"?><the><of and="in">{russian}</of></the>')
    (src / "noise.txt").write_text("qzx vbk jwq zzkx pqwv xkcd hjkl zxcv qwrt bnmx kjhg wqzx vbnm")
    profile = language.profiles(spark.createDataFrame([("en", "the fox of the wood and the bird in the tree")], "lang string, text string"))
    for given in (None, profile):
        config = session.SessionConfig("c", str(src), stages=("walk", "filetype", "lang"), language_profiles=given)
        rows = {r.name: r for r in session.run(spark, config).collect()}
        assert rows["r.xml"].langDetect.languages[0].name == "RUSSIAN" and rows["r.xml"].langDetectError is None
        assert not rows["noise.txt"].langDetect.reliable and rows["noise.txt"].langDetectError.message == "Failed to identify language"


def test_resources_from_a_file_alone(spark, folder, tmp_path, capsys):
    """Categories, keywords, guesses and languages from a JSON file, on the command line."""
    conf = tmp_path / "conf" / "corp"
    conf.mkdir(parents=True)
    (conf / "stop.json").write_text('["maple"]')
    (conf / "dictionary.json").write_text('{"birch": 0.5}')
    (conf / "lexicon.json").write_text('{"birch": ["NN"], "maple": "JJ"}')
    (conf / "lemmas.json").write_text('{"birch": {"noun": ["birk"]}}')
    (conf / "table.json").write_text('{"7": [[{"level": 1, "value": "tree"}]]}')
    (conf / "tables.json").write_text('{"t": "table.json"}')
    (conf / "labels.json").write_text('{"1": "Oaks"}')
    (conf / "training.json").write_text('{"1": {"pool": {"oak": 0.9}}}')
    (conf / "trainings.json").write_text('{"entry": "training.json"}')
    (conf / "languages.json").write_text('{"en": {"": -9000, " th": -2000, "the": -2000, "he ": -2000}}')
    (conf / "note.mustache").write_text("{{doc.name}}")
    files = {"stop_words": "stop.json", "dictionary": "dictionary.json", "lexicon": "lexicon.json", "lemmas": "lemmas.json", "category_tables": "tables.json", "labels": "labels.json", "trainings": "trainings.json", "language_profiles": "languages.json"}
    entries = {"resources": files, "categorizations": [{"id": "t", "identifier": "leaf > id"}], "bayes_selector": "leaf > body", "templates": [{"label": "n", "kind": "txt", "column": "bayes", "file": "note.mustache"}], "stages": list(ALL)}
    (conf / "session.json").write_text(json.dumps(entries))
    (folder / "a.xml").write_text(LEAF.replace("<name>", "<id>7</id><name>"))
    config = session.parse([str(folder), "-n", "my-corp-2020", "-o", str(tmp_path / "out"), "-c", str(tmp_path / "conf")])
    rows = {r.name: r for r in session.run(spark, config).collect()}
    a, c = rows["a.xml"], rows["c.txt"]
    assert a.matched and a.categories[0][0].value == "tree" and [(g.code, g.verbalization) for g in a.bayes] == [("1", "Oaks")] and a.enrichments[0].enrichment.output == "a.xml"
    assert [k.term for k in c.keywords] == ["birk"]
    with pytest.raises(ValueError, match="no configuration"):
        session.parse([str(folder), "-n", "other", "-c", str(tmp_path / "conf")])
    with pytest.raises(ValueError, match="unheard"):
        session.configure(config, {"resources": {"unheard": "x"}})


def test_keyterm_input(spark):
    docs = spark.createDataFrame([("a", "a", LEAF), ("b", "b", "maple birch maple")], "path string, name string, text string")
    out = {r.path: r.keywords for r in session.run(spark, session.SessionConfig("c", "p", stages=("filetype", "keyterms"), keyterm_input="application/xml"), docs).collect()}
    assert out["b"] is None and out["a"]
