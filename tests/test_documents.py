"""XML, PDF, file types, sources, sinks, sessions and streams."""

import json
import zlib

import pytest
from pyspark.sql import functions as F

from docsieve.functions import filetype, pdf, xml
from docsieve.operators import xpaths
from docsieve.plans import session
from docsieve.sources import corpus, sinks
from docsieve.streaming import jobs

GOOD = '<?xml version="1.0"?><!DOCTYPE herbarium SYSTEM "plants.dtd"><herbarium region="alps"><sheet no="12"><plant>Arnica <em>montana</em></plant><height>43.9</height><pressed/><note>dry meadow</note><note lang="de">selten</note></sheet></herbarium>'


def one(spark, text, *cols):
    return spark.createDataFrame([(text,)], "x string").select(*cols).first()


def test_typed_values(spark):
    x = xml.safe(F.col("x"))
    items = [("String", "/herbarium/sheet/plant"), ("Number", "//height"), ("Boolean", "//pressed"), ("Boolean", "//none"), ("Count", "//note"), ("Count", "//none"), ("Attribute", "/herbarium/@region"), ("String", "//none"), ("Number", "//plant")]
    assert list(one(spark, GOOD, *[xml.xpath_value(x, k, p).alias(str(i)) for i, (k, p) in enumerate(items)])) == ["Arnica montana", 43, True, False, 2, 0, "alps", None, None]


def test_metadata_rules(spark):
    items = [{"name": "a", "type": "String", "xpath": "//plant", "regex": "^z"}, {"name": "b", "type": "String", "xpath": "//plant", "regex": "mont"}, {"name": "c", "type": "String", "xpath": ["//none", "//plant"], "regex": "^z"}, {"name": "d", "type": "Count", "xpath": ["//none", "//note"]}]
    r = xml.with_metadata(spark.createDataFrame([(GOOD,)], "x string").select(xml.safe(F.col("x")).alias("x")), "x", items).first()
    plant = "Arnica montana"
    assert (r.a, r.aIsValid, r.aError, r.b, r.bIsValid, r.bError, r.c, r.d) == (None, False, plant, plant, True, None, plant, 0)


@pytest.mark.parametrize("text", ["<a><b></a>", "", None, "plain", "<a/><b/>", "<a x=1/>"])
def test_bad_documents_never_fail(spark, text):
    r = one(spark, text, xml.is_well_formed(F.col("x")).alias("ok"), xml.parse_errors(F.col("x")).alias("e"), xml.xpath_value(xml.safe(F.col("x")), "String", "/a").alias("v"))
    assert not r.ok and len(r.e) == 1 and r.v is None


def test_doctype(spark):
    assert tuple(one(spark, '<!DOCTYPE a PUBLIC "p" "s"><a/>', xml.doctype(F.col("x")))[0]) == ("a", "p", "s")
    assert one(spark, "<a/>", xml.doctype(F.col("x")))[0] is None
    assert one(spark, GOOD, xml.doctype(F.col("x")))[0].sysid == "plants.dtd"


def test_selectors(spark):
    x = xml.safe(F.col("x"))
    assert one(spark, GOOD, xml.select_text(x, "sheet > note"))[0] == "dry meadowselten"
    assert one(spark, GOOD, xml.select_text(x, 'note[lang="de"]'))[0] == "selten"
    assert one(spark, GOOD, xml.select_texts("sheet note")(x))[0] == ["dry meadow", "selten"]
    assert one(spark, '<a><b/><b class="x d y"><i>no</i><c class="d">in</c></b></a>', xml.select_texts("a b:nth-child(2) > c.d")(F.col("x")))[0] == ["in"]


def test_namespace_removal(spark):
    assert one(spark, "<a xmlns='u' b='xmlns'/>", xml.remove_first(F.col("x"), " xmlns='u'"))[0] == "<a b='xmlns'/>"


def test_dtd(spark):
    dtd = "<!ELEMENT a (b+, c?)><!ELEMENT b (#PCDATA)><!ELEMENT c EMPTY><!ATTLIST a k CDATA #REQUIRED>"
    check = lambda t: one(spark, t, xml.dtd_errors(dtd)(F.col("x")))[0]
    assert check("<a k='1'><b>t</b><b/><c/></a>") == []
    assert len(check("<a><b/></a>")) == 1 and len(check("<a k='1'><c/></a>")) == 1
    assert len(check("<a k='1'>" + "<z/>" * 30 + "</a>")) == 10


def test_inventory(spark, tmp_path):
    docs = spark.createDataFrame([('<c><b id="1"><t/></b><b id="2" k="x"/></c>',), ("<c/>",), ("<bad",), (None,)], "xml string")
    out = {r.xpath: (r.countElement, r.attributes) for r in xpaths.inventory(docs).collect()}
    assert out == {"/c": (2, []), "/c/b": (2, ["id", "k"]), "/c/b/t": (1, [])}
    docs.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    jobs.run_inventory(stream, "seen_paths", str(tmp_path / "cp")).awaitTermination()
    assert {r.xpath: r.countElement for r in spark.table("seen_paths").collect()} == {"/c": 2, "/c/b": 2, "/c/b/t": 1}


def a_pdf(*pages: str) -> bytes:
    out = b"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Kids [] >> endobj\n3 0 obj << /Title (A \\(small\\) one) >> endobj\n"
    for i, p in enumerate(pages):
        body = zlib.compress(f"BT ({p}) Tj ET".encode("latin-1"))
        out += f"{10 + 2 * i} 0 obj << /Type /Page /Contents {11 + 2 * i} 0 R >> endobj\n{11 + 2 * i} 0 obj << /Filter /FlateDecode >>\nstream\n".encode() + body + b"\nendstream endobj\n"
    return out + b"trailer << /Root 1 0 R /Info 3 0 R >>"


def test_pdf(spark):
    docs = spark.createDataFrame([(1, bytearray(a_pdf("one two three", "four five"))), (2, bytearray(b"no")), (3, None)], "id int, c binary")
    out = {r.id: r.p for r in docs.select("id", pdf.pdf_info("c").alias("p")).collect()}
    assert out[1].pages == 2 and out[1].metadata["Title"] == "A (small) one" and out[1].words == 7 and out[1].words_by_page == 3
    assert out[2].error and out[3].error
    assert [pdf.words_of(x) for x in ("", " a ", "a b")] == [1, 3, 2]


def test_file_types(spark):
    cases = [(b'<?xml version="1.0"?><a/>', "application/xml"), (a_pdf("x"), "application/pdf"), (b"%PDF-1.4 broken", "application/octet-stream"), (b"GIF89a..", "image/gif"), (b"PK\x03\x04abcPK\x05\x06", "application/zip"), (b"PK\x03\x04abc", "application/octet-stream"), (b"PK\x03\x04 META-INF/ PK\x05\x06", "application/java-archive"), (b"plain text", "text/plain"), (b"<html><body>", "text/html"), (b"<a>" * 11, "application/xml"), (b"\x00\x00\x01", "application/octet-stream"), (b"\xff\xfe\xfd", "application/octet-stream"), (b"", "application/octet-stream")]
    docs = spark.createDataFrame([(i, bytearray(c)) for i, (c, _) in enumerate(cases)], "i int, content binary")
    out = {r.i: r.m for r in docs.select("i", filetype.mime_type(F.col("content")).alias("m")).collect()}
    assert [out[i] for i in range(len(cases))] == [m for _, m in cases]
    assert docs.select(filetype.mime_type(F.col("content"), F.lit("kept"))).first()[0] == "kept"


RUSSIAN = "Съешь же ещё этих мягких французских булок, да выпей чаю"


@pytest.mark.parametrize(
    ("raw", "code", "text"),
    [
        (b"plain", "us-ascii", "plain"), ("déjà".encode(), "utf-8", "déjà"), ("\ufeffdéjà".encode(), "utf-8", "déjà"), ("déjà vu".encode("utf-16"), "utf-16le", "déjà vu"), ("a page".encode("utf-16-be"), "utf-16be", "a page"),
        ("a page".encode("utf-16-le"), "utf-16le", "a page"), ("déjà vu".encode("latin-1"), "iso-8859-1", "déjà vu"), ("the “page”".encode("cp1252"), "windows-1252", "the “page”"), (RUSSIAN.encode("cp1251"), "windows-1251", RUSSIAN),
        (RUSSIAN.encode("koi8-r"), "koi8-r", RUSSIAN), (RUSSIAN.encode("iso-8859-5"), "iso-8859-5", RUSSIAN), ("déjà".encode("utf-32"), "utf-32le", "déjà"), (b"\x00\x01\x02", "binary", None), (b"\xff\xfe\xfd", "binary", None), (b"a\x01b", "binary", None), (None, "binary", None), (b"", "us-ascii", ""),
    ],
)
def test_encodings(spark, raw, code, text):
    r = spark.createDataFrame([(raw,)], "c binary").select(filetype.file_type(F.col("c")).alias("t")).first().t
    assert (r.encoding, r.text) == (code, text)


def test_descriptions_and_errors(spark):
    cases = [(a_pdf("x"), "PDF document, version 1.4", None), (b"%PDF-1.7 no", "data", "PDF without objects or trailer"), (b'<?xml version="1.1"?>\n<a/>', "XML 1.1 document, ASCII text", None), ("é\r\n".encode(), "UTF-8 Unicode text, with CRLF line terminators", None), (b"", "empty", None), (None, "empty", "no content")]
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(cases)], "i int, c binary")
    got = {r.i: (r.t.description, r.t.error) for r in df.select("i", filetype.file_type(F.col("c")).alias("t")).collect()}
    assert [got[i] for i in range(len(cases))] == [(d, e) for _, d, e in cases]


def test_session_end_to_end(spark, tmp_path):
    src = tmp_path / "src" / "deep"
    src.mkdir(parents=True)
    (src / "a.xml").write_text(GOOD)
    (src / "b b.txt").write_text("alpha beta alpha beta")
    (src / "c.pdf").write_bytes(a_pdf("x y"))
    (src / "broken.xml").write_text('<?xml version="1.0"?><a><b></a>')
    tables = corpus.category_table(spark, {"t": {"43.9": [[{"level": 1, "value": "v"}]]}})
    config = session.SessionConfig("corpus", str(tmp_path / "src"), str(tmp_path / "out"), metadata=({"name": "height", "type": "String", "xpath": "//height"},), category_tables=tables, categorizations=({"id": "t", "identifier": "sheet > height"},))
    session.run(spark, config.selected(["filetype", "lang", "pdf", "xml", "xpaths", "keyterms", "categories", "out"]))
    rows = {r["name"]: r for r in map(json.loads, (x for f in (tmp_path / "out" / "analyse-corpus.json").glob("part-*") for x in f.read_text().splitlines()))}
    assert rows["a.xml"]["isWellFormed"] and rows["a.xml"]["height"] == "43.9" and rows["a.xml"]["matched"]
    assert rows["broken.xml"]["isWellFormed"] is False and rows["broken.xml"]["wellFormedErrors"][0]["line"] == 1
    assert rows["b b.txt"]["mimetype"] == "text/plain" and rows["b b.txt"]["keywords"][0]["term"] == "alpha"
    assert rows["c.pdf"]["pdfPageTotal"] == 1 and rows["c.pdf"]["extension"] == ".pdf"
    lines = [x for f in (tmp_path / "out" / "xpaths" / "xpaths.csv").glob("part-*") for x in f.read_text().splitlines()]
    assert "/herbarium/sheet/note;2;lang" in lines


def test_stage_lists():
    base = session.SessionConfig("c", "p")
    assert base.selected(["xml"]).stages == ("walk", "xml")
    assert "pdf" not in base.without(["pdf"]).stages
    with pytest.raises(ValueError):
        base.selected(["nothing"])
    assert session.parse(["in", "-n", "c", "-s", "xml"]).stages == ("walk", "xml")
    assert session.latest_output(["2019", "2021", "2020"]) == "2021" and session.latest_output([]) is None


def test_bundles_and_streams(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert sorted((r.k, r.bundle) for r in session.bundles(df, "k", 4).collect()) == [(i, i // 4) for i in range(10)]
    src = tmp_path / "files"
    src.mkdir()
    for i in range(5):
        (src / f"{i}.txt").write_text("x" * (i + 1))
    seen = []
    jobs.in_bundles(corpus.stream(spark, str(src), bundle=2), lambda b, n: seen.append(b.count()), str(tmp_path / "cp")).awaitTermination()
    assert sum(seen) == 5 and max(seen) <= 2


def test_templates(spark):
    t = sinks.compile_template("{{a.b}}|{{{c}}}|{{#l}}<{{x}}{{.}}>{{/l}}{{^n}}none{{/n}}")
    assert t({"a": {"b": "<"}, "c": "<", "l": ["p", "q"], "n": []}) == "&lt;|<|<p><q>none"
    with pytest.raises(ValueError):
        sinks.compile_template("{{#a}}x")
    df = spark.createDataFrame([(1, "v")], "id int, v string").select(sinks.render("{{v}}!", F.struct("v")))
    assert df.first()[0] == "v!"


def test_training_lines(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("a\tone two\nb\tthree\nc\n")
    assert [tuple(r) for r in corpus.training_lines(spark, str(p)).collect()] == [("a", "one two"), ("b", "three"), ("c", None)]
