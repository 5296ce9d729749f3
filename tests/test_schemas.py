"""Schema validation with places, the one-pass reader, and faults of malformed documents."""

import pytest
from pyspark.sql import functions as F

from docsieve.functions import xml, xmlread
from docsieve.functions.schemas import Schema

HEAD = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">'
BOOK = (
    HEAD
    + """
<xs:simpleType name="isbn"><xs:restriction base="xs:string"><xs:pattern value="[0-9]{3}-[0-9]+"/><xs:maxLength value="9"/></xs:restriction></xs:simpleType>
<xs:simpleType name="sizes"><xs:list itemType="xs:positiveInteger"/></xs:simpleType>
<xs:simpleType name="year"><xs:union memberTypes="xs:gYear"><xs:simpleType><xs:restriction base="xs:string"><xs:enumeration value="unknown"/></xs:restriction></xs:simpleType></xs:union></xs:simpleType>
<xs:complexType name="person"><xs:sequence><xs:element name="first" type="xs:string" minOccurs="0"/><xs:element name="last" type="xs:string"/></xs:sequence></xs:complexType>
<xs:complexType name="editor"><xs:complexContent><xs:extension base="person"><xs:sequence><xs:element name="house" type="xs:string"/></xs:sequence></xs:extension></xs:complexContent></xs:complexType>
<xs:group name="ways"><xs:choice><xs:element name="web" type="xs:anyURI"/><xs:element name="shop"/></xs:choice></xs:group>
<xs:element name="book"><xs:complexType><xs:sequence>
 <xs:element name="title"><xs:complexType><xs:simpleContent><xs:extension base="xs:string"><xs:attribute name="lang" type="xs:language"/></xs:extension></xs:simpleContent></xs:complexType></xs:element>
 <xs:element name="author" type="person" maxOccurs="3"/><xs:element name="editor" type="editor" minOccurs="0"/>
 <xs:element name="price" nillable="true"><xs:simpleType><xs:restriction base="xs:decimal"><xs:minExclusive value="0"/><xs:maxInclusive value="99.5"/><xs:fractionDigits value="2"/></xs:restriction></xs:simpleType></xs:element>
 <xs:group ref="ways" minOccurs="0" maxOccurs="unbounded"/>
 <xs:element name="made" minOccurs="0"><xs:complexType><xs:all><xs:element name="paper" type="xs:boolean"/><xs:element name="ink" type="xs:token" minOccurs="0"/></xs:all></xs:complexType></xs:element>
 <xs:element name="part" minOccurs="0" maxOccurs="unbounded"><xs:complexType mixed="true"><xs:sequence><xs:any minOccurs="0" processContents="lax"/></xs:sequence></xs:complexType></xs:element>
</xs:sequence>
<xs:attribute name="id" type="isbn" use="required"/><xs:attribute name="year" type="year"/><xs:attribute name="sizes" type="sizes"/><xs:attribute name="kind" fixed="print"/></xs:complexType></xs:element></xs:schema>"""
)
GOOD = '<book id="123-4" year="unknown" sizes="1 22" kind="print"><title lang="en">A</title><author><last>B</last></author><price>12.50</price><web>http://x</web><shop/><made><ink>x</ink><paper>true</paper></made><part>text <b>in</b> it</part></book>'


@pytest.mark.parametrize(
    ("change", "messages"),
    [
        (("", ""), []),
        (('id="123-4" ', ""), ["attribute id of element book is missing"]),
        (('"123-4"', '"12-4"'), ["does not follow the pattern"]),
        (('"123-4"', '"123-456789"'), ["has not the length"]),
        (('year="unknown"', 'year="later"'), ["fits no member"]),
        (('sizes="1 22"', 'sizes="1 -2"'), ["out of the range of positiveInteger"]),
        (('kind="print"', 'kind="ink"'), ["not the fixed value"]),
        (('kind="print"', 'colour="red"'), ["attribute colour is not allowed"]),
        (('lang="en"', 'lang="e!"'), ["not of type language"]),
        (("<title", "<subtitle/><title"), ["element subtitle is not expected in element book, expected title"]),
        (("<author><last>B</last></author>", ""), ["element price is not expected in element book, expected author"]),
        (("<last>B</last>", "<first>F</first>"), ["element author is not complete, expected last"]),
        (("<last>B</last>", "<last>B</last>text"), ["element author may not hold text"]),
        (("</author>", "</author>" + "<author><last>C</last></author>" * 3), ["element author is not expected"]),
        (("<price>", "<editor><last>E</last><house>H</house></editor><price>"), []),
        (("<price>", "<editor><last>E</last></editor><price>"), ["element editor is not complete, expected house"]),
        (("12.50", "0"), ["out of the range"]),
        (("12.50", "12.505"), ["too many digits"]),
        (("12.50", "twelve"), ["not of type decimal"]),
        (("<price>12.50</price>", '<price xsi:nil="true"/>'), []),
        (("<paper>true</paper>", ""), ["element made is not complete, expected paper"]),
        (("<ink>x</ink>", "<ink>x</ink><ink>y</ink>"), ["element ink is not expected in element made, expected paper"]),
        (("<shop/>", "<shop/><shop/><web>w</web>"), []),
        (("<b>in</b>", "<b>in</b><c/>"), ["element c is not expected in element part"]),
        (('<book id="123-4"', '<book id="123-4" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:noNamespaceSchemaLocation="s.xsd"'), []),
        ((GOOD, "<leaf/>"), ["element leaf is not declared"]),
    ],
)
def test_content(change, messages):
    found = [e["message"] for e in Schema(BOOK).errors(GOOD.replace(*change) if change[0] else GOOD)]
    assert len(found) == len(messages), found
    for f, m in zip(found, messages):
        assert m in f


def test_recursive_types_and_bounds():
    tree = HEAD + '<xs:element name="t" type="node"/><xs:complexType name="node"><xs:sequence><xs:element name="t" type="node" minOccurs="0" maxOccurs="2"/><xs:element name="v" type="xs:int" minOccurs="2" maxOccurs="1000"/></xs:sequence></xs:complexType></xs:schema>'
    s = Schema(tree)
    assert s.errors("<t><t><v>1</v><v>2</v></t>" + "<v>3</v>" * 500 + "</t>") == []
    assert [e["message"] for e in s.errors("<t><v>1</v></t>")] == ["element t is not complete, expected v"]
    assert len(s.errors("<t>" + "<v>x</v>" * 40 + "</t>")) == 10
    for value, good in (("2147483647", True), ("2147483648", False), (" 7 ", True), ("7.0", False)):
        assert (s.errors(f"<t><v>1</v><v>{value}</v></t>") == []) == good


@pytest.mark.parametrize(("kind", "good", "bad"), [("date", "2020-02-29", "2021-02-29"), ("dateTime", "2020-01-01T10:00:00Z", "2020-01-01"), ("time", "10:00:00", "10:00"), ("double", "1e5", "e5"), ("boolean", "1", "yes"), ("hexBinary", "0aFF", "0aF"), ("NMTOKENS", "a b-c", "a &"), ("duration", "P1DT2H", "P"), ("gYear", "1999", "99"), ("unsignedByte", "255", "256"), ("anyURI", "x y", None)])
def test_built_in_types(kind, good, bad):
    s = Schema(HEAD + f'<xs:element name="a" type="xs:{kind}"/></xs:schema>')
    assert s.errors(f"<a>{good}</a>") == []
    if bad is not None:
        assert len(s.errors(f"<a>{bad.replace('&', '&amp;')}</a>")) == 1


def test_column_and_places(spark):
    df = spark.createDataFrame([(1, GOOD), (2, GOOD.replace("<price>", "\n<price>\n").replace("12.50", "x")), (3, None)], "i int, x string")
    got = {r.i: r.e for r in df.select("i", xml.schema_errors(BOOK)(F.col("x")).alias("e")).collect()}
    assert got[1] == [] and got[3] == [] and [e.line for e in got[2]] == [3]
    with pytest.raises(ValueError, match="not a schema"):
        xml.schema_errors("<a/>")


# ---------------------------------------------------------------- one reading
DOC = '<a k="1" x:k="2"><b k="3">one<c>two</c> three</b><b>four</b><!-- no --><d><b k="5" class="p q"><b>in</b>ner</b></d>tail</a>'


@pytest.mark.parametrize(
    ("path", "first", "count"),
    [("/a/b", "onetwo three", 2), ("//b", "onetwo three", 4), ("/a/*", "onetwo three", 3), ("//b[2]", "four", 1), ("/a/b[@k]", "onetwo three", 1), ("//b[@k='5']", "inner", 1), ("//@k", "1", 3), ("/a/@x:k", "2", 1), ("//b/@k", "3", 2), ("//b//b", "in", 1), ("/b", None, 0), ("a/d/b", "inner", 1), ("//b/text()", "one", 5), ("/a/text()", "tail", 1), ("//c", "two", 1), ("//b[@k][1]", "onetwo three", 2), ("/a/@*", "1", 2)],
)
def test_paths(path, first, count):
    p = xmlread.compile_path(path)
    r = xmlread.Reader(xmlread.Reading((("string", p), ("count", p), ("boolean", p)))).read(DOC)
    assert (r["v0"], r["v1"], r["v2"]) == (first, count, count > 0)


def test_paths_against_the_engine(spark):
    """Where the engine knows a path too, both give the same."""
    paths = ["/a/b", "//b", "/a/*", "//b[2]", "//b[@k='5']", "//b/@k", "//b//b", "/b", "//c", "/a/d/b/b", "//*[@k]"]
    df = spark.createDataFrame([(DOC.replace(' x:k="2"', ""),)], "x string")
    want = df.select(*[F.xpath_string("x", F.lit(p)) for p in paths], *[F.xpath_int("x", F.lit(f"count({p})")) for p in paths]).first()
    reading = xmlread.Reading(tuple((k, xmlread.compile_path(p)) for k in ("string", "count") for p in paths))
    got = df.select(xmlread.reader(reading)(F.col("x")).alias("r")).first().r
    assert [got[f"v{i}"] or "" for i in range(len(paths))] == list(want)[: len(paths)]
    assert [got[f"v{len(paths) + i}"] for i in range(len(paths))] == list(want)[len(paths) :]


@pytest.mark.parametrize("path", ["//b[last()]", "//b[c]", "concat('a', 'b')", "//b[. = 'x']", "..", "//", "/a/b[", "id('x')", "//b | //c"])
def test_other_paths_are_left_to_the_engine(path):
    assert xmlread.compile_path(path) is None


def test_selectors_texts_and_lists():
    of = xmlread.compile_selector
    r = xmlread.Reader(xmlread.Reading(texts=(of("b"), of("a > b"), of("d b.q")), lists=(of("b"), of("b:nth-child(2)"), of('[k="5"] b')), inventory=True)).read(DOC)
    assert r["texts"] == ["onetwo threefourinner", "onetwo threefour", "inner"]
    assert r["lists"] == [["onetwo three", "four", "inner", "in"], ["four"], ["in"]]
    assert {p["xpath"]: (p["n"], p["attributes"]) for p in r["paths"]} == {"/a": (1, ["k", "x:k"]), "/a/b": (2, ["k"]), "/a/b/c": (1, []), "/a/d": (1, []), "/a/d/b": (1, ["class", "k"]), "/a/d/b/b": (1, [])}


def test_one_parse_for_all_items(spark):
    items = [{"name": f"n{i}", "type": t, "xpath": p} for i, (t, p) in enumerate([("String", "/a/b"), ("Count", "//b"), ("Boolean", "//c"), ("Number", "//@k"), ("Attribute", "/a/@k")])]
    out = xml.with_metadata(spark.createDataFrame([(DOC,), ("<a>",), (None,)], "x string"), "x", items)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert {tuple(r)[1:] for r in out.collect()} == {("onetwo three", 4, True, 1, "1"), (None,) * 5}


@pytest.mark.parametrize(
    ("value", "regex", "want"),
    [("43.9", r"\.", (43, True, None)), ("43", r"\.", (None, False, 43.0)), ("43.9", "^43$", (None, False, 43.9)), ("-2.5", "^-2.5$", (-2, True, None)), ("x", r"\.", (None, None, None)), ("1000000", "^1000000$", (1000000, True, None))],
)
def test_regex_sees_the_number_as_it_is_read(spark, value, regex, want):
    df = spark.createDataFrame([(f"<a>{value}</a>",)], "x string")
    r = xml.with_metadata(df, "x", [{"name": "n", "type": "Number", "xpath": "/a", "regex": regex}]).first()
    assert (r.n, r.nIsValid, r.nError) == want


def test_types_in_any_case(spark):
    df = spark.createDataFrame([("<a><b>4.5</b></a>",)], "x string")
    r = xml.with_metadata(df, "x", [{"name": n, "type": t, "xpath": "//b"} for n, t in (("s", "string"), ("n", "number"), ("N", "Number"), ("c", "COUNT"), ("z", "boolean"), ("o", "other"))][:1] + [{"name": "n1", "type": "number", "xpath": "//b"}, {"name": "n2", "type": "Number", "xpath": "//b"}, {"name": "c", "type": "COUNT", "xpath": "//b"}, {"name": "o", "type": "other", "xpath": "//b"}]).first()
    assert (r.s, r.n1, r.n2, r.c, r.o) == ("4.5", 4.5, 4, 1, "4.5")


# ---------------------------------------------------------------- faults of malformed documents
@pytest.mark.parametrize(
    ("text", "lines"),
    [
        ("<a>\n<b></c>\n<d x=1/>\n R & D\n</b></a>", [2, 3, 4]),
        ("<a>\n<b>\n</a>", [3]),
        ("<a/>\n<b/>", [2]),
        ("<a>\n<b x='1' x='2'/>\n</a>", [2]),
        ("<a>\n<!-- open\n</a>", [2]),
        ("<a>\n< b>\n</a>", [2]),
        ("", [1]),
        ("text", [1]),
        ("<a>\n</a>\ntext", [3]),
        ("\n".join(["<a>", *["<b></c>"] * 30, "</a>"]), list(range(2, 12))),
    ],
)
def test_faults(text, lines):
    import xml.parsers.expat as expat

    with pytest.raises(expat.ExpatError) as e:
        expat.ParserCreate("UTF-8").Parse(text.encode(), True)
    found = xmlread.errors_of(text, e.value)
    assert sorted({f["line"] for f in found}) == lines or [f["line"] for f in found][: len(lines)] == lines, found
    assert len(found) <= 10
