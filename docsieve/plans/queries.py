"""Registered queries, and the SQL each must agree with.

Queries read the Parquet tables of a folder.  XML and PDF operators have no such input
among them, so their documents are made from relational rows inside the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import filetype, language, pdf, text, xml, xmlread
from ..operators import bayes, categories, keyterms, segments, xpaths
from ..sources import corpus, scratch, sinks
from . import session
from .sql import ORACLE_SQL  # noqa: F401

STOP_WORDS = ("that", "with", "from", "this", "which", "hent", "ered")
LEXICON = {"the": "DT", "of": "IN", "and": "CC", "that": "IN", "was": "VBD", "is": "VBZ", "are": "VBP", "with": "IN", "from": "IN", "tion": "NN", "thth": "JJ", "oner": "JJ", "hein": "VB", "thin": "VB", "reth": "RB", "inan": "NNS"}
LEMMAS = (("inan", "noun", 1, "ina"), ("inan", "noun", 2, "inas"), ("thth", "adj", 1, "th"), ("hein", "verb", 1, "hei"), ("was", "verb", 1, "be"), ("reth", "adv", 1, "re"))
WEIGHTS = (("tion", 0.02), ("oner", 0.004), ("thth", 0.001), ("hein", 0.0))


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scanned table of fewer files than there are cores, dealt out to all cores; others as they are.

    Texts are costly to analyse and a file of one row group is read by one task; with as
    many files as cores the scan is parallel by itself and nothing is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def _lexicon(spark: SparkSession) -> DataFrame:
    return corpus.mapping_table(spark, LEXICON, "token", "tag", "string")


def _lemmas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEMMAS), "token string, pos string, ord int, lemma string")


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.posexplode(text.tokenize(F.col("text"))).alias("pos", "token"))


# ---------------------------------------------------------------- files
def walk_file_info(spark, d):
    return corpus.from_table(_docs(spark, d), "corpus", 0).select("corpusname", "startAt", "path", "name", "extension", "size")


def walk_folders(spark, d):
    """Pages written as files in folders, walked again: bytes and characters by folder."""
    path = scratch.folder(spark, "walk")
    pages = table(spark, d, "pages").select(F.coalesce("html", F.lit("")).alias("value"), (F.col("page_id") % 16).alias("bucket"))
    pages.write.partitionBy("bucket").text(f"{path}/deep")
    files = corpus.walk(spark, path, "corpus", 7)
    read = files.select("corpusname", "startAt", "extension", F.regexp_extract("path", r"bucket=(\d+)", 1).cast("long").alias("bucket"), "size", filetype.decoded(F.col("content")).alias("text"))
    return read.groupBy("corpusname", "startAt", "extension", "bucket").agg(F.sum("size").alias("bytes"), F.sum(F.length("text")).alias("chars"))


def filetype_detect(spark, d):
    pages = table(spark, d, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    docs = table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    both = pages.unionAll(docs)
    return both.select("kind", "id", filetype.mime_of_text(F.col("text")).alias("mimetype"), text.tag_count(F.col("text")).cast("long").alias("tags"))


def filetype_encoding(spark, d):
    return _docs(spark, d).select("doc_id", filetype.encoding(F.col("text")).alias("encoding"))


def _files(spark, d):
    """A file for every page: sound and broken containers, and its address in several encodings."""
    p = spread(table(spark, d, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")))
    b = lambda c: c.cast("binary")
    lit = lambda x: F.lit(x)
    french = F.concat(F.lit("page été: "), "url")
    kinds = (
        b(F.col("html")),
        F.concat(lit(b"%PDF-1.4\n1 0 obj <<>> endobj\n"), b(F.col("url")), lit(b"\ntrailer <<>>\n%%EOF")),
        F.concat(lit(b"%PDF-1.4 "), b(F.md5("url"))),
        F.concat(lit(b"\x89PNG\r\n\x1a\n"), b(F.col("url")), lit(b"IEND\xaeB`\x82")),
        F.concat(lit(b"PK\x03\x04"), b(F.col("url")), lit(b"PK\x05\x06\x00\x00")),
        F.concat(lit(b"PK\x03\x04"), b(F.col("url"))),
        F.concat(lit(b"\xff\xfe"), F.encode(french, "UTF-16LE")),
        F.encode(french, "ISO-8859-1"),
        F.concat(lit(b"\x01\x02"), b(F.col("url"))),
        F.concat(lit(b'<?xml version="1.0"?><a>'), b(F.md5("url")), lit(b"</a>")),
        b(french),
        F.encode(F.concat(F.lit("plain address: "), F.regexp_replace("url", "[^ -~]", "")), "UTF-16BE"),
    )
    each = F.lit(None).cast("binary")
    for i, c in enumerate(kinds):
        each = F.when(F.col("page_id") % len(kinds) == i, c).otherwise(each)
    return p.select("page_id", each.alias("content"))


def filetype_bytes(spark, d):
    """Type, encoding, error and decoded text of files by their bytes."""
    found = _files(spark, d).select("page_id", filetype.file_type(F.col("content")).alias("t"))
    return found.select("page_id", F.col("t.mime").alias("mimetype"), F.col("t.encoding").alias("encoding"), F.col("t.error").isNotNull().alias("broken"), F.md5("t.text").alias("text_md5"))


# ---------------------------------------------------------------- tokens and terms
def token_stream(spark, d):
    return _tokens(spark, d).select("doc_id", F.col("pos").cast("long").alias("pos"), "token")


def token_count(spark, d):
    return _docs(spark, d).select("doc_id", F.size(text.tokenize(F.col("text"))).cast("long").alias("n_tokens"))


def token_sanitize(spark, d):
    clean = text.sanitize(text.tokenize(F.col("text")), list(STOP_WORDS))
    out = _docs(spark, d).select("doc_id", clean.alias("c"))
    return out.select("doc_id", F.size("c").cast("long").alias("n_tokens"), F.size(F.filter("c", lambda t: t == text.SEPARATOR)).cast("long").alias("n_separators"))


def tag_tokens(spark, d):
    tagged = keyterms.tag(_tokens(spark, d), _lexicon(spark))
    return tagged.groupBy("doc_id", "tag").agg(F.count("*").alias("n"))


def lemmatize_tokens(spark, d):
    rows = keyterms.lemmatize(keyterms.tag(_tokens(spark, d), _lexicon(spark)), _lemmas(spark))
    return rows.groupBy("lemma", "pos_name").agg(F.count("*").alias("n"))


def multiterm_runs(spark, d):
    runs = text.runs(text.sanitize(text.tokenize(F.col("text")), list(STOP_WORDS)))
    return _docs(spark, d).select("doc_id", F.explode(runs).alias("run")).where(F.instr("run", " ") > 0).groupBy("doc_id", "run").agg(F.count("*").alias("n"))


def _resources(spark=None, dictionary=False) -> keyterms.Resources:
    weights = spark.createDataFrame(list(WEIGHTS), "term string, weight double") if dictionary else None
    return keyterms.Resources(STOP_WORDS, dictionary=weights)


def keyterm_frequency(spark, d):
    return keyterms.term_frequency(_docs(spark, d), _resources()).withColumn("strength", F.col("strength").cast("long"))


def keyterm_specificity(spark, d):
    out = keyterms.specificity(keyterms.term_frequency(_docs(spark, d), _resources()), _resources(spark, True).dictionary)
    return out.select("doc_id", "term", F.round("probability", 8).alias("probability"), F.round("specificity", 8).alias("specificity"))


def keyterm_ranking(spark, d):
    out = keyterms.keywords(_docs(spark, d), _resources())
    return out.select("doc_id", "term", "frequency", F.round("specificity", 8).alias("specificity"), F.col("rank").cast("long").alias("rank"))


def keyterm_tagged_ranking(spark, d):
    resources = keyterms.Resources(STOP_WORDS, lexicon=_lexicon(spark), lemmas=_lemmas(spark))
    return keyterms.term_frequency(_docs(spark, d), resources).select("doc_id", "term", "frequency")


def keyterm_stage_log(spark, d):
    return keyterms.stage_log(_docs(spark, d), _resources())


# ---------------------------------------------------------------- segmented documents
def _segments(spark, d):
    c = spread(table(spark, d, "conversations"))
    parts = c.where("turn > 0").select(F.col("conv_id").alias("doc_id"), F.col("role").alias("segment"), F.col("turn").alias("ord"), "text")
    titles = c.where("turn = 0").select(F.col("conv_id").alias("doc_id"), "text")
    return parts, titles


def segment_matrix(spark, d):
    cells = segments.segment_terms(_segments(spark, d)[0], _resources())
    return cells.select("doc_id", "segment", "term", "value")


def segment_fmeasure(spark, d):
    out = segments.f_measures(segments.segment_terms(_segments(spark, d)[0], _resources()))
    return out.select("doc_id", "segment", "term", *[F.round(c, 8).alias(c) for c in ("fr", "fp", "ff", "mean")])


def segment_keywords(spark, d):
    parts, titles = _segments(spark, d)
    out = segments.segment_keywords(parts, titles, _resources())
    return out.select("doc_id", "term", F.size("segments").cast("long").alias("n_segments"), "total", F.round("factor", 6).alias("factor"))


# ---------------------------------------------------------------- Bayes
def _by_lang(spark, d):
    return spread(table(spark, d, "documents").select(F.col("lang").alias("pool"), "text"))


def bayes_counts(spark, d):
    return bayes.train_counts(_by_lang(spark, d))


def bayes_probs(spark, d):
    return bayes.probabilities(bayes.train_counts(_by_lang(spark, d))).select("pool", "word", F.round("p", 8).alias("p"))


def _scores(spark, d):
    model = bayes.probabilities(bayes.train_counts(_by_lang(spark, d)))
    return bayes.score(table(spark, d, "benchmark"), model, doc_id="item_id")


def bayes_scores(spark, d):
    return _scores(spark, d).select(F.col("doc_id").alias("item_id"), "pool", "n", F.round("score", 6).alias("score"))


def bayes_guess(spark, d):
    return bayes.guess(_scores(spark, d)).select(F.col("doc_id").alias("item_id"), "pool", F.round("score", 6).alias("score"))


def _cascade_model(spark, d):
    docs = table(spark, d, "documents")
    first = bayes.probabilities(bayes.train_counts(_by_lang(spark, d))).withColumn("training", F.lit("entry"))
    english = docs.where("lang = 'en'").select(F.when(F.col("source") < "src5", "low").otherwise("high").alias("pool"), "text")
    second = bayes.probabilities(bayes.train_counts(english)).withColumn("training", F.lit("en"))
    labels = spark.createDataFrame([("en", "English"), ("low", "Low sources"), ("high", "High sources")], "code string, verbalization string")
    return first.unionByName(second), labels


def bayes_cascade(spark, d):
    model, labels = _cascade_model(spark, d)
    out = bayes.cascade(table(spark, d, "benchmark"), model, labels, depth=3, doc_id="item_id")
    return out.select(F.col("doc_id").alias("item_id"), "level", "code", F.round("probability", 6).alias("probability"), "verbalization")


# ---------------------------------------------------------------- languages
def lang_detect(spark, d):
    out = _docs(spark, d).select("doc_id", language.detect(F.col("text")).alias("l"))
    first = F.try_element_at(F.col("l.languages"), F.lit(1))
    return out.select("doc_id", F.col("l.reliable").alias("reliable"), first["code"].alias("code"), F.coalesce(first["percent"], F.lit(0)).alias("percent"))


def lang_gate(spark, d):
    return _docs(spark, d).select("doc_id", language.passes_gate(language.detect(F.col("text")), "en", 70).alias("passes"))


def lang_profiles(spark, d):
    """What the labelled documents teach of each language."""
    return language.profiles(spread(table(spark, d, "documents").select("lang", "text"))).select("code", "gram", F.col("weight").cast("long").alias("weight"))


def lang_identify(spark, d):
    """All documents by profiles of the labelled ones."""
    docs = spread(table(spark, d, "documents").select("doc_id", "lang", "text"))
    found = docs.select("doc_id", language.detector(language.profiles(docs))(F.col("text")).alias("l"))
    first = F.try_element_at(F.col("l.languages"), F.lit(1))
    return found.select("doc_id", F.col("l.reliable").alias("reliable"), F.size("l.languages").cast("long").alias("n_languages"), first["code"].alias("code"), first["percent"].cast("long").alias("percent"), first["score"].alias("score"))


# ---------------------------------------------------------------- categories
def _categories(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    path = F.array(F.array(F.struct(F.lit(1).alias("level"), F.col("r_name").alias("value")), F.struct(F.lit(2).alias("level"), F.col("n_name").alias("value"))))
    tables = nation.select(F.lit("nation").alias("table_id"), F.col("n_nationkey").cast("string").alias("identifier"), path.alias("categories"))
    supplier = table(spark, d, "supplier")
    ids = supplier.select(F.col("s_suppkey").alias("doc_id"), F.lit(0).alias("ord"), F.lit("nation").alias("table_id"), F.when(F.col("s_suppkey") % 7 == 0, F.lit("")).when(F.col("s_suppkey") % 5 == 0, "none").otherwise(F.col("s_nationkey").cast("string")).alias("identifier"))
    return categories.look_up(ids, tables)


def category_lookup(spark, d):
    each = _categories(spark, d).select("doc_id", F.explode(F.flatten("categories")).alias("c"))
    return each.select(F.col("doc_id").alias("s_suppkey"), "c.level", "c.value")


def category_abort(spark, d):
    return _categories(spark, d).select(F.col("doc_id").alias("s_suppkey"), "missing", "matched")


def config_match(spark, d):
    names = table(spark, d, "customer").select(F.col("c_custkey"), F.lower("c_name").alias("corpusname"))
    folders = table(spark, d, "region").select(F.format_string("%02d", "r_regionkey").alias("folder"))
    return categories.match_folder(names, folders).select("c_custkey", "folder")


# ---------------------------------------------------------------- XML
def _escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _orders_xml(spark, d):
    """A well-formed document per order, but for every seventh (cut off) and every eleventh (no XML)."""
    o = spread(table(spark, d, "orders"))
    body = F.concat(F.lit('<order id="'), F.col("o_orderkey"), F.lit('" xml:lang="en"><status>'), F.col("o_orderstatus"), F.lit("</status><price>"), F.floor("o_totalprice").cast("long"), F.lit("</price>"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("<prio>"), _escape(F.col("o_orderpriority")), F.lit("</prio>"))).otherwise(F.lit("<urgency/>")), F.lit("<cust><key>"), F.col("o_custkey"), F.lit("</key></cust></order>"))
    head = F.lit('<!DOCTYPE order SYSTEM "order.dtd">')
    doc = F.when(F.col("o_orderkey") % 11 == 0, "no markup").when(F.col("o_orderkey") % 7 == 0, F.concat(head, F.substring(body, F.lit(1), F.length(body) - 4))).otherwise(F.concat(head, body))
    return o.select("o_orderkey", doc.alias("xml"))


METADATA = [
    {"name": "status", "type": "String", "xpath": "/order/status", "regex": "^[OF]$"},
    {"name": "id", "type": "Attribute", "xpath": "/order/@id"},
    {"name": "lang", "type": "Attribute", "xpath": "/order/@xml:lang"},
    {"name": "price", "type": "Number", "xpath": "/order/price"},
    {"name": "hasPrio", "type": "Boolean", "xpath": "/order/prio"},
    {"name": "elements", "type": "Count", "xpath": "/order/*"},
    {"name": "first", "type": "String", "xpath": ["/order/prio", "/order/cust/key"]},
]


def xml_metadata(spark, d):
    return xml.with_metadata(_orders_xml(spark, d), "xml", METADATA).drop("xml")  # malformed documents stay, with nulls


def xml_wellformed(spark, d):
    docs = _orders_xml(spark, d)
    return docs.select("o_orderkey", xml.is_well_formed(F.col("xml")).alias("isWellFormed"), (F.size(xml.parse_errors(F.col("xml"))) > 0).alias("hasErrors"), xml.doctype(F.col("xml"))["sysid"].alias("sysid"))


DTD = '<!ELEMENT order (status, price, (prio | urgency), cust)><!ATTLIST order id CDATA #REQUIRED xml:lang CDATA #IMPLIED><!ELEMENT status (#PCDATA)><!ELEMENT price (#PCDATA)><!ELEMENT prio (#PCDATA)><!ELEMENT urgency EMPTY><!ELEMENT cust (key+)><!ELEMENT key (#PCDATA)>'


def xml_dtd_validate(spark, d):
    docs = _orders_xml(spark, d).withColumn("ok", xml.is_well_formed(F.col("xml")))
    # Every fifth order loses its price.
    seen = F.when(F.col("o_orderkey") % 5 == 0, F.regexp_replace("xml", "<price>.*</price>", "")).otherwise(F.col("xml"))
    return docs.select("o_orderkey", F.when(F.col("ok"), F.size(xml.dtd_errors(DTD)(xml.strip_doctype(seen))) == 0).alias("isValidAgainstDTD"))


def css_select_text(spark, d):
    reading = xmlread.Reading(texts=tuple(xmlread.compile_selector(s) for s in ("order > cust key", 'order[xml:lang="en"] status')))
    texts = _orders_xml(spark, d).select("o_orderkey", xmlread.reader(reading)(F.col("xml"))["texts"].alias("t"))
    return texts.select("o_orderkey", *[F.coalesce(F.col("t")[i], F.lit("")).alias(c) for i, c in enumerate(("cust", "status"))])


def _faulty_xml(spark, d):
    """Orders on lines of their own, with up to three faults at known places."""
    o, k = spread(table(spark, d, "orders")), F.col("o_orderkey")
    status = F.concat(F.lit("<status>"), F.when(k % 5 == 0, "R & D").otherwise(F.col("o_orderstatus")), F.lit("</status>"))
    price = F.concat(F.lit("<price>"), F.col("o_totalprice").cast("string"), F.when(k % 2 == 0, "</prise>").otherwise("</price>"))
    cust = F.concat(F.lit("<cust "), F.when(k % 3 == 0, F.concat(F.lit("key="), F.col("o_custkey"))).otherwise(F.concat(F.lit('key="'), F.col("o_custkey"), F.lit('"'))), F.lit("/>"))
    return o.select("o_orderkey", F.concat_ws("\n", F.lit('<?xml version="1.0"?>'), F.lit("<order>"), status, price, F.lit("<!-- < & -->"), cust, F.lit("</order>")).alias("xml"))


def xml_errors(spark, d):
    """Places of all faults of each document."""
    found = _faulty_xml(spark, d).select("o_orderkey", xml.parse_errors(F.col("xml")).alias("e"))
    return found.select("o_orderkey", F.size("e").cast("long").alias("n_errors"), F.array_join(F.array_distinct(F.col("e.line")).cast("array<string>"), ",").alias("lines"))


SCHEMA = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
<xs:simpleType name="state"><xs:restriction base="xs:string"><xs:enumeration value="O"/><xs:enumeration value="F"/><xs:enumeration value="P"/></xs:restriction></xs:simpleType>
<xs:element name="order"><xs:complexType>
<xs:sequence><xs:element name="status" type="state"/><xs:element name="price" type="xs:decimal"/><xs:choice maxOccurs="unbounded"><xs:element name="cust" type="xs:long"/><xs:element name="note"/></xs:choice></xs:sequence>
<xs:attribute name="id" type="xs:positiveInteger" use="required"/></xs:complexType></xs:element></xs:schema>"""


def xml_schema_errors(spark, d):
    """Orders with up to three faults against a schema: how many errors, and on which lines."""
    o, k = spread(table(spark, d, "orders")), F.col("o_orderkey")
    head = F.concat(F.lit('<order id="'), F.when(k % 6 == 0, "x").otherwise(""), k.cast("string"), F.lit('">'))
    status = F.concat(F.lit("<status>"), F.when(k % 4 == 0, "X").otherwise(F.col("o_orderstatus")), F.lit("</status>"))
    price = F.when(k % 5 != 0, F.concat(F.lit("<price>"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("</price>")))
    cust = F.concat(F.lit("<cust>"), F.col("o_custkey"), F.lit("</cust>"))
    docs = o.select("o_orderkey", F.concat_ws("\n", F.lit('<?xml version="1.0"?>'), head, status, price, cust, F.lit("</order>")).alias("xml"))
    found = docs.select("o_orderkey", xml.schema_errors(SCHEMA)(F.col("xml")).alias("e"))
    return found.select("o_orderkey", F.size("e").cast("long").alias("n_errors"), F.array_join(F.col("e.line").cast("array<string>"), ",").alias("lines"))


def xml_number_regex(spark, d):
    """A regex on a number with decimals, which are cut off behind it; a type in other spelling keeps them."""
    o = spread(table(spark, d, "orders"))
    docs = o.select("o_orderkey", F.concat(F.lit("<o><p>"), F.format_string("%d.%02d", (F.col("o_orderkey") % 50).cast("int"), (F.col("o_custkey") % 100).cast("int")), F.lit("</p></o>")).alias("x"))
    items = [{"name": "p", "type": "Number", "xpath": "/o/p", "regex": r"\."}, {"name": "q", "type": "number", "xpath": "//p"}, {"name": "s", "type": "STRING", "xpath": "/o/p"}, {"name": "u", "type": "unheard of", "xpath": "o/p"}]
    return xml.with_metadata(docs, "x", items).drop("x")


def _lines_xml(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.concat(F.lit('<line no="'), F.col("l_linenumber"), F.lit('"'), F.when(F.col("l_returnflag") == "R", F.lit(' returned="1"')).otherwise(""), F.lit("><qty>"), F.col("l_quantity").cast("long"), F.lit("</qty></line>"))), "").alias("lines"))
    return lines.select(F.concat(F.lit("<order>"), F.col("lines"), F.lit("</order>")).alias("xml"))


def xpath_inventory(spark, d):
    return xpaths.inventory(_lines_xml(spark, d)).select("xpath", "countElement", F.array_join("attributes", ",").alias("attributes"))


# ---------------------------------------------------------------- the rest
def pdf_word_stats(spark, d):
    pages = table(spark, d, "conversations").select("conv_id", pdf.page_words(F.col("text")).cast("long").alias("w"))
    per = pages.groupBy("conv_id").agg(F.count("*").alias("pages"), F.sum("w").alias("words"))
    return per.select("conv_id", "pages", "words", F.expr("words div pages").alias("words_by_page"))


def _pdf_files(spark, d):
    """A PDF file for every conversation, a page for each turn."""
    shown = F.regexp_replace(F.coalesce("text", F.lit("")), r"([\\\\()])", r"\\\\$1")
    turns = spread(table(spark, d, "conversations").select("conv_id", "turn", shown.alias("text")))
    at = F.lit(10) + 2 * F.col("i")
    stream = F.concat(F.lit("BT ("), F.col("text"), F.lit(") Tj ET"))
    page = F.concat(at, F.lit(" 0 obj << /Type /Page /Contents "), at + 1, F.lit(" 0 R >> endobj\n"), at + 1, F.lit(" 0 obj << >>\nstream\n"), stream, F.lit("\nendstream endobj\n"))
    from pyspark.sql import Window

    pages = turns.withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "text"))).select("conv_id", "i", page.alias("page"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "page"))), lambda p: p["page"]), "")
    head = F.concat(F.lit("%PDF-1.5\n3 0 obj << /Title (talk "), F.col("conv_id"), F.lit(") >> endobj\n"))
    whole = pages.groupBy("conv_id").agg(body.alias("body")).select("conv_id", F.concat(head, "body", F.lit("trailer << /Info 3 0 R >>\n%%EOF")).alias("x"))
    return whole.select("conv_id", F.encode("x", "ISO-8859-1").alias("content"))


def pdf_files(spark, d):
    """Type, title, pages and words of PDF files by a session's stages."""
    docs = _pdf_files(spark, d).select(F.col("conv_id").cast("string").alias("path"), F.col("conv_id").cast("string").alias("name"), "content")
    out = session.run(spark, session.SessionConfig("corpus", "talks", stages=("filetype", "pdf")), docs)
    return out.select(F.col("path").cast("long").alias("conv_id"), "mimetype", F.col("mimedetails.complete").alias("complete"), F.col("pdfMetadata")["Title"].alias("title"), F.col("pdfPageTotal").cast("long").alias("pages"), F.col("pdfWordCount").cast("long").alias("words"), F.col("pdfWordByPage").cast("long").alias("words_by_page"))


def error_log_rollup(spark, d):
    e = table(spark, d, "events").withColumn("error", F.when(F.col("event_type") == "error", F.col("props")))
    good, bad = session.split_errors(e)
    both = good.select(F.lit("ok").alias("status"), "event_type").unionAll(bad.select(F.lit("error").alias("status"), "event_type"))
    return both.groupBy("status", "event_type").agg(F.count("*").alias("n"))


def bundle_batches(spark, d):
    return session.bundles(_docs(spark, d).select("doc_id"), "doc_id", 64)


def out_json(spark, d):
    """The records written by the JSON sink and read back."""
    docs = table(spark, d, "documents").select("doc_id", F.col("doc_id").alias("id"), "lang", "source", "n_chars")
    path = sinks.write_json(docs, scratch.folder(spark, "out_json"), "corpus", now="0")
    return spark.read.schema("doc_id long, id long, lang string, source string, n_chars long").json(path)


def sink_xpaths(spark, d):
    """The path inventory written by its sink and read back."""
    path = scratch.folder(spark, "sink_xpaths")
    xpaths.write_csv(xpaths.inventory(_lines_xml(spark, d)), path)
    part = lambda i: F.split("value", ";", 3)[i]
    return spark.read.text(path).select(part(0).alias("xpath"), part(1).cast("long").alias("countElement"), F.coalesce(part(2), F.lit("")).alias("attributes"))


TEMPLATE = "<doc id='{{doc.id}}' lang='{{doc.lang}}'>{{#parts}}<p>{{.}}</p>{{/parts}}</doc>"


def enrichment_render(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.struct(F.struct(F.col("doc_id").alias("id"), "lang").alias("doc"), F.array(F.col("source"), F.col("n_chars").cast("string")).alias("parts")).alias("data"))
    return docs.select("doc_id", sinks.render(TEMPLATE, F.col("data")).alias("rendered"))


# ---------------------------------------------------------------- sessions
def _as_corpus(ids_and_xml: DataFrame) -> DataFrame:
    """(path, text) in the shape of a walked corpus."""
    return ids_and_xml.select(F.col("path").cast("string"), F.col("path").cast("string").alias("name"), "text")


def _element(name: str, c):
    return F.concat(F.lit(f"<{name}>"), _escape(c), F.lit(f"</{name}>"))


def session_bayes(spark, d):
    """The cascade of ``bayes_cascade`` through a session: items as XML, the text by a selector."""
    model, labels = _cascade_model(spark, d)
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("path"), F.concat(F.lit('<?xml version="1.0"?><item>'), _element("text", F.col("text")), F.lit("</item>")).alias("text"))
    config = session.SessionConfig("corpus", "benchmark", stages=("filetype", "xml", "bayes"), bayes_model=model, bayes_labels=labels, bayes_selector="item > text")
    out = session.run(spark, config, _as_corpus(items)).select("path", F.inline("bayes"))
    return out.select(F.col("path").cast("long").alias("item_id"), "level", "code", F.round("probability", 6).alias("probability"), "verbalization")


def session_segments(spark, d):
    """Keywords of the turns of conversations through a session: conversations as XML, turns and title by selectors."""
    c = spread(table(spark, d, "conversations")).select("conv_id", "turn", F.when(F.col("turn") == 0, _element("title", F.col("text"))).otherwise(_element("turn", F.col("text"))).alias("x"))
    one = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "x"))), lambda t: t["x"]), "")
    docs = c.groupBy(F.col("conv_id").alias("path")).agg(F.concat(F.lit('<?xml version="1.0"?><talk>'), one, F.lit("</talk>")).alias("text"))
    config = session.SessionConfig("corpus", "conversations", stages=("filetype", "xml", "segments"), resources=_resources(), segments=(("turn", "talk > turn"),), title="talk > title")
    out = session.run(spark, config, _as_corpus(docs)).select("path", F.inline("segmentKeywords"))
    return out.select(F.col("path").cast("long").alias("doc_id"), "term", F.size("segments").cast("long").alias("n_segments"), "total", F.round("factor", 6).alias("factor"))


def session_validation(spark, d):
    """Orders against a list of two DTDs: the name of the one that fits, and the number of errors of the others."""
    docs = _orders_xml(spark, d).select(F.col("o_orderkey").alias("path"), F.concat(F.lit('<?xml version="1.0"?>'), F.when(F.col("o_orderkey") % 5 == 0, F.regexp_replace("xml", "<price>.*</price>", "")).otherwise(F.col("xml"))).alias("text"))
    without = DTD.replace("(status, price, ", "(status, ")
    config = session.SessionConfig("corpus", "orders", stages=("filetype", "xml", "validation"), dtds=(("priced", DTD), ("free", without)))
    out = session.run(spark, config, _as_corpus(docs))
    return out.select(F.col("path").cast("long").alias("o_orderkey"), F.col("validDTD").alias("valid_dtd"), F.col("DTDErrors")[0]["name"].alias("broken_dtd"), F.size(F.col("DTDErrors")[0]["errors"]).cast("long").alias("n_errors"))


def stem_words(spark, d):
    words = _docs(spark, d).select(F.explode(text.tokenize(F.col("text"))).alias("token")).where("token != '#'").distinct()
    return words.select("token", text.stem(F.col("token")).alias("stem"))


QUERIES = {
    f.__name__: f
    for f in (
        walk_file_info, walk_folders, filetype_detect, filetype_encoding, filetype_bytes, token_stream, token_count, token_sanitize, tag_tokens, lemmatize_tokens, multiterm_runs,
        keyterm_frequency, keyterm_specificity, keyterm_ranking, keyterm_tagged_ranking, keyterm_stage_log, segment_matrix, segment_fmeasure, segment_keywords,
        bayes_counts, bayes_probs, bayes_scores, bayes_guess, bayes_cascade, lang_detect, lang_gate, lang_profiles, lang_identify, category_lookup, category_abort, config_match,
        xml_metadata, xml_wellformed, xml_dtd_validate, xml_errors, xml_schema_errors, xml_number_regex, css_select_text, xpath_inventory, pdf_word_stats, pdf_files, error_log_rollup, bundle_batches, out_json, sink_xpaths, enrichment_render,
        session_bayes, session_segments, session_validation, stem_words,
    )
}
