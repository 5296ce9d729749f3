"""XML columns: well-formedness, doctype, typed XPath metadata, selectors, validation (inventory X1-X14).

Paths and selectors are read in one pass by ``xmlread``.  Only location paths beyond its
subset go through Spark's built-in ``xpath_*`` functions, which see a text where it is
well formed, and without its doctype, so one bad document never fails a job.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import Schema
from .xmlread import ERROR_TYPE, MAX_ERRORS, Path, Reading, compile_path, compile_selector, errors_of, reader

DOCTYPE = r"(?s)<!DOCTYPE[^\[>]*(\[.*?\]\s*)?>"


# ---------------------------------------------------------------- well-formedness and doctype
@F.pandas_udf(ERROR_TYPE)
def parse_errors(texts: pd.Series) -> pd.Series:
    """At most ten errors of each text with their places; empty where well formed."""

    def of(text):
        if text is None:
            return [{"line": 0, "column": 0, "message": "no document"}]
        try:
            expat.ParserCreate("UTF-8").Parse(text.encode(), True)
        except expat.ExpatError as e:
            return errors_of(text, e)
        return []

    return texts.map(of)


@F.pandas_udf(T.BooleanType())
def _parses(texts: pd.Series) -> pd.Series:
    def ok(text):
        if text is None:
            return False
        try:
            expat.ParserCreate("UTF-8").Parse(text.encode(), True)
        except expat.ExpatError:
            return False
        return True

    return texts.map(ok).astype(bool)


def is_well_formed(xml: Column) -> Column:
    """Whether a text parses; null does not.  (One pass of expat costs a tenth of the row parser's.)"""
    return _parses(xml)


def strip_doctype(xml: Column) -> Column:
    return F.regexp_replace(xml, DOCTYPE, "")


def bare(xml: Column) -> Column:
    """A text without byte-order mark, XML declaration and doctype, as the XPath functions take it."""
    return F.regexp_replace(strip_doctype(xml), r"^\x{feff}?<\?xml[^>]*\?>|^\x{feff}", "")


def safe(xml: Column) -> Column:
    """What the XPath functions may see: the bare text where exactly it parses, else null."""
    return F.when(_parses(bare(xml)), bare(xml))


def doctype(xml: Column) -> Column:
    """struct(name, pubid, sysid), null without a doctype; missing parts are null."""
    q = r"""\s+(?:"([^"]*)"|'([^']*)')"""
    part = lambda pattern, *groups: F.coalesce(*[F.nullif(F.regexp_extract(xml, pattern, g), F.lit("")) for g in groups])
    name = part(r"(?s)<!DOCTYPE\s+([^\s>\[]+)", 1)
    public = part(r"(?s)<!DOCTYPE\s+[^\s>\[]+\s+PUBLIC" + q, 1, 2)
    system = F.coalesce(part(r"(?s)<!DOCTYPE\s+[^\s>\[]+\s+PUBLIC" + q + q, 3, 4), part(r"(?s)<!DOCTYPE\s+[^\s>\[]+\s+SYSTEM" + q, 1, 2))
    return F.when(name.isNotNull(), F.struct(name.alias("name"), public.alias("pubid"), system.alias("sysid")))


def remove_first(xml: Column, literal: str) -> Column:
    """The text without the first occurrence of a literal (a namespace declaration)."""
    at = F.instr(xml, F.lit(literal))
    return F.when(at > 0, F.concat(F.substring(xml, F.lit(1), at - 1), F.substring(xml, at + len(literal), F.length(xml)))).otherwise(xml)


# ---------------------------------------------------------------- XPath
KINDS = ("string", "number", "boolean", "count")


def rewrite(path: str) -> str:
    """Prefixed attributes by their whole name, which the engine does resolve."""
    return re.sub(r"@([A-Za-z_][\w.-]*:[A-Za-z_][\w.-]*)", r"@*[name()='\1']", path)


def kind_of(name: str) -> str:
    """A metadata type in any case; attributes and unknown types are strings."""
    return name.lower() if name.lower() in KINDS else "string"


def truncated(n: Column) -> Column:
    """A number without its decimals."""
    return F.when(n < 0, F.ceil(n)).otherwise(F.floor(n)).cast("long")


def engine_value(xml: Column, kind: str, path: str) -> Column:
    """One value of a safe text by the engine's functions, numbers with their decimals; null where there is none."""
    p = F.lit(rewrite(path))
    if kind == "number":
        return F.nanvl(F.xpath_number(xml, p), F.lit(None).cast("double"))
    if kind == "boolean":
        return F.xpath_boolean(xml, p)
    if kind == "count":
        return F.xpath_number(xml, F.lit(f"count({rewrite(path)})")).cast("long")
    return F.nullif(F.xpath_string(xml, p), F.lit(""))


def xpath_value(xml: Column, kind: str, path: str) -> Column:
    """One typed value of a safe text; null where there is none (false and 0 are values)."""
    of = kind_of(kind)
    compiled = compile_path(path)
    value = reader(Reading(((of, compiled),)))(xml)["v0"] if compiled else engine_value(xml, of, path)
    return truncated(value) if of == "number" else value


def shown(value: Column, kind: str) -> Column:
    """A value as a regular expression sees it: whole numbers without decimals."""
    text = value.cast("string")
    return F.when(value == F.floor(value), F.when(F.abs(value) < 1e15, value.cast("long").cast("string")).otherwise(text)).otherwise(text) if kind == "number" else text


class Metadata:
    """A metadata configuration: items with name, type, xpath (one or several) and maybe regex.

    ``values`` are what one reading of a document must give, ``columns`` the result columns.
    Of several paths the first with a value counts (Boolean and Count always have one) and no
    regex applies; with one path and a regex there are name (valid values), nameIsValid and
    nameError (invalid values).  The regex sees the value as it is read; a Number loses its
    decimals behind it (``number`` in other spellings keeps them)."""

    def __init__(self, items: list[dict]):
        self.items = items
        self.values: list[tuple[str, Path]] = []
        self.places: list[list[int | str]] = []
        for item in items:
            kind = kind_of(item["type"])
            paths = item["xpath"] if isinstance(item["xpath"], (list, tuple)) else [item["xpath"]]
            places: list[int | str] = []
            for p in paths[:1] if kind in ("boolean", "count") else paths:
                compiled = compile_path(p)
                places.append(len(self.values) if compiled else p)
                if compiled:
                    self.values.append((kind, compiled))
            self.places.append(places)

    def others(self) -> list[str]:
        """The paths that are left to the engine."""
        return [p for places in self.places for p in places if isinstance(p, str)]

    def columns(self, read: Column, safe_text: Column) -> list[Column]:
        out = []
        for item, places in zip(self.items, self.places, strict=True):
            kind, name, pattern = kind_of(item["type"]), item["name"], item.get("regex")
            value = F.coalesce(*[read[f"v{p}"] if isinstance(p, int) else engine_value(safe_text, kind, p) for p in places])
            final = truncated(value) if item["type"] == "Number" else value
            if not pattern or isinstance(item["xpath"], (list, tuple)):
                out.append(final.alias(name))
                continue
            ok = shown(value, kind).rlike(pattern)
            out += [F.when(ok, final).alias(name), F.when(value.isNotNull(), ok).alias(f"{name}IsValid"), F.when(~ok, value).alias(f"{name}Error")]
        return out


def with_metadata(docs: DataFrame, column: str, items: list[dict]) -> DataFrame:
    """``docs`` with the columns of a metadata configuration; every document is read once."""
    spec = Metadata(items)
    read = docs.withColumn("__read", reader(Reading(tuple(spec.values)))(F.col(column)))
    return read.select(*docs.columns, *spec.columns(F.col("__read"), safe(F.col(column)))) if items else docs


# ---------------------------------------------------------------- selectors
def select_text(xml: Column, selector: str) -> Column:
    """The texts of all matches, joined without anything between; null of a text that is not well formed."""
    return reader(Reading(texts=(compile_selector(selector),)))(xml)["texts"][0]


def select_texts(selector: str):
    """A function of a text: the text of each match, in document order; none of a null text."""
    read = reader(Reading(lists=(compile_selector(selector),)))
    return lambda xml: F.coalesce(read(xml)["lists"][0], F.array().cast("array<string>"))


# ---------------------------------------------------------------- validation
def schema_errors(schema: str):
    """A function of a well-formed text: at most ten errors against a schema, with their places; none of a null text."""
    Schema(schema)  # a schema that is none fails here, not in a task

    @F.pandas_udf(ERROR_TYPE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = Schema(schema)
        for texts in batches:
            yield texts.map(lambda t: [] if t is None else one.errors(t))

    return run


def path_error(spark: SparkSession, paths: list[str]) -> str | None:
    """What is wrong with the first of the location paths that is none; null if all can be evaluated."""
    for p in paths:
        try:
            spark.sparkContext._jvm.javax.xml.xpath.XPathFactory.newInstance().newXPath().compile(rewrite(p))
        except Py4JJavaError as e:
            cause = e.java_exception.getCause()
            return json.dumps({"message": f"{p}: {cause.getMessage() if cause is not None else e.java_exception.getMessage()}"})
    return None


def _model(node: tuple) -> str:
    """A content model of the parser as a regular expression over ``<child>`` names."""
    kind, quant, name, children = node
    star = {expat.model.XML_CQUANT_NONE: "", expat.model.XML_CQUANT_OPT: "?", expat.model.XML_CQUANT_REP: "*", expat.model.XML_CQUANT_PLUS: "+"}[quant]
    if kind == expat.model.XML_CTYPE_EMPTY:
        return ""
    if kind == expat.model.XML_CTYPE_ANY:
        return "(?:<[^>]*>)*"
    if kind == expat.model.XML_CTYPE_NAME:
        return f"(?:<{re.escape(name)}>){star}"
    if kind == expat.model.XML_CTYPE_MIXED:
        return f"(?:{'|'.join(_model(c) for c in children)})*" if children else ""
    joined = ("|" if kind == expat.model.XML_CTYPE_CHOICE else "").join(_model(c) for c in children)
    return f"(?:{joined}){star}"


class Dtd:
    """Element and attribute declarations of a DTD."""

    def __init__(self, text: str):
        self.content: dict[str, str] = {}
        self.text_allowed: set[str] = set()
        self.required: dict[str, set[str]] = {}
        self.known: dict[str, set[str]] = {}
        p = expat.ParserCreate()
        p.ElementDeclHandler = self._element
        p.AttlistDeclHandler = self._attribute
        root = re.search(r"<!ELEMENT\s+([^\s>]+)", text)
        p.Parse(f"<!DOCTYPE {root[1] if root else 'x'} [{text}]><{root[1] if root else 'x'}/>".encode(), True)

    def _element(self, name, model):
        self.content[name] = _model(model)
        if model[0] in (expat.model.XML_CTYPE_MIXED, expat.model.XML_CTYPE_ANY):
            self.text_allowed.add(name)

    def _attribute(self, element, attribute, kind, default, required):
        self.known.setdefault(element, set()).add(attribute)
        if required and default is None:
            self.required.setdefault(element, set()).add(attribute)

    def errors(self, xml: str) -> list[dict]:
        out: list[dict] = []
        stack: list[list] = []
        p = expat.ParserCreate()

        def fail(message):
            out.append({"line": p.CurrentLineNumber, "column": p.CurrentColumnNumber, "message": message})

        def start(name, attrs):
            if stack:
                stack[-1][1].append(name)
            if name not in self.content:
                fail(f"No declaration for element {name}")
            for a in sorted(self.required.get(name, set()) - set(attrs)):
                fail(f"Element {name} does not carry attribute {a}")
            for a in sorted(set(attrs) - self.known.get(name, set())):
                fail(f"No declaration for attribute {a} of element {name}")
            stack.append([name, [], ""])

        def end(name):
            _, children, text = stack.pop()
            if name in self.content and not re.fullmatch(self.content[name], "".join(f"<{c}>" for c in children)):
                fail(f"Element {name} content does not follow the DTD")
            elif name in self.content and name not in self.text_allowed and text.strip():
                fail(f"Element {name} content does not follow the DTD, text is not allowed")

        def data(s):
            if stack:
                stack[-1][2] += s

        p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = start, end, data
        try:
            p.Parse(xml.encode(), True)
        except expat.ExpatError as e:
            fail(expat.errors.messages[e.code])
        return out[:MAX_ERRORS]


def dtd_errors(dtd_text: str):
    """A function of a text without doctype: at most ten errors against a DTD."""

    @F.pandas_udf(ERROR_TYPE)
    def run(texts: pd.Series) -> pd.Series:
        dtd = Dtd(dtd_text)
        return texts.map(lambda t: [] if t is None else dtd.errors(t))

    return run


def enrich(docs: DataFrame, xml: str, items: list[dict]) -> DataFrame:
    """``docs`` with isWellFormed, wellFormedErrors, doctype and the configured metadata, all from one reading."""
    spec, x = Metadata(items), F.col(xml)
    read = docs.withColumn("__read", reader(Reading(tuple(spec.values)))(x))
    sound = F.coalesce(F.col("__read.sound"), F.lit(False))
    return read.select(*docs.columns, sound.alias("isWellFormed"), F.col("__read.errors").alias("wellFormedErrors"), doctype(x).alias("doctype"), *spec.columns(F.col("__read"), safe(x)))
