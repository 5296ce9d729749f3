"""Sessions: an immutable run configuration, a registry of stages, and their composition (inventory §1.4, §2.15-2.17).

A stage takes records and gives records, each for itself; what a document says is read
in one pass for all stages that ask (``xmlread``).  A side stage needs more than one row
at a time: it takes numbered records and gives a table of results by record number.  A run
composes the plain stages, writes the records once with their numbers (so sources are
scanned and documents parsed once), lets every side stage read the columns it needs of
that table, and joins all side tables to it by number.  Plain stages that read no side
results may stand anywhere in the list; ``after`` marks those that do.

A record whose ``error`` is set passes no later stage; the row itself stays, so nothing is
filtered, run twice or put together again.  A stage may have a ``prepare`` hook, which
changes the configuration before the chain is built, and a ``finish`` hook, which gets the
finished records.  Where a selected stage has one, the records are written by status
(ok, error) and the hooks (and the caller) read that table.
"""

from __future__ import annotations

import argparse
import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import filetype, language, pdf, text, xml, xmlread
from ..operators import bayes, categories, keyterms, segments, xpaths
from ..sources import corpus, scratch, sinks
from ..streaming import jobs
from ..streaming.runlog import RunLog

DEFAULT_STAGES = ("walk", "filetype", "pdf", "xml", "keyterms", "categories", "out")


@dataclass(frozen=True)
class SessionConfig:
    corpusname: str
    input_path: str
    output_path: str = "out"
    stages: tuple[str, ...] = DEFAULT_STAGES
    now: int = 0
    bundle: int = 0
    metadata: tuple[dict, ...] = ()
    namespace: str = ""  # a declaration that is taken out of every document
    resource_files: tuple[tuple[str, str], ...] = ()  # name, path; see RESOURCES
    language_profiles: DataFrame | None = None  # code, gram, weight
    keyterm_input: str = "text/plain"  # the type of the documents whose keywords are wanted
    resources: keyterms.Resources = field(default_factory=keyterms.Resources)
    category_tables: DataFrame | None = None
    categorizations: tuple[dict, ...] = ()
    dtds: tuple[tuple[str, str], ...] = ()  # name, text
    schemas: tuple[tuple[str, str], ...] = ()  # name, path on every executor
    bayes_model: DataFrame | None = None  # training, pool, word, p
    bayes_labels: DataFrame | None = None  # code, verbalization
    bayes_selector: str | None = None  # null: the whole text of the document
    bayes_entry: str = "entry"
    segments: tuple[tuple[str, str], ...] = ()  # name, selector
    title: str | None = None  # selector
    criterion: str = "frequency"
    templates: tuple[dict, ...] = ()  # label, kind, column, template

    def selected(self, names: list[str]) -> SessionConfig:
        """Only the named stages; the walk always comes first."""
        return replace(self, stages=("walk", *[n for n in names if n != "walk"]))._checked()

    def without(self, names: list[str]) -> SessionConfig:
        return replace(self, stages=tuple(s for s in self.stages if s not in names))._checked()

    def _checked(self) -> SessionConfig:
        unknown = [s for s in self.stages if s not in STAGES]
        if unknown or not self.corpusname or not self.input_path:
            raise ValueError(f"unknown stages: {unknown}" if unknown else "corpusname and input_path are mandatory")
        return self


Stage = Callable[[DataFrame, SessionConfig], DataFrame]
STAGES: dict[str, Stage] = {}
PREPARE: dict[str, Callable[[SparkSession, SessionConfig], SessionConfig]] = {}
FINISH: dict[str, Callable[[DataFrame, SessionConfig], None]] = {}
#: Side stages, and stages that read their results (so they come after the join).
SIDES: dict[str, Callable[[DataFrame, SessionConfig], DataFrame | None]] = {}
AFTER: set[str] = set()

#: The columns that show that a stage treated a record.
TREATED = {"filetype": "mimetype", "lang": "langDetect", "pdf": "pdfPageTotal", "xml": "isWellFormed", "validation": "validated", "keyterms": "keywords", "segments": "segmentKeywords", "bayes": "bayes", "categories": "matched", "enrich": "enrichments"}
#: Columns of a run that no record keeps.
OWN = ("__read", "__rid", "__sound")


def stage(name: str, prepare: Callable | None = None, finish: Callable | None = None, after: bool = True) -> Callable[[Stage], Stage]:
    """Registers a stage, maybe with hooks before and after the chain.

    ``after`` is False for stages that read no results of side stages."""

    def register(f: Stage) -> Stage:
        STAGES[name] = f
        SIDES.pop(name, None)
        (AFTER.add if after else AFTER.discard)(name)
        if prepare:
            PREPARE[name] = prepare
        if finish:
            FINISH[name] = finish
        return f

    return register


def side(name: str) -> Callable:
    """Registers a side stage: of numbered records (``__rid``) it gives a row for each number with a result, or None."""

    def register(f: Callable[[DataFrame, SessionConfig], DataFrame | None]) -> Callable:
        STAGES[name] = SIDES[name] = f
        return f

    return register


def list_stages() -> list[str]:
    return list(STAGES)


def _text(docs: DataFrame) -> DataFrame:
    return docs if "text" in docs.columns else docs.withColumn("text", filetype.decoded(F.col("content")))


def _is(docs: DataFrame, *kinds: str) -> Column:
    return F.coalesce(F.col("mimetype").isin(*kinds), F.lit(False)) if "mimetype" in docs.columns else F.lit(True)


@stage("walk", after=False)
def _walk(docs: DataFrame, config: SessionConfig) -> DataFrame:
    return docs


@stage("filetype", after=False)
def _filetype(docs: DataFrame, config: SessionConfig) -> DataFrame:
    """mimetype, mimedetails (encoding, complete) and filetypeError (null: none)."""
    known = F.col("mimetype") if "mimetype" in docs.columns else None
    if "content" in docs.columns:
        found = docs.withColumn("__type", filetype.file_type(F.col("content")))
        kind = F.col("__type.mime") if known is None else F.coalesce(known, F.col("__type.mime"))
        details = F.struct(F.col("__type.encoding").alias("encoding"), F.col("__type.description").alias("complete"))
        found = found.withColumns({"mimetype": kind, "mimedetails": details, "filetypeError": F.col("__type.error")})
        return _text(found.withColumn("__encoding", F.col("__type.encoding")).drop("__type")).drop("__encoding")
    docs = docs.withColumn("mimetype", filetype.mime_of_text(F.col("text")) if known is None else F.coalesce(known, filetype.mime_of_text(F.col("text"))))
    return docs.withColumn("mimedetails", F.struct(filetype.encoding(F.col("text")).alias("encoding"), filetype.description(F.col("mimetype")).alias("complete")))


@stage("lang", after=False)
def _lang(docs: DataFrame, config: SessionConfig) -> DataFrame:
    """langDetect of texts (tags left out of XML and HTML) and records with a fulltext; langDetectError where there is a text but no language."""
    docs = _text(docs)
    marked = ("application/xml", "text/html", "application/xhtml+xml")
    fits = _is(docs, "text/plain", *marked)
    if "fulltext" in docs.columns:
        fits = fits | F.col("fulltext").isNotNull()
    plain = F.when(_is(docs, *marked), language.without_markup(F.col("text"))).otherwise(F.col("text")) if "mimetype" in docs.columns else F.col("text")
    find = language.detector(config.language_profiles) if config.language_profiles is not None else language.detect
    docs = docs.withColumn("__lang", find(F.when(fits, plain)))
    unknown = fits & (F.col("text") != "") & (F.size("__lang.languages") == 0)
    return docs.withColumns({"langDetect": F.when(fits, F.col("__lang")), "langDetectError": F.when(unknown, F.struct(F.lit("Failed to identify language").alias("message")))}).drop("__lang")


@stage("pdf", after=False)
def _pdf(docs: DataFrame, config: SessionConfig) -> DataFrame:
    if "content" not in docs.columns:
        return docs
    info = F.when(F.col("mimetype") == "application/pdf", pdf.pdf_info(F.when(F.col("mimetype") == "application/pdf", F.col("content"))))
    docs = docs.withColumn("_pdf", info)
    return docs.withColumns({"pdfMetadata": F.col("_pdf.metadata"), "pdfPageTotal": F.col("_pdf.pages"), "pdfWordCount": F.col("_pdf.words"), "pdfWordByPage": F.col("_pdf.words_by_page"), "pdfError": F.col("_pdf.error")}).drop("_pdf")


# ---------------------------------------------------------------- one reading of every XML document
def _reading(config: SessionConfig) -> tuple[xmlread.Reading, xml.Metadata, dict[str, int]]:
    """All that the selected stages read of a document, and where each text is among the reading's texts."""
    spec = xml.Metadata(list(config.metadata) if "xml" in config.stages else [])
    texts: list[xmlread.Path] = []
    places: dict[str, int] = {}

    def wants(key: str, selector: str) -> None:
        places[key] = len(texts)
        texts.append(xmlread.compile_selector(selector))

    if "categories" in config.stages:
        for i, c in enumerate(config.categorizations):
            wants(f"category{i}", c["identifier"])
    if "bayes" in config.stages and config.bayes_selector:
        wants("bayes", config.bayes_selector)
    if "segments" in config.stages and config.title:
        wants("title", config.title)
    lists = tuple(xmlread.compile_selector(s) for _, s in config.segments) if "segments" in config.stages else ()
    return xmlread.Reading(tuple(spec.values), tuple(texts), lists, "xpaths" in config.stages), spec, places


def _read(docs: DataFrame, config: SessionConfig) -> DataFrame:
    """Adds the reading of XML documents (null for others) once, and whether they are sound."""
    if "__read" in docs.columns:
        return docs
    docs = _text(docs)
    seen = xml.remove_first(F.col("text"), config.namespace) if config.namespace else F.col("text")
    docs = docs.withColumn("__read", xmlread.reader(_reading(config)[0])(F.when(F.col("mimetype") == "application/xml", seen)))
    return docs.withColumn("__sound", F.coalesce(F.col("__read.sound"), F.lit(False)))


@stage("xml", after=False)
def _xml(docs: DataFrame, config: SessionConfig) -> DataFrame:
    """isWellFormed, wellFormedErrors, doctype and metadata of XML; ``error`` where a configured path is no path."""
    docs = _read(docs, config)
    spec = _reading(config)[1]
    fits = F.col("mimetype") == "application/xml"
    docs = docs.withColumns({"isWellFormed": F.when(fits, F.col("__sound")), "wellFormedErrors": F.when(fits, F.col("__read.errors")), "doctype": F.when(F.col("__sound"), xml.doctype(F.col("text")))})
    wrong = xml.path_error(docs.sparkSession, spec.others())
    if wrong is not None:
        old = F.col("error") if "error" in docs.columns else F.lit(None).cast("string")
        return docs.withColumn("error", F.coalesce(old, F.when(F.col("__sound"), F.lit(wrong))))
    # paths beyond the reading's are left to the engine, which sees sound texts only
    rest = xml.safe(F.when(F.col("__sound"), F.col("text"))) if spec.others() else F.lit(None).cast("string")
    return docs.withColumn("__safe", rest).select("*", *spec.columns(F.col("__read"), F.col("__safe"))).drop("__safe") if spec.items else docs


@stage("validation", after=False)
def _validation(docs: DataFrame, config: SessionConfig) -> DataFrame:
    """Well-formed XML against every DTD and schema of the lists: validDTD and validSchema are the
    first name that fits (null: none), DTDErrors and schemaErrors hold (name, errors) of all others.

    Each tells ten errors a document at most, with their places.  Other records: nulls."""
    docs = _read(docs, config)
    seen = F.when(F.col("__sound"), xml.strip_doctype(F.col("text")))
    of = lambda name, errors: F.struct(F.lit(name).alias("name"), errors.alias("errors"))
    dtds = F.array(*[of(n, xml.dtd_errors(t)(seen)) for n, t in config.dtds])
    schemas = F.array(*[of(n, xml.schema_errors(_schema_text(t))(seen)) for n, t in config.schemas])
    docs = docs.withColumns({"validated": F.when(seen.isNotNull(), F.lit(True)), "_dtds": dtds if config.dtds else F.lit(None), "_schemas": schemas if config.schemas else F.lit(None)})
    for given, column, valid, errors in ((config.dtds, "_dtds", "validDTD", "DTDErrors"), (config.schemas, "_schemas", "validSchema", "schemaErrors")):
        if given:
            fits = F.filter(column, lambda e: F.size(e["errors"]) == 0)
            docs = docs.withColumns({valid: F.when(F.col("validated"), F.try_element_at(fits, F.lit(1))["name"]), errors: F.when(F.col("validated"), F.filter(column, lambda e: F.size(e["errors"]) > 0))})
    return docs.drop("_dtds", "_schemas")


def _schema_text(given: str) -> str:
    """A schema by its text, or read from a file on the driver."""
    if given.lstrip().startswith("<"):
        return given
    with open(given, encoding="utf-8") as f:
        return f.read()


# ---------------------------------------------------------------- side stages
@side("keyterms")
def _keyterms(docs: DataFrame, config: SessionConfig) -> DataFrame:
    texts = docs.where(F.col("mimetype") == config.keyterm_input).select("__rid", "text")
    found = keyterms.keywords(texts, config.resources, doc_id="__rid")
    return found.groupBy(F.col("doc_id").alias("__rid")).agg(F.array_sort(F.collect_list(F.struct("rank", "term", "frequency", "strength", "specificity", "probability"))).alias("keywords"))


@side("categories")
def _categories(docs: DataFrame, config: SessionConfig) -> DataFrame | None:
    if config.category_tables is None or not config.categorizations or "isWellFormed" not in docs.columns:
        return None
    places = _reading(config)[2]
    each = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c["id"]).alias("table_id"), F.nullif(F.col("__read.texts")[places[f"category{i}"]], F.lit("")).alias("identifier")) for i, c in enumerate(config.categorizations)])
    rows = docs.where("isWellFormed").select(F.col("__rid").alias("doc_id"), F.inline(each))
    return categories.look_up(rows, config.category_tables).withColumnRenamed("doc_id", "__rid")


@side("bayes")
def _bayes(docs: DataFrame, config: SessionConfig) -> DataFrame | None:
    """``bayes``: the cascade of guesses of well-formed XML, by level; null elsewhere, without a model, or without a guess."""
    if config.bayes_model is None:
        return None
    words = F.col("__read.texts")[_reading(config)[2]["bayes"]] if config.bayes_selector else F.col("text")
    texts = docs.where("__sound").select("__rid", words.alias("text"))
    found = bayes.cascade(texts, config.bayes_model, config.bayes_labels, entry=config.bayes_entry, doc_id="__rid")
    each = F.struct(*[c for c in ("level", "code", "probability", "verbalization") if c in found.columns])
    return found.groupBy(F.col("doc_id").alias("__rid")).agg(F.array_sort(F.collect_list(each)).alias("bayes"))


@side("segments")
def _segments(docs: DataFrame, config: SessionConfig) -> DataFrame | None:
    """``segmentKeywords``: ranked terms of the configured segments of well-formed XML; null elsewhere."""
    if not config.segments:
        return None
    sound = docs.where("__sound")
    names = F.array(*[F.lit(n) for n, _ in config.segments])
    lists = sound.select(F.col("__rid").alias("doc_id"), F.posexplode(F.arrays_zip(names.alias("segment"), F.col("__read.lists").alias("texts"))).alias("list", "s"))
    parts = lists.select("doc_id", "list", F.col("s.segment").alias("segment"), F.posexplode("s.texts").alias("at", "text"))
    parts = parts.select("doc_id", "segment", F.struct("list", "at").alias("ord"), "text")
    titles = sound.select(F.col("__rid").alias("doc_id"), (F.col("__read.texts")[_reading(config)[2]["title"]] if config.title else F.lit("")).alias("text"))
    found = segments.segment_keywords(parts, titles, config.resources, config.criterion)
    return found.groupBy(F.col("doc_id").alias("__rid")).agg(F.array_sort(F.collect_list(F.struct("rank", "term", "factor", "total", "segments"))).alias("segmentKeywords"))


def _write_enrichments(records: DataFrame, config: SessionConfig) -> None:
    each = records.select("path", F.explode("enrichments").alias("e"))
    sinks.write_enrichments(each.select("path", "e.label", "e.enrichment.kind", F.col("e.enrichment.output").alias("rendered")), f"{config.output_path}/enrichments")


def _document_id(docs: DataFrame) -> Column:
    return text.base_name(F.col("name"), F.col("extension")) if "extension" in docs.columns else F.col("name")


@stage("enrich", finish=_write_enrichments)
def _enrich(docs: DataFrame, config: SessionConfig) -> DataFrame:
    """``enrichments``: the result columns of earlier stages through the configured templates.

    A template that is none gives an ``error`` to the records it should have treated.  A template sees ``doc`` (path, name, id: the name without extension) and ``result`` (its column); a column that no earlier
    stage made is left out, a null result gives no enrichment."""
    if "enrichments" not in docs.columns:
        docs = docs.withColumn("enrichments", F.array().cast("array<struct<label:string,enrichment:struct<kind:string,output:string>>>"))
    for t in config.templates:
        if t["column"] not in docs.columns:
            continue
        wrong = sinks.template_error(t["template"])
        if wrong is not None:
            old = F.col("error") if "error" in docs.columns else F.lit(None).cast("string")
            docs = docs.withColumn("error", F.coalesce(old, F.when(F.col(t["column"]).isNotNull(), F.lit(wrong))))
            continue
        data = F.struct(F.struct("path", "name", _document_id(docs).alias("id")).alias("doc"), F.col(t["column"]).alias("result"))
        docs = docs.withColumn("_out", sinks.render(t["template"], F.when(F.col(t["column"]).isNotNull(), data)))
        more = sinks.append_enrichment(F.col("enrichments"), t["label"], t["kind"], F.col("_out"))
        docs = docs.withColumn("enrichments", F.when(F.col("_out").isNull(), F.col("enrichments")).otherwise(more)).drop("_out")
    return docs


def _write_xpaths(records: DataFrame, config: SessionConfig) -> None:
    found = xpaths.summed(records.where("xpaths is not null").select(F.inline("xpaths")))
    xpaths.write_csv(found, f"{config.output_path}/xpaths/xpaths.csv")


@stage("xpaths", finish=_write_xpaths, after=False)
def _xpaths(docs: DataFrame, config: SessionConfig) -> DataFrame:
    """``xpaths``: the paths of each well-formed document, as it was read; their inventory is written at the end."""
    docs = _read(docs, config)
    return docs.withColumn("xpaths", F.transform("__read.paths", lambda p: F.struct(p["xpath"].alias("xpath"), p["n"].alias("countElement"), p["attributes"].alias("attributes"))))


def _write_records(records: DataFrame, config: SessionConfig) -> None:
    good, bad = split_errors(records) if "error" in records.columns else (records, None)
    sinks.write_json(good.drop("text", "xpaths", "status"), config.output_path, config.corpusname)
    if bad is not None:
        sinks.run_log(bad.select("path", "error"), f"{config.output_path}/errors")


@stage("out", finish=_write_records)
def _out(docs: DataFrame, config: SessionConfig) -> DataFrame:
    return docs


def _guarded(f: Stage, docs: DataFrame, config: SessionConfig) -> DataFrame:
    """A stage over records, of which those with an ``error`` stay as they are: their columns keep their values, new ones are null.

    The stage does not see their texts, so it does no work on them."""
    if "error" not in docs.columns:
        return f(docs, config)
    small = [c for c in docs.columns if c not in ("text", "content")]
    big = [c for c in docs.columns if c in ("text", "content")]
    fine = F.col("error").isNull()
    held = docs.withColumn("__failed", F.when(~fine, F.struct(*small)))
    held = held.withColumns({**{f"__{c}": F.when(~fine, F.col(c)) for c in big}, **{c: F.when(fine, F.col(c)) for c in big}})
    out = f(held, config)
    failed = F.col("__failed").isNotNull()
    hidden = {"__failed", *(f"__{c}" for c in big)}
    columns = []
    for c in out.columns:
        if c not in hidden:
            old = F.col("__failed")[c] if c in small else F.col(f"__{c}") if c in big else F.lit(None)
            columns.append(F.when(failed, old).otherwise(F.col(c)).alias(c))
    return out.select(*columns)


def prepared(config: SessionConfig, docs: DataFrame) -> DataFrame:
    """The plain stages that come before side stages, composed: what is scanned, and parsed, once."""
    sides = [n for n in config.stages if n in SIDES]
    first = min((i for i, n in enumerate(config.stages) if n in SIDES or n in AFTER), default=len(config.stages))
    for i, name in enumerate(config.stages):
        if name not in SIDES and (i < first or name not in AFTER):
            docs = _guarded(STAGES[name], docs, config)
    if {"bayes", "segments", "categories"} & set(sides):
        docs = _guarded(_read, docs, config)
    return _text(docs) if sides else docs


def run(spark: SparkSession, config: SessionConfig, docs: DataFrame | None = None) -> DataFrame:
    """Composes the selected stages over a corpus (walked, unless given).

    Records with an ``error`` pass no later stage; they are kept beside the others.  Where
    side stages are selected, the records are written once, without their raw content."""
    config = load_resources(spark, config._checked())
    for name in config.stages:
        if name in PREPARE:
            config = PREPARE[name](spark, config)
    docs = corpus.walk(spark, config.input_path, config.corpusname, config.now) if docs is None else docs
    docs = prepared(config, docs)
    late = [n for n in config.stages if n in AFTER]
    sides = [n for n in config.stages if n in SIDES]
    if sides:
        base = scratch.write(docs.drop("content").withColumn("__rid", F.monotonically_increasing_id()), "records")
        open_ = base.where(F.col("error").isNull()) if "error" in base.columns else base
        docs = base
        for name in sides:
            found = SIDES[name](open_, config)
            if found is not None:
                docs = docs.join(found, "__rid", "left")
    for name in late:
        docs = _guarded(STAGES[name], docs, config)
    docs = docs.drop(*OWN)
    finish = [FINISH[name] for name in config.stages if name in FINISH]
    if finish:
        path = f"{config.output_path}/records"
        status = F.when(F.col("error").isNull(), "ok").otherwise("error") if "error" in docs.columns else F.lit("ok")
        written = docs.drop("content").withColumn("status", status)
        written.write.mode("overwrite").partitionBy("status").parquet(path)
        docs = spark.read.schema(written.schema).parquet(path)
        for f in finish:
            f(docs, config)
    return docs


def progress(records: DataFrame, config: SessionConfig) -> DataFrame:
    """stage, records, treated: how far each selected stage came, in one aggregation."""
    names = [n for n in config.stages if TREATED.get(n) in records.columns]
    counts = records.agg(F.count("*").alias("records"), *[F.count(TREATED[n]).alias(n) for n in names])
    one = F.array(*[F.struct(F.lit(n).alias("stage"), F.col("records"), F.col(n).alias("treated")) for n in names])
    return counts.select(F.inline(one))


def split_errors(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records without, records with an error); of a written table only the files of one status are read."""
    if "status" in docs.columns:
        return docs.where("status = 'ok'"), docs.where("status = 'error'")
    return docs.where(F.col("error").isNull()), docs.where(F.col("error").isNotNull())


def bundles(docs: DataFrame, order: str, size: int) -> DataFrame:
    """Adds ``bundle``: rows in order, ``size`` to a bundle.

    Rows are numbered inside a range-partitioned sort and shifted by the partitions'
    running sums, so no task sees the whole table."""
    spread = docs.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id())
    from pyspark.sql import Window

    per = spread.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = per.select("_part", before.alias("_begin"))  # a row per sorted partition
    row = F.col("_begin") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return spread.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(starts), "_part").withColumn("bundle", F.floor(row / size).cast("long")).drop("_part", "_at", "_begin")


def latest_output(names: list[str]) -> str | None:
    """The newest session folder: the greatest name."""
    return max(names, default=None)


#: Resources a session can load from files: JSON, or Parquet tables (folders or ``.parquet``).
RESOURCES = ("stop_words", "dictionary", "lexicon", "lemmas", "category_tables", "labels", "trainings", "language_profiles")


def load_resources(spark: SparkSession, config: SessionConfig) -> SessionConfig:
    """The configuration with its ``resource_files`` read.

    JSON: stop_words a list; dictionary, lexicon and labels a map; lemmas a map from token and part of
    speech to a list; category_tables and trainings a map from their names to a table of theirs, or to its
    file.  Parquet: tables with the columns that the operators take."""
    if not config.resource_files:
        return config
    parts: dict = {}
    words = config.resources
    for name, path in config.resource_files:
        table = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else None
        given = corpus.read_resource(spark, path) if table is None else None
        if name == "stop_words":
            words = replace(words, stop_words=tuple(given) if table is None else tuple(r[0] for r in table.select("lemma").collect()))
        elif name == "dictionary":
            words = replace(words, dictionary=table if given is None else corpus.mapping_table(spark, {k: float(v) for k, v in given.items()}, "term", "weight", "double"))
        elif name == "lexicon":
            words = replace(words, lexicon=table if given is None else corpus.mapping_table(spark, {k: v[0] if isinstance(v, list) else v for k, v in given.items()}, "token", "tag", "string"))
        elif name == "lemmas":
            rows = [(t, pos, i, lemma) for t, kinds in (given or {}).items() for pos, lemmas in kinds.items() for i, lemma in enumerate(lemmas)]
            words = replace(words, lemmas=table if given is None else spark.createDataFrame(rows, "token string, pos string, ord int, lemma string"))
        elif name == "category_tables":
            parts["category_tables"] = table if given is None else corpus.category_table(spark, _nested(spark, given, path))
        elif name == "labels":
            parts["bayes_labels"] = table if given is None else corpus.mapping_table(spark, given, "code", "verbalization", "string")
        elif name == "trainings":
            parts["bayes_model"] = table if given is None else corpus.training_table(spark, _nested(spark, given, path))
        else:
            parts["language_profiles"] = table if given is None else spark.createDataFrame([(c, g, int(w)) for c, grams in given.items() for g, w in grams.items()], "code string, gram string, weight int")
    return replace(config, resources=words, resource_files=(), **parts)


def _nested(spark: SparkSession, given: dict, path: str) -> dict:
    """Tables by name, those that are given as files read from beside the file that names them."""
    return {k: corpus.read_resource(spark, f"{path.rpartition('/')[0]}/{v}") if isinstance(v, str) else v for k, v in given.items()}


def configure(config: SessionConfig, given: dict, folder: str = "") -> SessionConfig:
    """A configuration with the entries of a JSON file; unknown entries are an error.

    ``dtds`` maps names to DTD texts, ``schemas`` names to texts or paths, ``segments`` names to selectors,
    ``resources`` the names of RESOURCES to files; relative paths begin in ``folder``."""
    pairs = ("dtds", "schemas", "segments")
    lists = ("stages", "metadata", "categorizations", "templates")
    plain = ("now", "bundle", "title", "criterion", "bayes_selector", "bayes_entry", "namespace", "keyterm_input")
    own = given.get("resources", {})
    unknown = sorted(set(given) - {*pairs, *lists, *plain, "resources"}) + sorted(set(own) - set(RESOURCES))
    if unknown:
        raise ValueError(f"unknown entries: {unknown}")
    within = lambda p: os.path.join(folder, p) if folder and "://" not in p else p
    values = {k: tuple(v.items()) if k in pairs else tuple(v) if k in lists else v for k, v in given.items() if k != "resources"}
    if "schemas" in values:
        values["schemas"] = tuple((n, s if s.lstrip().startswith("<") else within(s)) for n, s in values["schemas"])
    if "templates" in values:  # the text itself, or a file of it
        values["templates"] = tuple({**{k: v for k, v in t.items() if k != "file"}, "template": _file(within(t["file"]))} if "file" in t else t for t in values["templates"])
    return replace(config, **values, resource_files=tuple((k, within(p)) for k, p in own.items()))


def _file(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def read_config(config: SessionConfig, path: str) -> SessionConfig:
    """A configuration from a file, or from a folder of them: ``session.json`` in the first folder (by name) whose name is part of the corpus name."""
    if os.path.isdir(path):
        fits = [n for n in sorted(os.listdir(path)) if n.lower() in config.corpusname.lower() and os.path.isfile(os.path.join(path, n, "session.json"))]
        if not fits:
            raise ValueError(f"no configuration for {config.corpusname} in {path}")
        path = os.path.join(path, fits[0], "session.json")
    return configure(config, json.loads(_file(path)), os.path.dirname(path))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docsieve", description="Analyse a folder of documents.")
    p.add_argument("path", nargs="?")
    p.add_argument("-n", "--corpusname")
    p.add_argument("-o", "--output", default="out")
    p.add_argument("-b", "--bundle", type=int, help="files at a time; 0: all at once")
    p.add_argument("-c", "--config", help="JSON file with metadata, lists, selectors, templates and resources, or a folder of configurations")
    p.add_argument("-m", "--model", help="Parquet table of a Bayes model")
    p.add_argument("-s", "--select", action="append", default=[])
    p.add_argument("-r", "--remove", action="append", default=[])
    p.add_argument("-l", "--list", action="store_true", help="name the stages and end")
    p.add_argument("-q", "--quiet", action="store_true", help="no counts at the end")
    return p


def parse(argv: list[str]) -> SessionConfig:
    p = parser()
    a = p.parse_args(argv)
    if a.select and a.remove:
        p.error("select and remove exclude each other")
    if not a.path or not a.corpusname:
        p.error("the path and --corpusname are mandatory")
    config = SessionConfig(a.corpusname, a.path, a.output)
    if a.config:
        config = read_config(config, a.config)
    if a.bundle is not None:
        config = replace(config, bundle=a.bundle)
    return config.selected(a.select) if a.select else config.without(a.remove)


def warnings_of(config: SessionConfig) -> list[str]:
    """Selected stages that will find nothing to do, as they are configured."""
    lacks = {"categories": config.category_tables is None or not config.categorizations, "bayes": config.bayes_model is None, "segments": not config.segments, "validation": not config.dtds and not config.schemas, "enrich": not config.templates}
    asks = {"categories": "tables and categorizations", "bayes": "a model", "segments": "selectors", "validation": "DTDs or schemas", "enrich": "templates"}
    out = [f"{n}: needs {asks[n]}" for n in config.stages if lacks.get(n)]
    if "categories" in config.stages and "xml" not in config.stages:
        out.append("categories: the stage xml is not selected")
    return out


def launch(spark: SparkSession, config: SessionConfig) -> list[str]:
    """Runs a session, in bundles where the configuration says so; the output folders.

    Bundles resume after a lost driver: the stream's checkpoint says which files are done, and a
    bundle that is done again replaces its own results.  The inventory of all bundles is kept as a
    table and written beside them.  ``log`` below the output holds the run's course and warnings."""
    log = RunLog(spark, f"{config.output_path}/log")
    try:
        config = load_resources(spark, config)
        log.info("session started", config.corpusname)
        for w in warnings_of(config):
            log.warning(w, config.corpusname)
        done = _launch(spark, config, log)
        log.info("session ended", config.corpusname)
        return done
    except Exception as e:
        log.error(e, config.corpusname)
        raise


def _failed(log: RunLog, records: DataFrame, folder: str) -> None:
    """A warning where records ended with an error."""
    n = records.where("status = 'error'").count() if "status" in records.columns else 0
    if n:
        log.warning(f"{n} records with an error", folder)


def _launch(spark: SparkSession, config: SessionConfig, log: RunLog) -> list[str]:
    if not config.bundle:
        _failed(log, run(spark, config), config.output_path)
        return [config.output_path]
    done: list[str] = []
    state = f"{config.output_path}/xpaths/bundles"

    def one(docs: DataFrame, n: int) -> None:
        folder = f"{config.output_path}/bundle={n}"
        records = run(docs.sparkSession, replace(config, output_path=folder), docs)
        _failed(log, records, folder)
        if "xpaths" in config.stages:
            jobs.merge_paths(xpaths.summed(records.where("xpaths is not null").select(F.inline("xpaths"))), state, n)
            jobs.compact_paths(docs.sparkSession, state)
        done.append(folder)

    name = f"{config.corpusname}-{uuid.uuid4().hex}"
    listener = log.listener(name)
    spark.streams.addListener(listener)
    try:
        files = corpus.stream(spark, config.input_path, config.corpusname, config.now, config.bundle)
        jobs.in_bundles(files, one, f"{config.output_path}/checkpoint", name).awaitTermination()
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        spark.streams.removeListener(listener)
    if "xpaths" in config.stages:
        xpaths.write_csv(jobs.path_state(spark, state), f"{config.output_path}/xpaths/xpaths.csv")
    return done
