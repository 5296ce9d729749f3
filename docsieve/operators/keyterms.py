"""Keyword extraction: terms of a text, their frequencies, probabilities and specificities.

The row form keeps a document's tokens in one array until its terms are exploded, so
a corpus is shuffled once, as counted terms.  Lexicon and lemmas meet each other before any
document does: what they make of a token is one table, a row a token, which goes to all
tasks while it has at most ``WORDS`` rows (counted).  There a batch's distinct tokens are
looked up once each, however often they occur, and its arrays are filled by their codes.
Larger tables go through ``tag`` and ``lemmatize``: tokens are exploded, joined and folded back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

DEFAULT_WEIGHT = 1e-5
#: Tokens of lexicon and lemmas that go to all tasks at most.
WORDS = 3_000_000


@dataclass(frozen=True)
class TermFilter:
    """How often a term must occur, by the number of tokens of its document."""

    steps: tuple[tuple[int, int], ...] = ((1000, 1), (3000, 4))
    rest: int = 7
    no_limit_strength: int = 2

    def min_occur(self, tokens: Column) -> Column:
        out = F.lit(self.rest)
        for limit, value in reversed(self.steps):
            out = F.when(tokens < limit, value).otherwise(out)
        return F.when(tokens.isNotNull(), out)

    def passes(self, occurrences: Column, strength: Column, tokens: Column) -> Column:
        return (strength >= self.no_limit_strength) | (occurrences >= self.min_occur(tokens))


@dataclass(frozen=True)
class Resources:
    """Stop-words by lemma; optional tables lexicon (token, tag), lemmas (token, pos, ord, lemma), dictionary (term, weight)."""

    stop_words: tuple[str, ...] = ()
    lexicon: DataFrame | None = None
    lemmas: DataFrame | None = None
    dictionary: DataFrame | None = None
    term_filter: TermFilter = field(default_factory=TermFilter)


def tag(tokens: DataFrame, lexicon: DataFrame | None) -> DataFrame:
    """(doc, pos, token) with tag: the lexicon's, else unknown; the separator tags itself."""
    if lexicon is None:
        return tokens.withColumn("tag", F.when(F.col("token") == X.SEPARATOR, X.SEPARATOR).otherwise(X.UNKNOWN_TAG))
    return tokens.join(lexicon, "token", "left").withColumn("tag", F.when(F.col("token") == X.SEPARATOR, X.SEPARATOR).otherwise(F.coalesce("tag", F.lit(X.UNKNOWN_TAG))))


def lemmatize(tagged: DataFrame, lemmas: DataFrame | None) -> DataFrame:
    """Adds lemma: the last one listed for token and part of speech, else the token."""
    tagged = tagged.withColumn("pos_name", X.translate_tag(F.col("tag")))
    if lemmas is None:
        return tagged.withColumn("lemma", F.col("token"))
    last = lemmas.groupBy("token", F.col("pos").alias("pos_name")).agg(F.max_by("lemma", "ord").alias("lemma"))
    return tagged.join(last, ["token", "pos_name"], "left").withColumn("lemma", F.coalesce("lemma", "token"))


def outcomes(resources: Resources) -> DataFrame:
    """token, out: what becomes of each token that lexicon or lemmas know, its lemma or the separator."""
    lexicon, lemmas = resources.lexicon, resources.lemmas
    tagged = lexicon.groupBy("token").agg(F.min("tag").alias("tag")) if lexicon is not None else None
    known = lemmas.select("token").distinct() if lemmas is not None else None
    both = known.withColumn("tag", F.lit(None).cast("string")) if tagged is None else tagged if known is None else tagged.join(known, "token", "full")
    rows = lemmatize(both.where("token is not null").withColumn("tag", F.coalesce("tag", F.lit(X.UNKNOWN_TAG))), lemmas)
    return rows.select("token", F.when(_kept(resources), F.col("lemma")).otherwise(X.SEPARATOR).alias("out"))


def _kept(resources: Resources) -> Column:
    return X.is_sane(F.col("token")) & ~F.col("lemma").isin(list(resources.stop_words)) & F.col("tag").rlike("^[NJ]")


def _looked_up(rows: DataFrame, table: DataFrame) -> DataFrame:
    """doc_id, n_tokens, clean: where the table knows a token (of ``tokens``), its outcome in place of what ``clean`` says."""
    known = table.where("token != '#'").collect()  # at most WORDS rows
    words = rows.sparkSession.sparkContext.broadcast((pa.array([r.token for r in known], pa.string()), pa.array([r.out for r in known], pa.string())))
    kind = rows.schema["doc_id"].dataType

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, outs = words.value
        code = {t: i for i, t in enumerate(tokens.to_pylist())}
        for batch in it:
            lists, clean = batch.column(2), batch.column(3)
            distinct = lists.flatten().dictionary_encode()
            of = np.array([code.get(t, -1) for t in distinct.dictionary.to_pylist()], np.int64)
            at = of[distinct.indices.to_numpy()] if len(distinct) else np.zeros(0, np.int64)
            own = outs.take(pa.array(np.maximum(at, 0))) if len(outs) else pa.nulls(len(at), pa.string())
            values = pa.compute.if_else(pa.array(at >= 0), own, clean.flatten())
            offsets = pa.array(np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).fill_null(0).to_numpy())]), pa.int32())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, values)], names=["doc_id", "n_tokens", "clean"])

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_tokens", T.IntegerType()), T.StructField("clean", T.ArrayType(T.StringType()))])
    return rows.select("doc_id", "n_tokens", "tokens", "clean").mapInArrow(run, schema)


def term_arrays(docs: DataFrame, resources: Resources, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, terms (array with repeats); a null text has no tokens."""
    tokens = F.coalesce(X.tokenize(F.col(text)), F.array().cast("array<string>"))
    base = docs.select(F.col(doc_id).alias("doc_id"), tokens.alias("tokens"))
    clean = base.select("doc_id", F.size("tokens").alias("n_tokens"), "tokens", X.sanitize(F.col("tokens"), list(resources.stop_words)).alias("clean"))
    if resources.lexicon is None and resources.lemmas is None:
        return clean.select("doc_id", "n_tokens", X.terms(F.col("clean")).alias("terms"))
    table = outcomes(resources)
    if table.limit(WORDS + 1).count() <= WORDS:
        return _looked_up(clean, table).select("doc_id", "n_tokens", X.terms(F.col("clean")).alias("terms"))
    each = base.select("doc_id", F.posexplode_outer("tokens").alias("pos", "token"))
    rows = lemmatize(tag(each, resources.lexicon), resources.lemmas)
    folded = rows.groupBy("doc_id").agg(F.count("token").alias("n_tokens"), F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("pos", F.when(_kept(resources), F.col("lemma")).otherwise(X.SEPARATOR).alias("t"))))).alias("s"))
    return folded.select("doc_id", F.col("n_tokens").cast("int").alias("n_tokens"), X.terms(F.col("s.t")).alias("terms"))


def _counted(arrays: DataFrame) -> DataFrame:
    """doc_id, n_tokens, counted: array of (term, c), counted inside each row by runs of the sorted array."""
    each = arrays.select("doc_id", "n_tokens", F.sort_array("terms").alias("s"))
    each = each.select("*", F.expr("if(size(s) = 0, array(), filter(sequence(1, size(s)), i -> i = 1 or s[i - 1] != s[i - 2]))").alias("at"))
    return each.select("doc_id", "n_tokens", F.expr("transform(at, (p, k) -> struct(s[p - 1] as term, cast(if(k = size(at) - 1, size(s) + 1, at[k + 1]) - p as bigint) as c))").alias("counted"))


def term_frequency(docs: DataFrame, resources: Resources = Resources(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, term, frequency, strength of the terms that pass the filter.

    Terms are counted inside each row; what is left is dealt out by document once, which the
    later windows over documents share."""
    # An outer explode: the filter that a plain one lets Catalyst infer would be pushed below the tokeniser, with copies of it.
    each = _counted(term_arrays(docs, resources, doc_id, text)).select("doc_id", "n_tokens", F.explode_outer("counted").alias("x")).where("x is not null")
    each = each.select("doc_id", "n_tokens", "x.term", "x.c").repartition("doc_id")
    counted = each.groupBy("doc_id", "n_tokens", "term").agg(F.sum("c").alias("frequency")).withColumn("strength", X.strength(F.col("term")))
    return counted.where(resources.term_filter.passes(F.col("frequency"), F.col("strength"), F.col("n_tokens"))).select("doc_id", "term", "frequency", "strength")


def specificity(frequencies: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Adds probability, and specificity as a share of the document's largest."""
    doc = Window.partitionBy("doc_id")
    total = frequencies.withColumn("probability", F.col("frequency") / F.sum("frequency").over(doc))
    if dictionary is not None:
        total = total.join(dictionary, "term", "left")
        weight = F.when(F.col("weight") != 0, F.col("weight")).otherwise(F.lit(DEFAULT_WEIGHT))
        total = total.withColumn("weight", F.coalesce(weight, F.lit(DEFAULT_WEIGHT)))
    else:
        total = total.withColumn("weight", F.lit(DEFAULT_WEIGHT))
    raw = total.withColumn("raw", F.col("probability") / F.col("weight")).drop("weight")
    return raw.withColumn("specificity", F.col("raw") / F.max("raw").over(doc)).drop("raw")


def keywords(docs: DataFrame, resources: Resources = Resources(), truncate: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Terms with their scores and rank (specificity first, then term), cut at the mean specificity if asked.

    Scores are compared on 12 decimals, so equal terms stay equal however they were summed."""
    doc = Window.partitionBy("doc_id")
    scored = specificity(term_frequency(docs, resources, doc_id, text), resources.dictionary)
    if truncate:
        scored = scored.withColumn("mean", F.avg("specificity").over(doc)).where(F.round("specificity", 12) >= F.round("mean", 12)).drop("mean")
    return scored.withColumn("rank", F.row_number().over(doc.orderBy(F.desc(F.round("specificity", 12)), "term")))


#: What a document lacks, in the order its stages would notice it.
STAGES = ("TOKENIZATION", "EXTRACTION", "INDEXATION")


def stage_log(docs: DataFrame, resources: Resources = Resources(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the first stage that gave nothing (null where keywords were found), from one look at each row."""
    rows = _counted(term_arrays(docs, resources, doc_id, text))
    found = F.exists("counted", lambda x: resources.term_filter.passes(x["c"], X.strength(x["term"]), F.col("n_tokens")))
    first = F.when(F.col("n_tokens") == 0, STAGES[0]).when(F.size("counted") == 0, STAGES[1]).when(~found, STAGES[2])
    return rows.select("doc_id", first.alias("missing"))
