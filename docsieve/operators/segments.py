"""Keyword matrices over the segments of structured documents (inventory A7-A10, N2, N3, P15, J8, O2).

The term-by-segment matrix stays in its sparse long form (doc, segment, term, value);
marginals and F-measures are window sums over it.  The sparse form equals the dense one
while values are positive, which all criteria are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keyterms import Resources, specificity, term_frequency

BOOST = 50
CRITERIA = ("frequency", "specificity", "probability")


def segment_terms(segments: DataFrame, resources: Resources = Resources(), criterion: str = "frequency") -> DataFrame:
    """From (doc_id, segment, ord, text): cells doc_id, segment, ord, term, strength and value.

    Several elements of one segment name become separate segments, numbered from 1."""
    if criterion not in CRITERIA:
        raise ValueError(f"criterion is one of {CRITERIA}")
    same = Window.partitionBy("doc_id", "segment")
    number = F.when(F.count("*").over(same) > 1, F.concat(F.col("segment"), F.lit(":nth-child("), F.row_number().over(same.orderBy("ord")).cast("string"), F.lit(")"))).otherwise(F.col("segment"))
    named = segments.withColumn("name", number)
    keyed = named.withColumn("key", F.struct("doc_id", F.col("name").alias("segment"), "ord"))
    scored = specificity(term_frequency(keyed, resources, "key", "text"), resources.dictionary)
    return scored.select("doc_id.doc_id", "doc_id.segment", "doc_id.ord", "term", "strength", F.col(criterion).cast("double").alias("value"))


def f_measures(cells: DataFrame) -> DataFrame:
    """Adds recall fr, precision fp, their harmonic mean ff, the segment's and term's means of ff, and the mean of means."""
    by_segment, by_term, by_doc = (Window.partitionBy("doc_id", *c) for c in (["segment"], ["term"], []))
    out = cells.withColumns({"row_sum": F.sum("value").over(by_segment), "col_sum": F.sum("value").over(by_term)})
    out = out.withColumns({"fr": F.col("value") / F.col("col_sum"), "fp": F.col("value") / F.col("row_sum")})
    out = out.withColumn("ff", F.when((F.col("fr") != 0) & (F.col("fp") != 0), 2 * F.col("fr") * F.col("fp") / (F.col("fr") + F.col("fp"))).otherwise(F.lit(0.0)))
    seen = F.count_if(F.col("ff") != 0)
    out = out.withColumns({"row_mean": F.sum("ff").over(by_segment) / seen.over(by_segment), "col_mean": F.sum("ff").over(by_term) / seen.over(by_term)})
    out = out.withColumns({"in_segment": F.count("*").over(by_segment), "in_term": F.count("*").over(by_term)})
    # Each segment's and term's mean once: every cell brings its share of it.
    shares = F.sum(F.col("row_mean") / F.col("in_segment")).over(by_doc) + F.sum(F.col("col_mean") / F.col("in_term")).over(by_doc)
    n = F.sum(1 / F.col("in_segment")).over(by_doc) + F.sum(1 / F.col("in_term")).over(by_doc)
    return out.withColumn("mean", shares / F.round(n)).drop("in_segment", "in_term")


def select_terms(stats: DataFrame, title_terms: DataFrame, boost: int = BOOST) -> DataFrame:
    """Terms with a cell at or above the mean, or in the title: segments, total, factor, rank.

    ``total`` counts the first selected segment's value twice, as users of these scores expect."""
    flagged = stats.join(title_terms.select("doc_id", "term", F.lit(True).alias("titled")).distinct(), ["doc_id", "term"], "left")
    kept = flagged.where((F.round("ff", 12) >= F.round("mean", 12)) | F.col("titled"))
    per = kept.groupBy("doc_id", "term").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "segment"))), lambda x: x["segment"]).alias("segments"),
        (F.sum("value") + F.min_by("value", "ord")).alias("total"),
        F.sum(F.col("ff") / F.col("row_mean")).alias("ratio"),
        F.count("*").alias("n"),
        F.max("strength").alias("strength"),
        F.coalesce(F.bool_or("titled"), F.lit(False)).alias("titled"),
    )
    factor = F.col("ratio") / F.col("n") + F.when(F.col("titled"), boost).otherwise(0) * F.col("n") * F.col("strength")
    out = per.withColumn("factor", factor)
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc(F.round("factor", 9)), "term")))


def segment_keywords(segments: DataFrame, titles: DataFrame, resources: Resources = Resources(), criterion: str = "frequency") -> DataFrame:
    """From segments and titles (doc_id, text): the ranked terms of every document."""
    cells = segment_terms(segments, resources, criterion)
    return select_terms(f_measures(cells), term_frequency(titles, resources).select("doc_id", "term"))
