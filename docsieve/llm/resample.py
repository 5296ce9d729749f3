"""Quality selection by importance resampling.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; words
and word pairs are hashed into ``BUCKETS`` buckets.  Two bag-of-n-gram models, of
labelled good text (the target) and of all text (raw), each normalised with Dirichlet
pseudo-counts, give each n-gram the log ratio of its two probabilities.  A document's
log weight is the sum over its n-grams at the temperature (n + ``SHRINK``) / ``SCALE``,
so that length alone neither admits nor rejects it; the
documents with the largest sum of that weight and a Gumbel variate are the sample: a
draw of k without replacement in proportion to the weights.

Scale: counts are partial sums of fixed size per task over all documents; the ratio
table has a fixed size and is broadcast; the k-th largest key is found digit by digit
from counts per digit, not by a sort, so no task sees more than its share.  The target
ids are at most ``TARGET_ROWS`` labelled rows, chosen by hash.

Defined cases: a null text has no n-grams and weight 0; null ids draw one common
variate; rows with equal id and text tie and are taken in any order (they are equal in
the result); k is the rounded share of all rows, by default the share of good ids among
the labelled ones (a label that leaves it open counts for neither); with no target rows
all weights are 0 and, by default, every row is selected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import chunks, column, keyed, materialise, read_table
from ._words import ALNUM_LOW, U, Words, mix

BUCKETS = 1 << 17
TARGET_ROWS = 100_000
SCALE = 200.0
SHRINK = 20
LEAN = 5.0
SEED = 17
_DIGIT = 12
_DIGITS = 4


def grams(col: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every word and word pair, row it belongs to), rows in order."""
    w = Words(col, ALNUM_LOW, lower=True)
    at, pair = w.windows(2, salt=2)
    b = np.concatenate([w.hash, pair]) % U(buckets)
    row = np.concatenate([w.row_of_word(), np.searchsorted(w.rows, at, side="right") - 1])
    order = np.argsort(row, kind="stable")
    return b[order].astype(np.int64), row[order]


def _counts(docs: DataFrame, doc_id: str, text: str, target: set, buckets: int) -> np.ndarray:
    shared = docs.sparkSession.sparkContext.broadcast(np.array(sorted(target), np.int64))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for batch in it:
            for part, col in chunks(batch, text):
                b, row = grams(col, buckets)
                ids = column(part, doc_id)
                good = np.isin(np.asarray(ids.fill_null(0)), shared.value) & ~np.asarray(ids.is_null())
                total[0] += np.bincount(b, minlength=buckets)
                total[1] += np.bincount(b[good[row]], minlength=buckets)
        some = np.flatnonzero(total[0])
        yield pa.record_batch({"bucket": pa.array(some, pa.int64()), "raw": total[0][some], "target": total[1][some]})

    rows = docs.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()  # a row per bucket at most
    out = np.zeros((2, buckets), np.int64)
    for b, raw, good in rows:
        out[:, b] = raw, good
    return out


def log_ratio(counts: np.ndarray, lean: float = LEAN) -> np.ndarray:
    """log(p / q) per bucket: p the target's model with ``lean`` pseudo-counts a bucket, q the raw
    model with pseudo-counts in the same proportion to its total."""
    raw, target = counts[0].sum(), counts[1].sum()
    if not target:
        return np.zeros(counts.shape[1])
    n = counts.shape[1]
    p = (counts[1] + lean) / (target + lean * n)
    more = lean * raw / target
    q = (counts[0] + more) / (raw + more * n)
    return np.log(p) - np.log(q)


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    u = ((mix(ids.astype(np.int64).view(U) ^ mix(np.array([seed], U))[0]) >> U(11)).astype(np.float64) + 0.5) / (1 << 53)
    return -np.log(-np.log(u))


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, target_rows: int = TARGET_ROWS, scale: float = SCALE, seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_weight and key (the weight plus its Gumbel variate) per document."""
    docs = keyed(docs, doc_id, text).withColumn(doc_id, F.col(f"`{doc_id}`").cast("long"))
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null").select(F.col("doc_id").cast("long")).distinct()
    target = {r[0] for r in good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows).collect()}  # at most target_rows ids
    table = docs.sparkSession.sparkContext.broadcast(log_ratio(_counts(docs, doc_id, text, target, buckets)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part, col in chunks(batch, text):
                b, row = grams(col, buckets)
                n = np.bincount(row, minlength=len(col))
                weight = scale * np.bincount(row, table.value[b], minlength=len(col)) / (n + SHRINK)
                ids = column(part, doc_id)
                key = weight + gumbel(np.asarray(ids.fill_null(-1)), seed)
                yield pa.record_batch([ids, pa.array(n, pa.int64()), pa.array(weight), pa.array(key)], names=[doc_id, "n_grams", "log_weight", "key"])

    return docs.mapInArrow(run, f"`{doc_id}` long, n_grams long, log_weight double, key double")


def top_k(rows: DataFrame, key: str, k: int, tie: list[str]) -> DataFrame:
    """``rows`` (a written table) with boolean ``selected`` for the k largest keys."""
    bits = _DIGIT * _DIGITS
    fixed = F.floor((F.least(F.greatest(F.col(key), F.lit(-32768.0)), F.lit(32767.0)) + 32768.0) * float(1 << (bits - 16))).cast("long")
    rows = rows.withColumn("__k", fixed)
    prefix, need = 0, k
    for d in range(_DIGITS):
        shift = bits - _DIGIT * (d + 1)
        here = rows.where(F.shiftright("__k", shift + _DIGIT) == prefix)
        counts = dict(here.groupBy(F.shiftright("__k", shift).bitwiseAND((1 << _DIGIT) - 1).alias("digit")).count().collect())  # 4096 rows at most
        digit = 0
        for digit in range((1 << _DIGIT) - 1, -1, -1):
            if counts.get(digit, 0) >= need:
                break
            need -= counts.get(digit, 0)
        prefix = (prefix << _DIGIT) | digit
    # Equal to 2**-32 (no weight at a usual scale is beyond the range): the tied rows alone are ordered,
    # numbered in a sort by range, as a table of null ids may hold nothing but ties.
    ties = _first(rows.where(F.col("__k") == prefix), [F.desc(key), *[F.asc_nulls_first(c) for c in tie]], need)
    return rows.where(F.col("__k") != prefix).withColumn("selected", F.col("__k") > prefix).unionByName(ties).drop("__k")


def _first(rows: DataFrame, order: list, n: int) -> DataFrame:
    """``rows`` with boolean ``selected`` for the first ``n`` in an order; equal rows are taken in any."""
    columns = rows.columns
    sort = [*order, F.asc("__salt")]
    placed = rows.withColumn("__salt", F.rand(SEED)).repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__at", F.monotonically_increasing_id())
    placed = materialise(placed.select(*columns, "__at"), "ties")
    part = F.shiftright("__at", 33)
    per = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = per.select("__part", before.alias("__begin"))  # a row per sorted partition
    numbered = placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return numbered.select(*columns, (F.col("__begin") + F.col("__at").bitwiseAND((1 << 33) - 1) < n).alias("selected"))


def good_share(labels: DataFrame) -> float:
    """The share of good ids among the labelled ones; 1 if none is good, as nothing can be told apart then."""
    per = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long")).agg(F.max(F.expr("quality = 1 and toxic = 0")).alias("good"))
    return per.agg(F.avg(F.col("good").cast("int"))).first()[0] or 1.0


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, doc_id: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """The scores of every document with ``selected``, true for round(share * rows) of them (``good_share``, if None)."""
    share = good_share(labels) if share is None else share
    rows = materialise(score(docs, labels, doc_id, text, **parameters), "weights")
    return top_k(rows, "key", round(share * rows.count()), [doc_id, "n_grams"])


def op10(spark, sf_dir: str) -> DataFrame:
    """Query over all of ``documents``, with the target from ``labels``."""
    out = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_grams", F.round("log_weight", 6).alias("log_weight"), F.col("selected").alias("kept"))
