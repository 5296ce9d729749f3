"""URL filters: rules first, then a ratio of two character language models.

What the rules decide trains the models: one of accepted and one of rejected URLs, each a
variable-order Markov model over the bytes of the URL (from the host on, host in lower
case) with contexts of up to ``ORDER`` bytes.  A context that was seen is smoothed with the
next shorter one by the number of different bytes that followed it (Witten-Bell); a context
that was not seen leaves the word to the shorter one.  A URL's score is the mean over its
bytes of log p(accepted) - log p(rejected).

The threshold is calibrated by cross-fitting: labelled URLs fall into two halves by hash,
and each is scored by models of the other.  Of the edges (1/256 apart) below which at most
``LOSS`` of the accepted URLs fall, the threshold is the lowest one with fewest rejected
URLs above it.  The halves are extra columns of the same counts, not extra passes.

Scale: a run of ``ORDER`` + 1 bytes is one integer, so counts, shorter contexts and
suffixes are masks of it.  Counts cover all URLs and are a table that grows with them; each
order joins the next shorter one, where a key meets at most 256 rows, and orders of at
most 65,536 rows are broadcast.  The runs that make up more than 1/65,536 of all positions
(so at most 65,536 of them) are broadcast and summed in place; the others are dealt
out by run, none of which is frequent then.  Ratios are fixed-point integers, so sums do not
depend on their order.

Defined cases: a null URL, or one without ``://``, has empty host and path, no rule, and is
allowed, as is every URL without a rule where the rules accept or reject nothing at all;
rules of equal length: the longer host wins, then block; a null page_id stays null; equal
rows are judged alike, one by one; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import CHUNK_BYTES, buffers, chunks, column, discard, keyed, materialise, read_table

ORDER = 5
LOSS = 0.05
HOT = 1 << 16
_ONE = 1 << 20  # of the fixed-point ratios
_EDGES = 256  # to a unit of the score
#: Classes of a URL, and of which of them each of the three model pairs counts accepted and rejected ones.
_CLASSES = ("a0", "a1", "r0", "r1")
_PAIRS = ((("a0", "a1"), ("r0", "r1")), (("a1",), ("r1",)), (("a0",), ("r0",)))

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


# ---------------------------------------------------------------- parts and rules
def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _low(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(rest: Column) -> Column:
    return _low(F.regexp_extract(rest, "^[^/?#]*", 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits host and path; null without one.

    A rule is a host and a path in one text; it fits the host and its subdomains."""
    each = [(verdict, rule, *rule.partition("/")) for verdict, rule in rules]
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule, own, slash, rest in sorted(each, key=lambda r: (len(r[1]), len(r[2]), r[0] == "block")):
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


# ---------------------------------------------------------------- runs of bytes
def runs(col: pa.Array, order: int, window: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(the last ``order`` + 1 bytes at every byte of every text, as one integer; the row it is in), a window at a time.

    Zero bytes stand before the beginning."""
    offsets, raw = buffers(col)
    for lo in range(0, len(raw), window):
        hi = min(lo + window, len(raw))
        row = np.searchsorted(offsets, np.arange(lo, hi), side="right") - 1
        at = np.arange(lo, hi) - offsets[row]
        out = raw[lo:hi].astype(np.int64)
        for j in range(1, order + 1):
            back = np.zeros(hi - lo, np.int64)
            skip = min(max(0, j - lo), hi - lo)
            back[skip:] = raw[max(0, lo + skip - j) : max(0, hi - j)]
            out |= np.where(at >= j, back, 0) << np.int64(8 * j)
        yield out, row


def _mask(order: int) -> int:
    return (1 << 8 * (order + 1)) - 1


def _counted(rows: DataFrame, order: int) -> DataFrame:
    """run, n, and how often it is in URLs of each class."""
    width = len(_CLASSES) + 1

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part, col in chunks(batch, "rest"):
                for g, row in runs(col, order):
                    kind = np.asarray(column(part, "class").fill_null(len(_CLASSES)))[row]
                    some, which = np.unique(g, return_inverse=True)
                    n = np.bincount(which * width + kind, minlength=len(some) * width).reshape(len(some), width)
                    yield pa.record_batch([pa.array(some), *[pa.array(x) for x in (n.sum(axis=1), *n.T[:-1])]], names=["run", "n", *_CLASSES])

    out = rows.select("rest", "class").mapInArrow(run, "run long, n long, a0 long, a1 long, r0 long, r1 long")
    return out.groupBy("run").agg(*[F.sum(c).alias(c) for c in ("n", *_CLASSES)])


def _sum(names: Sequence[str]) -> Column:
    out = F.col(names[0])
    for n in names[1:]:
        out = out + F.col(n)
    return out


def probabilities(counts: DataFrame, order: int) -> DataFrame:
    """run, n and p0 to p5: the probability of a run's last byte after the others, by accepted and rejected model of each pair."""
    sides = [side for pair in _PAIRS for side in pair]
    out = None
    for k in range(order + 1):
        own = counts.groupBy(F.col("run").bitwiseAND(_mask(k)).alias("run")).agg(*[F.sum(c).alias(c) for c in ("n", *_CLASSES)]) if k < order else counts
        after = Window.partitionBy(F.shiftright("run", 8))
        own = own.select("run", "n", *[_sum(s).alias(f"n{i}") for i, s in enumerate(sides)])
        own = own.select("*", *[F.sum(f"n{i}").over(after).alias(f"c{i}") for i in range(6)], *[F.count_if(F.col(f"n{i}") > 0).over(after).alias(f"t{i}") for i in range(6)])
        if k == 0:
            own = own.select("*", *[F.lit(1 / 256).alias(f"q{i}") for i in range(6)])
        else:
            shorter = out.select(F.col("run").alias("tail"), *[F.col(f"p{i}").alias(f"q{i}") for i in range(6)])
            own = own.withColumn("tail", F.col("run").bitwiseAND(_mask(k - 1))).join(F.broadcast(shorter) if k <= 2 else shorter, "tail")
        p = [F.when(F.col(f"c{i}") > 0, (F.col(f"n{i}") + F.col(f"t{i}") * F.col(f"q{i}")) / (F.col(f"c{i}") + F.col(f"t{i}"))).otherwise(F.col(f"q{i}")) for i in range(6)]
        out = own.select("run", "n", *[x.alias(f"p{i}") for i, x in enumerate(p)])
    return out


def ratios(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """run, n, and by pair of models the fixed-point log ratio of its last byte; written, as it grows with the URLs.

    ``rows`` holds rest and class (0 to 3 as in ``_CLASSES``, null without a rule)."""
    counts = materialise(_counted(rows, order), "url-runs")
    p = probabilities(counts, order)
    out = materialise(p.select("run", "n", *[F.round((F.ln(f"p{2 * j}") - F.ln(f"p{2 * j + 1}")) * _ONE).cast("long").alias(f"l{j}") for j in range(3)]), "url-ratios")
    discard(counts)
    return out


# ---------------------------------------------------------------- scores and verdicts
def score(rows: DataFrame, table: DataFrame, order: int = ORDER) -> DataFrame:
    """rid, n_bytes and total (fixed-point) of every row of rid, rest and class; labelled rows by the models without their half."""
    total = table.agg(F.sum("n")).first()[0] or 0
    hot = table.where(F.col("n") * HOT > total).orderBy("run").collect()  # fewer than HOT rows
    shared = rows.sparkSession.sparkContext.broadcast((np.array([r.run for r in hot], np.int64), np.array([(r.l0, r.l1, r.l2) for r in hot], np.int64).reshape(len(hot), 3)))

    def rows_of(key, rid, pair, s, n) -> pa.RecordBatch:
        return pa.record_batch({"run": key, "rid": rid, "pair": pair.astype(np.int32), "s": s, "n": n})

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value = shared.value
        for batch in it:
            for part, col in chunks(batch, "rest"):
                kind = np.asarray(column(part, "class").fill_null(-1))
                pair = np.where(kind < 0, 0, 1 + kind % 2)
                rid, own, n = np.asarray(column(part, "rid")), np.zeros(len(col), np.int64), np.zeros(len(col), np.int64)
                for g, row in runs(col, order):
                    at = np.searchsorted(known, g)
                    at[at == len(known)] = 0
                    here = known[at] == g if len(known) else np.zeros(len(g), bool)
                    np.add.at(own, row[here], value[at[here], pair[row[here]]])
                    n += np.bincount(row, minlength=len(col))
                    rest = row[~here]
                    yield rows_of(g[~here], rid[rest], pair[rest], np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64))
                yield rows_of(-1 - rid, rid, pair, own, n)  # a row's own sum goes under a key of its own, which no run has

    each = rows.select("rid", "rest", "class").mapInArrow(run, "run long, rid long, pair int, s long, n long")
    value = F.when(F.col("pair") == 0, F.col("l0")).when(F.col("pair") == 1, F.col("l1")).otherwise(F.col("l2"))
    met = each.join(table.where(F.col("n") * HOT <= total).select("run", "l0", "l1", "l2"), "run", "left")
    return met.groupBy("rid").agg(F.sum("n").alias("n_bytes"), F.sum(F.col("s") + F.coalesce(value, F.lit(0))).alias("total"))


def threshold(scored: DataFrame, loss: float = LOSS) -> float | None:
    """The calibrated threshold of rows with score and label (1 accepted, 0 rejected); None where one of both is missing."""
    edge = F.floor(F.col("score") * _EDGES).cast("long")
    bins = scored.where("label is not null").groupBy(edge.alias("edge")).agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).orderBy("edge").collect()  # scores are means of logarithms: some thousand edges
    good, bad = np.array([b.good for b in bins], np.int64), np.array([b.bad for b in bins], np.int64)
    if not good.sum() or not bad.sum():
        return None
    lost, missed = np.concatenate([[0], np.cumsum(good)]), bad.sum() - np.concatenate([[0], np.cumsum(bad)])
    allowed = np.flatnonzero(lost <= loss * good.sum())
    best = int(allowed[np.argmin(missed[allowed])])
    return (bins[0].edge if best == 0 else bins[best - 1].edge + 1) / _EDGES


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, page_id: str = "page_id", url: str = "url", order: int = ORDER, loss: float = LOSS) -> DataFrame:
    """page_id, host, path, rule, verdict, by (rule or model), score and threshold of every row."""
    rest = keyed(pages, page_id, url).select(F.col(f"`{page_id}`").alias("page_id"), F.coalesce(rest_of(F.col(f"`{url}`")), F.lit("")).alias("__rest"))
    parts = rest.select("page_id", host_of(F.col("__rest")).alias("host"), path_of(F.col("__rest")).alias("path"), "__rest")
    parts = parts.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    label = F.when(F.col("__rule.verdict") == "allow", 1).when(F.col("__rule.verdict") == "block", 0)
    text = F.concat("host", F.substring("__rest", F.length("host") + 1, F.length("__rest")))
    half = F.pmod(F.xxhash64(text), F.lit(2)).cast("int")
    base = parts.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"), F.col("__rule.verdict").alias("__given"), text.alias("rest"), label.alias("label"), (2 * (1 - label) + half).cast("int").alias("class"))
    base = materialise(base.withColumn("rid", F.monotonically_increasing_id()), "urls")  # row numbers are kept from here on
    table = ratios(base, order)
    mean = F.when(F.col("n_bytes") > 0, F.col("total") / (F.col("n_bytes") * F.lit(float(_ONE)))).otherwise(0.0)
    scores = score(base, table, order).select("rid", "n_bytes", mean.alias("score"))
    scored = materialise(base.drop("rest", "class").join(scores, "rid").drop("rid"), "url-scores")
    discard(base, table)
    t = threshold(scored, loss)
    guess = F.when((F.col("n_bytes") > 0) & (F.col("score") < F.lit(t)), "block").otherwise("allow")
    verdict = F.coalesce(F.col("__given"), guess)
    by = F.when(F.col("__given").isNotNull(), "rule").otherwise("model")
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), by.alias("by"), "score", F.lit(t).cast("double").alias("threshold"))


def op12(spark, sf_dir: str) -> DataFrame:
    """Query over all of ``pages``."""
    return judge(read_table(spark, sf_dir, "pages"))
