"""Quality rules: fixed base rules and robust multivariate outliers, in DataFrame functions only.

Words are ``[^\\x20\\x09-\\x0D]+``.  Per document the base statistics are counted in
one projection over the whole text.  Documents that pass the base rules give a
vector of transformed statistics, and every (lang, source) gets a minimum-covariance-
determinant estimate of it: from each of ``STARTS`` starting estimates (medians with
quartile spreads, mean and covariance of all rows, of one half of them, of the other
half) concentration steps take mean and covariance of the h = ceil(``support`` * n)
nearest rows; the start with the smallest determinant after two steps goes on until no
determinant changes or ``steps`` steps are made.  The covariance gets the consistency
factor of the normal distribution.  Documents whose squared Mahalanobis distance exceeds
``cutoff`` are rejected.

A group's estimate leans on that of all groups together as ``PRIOR`` more rows would
make it: rare languages and sources are judged mostly by the whole, large ones by
themselves, with no size at which the rule changes.

Scale: the text is read once; the steps run over a written table of a few numbers
per document.  Each step is one partial aggregation to bins of distance per group (sums
and cross products), so a group with a third of all rows is summed map-side.  The h
nearest rows are the bins up to the h-th row; the rows of its bin (1/64 octave) share
the weight that is left, so weights add up to h exactly and no group is ever sorted.

Statistics are fixed-point integers, so sums do not depend on row order.

Defined cases: a null or empty text has no words and fails the base rules; null
lang and source form their own groups; repeated rows are judged alike; variances have
``FLOORS`` added, so constant statistics and groups of one row give finite distances.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import discard, keyed, materialise, read_table

WINDOW = 5
#: positions of windows take this many low bits beside 40 bits of hash
_POS = 24
_SCALE = 1024
SUPPORT = 0.75
STARTS = 4
STEPS = 10
#: rows of the whole that every group's estimate leans on
PRIOR = 40.0
#: squared distance beyond which a document is rejected: the 0.999 quantile of chi-square with four degrees
CUTOFF = 18.467
#: groups up to which their estimates (a few hundred bytes each) are broadcast
BROADCAST_GROUPS = 50_000
#: standard deviations added to those of the statistics (in quadrature): logarithm of the mean
#: word length, and square roots of the shares of symbols, repeated lines and repeated words
FLOORS = (0.05, 0.06, 0.06, 0.12)
_K = len(FLOORS)
_BINS = 64
_ALL = "all"  # no group's key begins like this
_PAIRS = [(i, j) for i in range(_K) for j in range(i + 1)]
_ESTIMATE = [f"m{i}" for i in range(_K)] + [f"c{i}{j}" for i, j in _PAIRS]


def base_columns(df: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long)."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    space = F.lit(" \t\n\x0b\x0c\r")
    trimmed = F.btrim(t, space)
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, space)) > 0)
    df = df.select(
        "*",
        F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+")).alias("__w"),
        (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        lines.alias("__lines"),
    )
    df = df.select(
        "*",
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__w", lambda x: F.xxhash64(x)).alias("__h"),
    ).drop("__lines")
    low = (1 << _POS) - 1
    # 40 bits of each window's hash over its position, so one primitive sort brings equal windows together.
    packed = F.expr(f"sort_array(transform(sequence(0, size(__h) - {WINDOW}), i -> (xxhash64({', '.join(f'__h[i + {j}]' for j in range(WINDOW))}) & {~low}L) | i))")
    df = df.select("*", F.when(F.size("__w").between(WINDOW, low), packed).alias("__s")).drop("__h")
    same = f"(x & {~low}L) = (__s[{{}}] & {~low}L)"
    df = df.select("*", F.expr(f"filter(__s, (x, i) -> (i > 0 and {same.format('i - 1')}) or (i < size(__s) - 1 and {same.format('i + 1')}))").alias("__r")).drop("__s")
    clash = F.expr(f"exists(sequence(0, size(__r) - 2), k -> (__r[k] & {~low}L) = (__r[k + 1] & {~low}L) and slice(__w, cast(__r[k] & {low} as int) + 1, {WINDOW}) != slice(__w, cast(__r[k + 1] & {low} as int) + 1, {WINDOW}))")
    df = df.select("*", F.when(F.size("__w") > low, True).when(F.size("__r") > 1, clash).otherwise(False).alias("__exact"))
    # Exact by the words themselves, for hash clashes and for texts of more words than positions have bits.
    strings = f"sort_array(transform(sequence(0, size(__w) - {WINDOW}), i -> struct(slice(__w, i + 1, {WINDOW}) as g, i as i)))"
    df = df.select("*", F.when(F.col("__exact"), F.expr(strings)).alias("__t"))
    slow = F.expr("sort_array(transform(filter(__t, (x, i) -> (i > 0 and x.g = __t[i - 1].g) or (i < size(__t) - 1 and x.g = __t[i + 1].g)), x -> x.i))")
    fast = F.expr(f"sort_array(transform(__r, x -> cast(x & {low} as int)))")
    df = df.select("*", F.when(F.col("__exact"), slow).otherwise(fast).alias("__at"))
    count = F.expr(f"aggregate(sequence(0, size(__at) - 1), 0L, (a, k) -> a + if(k = size(__at) - 1, {WINDOW}, least({WINDOW}, __at[k + 1] - __at[k])))")
    return df.select("*", F.when(F.size("__at") > 0, count).otherwise(F.lit(0)).cast("long").alias("n_repeat_words")).drop("__w", "__r", "__t", "__at", "__exact")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _statistics() -> list[Column]:
    """The transformed vector, in units of 1/1024."""
    n = F.col("n_words")
    parts = [
        F.log((F.col("word_chars") + 150) / (n + 30)),  # short texts lean to five characters a word
        F.sqrt(F.col("n_symbols") / F.col("word_chars")),
        F.sqrt(F.col("n_dup_lines") / n),
        F.sqrt(F.col("n_repeat_words") / n),
    ]
    return [F.round(p * _SCALE).cast("long").alias(f"x{i}") for i, p in enumerate(parts)]


def consistency(support: float) -> float:
    """By how much the nearest ``support`` share of normal rows understates their covariance."""
    even = lambda x, degrees: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))  # noqa: E731  chi-square, even degrees
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if even(mid, _K) < support else (low, mid)
    return support / even(low, _K + 2)


def _sums(weight: Column | None = None) -> list[Column]:
    if weight is not None:
        return [F.sum(F.col(c) * weight).alias(c) for c in _SUMS]
    return [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(_K)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in _PAIRS]]


_SUMS = ["n", *[f"s{i}" for i in range(_K)], *[f"p{i}{j}" for i, j in _PAIRS]]


def _moments(df: DataFrame, factor: float, *keys: str) -> DataFrame:
    """From n, s_i and p_ij (counts, sums and sums of products) to means m_i and covariances c_ij, floors added."""
    m = [F.col(f"s{i}") / F.col("n") for i in range(_K)]
    cov = [(F.col(f"p{i}{j}") / F.col("n") - m[i] * m[j]) * factor + (FLOORS[i] * _SCALE) ** 2 * (i == j) for i, j in _PAIRS]
    return df.select(*keys, *[x.alias(f"m{i}") for i, x in enumerate(m)], *[c.alias(f"c{i}{j}") for c, (i, j) in zip(cov, _PAIRS)])


def _factor(df: DataFrame) -> DataFrame:
    """Adds the Cholesky factor l_ij and the logarithm of the determinant."""
    for j in range(_K):
        here = F.col(f"c{j}{j}")
        for k in range(j):
            here = here - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        df = df.withColumn(f"l{j}{j}", F.sqrt(F.greatest(here, F.lit(1.0))))
        for i in range(j + 1, _K):
            v = F.col(f"c{i}{j}")
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            df = df.withColumn(f"l{i}{j}", v / F.col(f"l{j}{j}"))
    total = F.lit(0.0)
    for j in range(_K):
        total = total + 2 * F.log(F.col(f"l{j}{j}"))
    return df.withColumn("log_det", total)


def _distance(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    for i in range(_K):
        v = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            v = v - F.col(f"l{i}{k}") * F.col(f"y{k}")
        df = df.withColumn(f"y{i}", v / F.col(f"l{i}{i}"))
    total = F.lit(0.0)
    for i in range(_K):
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    return df.withColumn("d2", total)


def _starts(stats: DataFrame, factor: float) -> DataFrame:
    """g, start, means and covariances to begin with."""
    # percentile() counts fixed-point values, so it is exact and partial.
    q = stats.groupBy("g").agg(*[F.percentile(f"x{i}", 0.5).alias(f"m{i}") for i in range(_K)], *[(F.percentile(f"x{i}", 0.75) - F.percentile(f"x{i}", 0.25)).alias(f"w{i}") for i in range(_K)])
    spread = [(F.col(f"w{i}") / 1.349) ** 2 + (FLOORS[i] * _SCALE) ** 2 if i == j else F.lit(0.0) for i, j in _PAIRS]
    robust = q.select("g", F.lit(0).alias("start"), *[F.col(f"m{i}") for i in range(_K)], *[c.cast("double").alias(f"c{i}{j}") for c, (i, j) in zip(spread, _PAIRS)])
    half = F.pmod(F.xxhash64(*[f"x{i}" for i in range(_K)]), F.lit(2)).cast("int")
    halves = stats.groupBy("g", half.alias("half")).agg(*_sums())
    parts = halves.unionByName(halves.groupBy("g").agg(*[F.sum(c).alias(c) for c in _SUMS]).withColumn("half", F.lit(-1)))
    return robust.unionByName(_moments(parts.withColumn("start", F.col("half") + 2), factor, "g", "start"))


def _step(stats: DataFrame, est: DataFrame, hint, support: float, factor: float) -> DataFrame:
    """One concentration step of every (g, start)."""
    near = _distance(stats.join(hint(_factor(est)), "g")).select("g", "start", *[f"x{i}" for i in range(_K)], F.floor(F.log2(F.col("d2") + 2.0**-20) * _BINS).alias("bin"))
    bins = near.groupBy("g", "start", "bin").agg(*_sums())
    # Bins (at most some thousands a group) in order of distance, up to the one with the h-th row.
    group = Window.partitionBy("g", "start")
    before = F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.ceil(F.sum("n").over(group) * support) - before
    bins = bins.withColumn("weight", F.least(left / F.col("n"), F.lit(1.0))).where("weight > 0")
    return _moments(bins.groupBy("g", "start").agg(*_sums(F.col("weight"))), factor, "g", "start")


def _estimates(stats: DataFrame, hint, support: float, steps: int) -> DataFrame:
    """One row per group g: the minimum-covariance-determinant mean and covariance."""
    factor = consistency(support)
    est = _starts(stats, factor)
    for _ in range(2):
        est = materialise(_step(stats, est, hint, support, factor), "estimates")
    first = F.min_by(F.struct("start", *_ESTIMATE), F.struct("log_det", "start")).alias("best")
    est = materialise(_factor(est).groupBy("g").agg(first).select("g", "best.*"), "estimates")
    for _ in range(steps - 2):
        new = materialise(_step(stats, est, hint, support, factor), "estimates")
        change = _factor(new).select("g", "log_det").join(_factor(est).select("g", F.col("log_det").alias("was")), "g").agg(F.max(F.abs(F.col("log_det") - F.col("was")))).first()[0]
        discard(est)
        est = new
        if (change or 0.0) < 1e-9:
            break
    return est.drop("start")


def _lean(est: DataFrame, sizes: DataFrame, prior: float) -> DataFrame:
    """Group estimates with ``prior`` rows of the whole added, and their factors."""
    whole = est.where(F.col("g") == _ALL).select(*[F.col(c).alias(f"all_{c}") for c in _ESTIMATE])  # one row
    own = sizes.join(est, "g").join(F.broadcast(whole))
    share = F.col("n") / (F.col("n") + prior)
    return _factor(own.select("g", *[(F.col(c) * share + F.col(f"all_{c}") * (1 - share)).alias(c) for c in _ESTIMATE])).drop("log_det")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", support: float = SUPPORT, steps: int = STEPS, cutoff: float = CUTOFF, prior: float = PRIOR, carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all, if None) as struct ``row``, the base statistics, base_failed, d2 and kept."""
    carry = docs.columns if carry is None else carry
    group = F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in (lang, source)])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), group.alias("g"), F.col(f"`{text}`").alias("__text"))
    base = base_columns(rows, "__text").drop("__text").withColumn("base_failed", base_failed())
    base = materialise(base.select("*", *[F.when(~F.col("base_failed"), x).alias(f"x{i}") for i, x in enumerate(_statistics())]), "quality")
    passed = base.where("not base_failed").select("g", *[f"x{i}" for i in range(_K)])
    sizes = materialise(passed.groupBy("g").agg(F.count("*").alias("n")), "group-sizes")
    hint = F.broadcast if sizes.count() <= BROADCAST_GROUPS else (lambda x: x)
    est = _estimates(passed.unionByName(passed.withColumn("g", F.lit(_ALL))), hint, support, steps)
    out = _distance(base.join(hint(_lean(est, sizes, prior)), "g", "left"))
    kept = ~F.col("base_failed") & (F.col("d2") <= cutoff)
    return out.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2", F.coalesce(kept, F.lit(False)).alias("kept"))


def filter_quality(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` without rejected documents, all columns as they were."""
    return judge(docs, **parameters).where("kept").select("row.*")


def op4(spark, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    out = judge(keyed(read_table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source"), carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("d2", 3).alias("distance2"))
