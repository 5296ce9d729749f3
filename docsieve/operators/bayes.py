"""Naive-Bayes categories: training, scoring, cascades (inventory A11-A13, J5-J7, N4, N6, O3, P16, P18).

A model is a table (training, pool, pool_ord, word, p).  Scores are sums of logarithms,
so thousands of small factors do not underflow.  Words of a text are counted before
they meet the model; the model is joined without hints, so it is broadcast only while small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import word_tokens
from ..sources import scratch

LIMIT = 2048
LEAST, MOST = 0.0001, 0.9999
NEUTRAL = 0.1


def train_counts(labelled: DataFrame, label: str = "pool", text: str = "text", lower: bool = False) -> DataFrame:
    """pool, word, n: how often each pool's texts hold each word."""
    each = labelled.select(F.col(label).alias("pool"), F.explode(word_tokens(F.col(text), lower)).alias("word"))
    return each.groupBy("pool", "word").agg(F.count("*").alias("n"))


def probabilities(counts: DataFrame) -> DataFrame:
    """pool, word, p: words that tell the pool from the others."""
    per_pool = counts.groupBy("pool").agg(F.sum("n").alias("tokens"))
    every = counts.agg(F.sum("n").alias("total"))  # one row
    per_word = counts.withColumn("all", F.sum("n").over(Window.partitionBy("word")))
    # Pools are few: one row each; the total is one row.
    x = per_word.join(per_pool.join(F.broadcast(every), F.lit(True)), "pool")
    good = F.when(F.col("tokens") == 0, 1.0).otherwise(F.least(F.lit(1.0), (F.col("all") - F.col("n")) / F.col("tokens")))
    bad = F.least(F.lit(1.0), F.col("n") / F.greatest(F.col("total") - F.col("tokens"), F.lit(1)))
    out = x.select("pool", "word", (bad / (good + bad)).alias("f"))
    return out.where(F.abs(F.col("f") - 0.5) >= NEUTRAL).select("pool", "word", F.least(F.greatest(F.col("f"), F.lit(LEAST)), F.lit(MOST)).alias("p"))


def combine(log_p, log_q, n):
    """Robinson's combination of n probabilities from the sums of log p and log(1 - p)."""
    p = 1 - F.exp(log_q / n)
    q = 1 - F.exp(log_p / n)
    return (1 + (p - q) / (p + q)) / 2


def score(docs: DataFrame, model: DataFrame, doc_id: str = "doc_id", text: str = "text", keys: tuple[str, ...] = (), lower: bool = False, limit: int = LIMIT) -> DataFrame:
    """doc_id, keys, pool, n, score: the ``limit`` largest probabilities of a text's words per pool combined."""
    words = docs.select(F.col(doc_id).alias("doc_id"), *keys, F.explode(word_tokens(F.col(text), lower)).alias("word"))
    words = words.groupBy("doc_id", *keys, "word").agg(F.count("*").alias("c"))
    met = words.join(model.select(*keys, "pool", "word", "p"), [*keys, "word"])
    best = Window.partitionBy("doc_id", *keys, "pool").orderBy(F.desc("p"), "word").rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("before", F.coalesce(F.sum("c").over(best), F.lit(0)))
    met = met.withColumn("c", F.least(F.col("c"), limit - F.col("before"))).where("c > 0")
    sums = met.groupBy("doc_id", *keys, "pool").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.ln("p")).alias("lp"), F.sum(F.col("c") * F.ln(1 - F.col("p"))).alias("lq"))
    return sums.select("doc_id", *keys, "pool", "n", combine(F.col("lp"), F.col("lq"), F.col("n")).alias("score"))


def guess(scores: DataFrame, keys: tuple[str, ...] = (), least: float = 0.0) -> DataFrame:
    """The pool with the largest score above ``least``; pools in order of name (or pool_ord) win ties."""
    order = "pool_ord" if "pool_ord" in scores.columns else "pool"
    w = Window.partitionBy("doc_id", *keys).orderBy(F.desc(F.round("score", 12)), order)
    return scores.where(F.col("score") > least).withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def levels(model: DataFrame, entry: str) -> int:
    """The longest chain of trainings from ``entry``; where trainings name each other in a circle, their number.

    What comes to the driver is a row per category that is itself a training, not data."""
    trainings = model.select("training").distinct()
    chains = model.select("training", "pool").distinct().join(trainings.withColumnRenamed("training", "pool"), "pool", "left_semi")
    after: dict[str, set[str]] = {}
    for r in chains.collect():
        after.setdefault(r.training, set()).add(r.pool)
    names = {entry}.union(after, *after.values())
    now, n = {entry}, 0
    while now and n < len(names):
        now, n = set().union(*(after.get(t, set()) for t in now)), n + 1
    return n


def cascade(docs: DataFrame, model: DataFrame, verbalization: DataFrame | None = None, depth: int | None = None, entry: str = "entry", doc_id: str = "doc_id", text: str = "text", least: float = 0.0) -> DataFrame:
    """doc_id, level, code, probability, verbalization: each guess names the next training, while there is one.

    Without ``depth`` there are as many levels as the model's trainings allow; a category
    that leads back to an earlier training ends when each training had its turn."""
    depth = levels(model, entry) if depth is None else depth
    trainings = model.select("training").distinct()
    now = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lit(entry).alias("training"))
    out = None
    for level in range(1, depth + 1):
        # Written: the level's rows and the next level read it, and plans do not pile up level upon level.
        best = scratch.write(guess(score(now, model, keys=("training",)), ("training",), least), f"guesses-{level}")
        rows = best.select("doc_id", F.lit(level).alias("level"), F.col("pool").alias("code"), F.col("score").alias("probability"))
        out = rows if out is None else out.unionAll(rows)
        if level == depth:
            break
        chosen = best.select("doc_id", F.col("pool").alias("training")).join(trainings, "training", "left_semi")
        now = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, "doc_id")
    if verbalization is not None:
        out = out.join(verbalization.select("code", "verbalization"), "code", "left").select("doc_id", "level", "code", "probability", "verbalization")
    return out


def train(labelled: DataFrame, training: str = "entry", label: str = "pool", text: str = "text", lower: bool = False) -> DataFrame:
    """training, pool, word, p of labelled texts; rows without a label or text teach nothing."""
    known = labelled.where((F.col(label) != "") & F.col(text).isNotNull())
    return probabilities(train_counts(known, label, text, lower)).select(F.lit(training).alias("training"), "pool", "word", "p")


def try_out(labelled: DataFrame, model: DataFrame, training: str = "entry", label: str = "pool", text: str = "text", lower: bool = False) -> DataFrame:
    """label, code, probability: what a model says of each labelled text; code is null where it says nothing."""
    rows = labelled.where(F.col(label) != "").select(F.col(label).alias("label"), F.col(text).alias("text"))
    rows = scratch.write(rows.withColumn("id", F.monotonically_increasing_id()), "labelled")
    best = guess(score(rows, model.where(F.col("training") == training), doc_id="id", lower=lower))
    return rows.join(best.select(F.col("doc_id").alias("id"), F.col("pool").alias("code"), F.col("score").alias("probability")), "id", "left").select("label", "code", "probability")
