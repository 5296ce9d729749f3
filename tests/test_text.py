"""Golden facts of the tokeniser, the term filter, run extraction and stems."""

import pytest
from pyspark.sql import functions as F

from docsieve.functions import text as X
from docsieve.operators import keyterms


def tokens(spark, s):
    return spark.createDataFrame([(s,)], "t string").select(X.tokenize(F.col("t"))).first()[0]


def test_tokenize(spark):
    assert tokens(spark, "We rowed home, then (late) slept!") == ["we", "rowed", "home", "#", "then", "#", "late", "#", "slept", "#"]
    assert tokens(spark, "") == []
    assert tokens(spark, None) is None
    assert tokens(spark, "été well-known (x) a b") == ["#", "t", "#", "#", "x", "#", "a", "b"]


def test_tokenize_word_by_word(spark):
    """Every short word over letters, digits, punctuation, underscores and other scripts, one at a time and together."""
    import itertools
    import re

    word = re.compile(r"^([^a-zA-Z0-9]*)(\w+)([^a-zA-Z0-9]*)$", re.A | re.S)
    words = ["".join(w) for n in range(1, 5) for w in itertools.product("aB0_-é#", repeat=n)]

    def plain(w):
        m = word.match(w.lower())
        return [] if m is None else ["#"] * bool(m[1]) + [m[2]] + ["#"] * bool(m[3])

    got = spark.createDataFrame([(w,) for w in words] + [("  \n ".join(words),), (" \ufeff\u00a0a,\u3000b\x0b",)], "t string").select("t", X.tokenize(F.col("t")).alias("k")).collect()
    for r in got[:-2]:
        assert r.k == plain(r.t), r.t
    assert got[-2].k == [k for w in words for k in plain(w)] and got[-1].k == ["a", "#", "b"]


def test_sanitize(spark):
    out = spark.createDataFrame([(["this", "is", "a", "sample", "test", "a1b2c"],)], "t array<string>").select(X.sanitize(F.col("t"), ["test"])).first()[0]
    assert out == ["this", "#", "#", "sample", "#", "#"]


@pytest.mark.parametrize("n, least", [(1, 1), (2000, 4), (100000, 7), (None, None)])
def test_filter_steps(spark, n, least):
    df = spark.createDataFrame([(n,)], "n int").select(keyterms.TermFilter().min_occur(F.col("n")))
    assert df.first()[0] == least


@pytest.mark.parametrize("tags, terms", [(["VB", "VBD"], 0), (["JJ", "NN", "VB"], 3), (["JJ", "NN", "VB", "NN"], 4)])
def test_runs(spark, tags, terms):
    words = [f"word{i}" if t[0] in "NJ" else "#" for i, t in enumerate(tags)]
    out = spark.createDataFrame([(words,)], "t array<string>").select(X.terms(F.col("t"))).first()[0]
    assert len(set(out)) == terms


def test_tags(spark):
    df = spark.createDataFrame([(t,) for t in ("RB", "JJ", "NNS", "VBD", "DT")], "t string").select(X.translate_tag(F.col("t")))
    assert [r[0] for r in df.collect()] == ["adv", "adj", "noun", "verb", None]


def test_base_name(spark):
    df = spark.createDataFrame([("a.b.xml", ".xml"), ("axml", ".xml"), ("a", "")], "n string, e string").select(X.base_name(F.col("n"), F.col("e")))
    assert [r[0] for r in df.collect()] == ["a.b", "axml", "a"]


def test_stems():
    # Pairs of the published sample vocabulary.
    pairs = {"consign": "consign", "consigned": "consign", "consistency": "consist", "knightly": "knight", "knots": "knot", "happy": "happi", "running": "run", "skies": "sky", "generally": "general", "hopping": "hop", "hoping": "hope", "relational": "relat"}
    assert {w: X.porter2(w) for w in pairs} == pairs


def test_keyword_pipeline(spark):
    docs = spark.createDataFrame([(1, "alpha beta, alpha beta gamma"), (2, ""), (3, None), (4, "a b c")], "doc_id long, text string")
    rows = {(r.doc_id, r.term): r for r in keyterms.keywords(docs, truncate=False).collect()}
    assert rows[1, "alpha"].frequency == 2 and rows[1, "alpha beta gamma"].strength == 3
    assert rows[1, "alpha"].specificity == 1.0
    log = {r.doc_id: r.missing for r in keyterms.stage_log(docs).collect()}
    assert log == {1: None, 2: "TOKENIZATION", 3: "TOKENIZATION", 4: "EXTRACTION"}
    cut = keyterms.keywords(docs).collect()
    assert {r.term for r in cut} == {"alpha", "beta"} and [r.rank for r in sorted(cut, key=lambda r: r.term)] == [1, 2]


def test_lexicon_and_lemmas(spark):
    docs = spark.createDataFrame([(1, "green houses stand")], "doc_id long, text string")
    lexicon = spark.createDataFrame([("green", "JJ"), ("houses", "NNS"), ("stand", "VB")], "token string, tag string")
    lemmas = spark.createDataFrame([("houses", "noun", 1, "hous"), ("houses", "noun", 2, "house")], "token string, pos string, ord int, lemma string")
    out = keyterms.term_frequency(docs, keyterms.Resources(lexicon=lexicon, lemmas=lemmas)).collect()
    assert {(r.term, r.strength) for r in out} == {("green", 1), ("house", 1), ("green house", 2)}


def test_tokenize_against_plain(spark):
    import random
    import re

    rng = random.Random(1)
    chars = ["a", "b", "1", "_", "_", "é", "!", "-", " ", " ", "\n", "\x01", "#", "日", "\ufeff", "\u00a0", "$", "\\"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(1500)]

    space = re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), X.SPACE)

    def plain(t):
        out = []
        for w in re.split(space, t.lower()):
            if m := re.match(r"^([^a-zA-Z0-9]*)([A-Za-z0-9_]+)([^a-zA-Z0-9]*)$", w):
                out += ["#"] * bool(m[1]) + [m[2]] + ["#"] * bool(m[3])
        return out

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", X.tokenize(F.col("t")).alias("k")).collect():
        assert r.k == plain(r.t), r.t


def test_tokenize_is_linear_on_junk(spark):
    import time

    junk = ["_" * 100_000 + "éa!b", "é" * 100_000 + "_" + "é" * 100_000, "_é" * 50_000 + "a", "a_" * 50_000 + "!", "_!" * 50_000, "a!" * 50_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(junk)], "i int, t string")
    begin = time.time()
    sizes = dict(df.select("i", F.size(X.tokenize(F.col("t")))).collect())
    assert sizes == {0: 0, 1: 3, 2: 2, 3: 2, 4: 3, 5: 0} and time.time() - begin < 20


def test_one_tokeniser_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "birch maple birch"), (2, ""), (3, None), (4, "!!")], "doc_id long, text string")
    found = keyterms.term_frequency(docs)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "birch", 2, 1), (1, "birch maple birch", 1, 3), (1, "maple", 1, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1


def test_lexicon_and_lemmas_look_each_token_up_once(spark, monkeypatch):
    """The table of outcomes and the join by token give the same; the former shuffles no tokens."""
    import random

    rng = random.Random(3)
    words = ["running", "leaves", "green", "oaks", "the1", "walked", "unknown", "stop", "abc", "x_yz"]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(rng.randrange(60)))) for i in range(40)] + [(99, None), (100, "")], "doc_id long, text string").repartition(3)
    lexicon = spark.createDataFrame([("running", "VBG"), ("leaves", "NNS"), ("green", "JJ"), ("oaks", "NNS"), ("walked", "VBD"), ("stop", "NN"), ("#", "NN")], "token string, tag string")
    lemmas = spark.createDataFrame([("leaves", "noun", 1, "leave"), ("leaves", "noun", 2, "leaf"), ("oaks", "noun", 1, "stop"), ("unknown", "noun", 1, "unknowable"), ("green", "verb", 1, "no")], "token string, pos string, ord int, lemma string")
    for lex, lem in ((lexicon, lemmas), (lexicon, None), (None, lemmas)):
        resources = keyterms.Resources(("stop",), lexicon=lex, lemmas=lem)
        key = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
        quick = keyterms.term_frequency(docs, resources)
        plan = quick._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and plan.count("Generate") == 1
        log = key(keyterms.stage_log(docs, resources))
        monkeypatch.setattr(keyterms, "WORDS", 1)
        slow = key(keyterms.term_frequency(docs, resources))
        assert "Join" in keyterms.term_frequency(docs, resources)._jdf.queryExecution().optimizedPlan().toString()
        assert key(quick) == slow and len(slow) > 20 and key(keyterms.stage_log(docs, resources)) == log
        monkeypatch.undo()
    assert ("99", "TOKENIZATION") in log and ("100", "TOKENIZATION") in log
