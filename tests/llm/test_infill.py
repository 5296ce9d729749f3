"""Fill-in-the-middle against a plain version, with escapes, sentinels, nulls and clashing columns."""

import hashlib
import random
import re

import pytest

from docsieve.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    t = text or ""
    units = UNIT.findall(t)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, None, t, t)
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return (doc_id, n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}", t)
    return (doc_id, n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}", t)


def texts():
    rng = random.Random(5)
    odd = ["\x01", "\x02", "a", "b", " ", "\n", "é", "\u00a0", "日", "<", "P>", "<S", "\t\t", "$0", "\\", "\x00", "😀", "\x0b", "\x1c"]
    out = ["".join(rng.choice(odd) for _ in range(rng.randrange(40))) for _ in range(400)]
    out += [None, "", " ", "\n\n", "one", "one ", " one", "<P>", "a <M> b", "x\x02bx\x01\x02a", "\x01" * 50, "word " * 60_000, " " * 100_000 + "x" + " " * 100_000, "y" * 300_000]
    return out


@pytest.fixture(scope="module")
def rows():
    t = texts()
    return [*enumerate(t), (None, "a null id of some words"), (None, None), (7, "an id again"), (12, t[12]), (12, t[12])]


def test_against_plain(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id long, text string, form string, N int").repartition(3)
    out = infill.transform(df).withColumn("again", infill.restore(infill.F.col("output"), infill.F.col("form")))
    assert set(out.columns) == {"doc_id", "text", "n", "form", "prefix", "middle", "suffix", "output", "again"}
    got = [tuple(r) for r in out.select("doc_id", "n", "form", "prefix", "middle", "suffix", "output", "again").collect()]
    want = [plain(*r) for r in rows]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[2] for r in want} == {"plain", "spm", "psm"}


def test_parameters_and_empty(spark):
    df = spark.createDataFrame([(i, f"some words of text {i}") for i in range(300)], "doc_id long, text string")
    forms = lambda **k: {r.form for r in infill.transform(df, **k).collect()}
    assert forms(rate=0) == {"plain"} and forms(rate=100, spm=100) == {"spm"} and forms(rate=100, spm=0) == {"psm"}
    other = {r.doc_id: r.prefix for r in infill.transform(df, seed=1, rate=100).collect()}
    assert any(other[r.doc_id] != r.prefix for r in infill.transform(df, rate=100).collect())
    assert infill.transform(df.limit(0)).collect() == []


def test_one_replacement_and_no_shuffle(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plan = infill.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1 and "Exchange" not in plan and "Python" not in plan
