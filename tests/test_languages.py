"""Languages: profiles on held-out documents, scripts, mixed texts, noise."""

import os

import pytest
from pyspark.sql import functions as F

from docsieve.functions import language

SF = "/root/testdata/sf0.01"
RUSSIAN = "Съешь же ещё этих мягких французских булок, да выпей чаю. Широкая электрификация южных губерний даст мощный толчок подъёму сельского хозяйства."
NOISE = "qzx vbk jwq zzkx pqwv xkcd hjkl zxcv qwrt bnmx kjhg wqzx vbnm qqwz xxvk jjqz wvbx zq"
# Enough of two languages to know them by.
FRENCH = "Le renard passe par la forêt et les oiseaux chantent dans les arbres pendant que le vent souffle sur la plaine et que la rivière coule vers la mer. "
ENGLISH = "The fox walks through the forest and the birds sing in the trees while the wind blows over the plain and the river flows towards the sea. "


@pytest.fixture(scope="module")
def find(spark):
    own = spark.createDataFrame([("fr", FRENCH), ("en", ENGLISH), ("fr", None), (None, ENGLISH)], "lang string, text string")
    return language.detector(language.profiles(own))


def answers(spark, f, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2)
    return [r.l for r in sorted(df.select("i", f(F.col("t")).alias("l")).collect(), key=lambda r: r.i)]


def test_scripts_noise_and_empty(spark, find):
    for f in (find, language.detect):
        russian, noise, empty, null, digits = answers(spark, f, [RUSSIAN, NOISE, "", None, "12 34 !!"])
        assert russian.reliable and russian.languages[0].name == "RUSSIAN" and russian.languages[0].percent == 100
        for r in (noise, empty, null, digits):
            assert not r.reliable and r.languages == []
    japanese, = answers(spark, find, ["日本語の文章です。" * 5])
    assert japanese.languages[0].code == "ja"


def test_mixed_texts_list_both(spark, find):
    both, french = answers(spark, find, [FRENCH * 20 + ENGLISH * 8, FRENCH])
    assert [x.code for x in both.languages] == ["fr", "en"] and both.languages[0].percent > 60 and 20 < both.languages[1].percent < 40 and both.reliable
    assert [(x.code, x.name, x.percent) for x in french.languages] == [("fr", "FRENCH", 100)] and french.reliable


def test_long_and_many(spark, find):
    out = answers(spark, find, [ENGLISH * 9000, *[FRENCH] * 50])
    assert out[0].languages[0].code == "en" and all(r.languages[0].code == "fr" for r in out[1:])


def test_no_profiles(spark):
    f = language.detector(language.profiles(spark.createDataFrame([], "lang string, text string")))
    russian, english = answers(spark, f, [RUSSIAN, ENGLISH])
    assert russian.languages[0].code == "ru" and english.languages == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    find = language.detector(language.profiles(docs.where("doc_id % 2 = 0")))
    found = docs.where("doc_id % 2 = 1").select("lang", find(F.col("text")).alias("l")).select("lang", F.try_element_at("l.languages", F.lit(1))["code"].alias("code"))
    by = {r.lang: r for r in found.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("code") == F.col("lang")).alias("right")).collect()}
    assert len(by) == 4 and all(r.right >= 0.98 * r.n for r in by.values())


def test_markup_is_left_out(spark):
    df = spark.createDataFrame([("<p class='the of and'>Le <b>renard</b></p>",)], "t string")
    assert df.select(language.without_markup(F.col("t"))).first()[0].split() == ["Le", "renard"]


ODD = ["", " ", "a", "12 ab, çb!", "l'été à la mer", "日本語の文章です。日本", "ǆ x" * 9, "𐐨𐐩 𐐨𐐩𐐪 a", "the fox " * 70, "--ab--", "straße ﬁ" * 40]


def plain(text):
    """Letters of a lower-cased text with one space around every word, in the plain way."""
    import unicodedata

    return f" {' '.join(''.join(c if unicodedata.category(c)[0] == 'L' else ' ' for c in text).split())} "


def test_trigrams_of_blocks(monkeypatch):
    """Small blocks and a small cube count what a plain count does, texts with rare letters and long ones too."""
    from collections import Counter

    monkeypatch.setattr(language, "BLOCK", language.SPAN)
    for cube in (3, 8, 128):
        monkeypatch.setattr(language, "CUBE", cube)
        got = Counter()
        for _, points, sizes in language._blocks(ODD):
            for grams, n in language._counts(points, sizes):
                got.update({"".join(map(chr, g)): int(k) for g, k in zip(grams, n, strict=True)})
        assert got == Counter(t[i : i + 3] for t in map(plain, ODD) for i in range(len(t) - 2))


def test_profiles_read_texts_once(spark, tmp_path):
    spark.createDataFrame([("fr", FRENCH), ("en", ENGLISH), ("en", None), (None, ENGLISH), ("de", "")], "lang string, text string").write.parquet(str(tmp_path / "t"))
    table = language.profiles(spark.read.parquet(str(tmp_path / "t")), top=5)
    rows = table.collect()
    assert sorted((r.code, r.gram == "") for r in rows) == [(c, g) for c in ("en", "fr") for g in (False,) * 5 + (True,)]
    run = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert run.count("MapInArrow") == 1
    assert sorted((r.code, r.gram) for r in language.profiles(spark.read.parquet(str(tmp_path / "t")), top=0).collect()) == [("en", ""), ("fr", "")]


def test_profiles_are_computed_once(spark):
    """The detector takes a table of profiles in one job."""
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    table = spark.createDataFrame([("en", "the", -5), ("en", "", -9)], "code string, gram string, weight int").coalesce(1).mapInPandas(watched, "code string, gram string, weight int")
    language.detector(table)
    assert seen.value == 2


def test_too_many_languages(spark):
    with pytest.raises(ValueError, match="100 languages"):
        language.detector(spark.range(101).selectExpr("cast(id as string) as code", "'' as gram", "-9 as weight"))


def plain_votes(rows, text):
    """Spans of a text judged one trigram at a time; all profiles are Latin."""
    import unicodedata
    from collections import Counter

    weight = {(c, g): w for c, g, w in rows}
    t, out = plain(text), {}
    grams = [t[i : i + 3] for i in range(len(t) - 2)]
    for i in range(0, len(grams), language.SPAN):
        span = grams[i : i + language.SPAN]
        script = Counter(n for g in span for n in [unicodedata.name(g[1]).split()[0]] if n in ("LATIN", "CYRILLIC")).most_common(1)
        code, margin = "", 0
        if script and script[0][0] == "LATIN":
            score = sorted((-sum(weight.get((c, g), weight[c, ""]) for g in span), c) for c in ("en", "fr"))
            if 2 * sum((score[0][1], g) in weight for g in span) >= len(span):
                code, margin = score[0][1], score[1][0] - score[0][0]
        elif script:
            code, margin = "ru", 1000 * len(span)
        one = out.setdefault(code, [0, 0])
        one[0], one[1] = one[0] + len(span), one[1] + margin
    return out


@pytest.mark.parametrize("places", [0, 1 << 22])
def test_votes_of_blocks(spark, find, monkeypatch, places):
    """Small blocks, long texts, tabled and searched trigrams give what a plain vote gives."""
    monkeypatch.setattr(language, "CUBE_SIZE", places)
    own = spark.createDataFrame([("fr", FRENCH), ("en", ENGLISH)], "lang string, text string")
    rows = [(r.code, r.gram, r.weight) for r in language.profiles(own).collect()]
    texts = [x.lower() for x in ("", "a", "12", FRENCH, NOISE, FRENCH * 9 + ENGLISH * 5, RUSSIAN * 3 + NOISE * 4 + ENGLISH, "", ENGLISH[:60])]
    want = [plain_votes(rows, x) for x in texts]
    for block in (language.SPAN, 2 * language.SPAN, 5000 * language.SPAN):
        monkeypatch.setattr(language, "BLOCK", block)
        assert language._Model(rows).votes(texts) == want
