"""Language identification (inventory W14, P5, P17): scripts, trigram profiles, function words.

``profiles`` learns from labelled texts which trigrams of letters each language uses and how
likely they are; ``detector`` makes a column function of such a table.  A text is voted on
in spans of ``SPAN`` trigrams: a span's script tells which languages are candidates (or
decides alone, where no profile is written in it), and of these the one with the largest
log-likelihood gets the span, if it knows at least half of the trigrams.  Percentages are
shares of the spans' trigrams, so texts in several languages show them all.

``detect`` needs no profiles: scripts, and function words of four languages.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common function words by language code.
FUNCTION_WORDS = {
    "de": ("der", "die", "das", "und", "in", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "this", "are", "or"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al", "lo"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "au", "ne", "se"),
}
# Names by code, as users of such results expect them.
NAMES = {
    "ar": "ARABIC", "bg": "BULGARIAN", "cs": "CZECH", "da": "DANISH", "de": "GERMAN", "el": "GREEK", "en": "ENGLISH", "es": "SPANISH", "fi": "FINNISH", "fr": "FRENCH",
    "hi": "HINDI", "hu": "HUNGARIAN", "hy": "ARMENIAN", "it": "ITALIAN", "iw": "HEBREW", "ja": "Japanese", "ka": "GEORGIAN", "ko": "Korean", "nl": "DUTCH", "no": "NORWEGIAN",
    "pl": "POLISH", "pt": "PORTUGUESE", "ro": "ROMANIAN", "ru": "RUSSIAN", "sv": "SWEDISH", "th": "THAI", "tr": "TURKISH", "uk": "UKRAINIAN", "vi": "VIETNAMESE", "zh": "Chinese",
}
# Scripts by first and last code point, and the language a script stands for without profiles.
SCRIPTS = (
    ("Latin", 0x0041, 0x024F, None), ("Greek", 0x0370, 0x03FF, "el"), ("Cyrillic", 0x0400, 0x052F, "ru"), ("Armenian", 0x0530, 0x058F, "hy"), ("Hebrew", 0x0590, 0x05FF, "iw"),
    ("Arabic", 0x0600, 0x06FF, "ar"), ("Devanagari", 0x0900, 0x097F, "hi"), ("Thai", 0x0E00, 0x0E7F, "th"), ("Georgian", 0x10A0, 0x10FF, "ka"), ("Latin", 0x1E00, 0x1EFF, None),
    ("Greek", 0x1F00, 0x1FFF, "el"), ("Kana", 0x3040, 0x30FF, "ja"), ("Han", 0x4E00, 0x9FFF, "zh"), ("Hangul", 0xAC00, 0xD7AF, "ko"),
)
MIN_HITS = 3
WORDS = r"[^\p{L}]+"

#: Trigrams kept of each language, trigrams to a span, and languages listed.
TOP, SPAN, LISTED = 2000, 200, 3
#: Letters looked at in one go (whole spans), and letters to an edge of the cube that trigrams are counted in.
BLOCK, CUBE = 5000 * SPAN, 128
#: Places of a table of all trigrams of the profiles' letters, at most (beyond, they are searched), and bits of a sum of weights.
CUBE_SIZE, WEIGHT_BITS = 1 << 22, 40
#: Reliable: so many trigrams of the first language at least, a mean margin (in 1/1000 of a nat), and half of the text.
LEAST, MARGIN = 12, 50
MAX_LANGUAGES = 100

KIND = "struct<reliable:boolean,languages:array<struct<name:string,code:string,percent:int,score:double>>>"


def _let(x: Column, f) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` names it."""
    return F.transform(F.array(x), f)[0]


# ---------------------------------------------------------------- trigram profiles
@functools.lru_cache(None)
def _is_letter(code: int) -> bool:
    return unicodedata.category(chr(code))[0] == "L"


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _present(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct code points, and how often each is there."""
    n = np.bincount(points)
    some = np.flatnonzero(n)
    return some, n[some]


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased texts in a row, only letters, with one space around every word; how many each text has."""
    points = _points(" " + "  ".join(texts) + " ")
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    start = np.cumsum(size) - size
    some, _ = _present(points)
    of = np.zeros(some[-1] + 1, bool)
    of[some] = [_is_letter(int(c)) for c in some]
    letter = of[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[start] = True
    return np.where(letter, points, np.uint32(32))[keep], np.add.reduceat(keep, start, dtype=np.int64)


def _blocks(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts as ``_letters`` in blocks of some ``BLOCK`` letters: number of the first text, code points, how many each text has.

    A longer text comes in several blocks, with whole spans of trigrams each: a block shares two letters with the next one."""
    first, size = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or size + len(texts[i]) > BLOCK:
            if i > first:
                points, sizes = _letters(texts[first:i])
                if len(sizes) > 1 or len(points) <= BLOCK + 2:
                    yield first, points, sizes
                else:
                    for at in range(0, len(points) - 2, BLOCK):
                        part = points[at : at + BLOCK + 2]
                        yield first, part, np.array([len(part)])
            first, size = i, 0
        if i < len(texts):
            size += len(texts[i])


def _ends(sizes: np.ndarray) -> np.ndarray:
    """Where no trigram starts, as its text ends: the last two places of each text (but for the last two of all)."""
    end = np.cumsum(sizes)
    at = np.concatenate([end - 1, end[sizes > 1] - 2])
    return at[at < end[-1] - 2]


def _counts(points: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points of distinct trigrams, a row for each; how often each is there).

    Trigrams of the commonest letters are counted in a cube; those with other letters (as in scripts of thousands) are sorted."""
    if len(points) < 3:
        return
    some, n = _present(points)
    common = np.sort(some[np.argsort(-n, kind="stable")[: CUBE - 1]])
    k = len(common) + 1
    number = np.zeros(some[-1] + 1, np.int32)
    number[common] = np.arange(1, k)
    c = number[points]
    key = (c[:-2] * k + c[1:-1]) * k + c[2:]
    if len(common) < len(some):
        rare = c == 0
        rare = rare[:-2] | rare[1:-1] | rare[2:]
        key[rare] = k**3
        rare[_ends(sizes)] = False
        i = np.flatnonzero(rare)
        wide = points.astype(np.int64)
        found, n = np.unique(wide[i] << 42 | wide[i + 1] << 21 | wide[i + 2], return_counts=True)
        yield (found[:, None] >> np.array([42, 21, 0]) & 0x1FFFFF).astype(np.uint32), n
    key[_ends(sizes)] = k**3
    n = np.bincount(key, minlength=k**3 + 1)[: k**3]
    found = np.flatnonzero(n)
    yield common[np.stack([found // k**2, found // k % k, found % k], axis=1) - 1].astype(np.uint32), n[found]


def profiles(labelled: DataFrame, label: str = "lang", text: str = "text", top: int = TOP) -> DataFrame:
    """code, gram, weight of the ``top`` most frequent trigrams of each language, and of the gram '' for all others.

    Weights are 1000 log-probabilities with one more count for each gram.  Rows without a label or text teach nothing.
    Trigrams are counted within each task first; what is shuffled is distinct trigrams.  Texts are read once: totals and
    best trigrams both come from the one shuffle."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            by: dict[str, list[str]] = {}
            for code, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(code, []).append(x)
            for code, texts in by.items():
                for _, points, sizes in _blocks(texts):
                    for grams, n in _counts(points, sizes):
                        if len(n):
                            yield pa.record_batch({"code": pa.array([code] * len(n)), "gram": pa.array(np.ascontiguousarray(grams).view("<U3").ravel()), "n": pa.array(n, pa.int64())})

    rows = labelled.select(F.col(label).cast("string").alias("code"), F.col(text).alias("x")).where("code is not null and x is not null").select("code", F.lower("x").alias("x"))
    counts = rows.mapInArrow(count, "code string, gram string, n long").groupBy("code", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("code").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    best = counts.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy(F.desc("n"), "gram"))).where(F.col("r") <= max(top, 1))
    # the first row of a language also gives the one of all other trigrams
    own, rest = F.struct("gram", "n"), F.struct(F.lit("").alias("gram"), F.lit(0).cast("long").alias("n"))
    both = best.select("code", F.inline(F.when(F.col("r") > 1, F.array(own)).otherwise(F.array(own, rest) if top > 0 else F.array(rest))))
    # a row for each language
    return both.join(F.broadcast(totals), "code").select("code", "gram", F.round(1000 * F.ln((F.col("n") + 1) / (F.col("total") + F.col("kinds")))).cast("int").alias("weight"))


class _Model:
    """The profiles as arrays: for each language a weight and a mark of every trigram, packed into one integer so that spans are summed once."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        self.codes = sorted({c for c, _, _ in rows})
        index = {c: i for i, c in enumerate(self.codes)}
        grams = sorted({g for _, g, _ in rows if g})
        at = {g: i for i, g in enumerate(grams)}
        letters = _points("".join(grams)).reshape(-1, 3)
        rest = np.zeros(len(self.codes), np.int64)
        for c, g, w in rows:
            if not g:
                rest[index[c]] = w
        self.packed = np.tile(rest[:, None], (1, len(grams) + 2))
        self.other, self.void = len(grams), len(grams) + 1  # trigrams of no language; places that count for nothing
        self.packed[:, self.void] = 0
        known = np.zeros((len(self.codes), len(grams)), bool)
        for c, g, w in rows:
            if g:
                self.packed[index[c], at[g]], known[index[c], at[g]] = w + (1 << WEIGHT_BITS), True
        scripts = sorted({s[0] for s in SCRIPTS}) + [""]
        self.scripts = {s: i for i, s in enumerate(scripts)}
        some = np.unique(letters)
        end = max(SCRIPTS[-1][2], int(some.max(initial=0))) + 2  # the last place stands for all letters beyond
        self.kind = np.full(end, self.scripts[""], np.uint8)
        for name, first, last, _ in SCRIPTS:
            self.kind[first : last + 1] = self.scripts[name]
        self.edge = len(some) + 1
        self.number = np.zeros(end, np.int32 if self.edge**3 <= CUBE_SIZE else np.int64)
        self.number[some] = np.arange(1, self.edge)
        self.keys = self.key(self.number[letters.T])  # ascending, as the grams are
        self.place = None
        if self.edge**3 <= CUBE_SIZE:
            self.place = np.full(self.edge**3, self.other, np.int32)
            self.place[self.keys] = np.arange(len(grams))
        of = np.array([np.bincount(self.kind[letters[k, 1]], minlength=len(scripts)) for k in known]).reshape(-1, len(scripts))
        of[:, -1] = 0
        self.written = of.argmax(axis=1)
        alone = {s[0]: s[3] for s in SCRIPTS if s[3]}
        self.names = self.codes + sorted(set(alone.values()) - set(self.codes)) + [""]
        self.alone = np.array([self.names.index(alone[s]) if s in alone else -1 for s in scripts])

    def key(self, c) -> np.ndarray:
        return (c[0] * self.edge + c[1]) * self.edge + c[2]

    def spans(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """text, number of the language, trigrams and margin of each span of a block."""
        there = np.maximum(sizes - 2, 0)
        n = -(-there // SPAN)
        row = np.repeat(np.arange(len(sizes)), n)
        if not len(row):
            return row, row, row, row
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = (np.cumsum(sizes) - sizes)[row] + place * SPAN
        size = np.minimum(SPAN, there[row] - place * SPAN)
        p = np.minimum(points, len(self.number) - 1)
        c = self.number[p]
        key = self.key((c[:-2], c[1:-1], c[2:]))
        if self.place is not None:
            found = self.place[key]
        else:
            found = np.minimum(np.searchsorted(self.keys, key), self.other - 1)
            found = np.where(self.keys[found] == key, found, self.other)
        found[_ends(sizes)] = self.void
        kind = self.kind[p[1:-1]]  # of the letter in the middle; across two texts it is a space
        script = np.zeros((len(row), len(self.scripts)), np.int64)
        for s in np.flatnonzero(np.bincount(kind)):
            if s != self.scripts[""]:
                script[:, s] = np.add.reduceat((kind == s).astype(np.uint16), at, dtype=np.uint16)
        kana, han = self.scripts["Kana"], self.scripts["Han"]
        mixed = script[:, kana] > 0  # Han characters among Kana are Japanese
        script[mixed, kana] += script[mixed, han]
        script[mixed, han] = 0
        script = np.where(script.max(axis=1) > 0, script.argmax(axis=1), self.scripts[""])
        lone = self.alone[script]
        code, margin = np.where(lone < 0, len(self.names) - 1, lone), np.where(lone < 0, 0, 1000 * size)
        if self.codes:
            sums = np.stack([np.add.reduceat(w[found], at) for w in self.packed])
            half = 1 << WEIGHT_BITS - 1
            score = (sums + half & 2 * half - 1) - half
            known = sums - score >> WEIGHT_BITS
            fits = self.written[:, None] == script
            score = np.where(fits, score, -half)
            best = score.argmax(axis=0)  # of equal ones the first by code
            each = np.arange(len(row))
            top = score[best, each]
            score[best, each] = -half
            some = fits.any(axis=0)
            sure = some & (2 * known[best, each] >= size)
            code = np.where(sure, best, np.where(some, len(self.names) - 1, code))
            margin = np.where(sure, np.where(fits.sum(axis=0) > 1, top - score.max(axis=0), 1000 * size), np.where(some, 0, margin))
        return row, code, size, margin

    def votes(self, texts: list[str]) -> list[dict[str, list[int]]]:
        """For each lower-cased text: code -> [trigrams, margin]; the code '' holds what no language got."""
        out: list[dict[str, list[int]]] = [{} for _ in texts]
        blocks = [(first + row, *rest) for first, points, sizes in _blocks(texts) for row, *rest in [self.spans(points, sizes)]]
        if not blocks:
            return out
        row, code, size, margin = map(np.concatenate, zip(*blocks, strict=True))
        if not len(row):
            return out
        key = row * len(self.names) + code
        order = np.argsort(key, kind="stable")
        start = np.flatnonzero(np.diff(key[order], prepend=-1))
        for k, n, m in zip(key[order][start].tolist(), np.add.reduceat(size[order], start).tolist(), np.add.reduceat(margin[order], start).tolist(), strict=True):
            out[k // len(self.names)][self.names[k % len(self.names)]] = [n, m]
        return out


def detector(table: DataFrame) -> Callable[[Column], Column]:
    """A column function of a text by a table of profiles: struct(reliable, languages), best first.

    The table is at most ``TOP`` + 1 rows for each of ``MAX_LANGUAGES`` languages (checked), so it goes to all tasks; it is
    computed once, a row for each language.  Null and empty texts, and texts no language was found in, have no languages."""
    own = table.where("code is not null").groupBy("code").agg(F.collect_list(F.struct("gram", "weight")).alias("grams")).limit(MAX_LANGUAGES + 1).collect()
    if len(own) > MAX_LANGUAGES:
        raise ValueError(f"profiles of more than {MAX_LANGUAGES} languages")
    model = _Model([(r.code, x.gram, x.weight) for r in own for x in r.grams])
    shared = table.sparkSession.sparkContext.broadcast(model)

    def judged(votes: dict[str, list[int]]) -> dict:
        total = sum(n for n, _ in votes.values())
        order = sorted(((n, m, c) for c, (n, m) in votes.items() if c), key=lambda x: (-x[0], x[2]))
        listed = [{"name": NAMES.get(c, c.upper()), "code": c, "percent": 100 * n // total, "score": m // n / 1000} for n, m, c in order[:LISTED]]
        reliable = bool(order) and order[0][0] >= LEAST and order[0][1] // order[0][0] >= MARGIN and 2 * order[0][0] >= total
        return {"reliable": reliable, "languages": listed}

    @F.pandas_udf(KIND)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judged(v) for v in shared.value.votes(texts.fillna("").tolist())], columns=["reliable", "languages"])

    return lambda text: run(F.lower(text))


# ---------------------------------------------------------------- without profiles
def _by_script(text: Column) -> Column:
    """array of (score, code, name): letters of every script that stands for a language; none of Latin."""
    alone = {}
    for _, first, last, code in SCRIPTS:
        if code:
            alone.setdefault(code, []).append(f"\\x{{{first:04x}}}-\\x{{{last:04x}}}")
    return F.array(*[F.struct(F.regexp_count(text, F.lit(f"[{''.join(ranges)}]+")).alias("score"), F.lit(code).alias("code"), F.lit(NAMES[code]).alias("name")) for code, ranges in sorted(alone.items())])


def detect(text: Column) -> Column:
    """struct(reliable, languages array<struct<name, code, percent, score>>), best first, without profiles.

    Scores are function words, or words of a script that stands for one language.  Reliable:
    enough hits, and half as many again as the runner-up.  Nulls and texts without hits are
    not reliable and have no languages."""

    def ranked(counted: Column) -> Column:
        total = F.aggregate(counted, F.lit(0), lambda a, x: a + x["score"])
        order = F.array_sort(F.filter(counted, lambda x: x["score"] > 0), lambda a, b: F.when(a["score"] != b["score"], b["score"] - a["score"]).otherwise(F.when(a["code"] < b["code"], -1).otherwise(1)))
        return F.transform(order, lambda x: F.struct(x["name"].alias("name"), x["code"].alias("code"), F.floor(100 * x["score"] / total).cast("int").alias("percent"), x["score"].cast("double").alias("score")))

    def judged(languages: Column) -> Column:
        top, next_ = F.try_element_at(languages, F.lit(1)), F.try_element_at(languages, F.lit(2))
        reliable = F.coalesce((top["score"] >= MIN_HITS) & (top["score"] * 2 >= F.coalesce(next_["score"], F.lit(0.0)) * 3), F.lit(False))
        return F.struct(reliable.alias("reliable"), languages.alias("languages"))

    def counts(words: Column) -> Column:
        own = lambda c: F.size(F.filter(words, lambda w: w.isin(*FUNCTION_WORDS[c])))
        return F.array(*[F.struct(own(c).alias("score"), F.lit(c).alias("code"), F.lit(NAMES[c]).alias("name")) for c in sorted(FUNCTION_WORDS)])

    latin = _let(F.split(F.lower(text), WORDS), counts)
    others = F.when(text.rlike(r"[\x{0370}-\x{1dff}\x{1f00}-\x{1fff}\x{3040}-\x{d7af}]"), _by_script(text)).otherwise(F.slice(_by_script(F.lit("")), 1, 0))
    return _let(_let(F.concat(latin, others), ranked), judged)


def without_markup(text: Column) -> Column:
    """A text without tags, as XML and HTML are read."""
    return F.regexp_replace(text, r"<[^>]*+>", " ")


def passes_gate(detected: Column, code: str, percent: int) -> Column:
    first = F.try_element_at(detected["languages"], F.lit(1))
    return F.coalesce(detected["reliable"] & (first["percent"] >= percent) & (first["code"] == code), F.lit(False))
