"""Column functions over text: tokens, tags, sanitising, runs, stems (inventory W1-W14, P11, N1, T2)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The white space of the tokeniser's split, and its word pattern.
SPACE = r"[\t\n\x0B\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
WORD = r"^([^a-zA-Z0-9]*)(\w+)([^a-zA-Z0-9]*)$"
SEPARATOR = "#"
UNKNOWN_TAG = "NND"


def tokenize(text: Column) -> Column:
    """Lower-cased words in order, with ``#`` where a word carried punctuation at an edge.

    A word with punctuation inside is left out; nothing marks its place.  One pass takes
    the words apart (edge, core, edge; or an underscore between edges, where nothing else is
    a word character; or nothing, if the word is no good), a second one puts ``#`` for edges.
    Every match takes a whole word, by classes that share no character or never give any
    back, so the time grows with the text, whatever is in it."""
    space = SPACE[1:-1]
    edge, other, end = f"[^a-z0-9{space}]", f"[^a-z0-9_{space}]", f"(?![^{space}])"
    word = f"({edge}*+)([a-z0-9][a-z0-9_]*+)({edge}*+){end}|({edge}*)(_)({other}*+){end}|[^{space}]++"
    parts = F.regexp_replace(F.lower(text), F.lit(word), F.lit(" \x01$1$4 $2$5 \x01$3$6 "))
    marked = F.replace(F.regexp_replace(parts, F.lit("\x01[^ ]++"), F.lit(SEPARATOR)), F.lit("\x01"), F.lit(""))
    return F.array_remove(F.split(marked, f"{SPACE}+"), "")


def word_tokens(text: Column, lower: bool = False) -> Column:
    r"""All ``\w+`` of a text, case kept unless asked: the classifier's tokens."""
    return F.regexp_extract_all(F.lower(text) if lower else text, F.lit(r"(\w+)"), F.lit(1))


def is_sane(token: Column) -> Column:
    """Four characters, at most two outside \\w, fewer than two digits."""
    return (F.length(token) >= 4) & (F.length(F.regexp_replace(token, r"\w", "")) <= 2) & (F.regexp_count(token, F.lit(r"\d")) < 2)


def sanitize(tokens: Column, stop_words: list[str]) -> Column:
    """Tokens that fail, or are stop-words, become separators; places stay."""
    keep = lambda t: is_sane(t) & ~t.isin(stop_words) if stop_words else is_sane(t)
    return F.transform(tokens, lambda t: F.when(keep(t), t).otherwise(F.lit(SEPARATOR)))


def runs(tokens: Column) -> Column:
    """Maximal runs between separators, each as its words joined by a space.

    With tokens already reduced to lemmas and everything that is neither noun nor
    adjective turned into a separator, these are the composite-term candidates."""
    return F.filter(F.transform(F.split(F.array_join(tokens, " "), SEPARATOR), lambda r: F.btrim(r)), lambda r: r != "")


def terms(tokens: Column) -> Column:
    """Every word of every run, and every run of several words once."""
    r = runs(tokens)
    return F.concat(F.filter(tokens, lambda t: t != SEPARATOR), F.filter(r, lambda x: F.instr(x, " ") > 0))


def translate_tag(tag: Column) -> Column:
    """A part of speech for the lemmatiser, null for others; nouns are looked for first."""
    return F.when(tag.isin("RB"), "adv").when(tag == "JJ", "adj").when(tag.rlike("N[A-Z]{1,3}"), "noun").when(tag.rlike("V[A-Z]{1,3}"), "verb")


def strength(term: Column) -> Column:
    """Words in a term."""
    return F.size(F.split(term, " "))


def base_name(name: Column, extension: Column) -> Column:
    """A name without its extension, compared literally."""
    return F.when((extension != "") & F.endswith(name, extension) & (F.length(name) > F.length(extension)), F.substring(name, F.lit(1), F.length(name) - F.length(extension))).otherwise(name)


def tag_count(text: Column) -> Column:
    """Matches of ``<...>``, shortest first, across lines."""
    return F.regexp_count(text, F.lit(r"(?s)<.*?>"))


# ---------------------------------------------------------------- English stems (Porter2)
_VOWELS = set("aeiouy")
# Fixed values of the published algorithm.
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_LI = set("cdeghkmnrt")
_WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
_AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_STEP2 = (("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"))
_STEP3 = (("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"), ("ness", ""), ("ful", ""))
_STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic")


def _after_vowel_consonant(w: str, at: int) -> int:
    for i in range(at, len(w) - 1):
        if w[i] in _VOWELS and w[i + 1] not in _VOWELS:
            return i + 2
    return len(w)


def _short_syllable(w: str) -> bool:
    if len(w) == 2:
        return w[0] in _VOWELS and w[1] not in _VOWELS
    return len(w) > 2 and w[-3] not in _VOWELS and w[-2] in _VOWELS and w[-1] not in _VOWELS and w[-1] not in "wxY"


def porter2(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    w = w.removeprefix("'")
    if w in _WHOLE:
        return _WHOLE[w]
    w = "".join("Y" if c == "y" and (i == 0 or w[i - 1] in _VOWELS) else c for i, c in enumerate(w))
    r1 = next((len(p) for p in ("gener", "commun", "arsen") if w.startswith(p)), None) or _after_vowel_consonant(w, 0)
    r2 = _after_vowel_consonant(w, r1)
    for s in ("'s'", "'s", "'"):
        if w.endswith(s):
            w = w[: -len(s)]
            break
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and any(c in _VOWELS for c in w[:-2]):
        w = w[:-1]
    if w in _AFTER_1A:
        return w
    if w.endswith(("eed", "eedly")):
        cut = 3 if w.endswith("eed") else 5
        if len(w) - cut >= r1:
            w = w[:-cut] + "ee"
    else:
        for s in ("ingly", "edly", "ing", "ed"):
            if w.endswith(s):
                if any(c in _VOWELS for c in w[: -len(s)]):
                    w = w[: -len(s)]
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(_DOUBLES):
                        w = w[:-1]
                    elif r1 >= len(w) and _short_syllable(w):
                        w += "e"
                break
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWELS:
        w = w[:-1] + "i"
    for s, new in _STEP2:
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                w = w[: -len(s)] + new
            break
    else:
        if w.endswith("ogi") and len(w) - 3 >= r1 and w[-4:-3] == "l":
            w = w[:-1]
        elif w.endswith("li") and len(w) - 2 >= r1 and w[-3:-2] in _LI:
            w = w[:-2]
    for s, new in _STEP3:
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                w = w[: -len(s)] + new
            break
    else:
        if w.endswith("ative") and len(w) - 5 >= r2:
            w = w[:-5]
    for s in _STEP4:
        if w.endswith(s):
            if len(w) - len(s) >= r2:
                w = w[: -len(s)]
            break
    else:
        if w.endswith("ion") and len(w) - 3 >= r2 and w[-4:-3] in ("s", "t"):
            w = w[:-3]
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable(w[:-1]))):
        w = w[:-1]
    elif w.endswith("l") and len(w) - 1 >= r2 and w[-2:-1] == "l":
        w = w[:-1]
    return w.replace("Y", "y")


@F.pandas_udf(T.StringType())
def stem(words: pd.Series) -> pd.Series:
    """Porter2 stems; distinct words of a batch are stemmed once."""
    known = {w: porter2(w) for w in words.dropna().unique()}
    return words.map(known)
