"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams (bytes, A-Z
lower-cased) is derived that every match must satisfy.  For a block of texts the
postings of just the trigrams that queries name are built with array operations;
rows whose postings satisfy a rule's query are candidates and are verified by the
regular expression itself.  A rule without mandatory trigrams scans every text.
Nothing is shuffled and a task holds one block of texts at a time.

Offsets are in code points, ends exclusive; matches of a kind are leftmost and
do not overlap; those failing the rule's length test are dropped.

Defined cases: a null or empty text has no spans; rows with equal doc_id are
scanned one by one; in redaction overlapping spans merge and take the name of the
first; null texts stay null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import buffers, chunks, column, keyed, read_table, trimmed
from ._words import LOWER


@dataclass(frozen=True)
class Rule:
    """``group`` of each match must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


def _private_key() -> str:
    """A PEM or PGP private key up to its END line; where that is missing, to the end of its base64 run."""
    name = r"[A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
    to_end = rf"[^-]*+(?:-(?!----(?:BEGIN|END)\x20)[^-]*+)*+-----END {name}"
    headers = r"(?:\r?\n(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n]*+)*+"
    # Line breaks may be escaped, lines quoted and joined; a short line counts where it stands alone.
    between = r"""(?:[\s"'>|,]|\\[rnt]|\\(?=\r?\n)|\+(?=\s))++"""
    alone = r"""(?:(?<=\n)|(?<=\\n))[A-Za-z0-9+/]++={0,2}+(?=[\x20\t\r]*(?:[\n\\"']|\Z))"""
    run = rf"(?:{between}(?:[A-Za-z0-9+/]{{16,}}+={{0,2}}+|[A-Za-z0-9+/]{{2,}}+={{1,2}}+|=[A-Za-z0-9+/]{{4}}|{alone}))*+"
    return rf"-----BEGIN {name}(?:{to_end}|{headers}{run})"


# The base kinds, in the order that breaks ties.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("private_key", _private_key()),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}", any_case=True),
)
RULES = BASE + MORE

_EXACT = 64  # alternatives kept apart before they are turned into trigrams


# ---------------------------------------------------------------- regex -> trigram query
def _all(parts: list):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _any(parts: list):
    return True if any(p is True for p in parts) or not parts else parts[0] if len(parts) == 1 else ("or", parts)


def _of_strings(strings: set[bytes]):
    """Every match contains one of these strings."""
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)]) if strings else True


def _fold(code: int) -> bytes:
    return LOWER[np.frombuffer(chr(code).encode(), np.uint8)].tobytes()


def _members(items) -> set[bytes] | None:
    """The characters of a class, None if they are many or it is negated."""
    out: set[bytes] = set()
    for op, arg in items:
        if op is rc.LITERAL:
            out.add(_fold(arg))
        elif op is rc.RANGE and arg[1] - arg[0] < 8:
            out |= {_fold(c) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(tree) -> tuple[set[bytes] | None, object]:
    """(all strings it matches, if few; the query its matches satisfy)."""
    known, query = {b""}, []

    def break_off():
        nonlocal known
        query.append(_of_strings(known))
        known = {b""}

    pure = True
    for op, arg in tree:
        own: set[bytes] | None
        inner: object = True
        if op is rc.LITERAL:
            own = {_fold(arg)}
        elif op is rc.IN:
            own = _members(arg)
        elif op is rc.SUBPATTERN:
            own, inner = _walk(arg[3])
        elif op is rc.BRANCH:
            ways = [_walk(x) for x in arg[1]]
            own = set().union(*(w[0] for w in ways)) if all(w[0] is not None for w in ways) else None
            inner = True if own is not None else _any([w[1] for w in ways])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT, getattr(rc, "POSSESSIVE_REPEAT", None)):
            low, high, body = arg
            strings, one = _walk(body)
            if strings is not None and (low, high) in ((0, 1), (1, 1)):
                own = strings | ({b""} if low == 0 else set())
            else:
                own, inner = None, one if low else True
                if low and strings is not None:
                    inner = _of_strings(strings)
        elif op in (rc.AT, rc.ASSERT, rc.ASSERT_NOT):
            continue
        else:
            own = None
        joined = {a + b for a in known for b in own} if own is not None and len(known) * len(own) <= _EXACT else None
        if joined is not None:
            known = joined
            continue
        pure = False
        break_off()
        if own is not None and len(own) <= _EXACT:
            known = own
        else:
            query.append(inner if own is None else _of_strings(own))
    return (known, _of_strings(known)) if pure else (None, _all([*query, _of_strings(known)]))


def trigram_query(rule: Rule):
    """True (no mandatory trigrams), a trigram, or ("and" | "or", parts)."""
    return _walk(rp.parse(rule.pattern, re.ASCII))[1]


def _trigrams(query) -> set[bytes]:
    return set() if query is True else {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


class Index:
    """Builds postings of the queries' trigrams for a block of texts."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, r.compiled(), trigram_query(r)) for r in rules]
        self.number = {t: i for i, t in enumerate(sorted(set().union(*(_trigrams(q) for _, _, q in self.rules))))}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, i in self.number.items():
            self.table[int.from_bytes(t, "big")] = i + 1

    def postings(self, col: pa.Array) -> np.ndarray:
        """Row masks by trigram."""
        offsets, raw = buffers(col)
        rows = np.zeros((len(self.number) + 1, len(col)), bool)
        if len(raw) < 3:
            return rows
        b = LOWER[raw].astype(np.int32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        which = self.table[code]
        at = np.flatnonzero(which)
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 3 <= offsets[row + 1]
        rows[which[at[inside]], row[inside]] = True
        return rows

    def candidates(self, query, postings: np.ndarray) -> np.ndarray:
        if query is True:
            return np.ones(postings.shape[1], bool)
        if isinstance(query, bytes):
            return postings[self.number[query] + 1]
        masks = [self.candidates(q, postings) for q in query[1]]
        return np.logical_and.reduce(masks) if query[0] == "and" else np.logical_or.reduce(masks)

    def spans(self, col: pa.Array) -> list[list[tuple[str, int, int]]]:
        """Per row (kind, start, end), by start and then the order of the rules."""
        postings = self.postings(col)
        texts: dict[int, str] = {}
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(col))]
        whole = col.to_pylist() if any(q is True for _, _, q in self.rules) else None
        for i, (rule, pattern, query) in enumerate(self.rules):
            for r in np.flatnonzero(self.candidates(query, postings)).tolist():
                text = whole[r] if whole is not None else texts.setdefault(r, col[r].as_py())
                found[r] += [(m.start(), i, m.end()) for m in pattern.finditer(text) if len(m[rule.group]) >= rule.least]
        return [[(self.rules[i][0].kind, s, e) for s, i, e in sorted(x)] if x else x for x in found]


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans array<struct<kind, start, end>> per document."""
    docs = keyed(docs, doc_id, text)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules)
        for batch in it:
            for part, col in chunks(batch, text):
                rows = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in index.spans(col)]
                yield pa.record_batch([column(part, doc_id), pa.array(rows, _SPAN)], names=[doc_id, "spans"])

    return docs.mapInArrow(trimmed(run), f"`{doc_id}` {kind}, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``, all columns kept."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules)
        for batch in it:
            for part, col in chunks(batch, text):
                spans = index.spans(col)
                if not any(spans):
                    yield part
                    continue
                i = part.schema.get_field_index(text)
                texts = part.column(i).to_pylist()
                for r, found in enumerate(spans):
                    if found:
                        texts[r] = _cut(texts[r], found)
                yield part.set_column(i, part.schema.field(i), pa.array(texts, part.schema.field(i).type))

    return docs.mapInArrow(trimmed(run), docs.schema)


def _cut(text: str, spans: list[tuple[str, int, int]]) -> str:
    merged: list[list] = []
    for kind, s, e in spans:
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    out, last = [], 0
    for kind, s, e in merged:
        out += [text[last:s], f"[{kind.upper()}]"]
        last = e
    return "".join([*out, text[last:]])


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def op7(spark, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    base = [r.kind for r in BASE]
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select(
        "doc_id",
        *[_count(k).alias(f"n_{k}") for k in base],
        F.sha2(joined(F.filter("spans", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
