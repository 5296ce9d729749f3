"""One pass over a document for everything asked of it (inventory X1-X8, X13, X14, A1, A2).

Location paths and selectors are compiled into one automaton over start and end events: every
step of every path is a bit, a node's state is the set of steps its children may take (and
of those any descendant may), and what an element name does to a state is looked up in a
table that fills as names come.  A document is parsed once, by expat, whatever number of
values, texts, lists and paths is read from it; a malformed one gives its errors (at most
ten, with places) and nothing else.

Paths: ``/a/b``, ``//b``, ``*``, ``@k``, ``@*``, ``.``-free steps with ``[n]``, ``[@k]`` and
``[@k='v']``, and a last ``text()``; others are not compiled (``compile_path`` gives None).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ERRORS = 10
ERRORS = "array<struct<line:int,column:int,message:string>>"
ERROR_TYPE = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("column", T.IntegerType()), T.StructField("message", T.StringType())]))

_NAME = r"[^\W\d][\w.\-]*(?::[^\W\d][\w.\-]*)?"
_STEP = re.compile(rf"(//?)(?:(?P<attr>@)(?P<key>{_NAME}|\*)$|(?P<text>text\(\))$|(?P<name>{_NAME}|\*)(?P<tests>(?:\[[^\]]*\])*))")
_TEST = re.compile(rf"\[\s*(?:(?P<at>\d+)|@(?P<key>{_NAME})(?:\s*=\s*(?:'(?P<one>[^']*)'|\"(?P<two>[^\"]*)\"))?|(?P<word>@class)~=(?P<cls>[\w-]+)|(?P<nth>nth-child)=(?P<n>\d+))\s*\]")


@dataclass(frozen=True)
class Step:
    """A name or ``*``, whether any descendant may take it, and its tests in order."""

    name: str
    deep: bool
    tests: tuple[tuple, ...] = ()


@dataclass(frozen=True)
class Path:
    """Steps to an element, and what of it is meant: the element, an attribute (``*``: any) or its own texts."""

    steps: tuple[Step, ...]
    attribute: str | None = None
    text: bool = False


def compile_path(path: str) -> Path | None:
    """A location path of the subset above; None for any other expression."""
    rest = path.strip()
    if not rest.startswith("/"):
        rest = f"/{rest}"
    steps: list[Step] = []
    while rest:
        m = _STEP.match(rest)
        if not m:
            return None
        rest, deep = rest[m.end() :], m[1] == "//"
        if m["attr"] or m["text"]:
            if deep:
                steps.append(Step("*", True))
            return Path(tuple(steps), m["key"], bool(m["text"])) if steps else None
        tests, left = [], m["tests"] or ""
        while left:
            t = _TEST.match(left)
            if not t or t["cls"] or t["nth"]:
                return None
            left = left[t.end() :]
            value = t["one"] if t["one"] is not None else t["two"]
            tests.append(("at", int(t["at"])) if t["at"] else ("has", t["key"]) if value is None else ("is", t["key"], value))
        steps.append(Step(m["name"], deep, tuple(tests)))
    return Path(tuple(steps))


def compile_selector(selector: str) -> Path:
    """A CSS selector of names, ``>``, blanks, ``*``, ``#id``, ``.class``, ``[a]``, ``[a="v"]`` and ``:nth-child(n)``."""
    steps, deep = [], True
    for token in re.findall(r"\s*>\s*|\s+|[^\s>\[]+(?:\[[^\]]*\])*(?:[^\s>\[]+)*|(?:\[[^\]]*\])+", selector.strip()):
        if token.strip() in ("", ">"):
            deep = deep and token.strip() != ">"
            continue
        m = re.match(r"[\w*|-]*", token)
        tests: list[tuple] = []
        for attribute, ident, cls, nth in re.findall(r"\[([^\]]*)\]|#([\w-]+)|\.([\w-]+)|:nth-child\((\d+)\)", token[m.end() :]):
            if attribute:
                k, eq, v = (x.strip() for x in attribute.partition("="))
                tests.append(("is", k, v.strip("\"'")) if eq else ("has", k))
            else:
                tests.append(("is", "id", ident) if ident else ("word", "class", cls) if cls else ("child", int(nth)))
        steps.append(Step(m[0] or "*", deep, tuple(tests)))
        deep = True
    return Path(tuple(steps))


# ---------------------------------------------------------------- what to read
@dataclass(frozen=True)
class Reading:
    """What one pass gives: ``values`` (kind, path), ``texts`` (the text of all matches, once), ``lists`` (the text of each match), the paths of all elements."""

    values: tuple[tuple[str, Path], ...] = ()
    texts: tuple[Path, ...] = ()
    lists: tuple[Path, ...] = ()
    inventory: bool = False
    kinds: dict = field(default_factory=lambda: {"string": "string", "number": "double", "boolean": "boolean", "count": "bigint"}, compare=False)

    def schema(self) -> str:
        values = ",".join(f"v{i}:{self.kinds[k]}" for i, (k, _) in enumerate(self.values)) or "none:int"
        return f"struct<errors:{ERRORS},sound:boolean,{values},texts:array<string>,lists:array<array<string>>,paths:array<struct<xpath:string,n:bigint,attributes:array<string>>>>"


class _Automaton:
    """All paths' steps as bits, and the transitions found so far."""

    def __init__(self, paths: list[Path]):
        self.steps: list[Step] = []
        self.start_child = self.start_deep = 0
        self.next_child = self.next_deep = self.last = self.tested = 0
        self.path_of: dict[int, int] = {}
        for p, path in enumerate(paths):
            for i, step in enumerate(path.steps):
                bit = 1 << len(self.steps)
                self.steps.append(step)
                if i == 0:
                    self.start_deep |= bit * step.deep
                    self.start_child |= bit * (not step.deep)
                if i == len(path.steps) - 1:
                    self.last |= bit
                    self.path_of[len(self.steps) - 1] = p
                elif path.steps[i + 1].deep:
                    self.next_deep |= bit
                else:
                    self.next_child |= bit
                if step.tests:
                    self.tested |= bit
        self.by_name: dict[str, int] = {}
        self.moves: dict[tuple[int, int], tuple] = {}

    def named(self, name: str) -> int:
        m = self.by_name.get(name)
        if m is None:
            m = sum(1 << i for i, s in enumerate(self.steps) if s.name in ("*", name))
            if len(self.by_name) < 10_000:
                self.by_name[name] = m
        return m

    def move(self, taken: int, deep: int) -> tuple[int, int, tuple[int, ...]]:
        """(steps of children, steps of descendants, paths that end here)."""
        got = self.moves.get((taken, deep))
        if got is None:
            ends, m = [], taken & self.last
            while m:
                low = m & -m
                ends.append(self.path_of[low.bit_length() - 1])
                m ^= low
            got = ((taken & self.next_child) << 1, deep | (taken & self.next_deep) << 1, tuple(sorted(ends)))
            if len(self.moves) < 10_000:
                self.moves[taken, deep] = got
        return got


def to_number(text: str | None) -> float | None:
    """A number as location paths read it; None for anything else."""
    if text is None or not re.fullmatch(r"[ \t\r\n]*-?(?:\d+(?:\.\d*)?|\.\d+)[ \t\r\n]*", text, re.A):
        return None
    return float(text)


class Reader:
    """Reads documents one after the other."""

    def __init__(self, reading: Reading):
        self.reading = reading
        self.paths = [p for _, p in reading.values] + list(reading.texts) + list(reading.lists)
        self.automaton = _Automaton(self.paths)
        v, t = len(reading.values), len(reading.texts)
        self.roles = [("value", i) for i in range(v)] + [("text", i) for i in range(t)] + [("list", i) for i in range(len(reading.lists))]
        self.kind = [k for k, _ in reading.values]

    def read(self, document: str) -> dict:
        """errors, sound, v0.., texts, lists, paths of one document."""
        auto, roles, paths = self.automaton, self.roles, self.paths
        nv = len(self.kind)
        first: list[str | None] = [None] * nv
        count = [0] * nv
        texts: list[list[str]] = [[] for _ in self.reading.texts]
        open_text = [0] * len(texts)
        lists: list[list] = [[] for _ in self.reading.lists]
        buffer: list[str] = []
        opened = 0  # elements whose text is being gathered
        own: list = []  # value indices that wait for the first own text of the innermost element
        inventory: dict[str, list] = {}
        # frame: steps of children, steps of descendants, child counters, gathering, names of text() paths, xpath
        stack: list[tuple] = [(auto.start_child, auto.start_deep, {}, (), (), "")]
        seen_children: list[int] = [0]
        run: list[str] = []

        def flush() -> None:
            """Ends a text node: paths to own texts count it."""
            if run:
                waiting = stack[-1][4]
                if waiting:
                    node = "".join(run)
                    for what, i in waiting:
                        take(what, i, node)
                run.clear()

        def take(what: str, i: int, value: str) -> None:
            if what == "value":
                count[i] += 1
                if first[i] is None:
                    first[i] = value
            elif what == "text":
                texts[i].append(value)
            else:
                lists[i].append(value)

        def passes(bit: int, step: Step, attrs: dict, frame: tuple) -> bool:
            for k, test in enumerate(step.tests):
                kind = test[0]
                if kind == "at":
                    n = frame[2][bit, k] = frame[2].get((bit, k), 0) + 1
                    if n != test[1]:
                        return False
                elif kind == "child":
                    if seen_children[-1] != test[1]:
                        return False
                elif kind == "has":
                    if test[1] not in attrs:
                        return False
                elif kind == "is":
                    if attrs.get(test[1]) != test[2]:
                        return False
                elif test[2] not in attrs.get(test[1], "").split():
                    return False
            return True

        def start(name: str, attrs: dict) -> None:
            nonlocal opened
            flush()
            frame = stack[-1]
            seen_children[-1] += 1
            taken = (frame[0] | frame[1]) & auto.named(name)
            m = taken & auto.tested
            while m:
                low = m & -m
                if not passes(low, auto.steps[low.bit_length() - 1], attrs, frame):
                    taken ^= low
                m ^= low
            child, deep, ends = auto.move(taken, frame[1])
            gathering, waiting = [], []
            for p in ends:
                what, i = roles[p]
                if paths[p].attribute is not None:
                    keys = sorted(attrs) if paths[p].attribute == "*" else [paths[p].attribute] * (paths[p].attribute in attrs)
                    for k in keys:
                        take(what, i, attrs[k])
                elif paths[p].text:
                    waiting.append((what, i))
                elif what == "value":
                    count[i] += 1
                    if first[i] is None and self.kind[i] in ("string", "number"):
                        first[i] = ""  # the first in document order, whatever ends before it
                        gathering.append((what, i, len(buffer), 0))
                elif what == "text":
                    open_text[i] += 1
                    if open_text[i] == 1:
                        gathering.append((what, i, len(buffer), 0))
                    else:
                        gathering.append(("inner", i, 0, 0))
                else:
                    lists[i].append("")
                    gathering.append((what, i, len(buffer), len(lists[i]) - 1))
            opened += len(gathering)
            path = ""
            if self.reading.inventory:
                path = f"{frame[5]}/{name}"
                one = inventory.get(path)
                if one is None:
                    one = inventory[path] = [0, set()]
                one[0] += 1
                one[1].update(attrs)
            stack.append((child, deep, {}, gathering, waiting, path))
            seen_children.append(0)

        def end(_: str) -> None:
            nonlocal opened
            flush()
            frame = stack.pop()
            seen_children.pop()
            for what, i, at, k in frame[3]:
                if what == "inner":
                    open_text[i] -= 1
                    continue
                value = "".join(buffer[at:])
                if what == "value":
                    first[i] = value
                elif what == "text":
                    open_text[i] -= 1
                    texts[i].append(value)
                else:
                    lists[i][k] = value
            opened -= len(frame[3])
            if not opened and buffer:
                buffer.clear()

        def data(s: str) -> None:
            if opened:
                buffer.append(s)
            if stack[-1][4]:
                run.append(s)

        p = expat.ParserCreate("UTF-8")
        p.buffer_text = True
        p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = start, end, data
        p.CommentHandler = lambda _: flush()
        p.ProcessingInstructionHandler = lambda *_: flush()
        try:
            p.Parse(document.encode(), True)
        except expat.ExpatError as e:
            return {"errors": errors_of(document, e), "sound": False}
        out = {"errors": [], "sound": True, "texts": ["".join(t) for t in texts], "lists": lists}
        if self.reading.inventory:
            out["paths"] = [{"xpath": k, "n": n, "attributes": sorted(a)} for k, (n, a) in inventory.items()]
        for i, kind in enumerate(self.kind):
            out[f"v{i}"] = count[i] if kind == "count" else count[i] > 0 if kind == "boolean" else to_number(first[i]) if kind == "number" else first[i] or None
        return out


def reader(reading: Reading) -> Callable[[Column], Column]:
    """A column function of a text by ``reading``; all fields but errors and sound are null where it is malformed, and all of a null text."""
    schema = reading.schema()
    names = re.findall(r"(?:^struct<|,)(errors|sound|v\d+|none|texts|lists|paths):", schema)

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = Reader(reading)
        for texts in batches:
            rows = [one.read(t) if t is not None else {} for t in texts]
            yield pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})

    return lambda text: F.when(text.isNotNull(), run(text))


# ---------------------------------------------------------------- errors of malformed documents
_TOKEN = re.compile(r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!DOCTYPE[^\[>]*(?:\[.*?\]\s*)?>|<(/?)([^\W\d][\w.:\-]*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*)(>|(?=<)|$)|<|&(?!(?:#\d+|#x[0-9A-Fa-f]+|[^\W\d][\w.\-]*);)|[^<&]+|&", re.S)
_ATTRIBUTE = re.compile(r"\s+([^\W\d][\w.:\-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")


def errors_of(document: str, found: expat.ExpatError | None = None, limit: int = MAX_ERRORS) -> list[dict]:
    """At most ``limit`` faults of a malformed document, in order of their places (line from 1, column from 0).

    The parser stops at the first; the others come from a scan of the tags with a stack of
    open elements that goes on behind each fault: an end tag that fits an outer element
    closes the inner ones, one that fits none is passed over."""
    faults: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    roots = 0

    def tag(m: re.Match) -> None:
        nonlocal roots
        closing, name, rest, close = m[1], m[2], m[3], m[4]
        if close != ">":
            faults.append((m.start(), f"tag {name} is not finished"))
        if closing:
            if stack and stack[-1][0] == name:
                stack.pop()
            elif any(n == name for n, _ in stack):
                while stack[-1][0] != name:
                    inner, _ = stack.pop()
                    faults.append((m.start(), f"end tag {name} where {inner} is open"))
                stack.pop()
            else:
                faults.append((m.start(), f"end tag {name} without its start"))
            return
        body = rest[:-1] if rest.endswith("/") else rest
        at, names = 0, set()
        for a in _ATTRIBUTE.finditer(body):
            if body[at : a.start()].strip():
                break
            if a[1] in names:
                faults.append((m.start(), f"attribute {a[1]} twice in tag {name}"))
            names.add(a[1])
            if "<" in (a[2] or a[3] or ""):
                faults.append((m.start(), f"attribute {a[1]} holds a <"))
            at = a.end()
        if body[at:].strip():
            faults.append((m.start(), f"attributes of tag {name} are malformed"))
        if not stack:
            roots += 1
            if roots == 2:
                faults.append((m.start(), "content after the outermost element"))
        if not rest.endswith("/"):
            stack.append((name, m.start()))

    for m in _TOKEN.finditer(document):
        t = m[0]
        if m[2]:
            tag(m)
        elif t == "<":
            faults.append((m.start(), "a comment, section or instruction is not finished" if document.startswith(("<!", "<?"), m.start()) else "a < that begins no tag"))
        elif t == "&":
            faults.append((m.start(), "an & that begins no reference"))
        elif not stack and t[0] not in "<" and t.strip(" \t\r\n﻿"):
            faults.append((m.start() + len(t) - len(t.lstrip(" \t\r\n﻿")), "text outside the outermost element"))
        if len(faults) > limit:
            break
    if not roots and not faults:
        faults.append((len(document), "no element found"))
    for name, _ in reversed(stack):
        faults.append((len(document), f"element {name} is not closed"))
    lines: list[dict] = []
    line, last = 1, 0
    for at, message in faults:
        line, last = line + document.count("\n", last, at), at
        lines.append({"line": line, "column": at - (document.rfind("\n", 0, at) + 1), "message": message})
    if found is not None:
        own = {"line": found.lineno, "column": found.offset, "message": expat.errors.messages[found.code]}
        # The parser's own message first; the scan's fault on that line is the same one, said in other words.
        same = next((i for i, x in enumerate(lines) if x["line"] == own["line"]), None)
        if same is not None:
            lines.pop(same)
        lines = sorted([own, *lines], key=lambda x: x["line"])
    return lines[:limit]
