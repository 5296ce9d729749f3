"""Schema validation with places (inventory X11): content models as finite automata over the events of one parse.

A schema's types are compiled once: every content model becomes a position automaton (each
particle's first, last and following positions; bounded repeats are unrolled up to
``UNROLL``, larger ones count as unbounded), every simple type a list of checks.  Elements
are matched by their local names; namespaces, identity constraints and imports are not
looked at.  A document gives at most ten errors, in order of their places.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from decimal import Decimal, InvalidOperation
from xml.etree import ElementTree
from xml.parsers import expat

from .xmlread import MAX_ERRORS

UNROLL = 64
_XS = "{http://www.w3.org/2001/XMLSchema}"
_INTEGERS = {"integer": (None, None), "nonNegativeInteger": (0, None), "positiveInteger": (1, None), "nonPositiveInteger": (None, 0), "negativeInteger": (None, -1)}
_INTEGERS |= {name: (-(1 << bits - 1), (1 << bits - 1) - 1) for name, bits in (("long", 64), ("int", 32), ("short", 16), ("byte", 8))}
_INTEGERS |= {f"unsigned{name}": (0, (1 << bits) - 1) for name, bits in (("Long", 64), ("Int", 32), ("Short", 16), ("Byte", 8))}
_ZONE = r"(?:Z|[+-]\d\d:\d\d)?"
# The lexical forms of built-in types.
_FORMS = {
    "boolean": r"true|false|0|1", "decimal": r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)", "float": r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?|[+-]?INF|NaN", "double": r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?|[+-]?INF|NaN",
    "date": rf"-?\d{{4,}}-\d\d-\d\d{_ZONE}", "time": rf"\d\d:\d\d:\d\d(?:\.\d+)?{_ZONE}", "dateTime": rf"-?\d{{4,}}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?{_ZONE}", "gYear": rf"-?\d{{4,}}{_ZONE}", "gYearMonth": rf"-?\d{{4,}}-\d\d{_ZONE}",
    "duration": r"-?P(?=.)(?:\d+Y)?(?:\d+M)?(?:\d+D)?(?:T(?=.)(?:\d+H)?(?:\d+M)?(?:\d+(?:\.\d+)?S)?)?", "language": r"[a-zA-Z]{1,8}(?:-[a-zA-Z0-9]{1,8})*", "hexBinary": r"(?:[0-9a-fA-F]{2})*", "base64Binary": r"[A-Za-z0-9+/ \n\r\t]*={0,2}\s*",
    "NMTOKEN": r"[\w.:\-]+", "Name": r"[^\W\d][\w.:\-]*|:[\w.:\-]*", "NCName": r"[^\W\d][\w.\-]*", "ID": r"[^\W\d][\w.\-]*", "IDREF": r"[^\W\d][\w.\-]*", "ENTITY": r"[^\W\d][\w.\-]*", "QName": r"(?:[^\W\d][\w.\-]*:)?[^\W\d][\w.\-]*",
}
Check = Callable[[str], str | None]


def _local(name: str | None) -> str:
    return (name or "").rpartition("}")[2].rpartition(":")[2]


# ---------------------------------------------------------------- simple types
def _built_in(name: str) -> Check:
    """What is wrong with a value of a built-in type; None for nothing."""
    if name in _INTEGERS:
        low, high = _INTEGERS[name]

        def whole(v: str) -> str | None:
            v = v.strip()
            if not re.fullmatch(r"[+-]?\d+", v, re.A):
                return f"'{v}' is not of type {name}"
            return f"'{v}' is out of the range of {name}" if (low is not None and int(v) < low) or (high is not None and int(v) > high) else None

        return whole
    if name in ("NMTOKENS", "IDREFS", "ENTITIES"):
        one = _built_in(name[:-1] if name != "ENTITIES" else "ENTITY")
        return lambda v: next((e for e in map(one, v.split()) if e), None if v.split() else f"'{v}' is not of type {name}")
    form = _FORMS.get(name)
    if form is None:
        return lambda v: None

    def formed(v: str) -> str | None:
        v = v.strip()
        good = re.fullmatch(form, v, re.A if name not in ("Name", "NCName", "ID", "IDREF", "NMTOKEN", "QName", "ENTITY") else 0)
        if good and name in ("date", "dateTime") and v[0] != "-" and len(v.split("-")[0]) == 4:
            try:
                datetime.date(int(v[:4]), int(v[5:7]), int(v[8:10]))
            except ValueError:
                good = None
        return None if good else f"'{v}' is not of type {name}"

    return formed


def _facets(node: ElementTree.Element, base: Check, name: str) -> Check:
    """The checks of a restriction on top of its base type."""
    given: dict[str, list[str]] = {}
    for f in node:
        given.setdefault(_local(f.tag), []).append(f.get("value", ""))
    patterns = [re.compile(_pattern(p)) for p in given.get("pattern", [])]
    numbers = {k: Decimal(v[0]) for k in ("minInclusive", "maxInclusive", "minExclusive", "maxExclusive") if (v := given.get(k)) and re.fullmatch(r"[+-]?[\d.]+(?:[eE][+-]?\d+)?", v[0])}
    sizes = {k: int(v[0]) for k in ("length", "minLength", "maxLength", "totalDigits", "fractionDigits") if (v := given.get(k))}
    collapse = given.get("whiteSpace", [""])[0] == "collapse"

    def check(v: str) -> str | None:
        if wrong := base(v):
            return wrong
        seen = " ".join(v.split()) if collapse else v
        tight = seen.strip()
        if "enumeration" in given and seen not in given["enumeration"] and tight not in given["enumeration"]:
            return f"'{tight}' is none of the values of {name}"
        if patterns and not any(p.fullmatch(seen) or p.fullmatch(tight) for p in patterns):
            return f"'{tight}' does not follow the pattern of {name}"
        n = len(seen)
        if ("length" in sizes and n != sizes["length"]) or n < sizes.get("minLength", 0) or n > sizes.get("maxLength", n):
            return f"'{tight}' has not the length of {name}"
        if numbers or "totalDigits" in sizes or "fractionDigits" in sizes:
            try:
                x = Decimal(tight)
            except InvalidOperation:
                return None
            if x < numbers.get("minInclusive", x) or x > numbers.get("maxInclusive", x) or ("minExclusive" in numbers and x <= numbers["minExclusive"]) or ("maxExclusive" in numbers and x >= numbers["maxExclusive"]):
                return f"'{tight}' is out of the range of {name}"
            if x.is_finite():
                digits, places = x.normalize().as_tuple().digits, max(0, -int(x.normalize().as_tuple().exponent))
                if len(digits) > sizes.get("totalDigits", len(digits)) or places > sizes.get("fractionDigits", places):
                    return f"'{tight}' has too many digits for {name}"
        return None

    return check


def _pattern(p: str) -> str:
    r"""A schema's pattern for this engine: name classes of their own, anchors are plain characters."""
    return re.sub(r"\\([ic])", lambda m: r"[^\W\d]" if m[1] == "i" else r"[\w.:\-]", p.replace("^", r"\^") if not re.search(r"\[\^", p) else p).replace("$", r"\$")


# ---------------------------------------------------------------- content models
class Model:
    """A position automaton: ``step(state, name)`` to the positions that name may take, and which of them may be last."""

    def __init__(self) -> None:
        self.names: list[str] = []  # of each position; '*' for any
        self.types: list = []
        self.follow: list[set[int]] = []
        self.first: set[int] = set()
        self.last: set[int] = set()
        self.empty = True

    def step(self, state: set[int] | None, name: str) -> set[int]:
        may = self.first if state is None else set().union(*(self.follow[p] for p in state)) if state else set()
        return {p for p in may if self.names[p] in (name, "*")}

    def may_end(self, state: set[int] | None) -> bool:
        return self.empty if state is None else bool(state & self.last)


class _Part:
    def __init__(self, first: set[int], last: set[int], empty: bool):
        self.first, self.last, self.empty = first, last, empty


class Schema:
    """A compiled schema."""

    def __init__(self, text: str):
        root = ElementTree.fromstring(text.encode() if isinstance(text, str) else text)
        if root.tag != f"{_XS}schema":
            raise ValueError("not a schema")
        self.named = {(_local(n.tag), n.get("name")): n for n in root if n.get("name")}
        self.done: dict = {}
        self.roots = {n.get("name"): self._type_of(n) for n in root if _local(n.tag) == "element"}

    # A type is a dict: model (None: no elements), mixed, check (None: no simple content), attributes, open (any content)
    def _any(self) -> dict:
        return {"model": None, "mixed": True, "check": None, "attributes": {}, "any_attribute": True, "open": True}

    def _simple(self, check: Check) -> dict:
        return {"model": None, "mixed": True, "check": check, "attributes": {}, "any_attribute": False, "open": False}

    def _type_of(self, element: ElementTree.Element) -> dict:
        """The type of an element declaration; declarations met again (recursion) share it."""
        if id(element) in self.done:
            return self.done[id(element)]
        out: dict = {}
        self.done[id(element)] = out
        inner = next((c for c in element if _local(c.tag) in ("complexType", "simpleType")), None)
        found = self._by_node(inner) if inner is not None else self._by_name(element.get("type")) if element.get("type") else self._any()
        out.update(found)
        if element.get("nillable") in ("true", "1"):
            out["nillable"] = True
        if element.get("fixed") is not None:
            out["fixed"] = element.get("fixed")
        return out

    def _by_name(self, name: str) -> dict:
        local = _local(name)
        for kind in ("complexType", "simpleType"):
            if (kind, local) in self.named:
                return self._by_node(self.named[kind, local])
        if local == "anyType":
            return self._any()
        return self._simple(_built_in(local))

    def _by_node(self, node: ElementTree.Element) -> dict:
        if id(node) in self.done:
            return self.done[id(node)]
        out: dict = {}
        self.done[id(node)] = out
        out.update(self._simple(self._check(node)) if _local(node.tag) == "simpleType" else self._complex(node))
        return out

    def _check(self, node: ElementTree.Element) -> Check:
        """Of a simpleType: restriction, list or union."""
        name = node.get("name") or "the type"
        for c in node:
            kind, inner = _local(c.tag), [x for x in c if _local(x.tag) == "simpleType"]
            if kind == "restriction":
                base = self._by_name(c.get("base"))["check"] if c.get("base") else self._check(inner[0])
                return _facets(c, base or (lambda v: None), name)
            if kind == "list":
                item = self._by_name(c.get("itemType"))["check"] if c.get("itemType") else self._check(inner[0])
                return lambda v, item=item: next((e for e in map(item, v.split()) if e), None)
            if kind == "union":
                ways = [self._by_name(m)["check"] for m in (c.get("memberTypes") or "").split()] + [self._check(x) for x in inner]
                return lambda v, ways=ways: None if any(w(v) is None for w in ways) else f"'{v.strip()}' fits no member of {name}"
        return lambda v: None

    def _complex(self, node: ElementTree.Element) -> dict:
        out = {"model": Model(), "mixed": node.get("mixed") in ("true", "1"), "check": None, "attributes": {}, "any_attribute": False, "open": False}
        particles: list[ElementTree.Element] = []
        self._collect(node, out, particles)
        if out["check"] is None and not out["open"]:
            model = out["model"]
            part = self._sequence(model, particles)
            model.first, model.last, model.empty = part.first, part.last, part.empty
        return out

    def _collect(self, node: ElementTree.Element, out: dict, particles: list) -> None:
        """Particles and attributes of a complex type, those of the base type first."""
        for c in node:
            kind = _local(c.tag)
            if kind in ("complexContent", "simpleContent"):
                if c.get("mixed") in ("true", "1"):
                    out["mixed"] = True
                for d in c:
                    how = _local(d.tag)
                    if how not in ("extension", "restriction"):
                        continue
                    base = self.named.get(("complexType", _local(d.get("base"))))
                    if base is not None:
                        if how == "extension" or kind == "simpleContent":
                            self._collect(base, out, particles)
                            out["mixed"] = out["mixed"] or base.get("mixed") in ("true", "1")
                        else:
                            self._collect(base, out, [])
                    elif kind == "simpleContent":
                        out["check"] = self._by_name(d.get("base"))["check"] or (lambda v: None)
                    elif _local(d.get("base")) == "anyType" and how == "extension":
                        out["open"] = True
                    if how == "restriction" and kind == "simpleContent":
                        out["check"] = _facets(d, out["check"] or (lambda v: None), "the type")
                    self._collect(d, out, particles)
            elif kind in ("sequence", "choice", "all", "group", "element", "any"):
                particles.append(c)
            elif kind == "attribute":
                declared = self.named.get(("attribute", _local(c.get("ref")))) if c.get("ref") else c
                name = _local(c.get("name") or c.get("ref"))
                inner = next((x for x in (declared if declared is not None else c) if _local(x.tag) == "simpleType"), None)
                kind_of = (declared if declared is not None else c).get("type")
                check = self._check(inner) if inner is not None else self._by_name(kind_of)["check"] if kind_of else None
                if c.get("use") == "prohibited":
                    out["attributes"].pop(name, None)
                else:
                    out["attributes"][name] = (check, c.get("use") == "required", c.get("fixed"))
            elif kind == "attributeGroup" and (group := self.named.get(("attributeGroup", _local(c.get("ref"))))) is not None:
                self._collect(group, out, [])
            elif kind == "anyAttribute":
                out["any_attribute"] = True

    # Position automata, particle by particle.
    def _particle(self, model: Model, node: ElementTree.Element) -> _Part:
        low = int(node.get("minOccurs", "1"))
        high = None if node.get("maxOccurs") == "unbounded" else int(node.get("maxOccurs", "1"))
        if high == 0:
            return _Part(set(), set(), True)
        if high is not None and high > UNROLL:
            high = None
        low = min(low, UNROLL)
        parts = [self._once(model, node) for _ in range(max(1, low if high is None else high))]
        if high is None:  # the last copy repeats
            for p in parts[-1].last:
                model.follow[p] |= parts[-1].first
        for i, p in enumerate(parts):
            if i >= low:
                p.empty = True
        return self._joined(model, parts)

    def _joined(self, model: Model, parts: list[_Part]) -> _Part:
        out = _Part(set(), set(), True)
        for p in parts:
            for q in out.last:
                model.follow[q] |= p.first
            out = _Part(out.first | p.first if out.empty else out.first, p.last | out.last if p.empty else p.last, out.empty and p.empty)
        return out

    def _sequence(self, model: Model, nodes: list[ElementTree.Element]) -> _Part:
        return self._joined(model, [self._particle(model, n) for n in nodes])

    def _once(self, model: Model, node: ElementTree.Element) -> _Part:
        kind = _local(node.tag)
        inner = [c for c in node if _local(c.tag) in ("sequence", "choice", "all", "group", "element", "any")]
        if kind == "sequence":
            return self._sequence(model, inner)
        if kind == "group":
            found = self.named.get(("group", _local(node.get("ref"))))
            return self._sequence(model, [c for c in found if _local(c.tag) in ("sequence", "choice", "all")]) if found is not None else _Part(set(), set(), True)
        if kind == "choice":
            parts = [self._particle(model, c) for c in inner]
            return _Part(set().union(*(p.first for p in parts)), set().union(*(p.last for p in parts)), any(p.empty for p in parts) or not parts)
        if kind == "all":  # any order: each position may follow each other one; how often is counted apart
            parts = [self._once(model, c) for c in inner]
            every = set().union(*(p.first for p in parts)) if parts else set()
            for p in every:
                model.follow[p] |= every - {p}
            needed = {min(p.first) for p, c in zip(parts, inner) if c.get("minOccurs", "1") != "0"}
            model.needed = needed  # type: ignore[attr-defined]
            model.once = every  # type: ignore[attr-defined]
            return _Part(every, every, not needed)
        at = len(model.names)
        declared = self.named.get(("element", _local(node.get("ref")))) if node.get("ref") else node
        model.names.append("*" if kind == "any" else _local(node.get("name") or node.get("ref")))
        model.types.append(None if kind == "any" or declared is None else self._type_of(declared))
        model.follow.append(set())
        return _Part({at}, {at}, False)

    # ---------------------------------------------------------------- documents
    def errors(self, document: str) -> list[dict]:
        """At most ten errors of a well-formed document."""
        out: list[dict] = []
        stack: list[dict] = []
        p = expat.ParserCreate("UTF-8")
        p.buffer_text = True

        def fail(message: str) -> None:
            if len(out) < MAX_ERRORS:
                out.append({"line": p.CurrentLineNumber, "column": p.CurrentColumnNumber, "message": message})

        def start(qname: str, attrs: dict) -> None:
            name = _local(qname)
            if not stack:
                kind = self.roots.get(name)
                if kind is None:
                    fail(f"element {name} is not declared")
            else:
                kind = self._child(stack[-1], name, fail)
            stack.append({"name": name, "type": kind, "state": None, "text": [], "seen": set(), "lost": False, "nil": False})
            if not kind:
                return
            own = {}
            for k, v in attrs.items():
                if k == "xmlns" or k.startswith("xmlns:"):
                    continue
                if k.startswith(("xsi:", "xml:")) and _local(k) not in kind["attributes"]:
                    stack[-1]["nil"] |= k == "xsi:nil" and v in ("true", "1")
                    continue
                own[_local(k)] = v
            for k in sorted(own):
                declared = kind["attributes"].get(k)
                if declared is None:
                    if not kind["any_attribute"]:
                        fail(f"attribute {k} is not allowed in element {name}")
                elif declared[0] is not None and (wrong := declared[0](own[k])):
                    fail(f"attribute {k} of element {name}: {wrong}")
                elif declared[2] is not None and own[k] != declared[2]:
                    fail(f"attribute {k} of element {name}: '{own[k]}' is not the fixed value")
            for k in sorted(k for k, d in kind["attributes"].items() if d[1] and k not in own):
                fail(f"attribute {k} of element {name} is missing")

        def end(_: str) -> None:
            frame = stack.pop()
            kind, name, text = frame["type"], frame["name"], "".join(frame["text"])
            if not kind or kind["open"]:
                return
            if frame["nil"] and kind.get("nillable"):
                return
            if kind["check"] is not None:
                if not frame["lost"] and (wrong := kind["check"](text)):
                    fail(f"element {name}: {wrong}")
                elif kind.get("fixed") is not None and text != kind["fixed"]:
                    fail(f"element {name}: '{text}' is not the fixed value")
                return
            model = kind["model"]
            if not kind["mixed"] and text.strip():
                fail(f"element {name} may not hold text")
            if model is not None and not frame["lost"]:
                missing = getattr(model, "needed", set()) - frame["seen"]
                if not model.may_end(frame["state"]) or (missing and not (frame["state"] is None and model.empty)):
                    may = sorted({model.names[q] for q in missing} or {model.names[q] for q in (model.first if frame["state"] is None else set().union(*(model.follow[q] for q in frame["state"])))})
                    fail(f"element {name} is not complete, expected {' or '.join(may)}")

        def data(s: str) -> None:
            if stack:
                stack[-1]["text"].append(s)

        p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = start, end, data
        try:
            p.Parse(document.encode(), True)
        except expat.ExpatError as e:
            fail(expat.errors.messages[e.code])
        return out

    def _child(self, frame: dict, name: str, fail: Callable[[str], None]) -> dict | None:
        """The type of a child, by the step its parent's content takes; after a step that is none the parent is not looked at."""
        kind = frame["type"]
        if not kind:
            return None
        if kind["open"]:
            return self.roots.get(name) or {}
        if kind["check"] is not None or kind["model"] is None:
            if not frame["lost"]:
                fail(f"element {frame['name']} may not hold elements")
            frame["lost"] = True
            return None
        model = kind["model"]
        if frame["lost"]:
            return next((t for n, t in zip(model.names, model.types) if n == name), None)
        state = model.step(frame["state"], name)
        again = state & frame["seen"] & getattr(model, "once", set())
        if not state or again:
            may = model.first if frame["state"] is None else set().union(*(model.follow[q] for q in frame["state"]))
            expected = sorted({model.names[q] for q in may - (frame["seen"] & getattr(model, "once", set()))})
            fail(f"element {name} is not expected in element {frame['name']}" + (f", expected {' or '.join(expected)}" if expected else ""))
            frame["lost"] = True
            return next((t for n, t in zip(model.names, model.types) if n == name), None)
        frame["state"] = state
        frame["seen"] |= state
        types = [model.types[q] for q in sorted(state)]
        return types[0] if types[0] is not None else self.roots.get(name) or {}
