"""Per-page helper: which elements match which selectors, and with what text or attribute.

One streaming pass over a page. No tree is kept: the helper
holds the stack of open elements and the values of the open matches. Record assembly,
fallbacks, casts and validation are column expressions in ``operators.extract``.

A page is cut into its pieces by one pattern, and the selectors are run as a lazy automaton: its states are paths of
open elements, told apart by the selector conditions they satisfy, and what a start or end tag does in a state is worked out
once. Pages that this form cannot take (a value or declaration that is never closed, very deep nesting) are read piece by piece.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from html import unescape
from itertools import accumulate, chain

import pyarrow as pa

# Fixed values from the HTML standard: elements without content, and start tags that end an open element.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
ENDED_BY = {
    "p": ENDS_P,
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
}
# Start tag -> the open elements it ends.
ENDS = {tag: [e for e, by in ENDED_BY.items() if tag in by] for tag in set().union(*ENDED_BY.values())}
# An element is only closed implicitly inside the nearest of these.
SCOPE = {"p": {"td", "th", "button", "body", "table"}, "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"},
         "option": {"select", "datalist"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
NO_TEXT = {"script", "style", "template"}

_TOKEN = re.compile(r"\s*([>,])\s*|\s+|([.#]?[\w-]+|\*)|\[\s*([\w:-]+)\s*(?:([*^]?=)\s*(\"[^\"]*\"|'[^']*'|[^\]\s]+)\s*)?\]|:root")


@dataclass(frozen=True)
class FieldSpec:
    """One output field: a selector, what to take from the match, one or many, optional nested fields."""

    name: str
    selector: str
    attribute: str = "text"
    multiple: bool = False
    children: tuple["FieldSpec", ...] = ()
    separator: str = ""

    @staticmethod
    def of(raw: dict) -> "FieldSpec":
        return FieldSpec(
            raw["name"], raw["selector"], raw.get("attribute", "text"), raw.get("multiple", False),
            tuple(FieldSpec.of(c) for c in raw.get("children", ())),
        )


def compile_selector(text: str) -> list[list[tuple[str, list[tuple]]]]:
    """Alternatives of a selector list; each is [(combinator to the left, [conditions])] from left to right."""
    alternatives, steps, conditions, combinator = [], [], [], " "
    position, text = 0, text.strip()
    while position < len(text):
        m = _TOKEN.match(text, position)
        if not m:
            raise ValueError(f"unsupported selector {text!r}")
        position = m.end()
        mark, simple, attr, op, value = m.groups()
        token = m.group(0)
        if simple:
            kind = {".": "class", "#": "id"}.get(simple[0], "tag")
            conditions.append((kind, simple if kind == "tag" else simple[1:]))
        elif attr:
            conditions.append(("attr", attr.lower(), op, value.strip("\"'") if value else None))
        elif token == ":root":
            conditions.append(("root",))
        else:  # a combinator or a comma ends the compound
            if conditions:
                steps.append((combinator, conditions))
                conditions, combinator = [], " "
            if mark == ",":
                alternatives.append(steps)
                steps, combinator = [], " "
            elif mark == ">":
                combinator = ">"
    if conditions:
        steps.append((combinator, conditions))
    alternatives.append(steps)
    return alternatives


# The start of a comment, a declaration or a tag; inside a tag its end or the start of a quoted value.
_MARKUP = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
# The same with the rest of a tag whose quoted values are all closed.
_CLOSED = r"(?:[^>=]++|=(?!\s*+[\"'])|=\s*+(?:\"[^\"]*+\"|'[^']*+'))*+"
_WHOLE = re.compile(rf"<(?:(/?)([a-zA-Z][^\s/>]*+)(?:({_CLOSED})(>))?|(!--)|([!?]))")
# All pieces of a page: the name of an end tag; a start tag without its brackets, a script or style with what it holds;
# comments; declarations; or, from the first piece on that is never closed, the rest of the page.
_PIECES = re.compile(
    rf"<(?:/([a-zA-Z][^\s/>]*+){_CLOSED}>"
    rf"|((?:([sS][cC][rR][iI][pP][tT])(?=[\s/>])|([sS][tT][yY][lL][eE])(?=[\s/>])|[a-zA-Z][^\s/>]*+){_CLOSED})>"
    r"(?(3)(?:(?<=/>)|(?:[^<]++|<(?!/(?i:script)[\s/>]))*+))(?(4)(?:(?<=/>)|(?:[^<]++|<(?!/(?i:style)[\s/>]))*+))"
    r"|!--(?:[^-]++|-(?!->))*+(?:-->)?|[!?][^>]*+>|((?s:/?[a-zA-Z].*|[!?].*)))"
)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_IN_TAG = re.compile(r">|=\s*+([\"'])")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*))?")
_UNQUOTED_END = re.compile(r"=[^\s\"']+$")
MAX_SEEN = 4096
MAX_STATES = 8192
MAX_DEPTH = 256
MAX_ALIKE = 64
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in ("script", "style")}


class Markup:
    """Comments, declarations and tags of a page in one pass forward.

    A tag ends at the first ``>`` outside a quoted value. A quote is one only where a value starts, and only if it is
    closed; any other quote mark is a plain character. Places where a mark no longer occurs are remembered, so no part of a page
    is searched twice however broken it is.
    """

    def __init__(self, html: str):
        self.html = html
        self.gone: set[str] = set()

    def _find(self, mark: str, position: int) -> int:
        if mark in self.gone:
            return -1
        found = self.html.find(mark, position)
        if found < 0:
            self.gone.add(mark)
        return found

    def _tag_end(self, position: int) -> int:
        while match := _IN_TAG.search(self.html, position):
            if not match[1]:
                return match.start()
            closed = self._find(match[1], match.end())
            position = match.end() if closed < 0 else closed + 1
        return -1

    def next(self, position: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, closing slash, name, raw attributes) of the next piece; the name is empty unless it is a tag."""
        if not self.gone:  # beyond a value that is never closed the short form would be searched for in vain
            match = _WHOLE.search(self.html, position)
            if match is None:
                return None
            if match[4]:
                return match.start(), match.end(), match[1], match[2], match[3]
            position = match.start()
        while match := _MARKUP.search(self.html, position):
            comment, declaration, closing, name = match.groups()
            if comment:
                end = self._find("-->", match.end())
                return match.start(), len(self.html) if end < 0 else end + 3, "", "", ""
            end = self._find(">", match.end()) if declaration else self._tag_end(match.end())
            if end < 0:
                return None  # nothing that follows can be closed either
            return match.start(), end + 1, closing or "", name or "", "" if declaration else self.html[match.end() : end]
        return None


def parse_attributes(raw: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a repeated name wins, one without a value is empty."""
    values: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        name = name.lower()
        if name not in values:
            if value[:1] in ("'", '"'):
                value = value[1:-1]
            values[name] = unescape(value) if "&" in value else value
    return values


class StartTag:
    """What a start tag says by itself: parsed once for all elements written alike."""

    __slots__ = ("tag", "attrs", "classes", "ends", "empty", "selected")

    def __init__(self, name: str, raw: str):
        self.tag = name.lower()
        self.attrs = parse_attributes(raw) if raw else {}
        self.classes = tuple(self.attrs["class"].split()) if "class" in self.attrs else ()
        self.ends = ENDS.get(self.tag, ())
        self.empty = self.tag in VOID or (raw.endswith("/") and not _UNQUOTED_END.search(raw))
        self.selected = None  # its Kind, in a SelectPlan

    @classmethod
    def of(cls, tag: str, attrs: dict[str, str]) -> "StartTag":
        """One whose attributes are known."""
        start = cls(tag, "")
        start.attrs, start.classes = attrs, tuple(attrs["class"].split()) if "class" in attrs else ()
        return start


class Element:
    __slots__ = ("start", "tag", "attrs", "classes", "open_hits", "first_text")

    def __init__(self, start: StartTag, first_text: int):
        self.start, self.tag, self.attrs, self.classes, self.first_text = start, start.tag, start.attrs, start.classes, first_text
        self.open_hits: list = []

    def satisfies(self, conditions: list[tuple]) -> bool:
        for condition in conditions:
            kind = condition[0]
            if kind == "tag":
                ok = condition[1] == "*" or self.tag == condition[1].lower()
            elif kind == "class":
                ok = condition[1] in self.classes
            elif kind == "id":
                ok = self.attrs.get("id") == condition[1]
            elif kind == "root":
                ok = self.tag == ":root"
            else:
                _, name, op, wanted = condition
                have = self.attrs.get(name)
                ok = have is not None and (
                    op is None or (op == "=" and have == wanted)
                    or (op == "*=" and wanted in have) or (op == "^=" and have.startswith(wanted))
                )
            if not ok:
                return False
        return True


def matches(stack: list[Element], steps: list, step: int = -1, depth: int = -1) -> bool:
    """Whether the element at ``depth`` of the open stack matches the steps up to ``step``."""
    step, depth = step % len(steps), depth % len(stack)
    combinator, conditions = steps[step]
    if not stack[depth].satisfies(conditions):
        return False
    if step == 0:
        return True
    nearest = range(depth - 1, depth - 2, -1) if combinator == ">" else range(depth - 1, -1, -1)
    return any(matches(stack, steps, step - 1, d) for d in nearest if d >= 0)


class PageScan:
    """Open-element stack and text runs of one page; subclasses react to elements opening and closing."""

    every = True  # whether ``closed`` is called for elements without open hits too

    def __init__(self, seen: dict):
        self.seen = seen  # (tag, raw attributes) -> StartTag, shared by the pages of a task: templates repeat
        self.texts: list[str] = []  # stripped, non-empty text runs in document order
        self.stack: list[Element] = []
        self.open_tags: dict[str, int] = {}

    def scan(self, html: str):
        self._open(Element(StartTag(":root", ""), 0))
        texts, stack, open_tags, seen = self.texts, self.stack, self.open_tags, self.seen
        opened, following, position = self.opened, Markup(html).next, 0
        while piece := following(position):
            begin, end, closing, name, raw = piece
            if begin > position:
                run = html[position:begin]
                if "&" in run:
                    run = unescape(run)
                run = run.strip()
                if run and stack[-1].tag not in NO_TEXT:
                    texts.append(run)
            position = end
            if not name:
                continue
            if closing:
                tag = name.lower()
                if open_tags.get(tag) and tag not in VOID:
                    self._close_to(tag)
                continue
            start = seen.get((name, raw))
            if start is None:
                if len(seen) >= MAX_SEEN:
                    seen.clear()
                start = seen[name, raw] = StartTag(name, raw)
            if start.ends:
                self._imply_ends(start.ends)
            tag, element = start.tag, Element(start, len(texts))
            stack.append(element)
            open_tags[tag] = open_tags.get(tag, 0) + 1
            opened(element)
            if start.empty:
                self._close_to(tag)
            if tag in _RAW_END and not raw.endswith("/"):
                found = _RAW_END[tag].search(html, position)
                position = found.start() if found else len(html)
        self._text(html[position:])
        while stack:
            self._close_to(stack[-1].tag)
        return self

    def opened(self, element: Element) -> None: ...

    def closed(self, element: Element) -> None: ...

    def _text(self, run: str) -> None:
        run = (unescape(run) if "&" in run else run).strip()
        if run and self.stack[-1].tag not in NO_TEXT:
            self.texts.append(run)

    def _open(self, element: Element) -> None:
        self.stack.append(element)
        self.open_tags[element.tag] = self.open_tags.get(element.tag, 0) + 1
        self.opened(element)

    def _close_to(self, tag: str) -> None:
        stack, open_tags = self.stack, self.open_tags
        while True:
            element = stack[-1]
            if element.open_hits or self.every:
                self.closed(element)
            stack.pop()
            open_tags[element.tag] -= 1
            if element.tag == tag:
                return

    def _imply_ends(self, ends: list[str]) -> None:
        for ended in ends:
            if self.open_tags.get(ended):
                for element in reversed(self.stack):
                    if element.tag == ended:
                        self._close_to(ended)
                        break
                    if element.tag in SCOPE[ended]:
                        break


class Kind:
    """What selectors ask of an element by itself; the same object for all elements that answer alike."""

    __slots__ = ("tag", "sure", "others", "outer", "empty", "alone")

    def __init__(self, tag: str, sure: tuple, others: tuple, outer: frozenset, empty: bool = False):
        self.tag, self.sure, self.others, self.outer, self.empty = tag, sure, others, outer, empty
        # sure: selectors that it matches wherever it stands; others: (selector, alternatives) that depend on the open elements;
        # outer: the conditions it satisfies that selectors ask of open elements; alone: the same of an element without content
        self.alone = self if empty else Kind(tag, sure, others, outer, True)


class Shape:
    """A start tag without its quoted values: attribute names (None if it is not that simple), and the kinds by the values of those asked for."""

    __slots__ = ("tag", "empty", "names", "watched", "kinds")


class State:
    """The open elements of a page, as a path of kinds from the root."""

    __slots__ = ("kind", "parent", "depth", "textual", "takes", "steps", "ups")

    def __init__(self, kind: Kind, parent: "State | None"):
        self.kind, self.parent, self.depth = kind, parent, parent.depth + 1 if parent else 1
        self.textual = kind.tag not in NO_TEXT
        self.takes: dict[Group, list[tuple]] = {}  # what the innermost element gives to the open records
        self.steps: dict[Kind, tuple | None] = {}  # start tag -> (state it is opened in, state inside, takes)
        self.ups: dict[str, State] = {}  # name of an end tag -> state after it


class Group:
    """The fields of one record, which is a list of their values."""

    def __init__(self, specs: tuple[FieldSpec, ...]):
        self.specs = specs
        self.inner = [Group(spec.children) if spec.children else None for spec in specs]
        self.many = [i for i, spec in enumerate(specs) if spec.multiple]
        self.by_selector: dict[str, list[tuple]] = {}
        for i, spec in enumerate(specs):
            attribute = None if spec.attribute == "text" else spec.attribute
            self.by_selector.setdefault(spec.selector, []).append((i, spec.multiple, attribute, spec.separator, self.inner[i]))
        scope = self.by_selector.get(":scope", ())  # what the element of the record gives itself: single attributes, and the rest
        self.own = [(i, attribute) for i, multiple, attribute, _, inner in scope if attribute is not None and not multiple and not inner]
        self.scope = [entry for entry in scope if (entry[0], entry[2]) not in self.own]

    def record(self) -> list:
        values = [None] * len(self.specs)
        for i in self.many:
            values[i] = []
        return values

    def named(self, record: list) -> dict:
        """The record by field names."""
        return {spec.name: self._each(i, record[i], Group.named) for i, spec in enumerate(self.specs)}

    def listed(self, record: dict) -> list:
        """The record as a list."""
        return [self._each(i, record[spec.name], Group.listed) for i, spec in enumerate(self.specs)]

    def _each(self, i: int, value, form):
        inner = self.inner[i]
        if inner is None or value is None:
            return value
        return [form(inner, v) for v in value] if self.specs[i].multiple else form(inner, value)


def _holds(value: str, test: tuple[str, str]) -> bool:
    op, wanted = test
    return wanted in value if op == "*=" else value.startswith(wanted)


class SelectPlan:
    """Field specs with their selectors compiled and indexed by what an element must have to match."""

    def __init__(self, fields: tuple[FieldSpec, ...]):
        self.fields, self.group = fields, Group(fields)
        self.seen: dict = {}
        self.starts: dict[str, tuple[Kind, dict]] = {}  # start tag without its brackets -> what it says
        self.shapes: dict[tuple, Shape] = {}
        self.compiled: dict[str, list] = {}
        self.index: dict[tuple, set[str]] = {}
        self.conditions: list[list[tuple]] = []  # what selectors ask of the elements around a match
        self.places: dict[tuple, int] = {}
        self.selected: dict[tuple, Kind] = {}
        self.kinds: dict[tuple, Kind] = {}
        self.by_selector: dict[int, dict[str, list[FieldSpec]]] = {}  # by the id of the specs, which live as long as the plan
        self._add(fields)
        self.watched = self._watched()
        self._restart()

    def _add(self, fields: tuple[FieldSpec, ...]) -> None:
        grouped = self.by_selector[id(fields)] = {}
        for spec in fields:
            grouped.setdefault(spec.selector, []).append(spec)
            self._add(spec.children)
            if spec.selector == ":scope" or spec.selector in self.compiled:
                continue
            self.compiled[spec.selector] = compile_selector(spec.selector)
            for steps in self.compiled[spec.selector]:
                self.index.setdefault(steps[-1][1][-1][:2], set()).add(spec.selector)
                for _, conditions in steps[:-1]:
                    if self.places.setdefault(tuple(conditions), len(self.conditions)) == len(self.conditions):
                        self.conditions.append(conditions)

    def _watched(self) -> list[tuple]:
        """(attribute, words of a list, values, tests) that some selector asks for."""
        asked: dict[str, tuple[set, set, set]] = {}
        for _, conditions in (step for selector in self.compiled.values() for steps in selector for step in steps):
            for kind, name, *rest in (c for c in conditions if c[0] in ("class", "id", "attr")):
                words, values, tests = asked.setdefault(name if kind == "attr" else kind, (set(), set(), set()))
                if kind == "class":
                    words.add(name)
                elif kind == "id":
                    values.add(name)
                elif rest[0] == "=":
                    values.add(rest[1])
                elif rest[0]:
                    tests.add(tuple(rest))
        return [(name, frozenset(words), frozenset(values), sorted(tests)) for name, (words, values, tests) in sorted(asked.items())]

    def _kind(self, element: Element) -> Kind:
        keys = [("tag", element.tag), ("tag", "*"), ("id", element.attrs.get("id")), *(("class", c) for c in element.classes)]
        keys += [("attr", a) for a in element.attrs] + ([("root",)] if element.tag == ":root" else [])
        sure, others, fits = [], [], []
        for selector in set().union(*(self.index[k] for k in keys if k in self.index)):
            fitting = [i for i, steps in enumerate(self.compiled[selector]) if element.satisfies(steps[-1][1])]
            if any(len(self.compiled[selector][i]) == 1 for i in fitting):
                sure.append(selector)
            elif fitting:
                others.append((selector, [self.compiled[selector][i] for i in fitting]))
                fits.append((selector, tuple(fitting)))
        outer = frozenset(i for i, conditions in enumerate(self.conditions) if element.satisfies(conditions))
        alike = (element.tag, frozenset(sure), frozenset(fits), outer)
        if alike not in self.kinds:
            self.kinds[alike] = Kind(element.tag, tuple(sure), tuple(others), outer)
        return self.kinds[alike]

    def selected_by(self, start: StartTag) -> Kind:
        """The kind of an element, looked up by what selectors ask of it."""
        like, attrs = [start.tag], start.attrs
        for name, words, values, tests in self.watched if attrs else ():
            value = attrs.get(name)
            if value is not None:
                like.append((
                    name, words.intersection(start.classes) if words else None, value if value in values else None,
                    *[_holds(value, test) for test in tests],
                ))
        like = tuple(like)
        if like not in self.selected:
            if len(self.selected) >= MAX_SEEN:
                self.selected.clear()
                self.kinds.clear()
            self.selected[like] = self._kind(Element(start, 0))
        return self.selected[like]

    # --- the automaton ---

    def _restart(self) -> None:
        self.size, self.root = 0, self._state(self.selected_by(StartTag(":root", "")), None)

    def _around(self, state: State, steps: list, step: int) -> bool:
        """Whether the elements around the innermost one match the steps before ``step``, which it matches."""
        if step == 0:
            return True
        wanted, outer = self.places[tuple(steps[step - 1][1])], state.parent
        while outer is not None:
            if wanted in outer.kind.outer and self._around(outer, steps, step - 1):
                return True
            if steps[step][0] == ">":
                return False
            outer = outer.parent
        return False

    def _state(self, kind: Kind, parent: State | None) -> State:
        state = State(kind, parent)
        hits = list(kind.sure)
        hits += [s for s, fitting in kind.others if any(self._around(state, steps, len(steps) - 1) for steps in fitting)]
        groups = [self.group] if hits else []
        for group in groups:
            groups += [g for g in group.inner if g]
            if found := [entry for selector in hits for entry in group.by_selector.get(selector, ())]:
                state.takes[group] = found
        return state

    def start(self, inside: str) -> tuple[Kind, dict]:
        """Kind and attributes of the start tag written between the brackets."""
        if len(self.starts) >= MAX_SEEN:
            self.starts.clear()
        parts = inside.split('"')
        shape = None
        if len(parts) > 1 and len(parts) % 2:
            outside = tuple(parts[::2])
            shape = self.shapes.get(outside)
            if shape is None:
                if len(self.shapes) >= MAX_SEEN:
                    self.shapes.clear()
                shape = self.shapes[outside] = self._shape(inside, outside)
        if shape is None or shape.names is None:
            name = _NAME.match(inside).group()
            start = StartTag(name, inside[len(name) :])
            kind, attrs = self.selected_by(start), start.attrs
            if start.empty:
                kind = kind.alone
        else:
            values = parts[1::2]
            if "&" in inside:
                values = [unescape(value) if "&" in value else value for value in values]
            attrs = dict(zip(shape.names, values, strict=True))
            key = tuple([
                values[i] if wanted is None else (values[i] in wanted and values[i], *[_holds(values[i], test) for test in tests])
                for i, wanted, tests in shape.watched
            ])
            kind = shape.kinds.get(key)
            if kind is None:
                if len(shape.kinds) >= MAX_ALIKE:
                    shape.kinds.clear()
                kind = self.selected_by(StartTag.of(shape.tag, attrs))
                kind = shape.kinds[key] = kind.alone if shape.empty else kind
        found = self.starts[inside] = kind, attrs
        return found

    def _shape(self, inside: str, outside: tuple[str, ...]) -> "Shape":
        """How a start tag is written outside of its double quotes.

        Where each of them begins and ends a value, and no attribute stands without one or twice, the rest says the names.
        """
        name = _NAME.match(inside).group()
        start, shape = StartTag(name, inside[len(name) :]), Shape()
        shape.tag, shape.empty, shape.kinds = start.tag, start.empty, {}
        marks = [f"\0{i}" for i in range(len(outside) - 1)]
        told = "".join([outside[0][len(name) :], *[f'"{mark}"{rest}' for mark, rest in zip(marks, outside[1:], strict=True)]])
        found = [(n.lower(), value) for n, value in _ATTRIBUTE.findall(told)]
        plain = [value for _, value in found] == [f'"{mark}"' for mark in marks] and len(dict(found)) == len(found)
        shape.names = tuple([n for n, _ in found]) if plain else None
        asked = {n: (None if words else values, tests) for n, words, values, tests in self.watched if words or values or tests}
        shape.watched = [(i, *asked[n]) for i, n in enumerate(shape.names or ()) if n in asked]
        return shape

    def step(self, state: State, kind: Kind) -> tuple[State, State, dict] | None:
        """(state the element is opened in, state after its start tag, what it gives); None if it stands too deep."""
        base = state
        for ended in ENDS.get(kind.tag, ()):
            at = base
            while at is not None:
                if at.kind.tag == ended:
                    base = at.parent
                    break
                if at.kind.tag in SCOPE[ended]:
                    break
                at = at.parent
        if base.depth >= MAX_DEPTH:
            return None
        inner = self._state(kind, base)
        found = base, base if kind.empty else inner, inner.takes
        if self.size < MAX_STATES:
            self.size += 1
            state.steps[kind] = found
        return found

    def up(self, state: State, name: str) -> State:
        """The state after an end tag."""
        tag, at = name.lower(), state
        while at is not None and at.kind.tag != tag:
            at = at.parent
        after = state if at is None or tag in VOID else at.parent
        if self.size < MAX_STATES:
            self.size += 1
            state.ups[name] = after
        return after

    def scan(self, html: str) -> list | None:
        """The record of the page; None if it has to be read piece by piece."""
        if self.size >= MAX_STATES:
            self._restart()
        state, starts, out, texts = self.root, self.starts, self.group.record(), []
        searches: list[tuple[Group, list]] = [(self.group, out)]  # open matches that have fields of their own
        held: list[tuple] = []  # per open element that gave something: (depth, texts before, texts wanted, searches before)
        if state.takes:
            _open(state.takes, {}, state.depth, texts, searches, held)
        pieces = _PIECES.split(html)
        pieces += [None] * 5
        pieces = iter(pieces)
        for run, ended, inside, _, _, broken in zip(pieces, pieces, pieces, pieces, pieces, pieces):  # noqa: B905
            if run:
                if "&" in run:
                    run = unescape(run)
                run = run.strip()
                if run and state.textual:
                    texts.append(run)
            if inside is not None:
                kind, attrs = starts.get(inside) or self.start(inside)
                step = state.steps.get(kind) or self.step(state, kind)
                if step is None:
                    return None
                base, state, takes = step
                if held and held[-1][0] > base.depth:
                    _close(base.depth, texts, searches, held)
                if takes:
                    _open(takes, attrs, base.depth + 1, texts, searches, held)
                    if kind.empty and held and held[-1][0] > base.depth:
                        _close(base.depth, texts, searches, held)
            elif ended is not None:
                state = state.ups.get(ended) or self.up(state, ended)
                if held and held[-1][0] > state.depth:
                    _close(state.depth, texts, searches, held)
            elif broken is not None:
                return None
        _close(0, texts, searches, held)
        return out

    def record(self, html: str) -> list:
        """The record of any page."""
        found = self.scan(html)
        return self.group.listed(SelectScan(self).scan_pieces(html).out) if found is None else found


def struct_array(group: Group, records: list) -> pa.StructArray:
    """Records (None for one that is missing) as an Arrow column of structs, made field by field."""
    missing = [record is None for record in records]
    if any(missing):
        blank = group.record()
        records = [blank if record is None else record for record in records]
    columns = []
    for spec, inner, values in zip(group.specs, group.inner, zip(*records, strict=True) if records else [()] * len(group.specs), strict=True):
        items = list(chain.from_iterable(values)) if spec.multiple else values
        column = struct_array(inner, items) if inner else pa.array(items, pa.string())
        if spec.multiple:
            column = pa.ListArray.from_arrays(pa.array(accumulate(map(len, values), initial=0), pa.int32()), column)
        columns.append(column)
    return pa.StructArray.from_arrays(columns, [spec.name for spec in group.specs], mask=pa.array(missing, pa.bool_()))


def _open(takes: dict, attrs: dict, depth: int, texts: list, searches: list, held: list) -> None:
    """What an element gives to the open records; only a first one gives where one value is wanted."""
    before, wanted = len(searches), []
    for group, record in searches[:]:
        for entry in takes.get(group, ()):
            if entry[1] or record[entry[0]] is None:
                _give(entry, record, attrs, searches, wanted)
    if wanted or len(searches) > before:
        held.append((depth, len(texts), wanted, before))


def _give(entry: tuple, record: list, attrs: dict, searches: list, wanted: list) -> None:
    place, multiple, attribute, separator, inner = entry
    if inner:
        value = inner.record()
        searches.append((inner, value))
        for at, name in inner.own:
            value[at] = attrs.get(name, "")
        for own in inner.scope:
            _give(own, value, attrs, searches, wanted)
    else:
        value = "" if attribute is None else attrs.get(attribute, "")
    if multiple:
        record = record[place]
        place = len(record)
        record.append(value)
    else:
        record[place] = value
    if attribute is None and not inner:
        wanted.append((record, place, separator))


def _close(depth: int, texts: list, searches: list, held: list) -> None:
    """Close the elements below ``depth``: their texts are complete."""
    while held and held[-1][0] > depth:
        _, first, wanted, before = held.pop()
        for values, place, separator in wanted:
            values[place] = separator.join(texts[first:])
        del searches[before:]


class SelectScan(PageScan):
    """Collects the values of field specs; ``out`` is the record of the page itself."""

    every = False

    def __init__(self, plan: SelectPlan):
        super().__init__(plan.seen)
        self.plan = plan
        self.out = self._empty(plan.fields)
        # (element, record, specs by selector) of the open matches that have fields of their own
        self.searches: list[tuple[Element | None, dict, dict]] = [(None, self.out, plan.by_selector[id(plan.fields)])]

    @staticmethod
    def _empty(fields: tuple[FieldSpec, ...]) -> dict:
        return {spec.name: [] if spec.multiple else None for spec in fields}

    def scan(self, html: str):
        found = self.plan.scan(html)
        if found is None:
            return self.scan_pieces(html)
        self.out = self.plan.group.named(found)
        return self

    def scan_pieces(self, html: str):
        """The same, one piece after the other: any page, with one element for each that is open."""
        return super().scan(html)

    def opened(self, element: Element) -> None:
        start = element.start
        if start.selected is None:
            start.selected = self.plan.selected_by(start)
        hits, others = start.selected.sure, start.selected.others
        if others:
            hits += tuple([s for s, fitting in others if any([matches(self.stack, steps) for steps in fitting])])
        if not hits:
            return
        for _, record, by_selector in self.searches[:]:
            for selector in hits:
                if selector in by_selector:
                    for spec in by_selector[selector]:
                        if spec.multiple or record[spec.name] is None:
                            self._take(element, spec, record)

    def _take(self, element: Element, spec: FieldSpec, record: dict) -> None:
        name, values = spec.name, None
        if spec.children:
            value, by_selector = self._empty(spec.children), self.plan.by_selector[id(spec.children)]
            self.searches.append((element, value, by_selector))
            element.open_hits.append(None)
            for child in by_selector.get(":scope", ()):
                self._take(element, child, value)
        else:
            value = element.attrs.get(spec.attribute, "")
        if spec.multiple:
            values = record[name]
            values.append(value)
        else:
            record[name] = value
        if spec.attribute == "text" and not spec.children:
            element.open_hits.append((spec, record, len(values) - 1 if spec.multiple else None))

    def closed(self, element: Element) -> None:
        for entry in element.open_hits:
            if entry is None:
                self.searches = [s for s in self.searches if s[0] is not element]
                continue
            spec, record, slot = entry
            text = spec.separator.join(self.texts[element.first_text :])
            if slot is None:
                record[spec.name] = text
            else:
                record[spec.name][slot] = text


# Attributes whose value is a list of tokens.
TOKEN_LISTS = {"rel", "rev", "accept-charset", "headers", "accesskey", "dropzone"}
SKIPPED = {"svg", "script", "style"}


class CascadeScan(PageScan):
    """Nested JSON ``{tag: {text, attrs, children}}`` of every container element.

    JSON text is built from the leaves up, so nesting depth is not limited by recursion.
    Without a container selector each child of the body (of the page, if it has none) is a record.
    """

    def __init__(self, container: list | None):
        super().__init__({})
        self.container = container
        self.found: list[tuple[int, str, str]] = []  # (position, tag of the parent, JSON)
        self.open_nodes: list[tuple] = []  # per open element: (children JSON, inside a record, position if a record)
        self.position = 0

    def opened(self, element: Element) -> None:
        self.position += 1
        inside = bool(self.open_nodes) and self.open_nodes[-1][1]
        if self.container is not None:
            is_record = any(matches(self.stack, steps) for steps in self.container)
        else:
            is_record = len(self.stack) > 1 and self.stack[-2].tag in ("body", ":root")
            is_record = is_record and element.tag not in SKIPPED | {"head"}
        inside = (inside or is_record) and (is_record or element.tag not in SKIPPED)
        self.open_nodes.append(([], inside, self.position if is_record else None))

    def closed(self, element: Element) -> None:
        children, inside, position = self.open_nodes.pop()
        if not inside:
            return
        parts = []
        text = "".join(self.texts[element.first_text :])
        if text and not children:
            parts.append(f'"text": {json.dumps(text, ensure_ascii=False)}')
        attrs = {
            name: value.split() if name in TOKEN_LISTS else value
            for name, value in element.attrs.items()
            if name not in ("class", "style") and not name.startswith("on")
        }
        if attrs:
            parts.append(f'"attrs": {json.dumps(attrs, ensure_ascii=False)}')
        if children:
            parts.append(f'"children": [{", ".join(children)}]')
        if not parts:
            return
        rendered = f"{{{json.dumps(element.tag)}: {{{', '.join(parts)}}}}}"
        if position is not None:
            self.found.append((position, self.stack[-2].tag if len(self.stack) > 1 else "", rendered))
        if self.open_nodes and self.open_nodes[-1][1] and element.tag not in SKIPPED:
            self.open_nodes[-1][0].append(rendered)

    def records(self) -> list[str]:
        found = sorted(self.found)
        if self.container is None and any(parent == "body" for _, parent, _ in found):
            found = [f for f in found if f[1] == "body"]
        return [rendered for _, _, rendered in found]
