"""Pages read once: rules are matched while the page is read, and only what they take leaves Python.

A rule names steps to some elements and what to keep of them. ``page_reader`` carries, for every open element, the
steps that its children or all elements below it may take next, so one walk answers all rules and attributes are read
only where a step asks for them. ``read_page`` gives the whole page as a node table, for what rules do not say.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property
from html import unescape

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..schemas import PAGE

# Elements without content, elements closed by the next one of the same kind within
# the containers named beside them, and elements that end an open paragraph.
_EMPTY = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_CLOSED_BY_SIBLING = {
    "li": ("ul", "ol"),
    "tr": ("table",),
    "td": ("tr", "table"),
    "dt": ("dl",),
    "dd": ("dl",),
    "option": ("select",),
}
_PARAGRAPH_LIMITS = ("div", "td", "li", "article", "section", "body")
_ENDS_PARAGRAPH = frozenset(
    "article aside blockquote div dl footer form h1 h2 h3 h4 h5 h6 header hr nav ol p pre section "
    "table ul".split()
)


_RAW_TEXT = {tag: re.compile(rf"</{tag}\b", re.I) for tag in ("script", "style")}
# A comment, a declaration, or a tag with its attributes. Repeats are possessive: an unclosed quote or
# tag ends the token there instead of trying every shorter one.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>?""",
    re.S,
)
_HAS_RAW_TEXT = re.compile(r"<(?:script|style)\b", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"']++)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")


class _Walk:
    """Open elements of a page, the outermost first; unclosed and stray tags are tolerated."""

    def __init__(self, root):
        self.open = [root]

    def begin(self, tag: str, attributes: str) -> None:
        if tag in _ENDS_PARAGRAPH:
            self.end("p", _PARAGRAPH_LIMITS)
        if tag in _CLOSED_BY_SIBLING:
            self.end(tag, _CLOSED_BY_SIBLING[tag])
        element = self.opened(tag, attributes)
        if tag not in _EMPTY:
            self.open.append(element)

    def end(self, tag: str, limits=()) -> None:
        """Close the nearest open ``tag`` and all inside it, looking no further than ``limits``."""
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                return self.close(depth)
            if self.open[depth].tag in limits:
                return None

    def close(self, depth: int = 1) -> None:
        del self.open[depth:]

    def read(self, html: str | None):
        html, at = html or "", 0
        while found := _MARKUP.search(html, at):
            self.said(html[at : found.start()])
            at, tag = found.end(), (found["tag"] or "").lower()
            if found["end"]:
                self.end(tag)
            elif tag:
                self.begin(tag, found["attrs"])
                if tag in _RAW_TEXT:
                    stop = _RAW_TEXT[tag].search(html, at)
                    until = stop.start() if stop else len(html)
                    self.said(html[at:until], raw=True)
                    at = until
        self.said(html[at:])
        self.close()
        return self


def _attributes(text: str) -> dict[str, str]:
    attrs: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        attrs.setdefault(name.lower(), unescape(double or single or bare))
    return attrs


@dataclass
class _Node:
    tag: str | None
    row: dict = field(default_factory=lambda: {"kids": [], "text": []})
    counts: dict = field(default_factory=dict)


class _Nodes(_Walk):
    """Collects the nodes of a page in document order, with an index of ids and classes."""

    def __init__(self):
        super().__init__(_Node(None))
        self.nodes: list[dict] = []
        self.places: dict[str, dict[str, list[int]]] = {"id": {}, "class": {}}

    def opened(self, tag: str, attributes: str) -> _Node:
        at, attrs, above = len(self.nodes), _attributes(attributes), self.open[-1]
        nth = above.counts[tag] = above.counts.get(tag, 0) + 1
        row = dict(idx=at, last=at, kids=[], tag=tag, nth=nth, attrs=list(attrs.items()), text=[])
        self.nodes.append(row)
        above.row["kids"].append(at)
        for name, index in self.places.items():
            if name in attrs:
                index.setdefault(attrs[name], []).append(at)
        return _Node(tag, row)

    def close(self, depth: int = 1) -> None:
        for node in self.open[depth:]:
            node.row["last"] = len(self.nodes) - 1
        super().close(depth)

    def said(self, text: str, raw: bool = False) -> None:
        if text and len(self.open) > 1:
            self.open[-1].row["text"].append(text if raw else unescape(text))


def _read(html: str | None) -> dict:
    page = _Nodes().read(html)
    return {"nodes": page.nodes, "ids": page.places["id"], "classes": page.places["class"]}


@F.arrow_udf(PAGE)
def _read_pages(pages: pa.Array) -> pa.Array:
    return pa.array([_read(h) for h in pages.to_pylist()], to_arrow_type(PAGE))


# Not to be repeated: a filter on what was read must not be pushed below the reading, or every page
# would be read once for the filter and once more for the result.
read_page = _read_pages.asNondeterministic()


@dataclass(frozen=True)
class Step:
    """One selector step: a tag, a position among same-tag siblings, required attributes."""

    tag: str | None = None
    nth: int | None = None
    deep: bool = False
    attrs: dict = field(default_factory=dict)

    @cached_property
    def sign(self) -> str:
        """What stands in the attributes of every element that the step accepts, unless they escape something."""
        return max(self.attrs.values(), key=len, default="")

    @cached_property
    def plainly(self) -> str | None:
        """Attributes that say just what the step asks for, as they are mostly written."""
        (name, value), *more = self.attrs.items() or [("", "")]
        plain = not more and name and name == name.lower() and not re.search(r"""[\s=/"'&]""", name) and value
        return f' {name}="{value}"' if plain and not re.search(r"""[&"]""", value) else None

    def possible(self, tag: str, attributes: str) -> bool:
        """False only where ``accepts`` would be."""
        return (self.tag is None or self.tag == tag) and (self.sign in attributes or "&" in attributes)

    def accepts(self, element: _Element) -> bool:
        if self.nth is not None and self.nth != element.nth:
            return False
        if not self.attrs or element.text_of_attrs == self.plainly:
            return True
        return all([element.attr(name) == value for name, value in self.attrs.items()])


def child(tag: str | None = None, nth: int | None = None, **attrs) -> Step:
    return Step(tag, nth, False, {k.rstrip("_"): v for k, v in attrs.items()})


def deep(tag: str | None = None, nth: int | None = None, **attrs) -> Step:
    return Step(tag, nth, True, {k.rstrip("_"): v for k, v in attrs.items()})


@dataclass(frozen=True)
class Rule:
    """What to take of the elements that ``steps`` reach, in document order, each element once.

    ``text`` (the first text directly inside any of them), ``texts``, ``count``, ``any``, ``@name`` (attribute of the
    first), ``@@name`` (that attribute of all that have it), or ``each``: one struct per element, filled by the rules in
    ``each``, which start from the element; a rule without steps takes from the element itself. ``default`` stands for null.
    """

    steps: tuple[Step, ...]
    take: str = "text"
    default: object = None
    each: dict = field(default_factory=dict)

    @property
    def type(self) -> T.DataType:
        if self.take == "each":
            return T.ArrayType(rules_type(self.each))
        if self.take == "texts" or self.take.startswith("@@"):
            return T.ArrayType(T.StringType())
        return {"count": T.IntegerType(), "any": T.BooleanType()}.get(self.take, T.StringType())


def rule(*steps: Step, take: str = "text", default=None, **each: Rule) -> Rule:
    return Rule(steps, "each" if each else take, default, each)


def rules_type(rules: Mapping[str, Rule]) -> T.StructType:
    return T.StructType([T.StructField(name, r.type) for name, r in rules.items()])


class _Taken:
    """What a rule has met below its start so far."""

    __slots__ = ("rule", "met")

    def __init__(self, given: Rule):
        self.rule, self.met = given, []

    def meet(self, element: _Element) -> None:
        take = self.rule.take
        if take in ("text", "texts"):
            if element.texts is None:
                element.texts = []
            self.met.append(element.texts)
        elif take == "each":
            self.met.append(element.start(self.rule.each))
        else:
            self.met.append(element.attr(take.lstrip("@")) if take[0] == "@" else None)

    def value(self):
        take, met = self.rule.take, self.met
        if take == "each":
            return [values_of(taken) for taken in met]
        if take == "texts":
            return [text for texts in met for text in texts]
        if take == "count":
            return len(met)
        if take == "any":
            return bool(met)
        if take[:2] == "@@":
            return [value for value in met if value is not None]
        first = next((texts[0] for texts in met if texts), None) if take == "text" else next(iter(met), None)
        return self.rule.default if first is None else first


def values_of(taken: dict[str, _Taken]) -> dict:
    return {name: t.value() for name, t in taken.items()}


class _Element:
    """An open element: the steps its children (``direct``) and all elements below it (``lasting``) may take next.

    An element that no step leads to holds nothing of its own; those below the same ``lasting`` share ``plain``.
    """

    __slots__ = ("nth", "text_of_attrs", "attrs", "counts", "direct", "lasting", "texts", "steps", "plain", "counted", "own")

    def __init__(self, nth: int, attributes: str, lasting: list, plain: _Element | None = None, counted: bool = False):
        self.nth, self.text_of_attrs, self.lasting, self.plain = nth, attributes, lasting, plain
        self.attrs = self.texts = None
        self.direct: list = []
        self.steps, self.counted = lasting, counted  # whether lasting steps ask for positions
        self.counts = {} if counted else None
        self.own = False

    def attr(self, name: str) -> str | None:
        if self.attrs is None:
            self.attrs = _attributes(self.text_of_attrs) if self.text_of_attrs else {}
        return self.attrs.get(name)

    def start(self, rules: Mapping[str, Rule]) -> dict[str, _Taken]:
        taken = {name: _Taken(r) for name, r in rules.items()}
        for t in taken.values():
            self.follow(t, 0)
        return taken

    def follow(self, taken: _Taken, at: int) -> None:
        """The first ``at`` steps of a rule lead here."""
        steps = taken.rule.steps
        if at == len(steps):
            taken.meet(self)
            return
        step = steps[at]
        if not step.deep:
            for known, followers in self.direct:
                if known is step:
                    followers.append((taken, at))
                    return
            self.direct.append((step, [(taken, at)]))
        elif any([t is taken and a == at for _, ((t, a),) in self.lasting]):
            return
        else:
            self.lasting = [*self.lasting, (step, [(taken, at)])]  # lists are shared with the elements above
            self.plain, self.counted = None, self.counted or step.nth is not None
        self.steps = self.direct + self.lasting
        if step.nth is not None and self.counts is None:
            self.counts = {}

    def below(self) -> _Element:
        """An element inside that no step leads to."""
        if self.counted:
            return _Element(1, "", self.lasting, None, True)
        if self.plain is None:
            self.plain = _Element(1, "", self.lasting)
            self.plain.plain = self.plain  # and so on below it
        return self.plain


def _tokens(html: str) -> tuple[list, set[int]]:
    """Text, end mark, tag and attributes by turns, and the places of texts that stand as they are."""
    if not _HAS_RAW_TEXT.search(html):
        return _MARKUP.split(html), set()
    tokens, raw, at = [], set(), 0
    while found := _MARKUP.search(html, at):
        tokens += (html[at : found.start()], *found.groups())
        at = found.end()
        if not found["end"] and (tag := (found["tag"] or "").lower()) in _RAW_TEXT:
            stop = _RAW_TEXT[tag].search(html, at)
            until = stop.start() if stop else len(html)
            raw.add(len(tokens))
            tokens += (html[at:until], None, None, None)
            at = until
    return [*tokens, html[at:]], raw


def _last_possible(tokens: list, steps: list) -> int:
    """The place of the last tag that a step from anywhere may accept, or -1."""
    if all(step.attrs for step, _ in steps):  # most tags are passed by their attributes
        signs = ["&", *{min(step.attrs.values(), key=len) for step, _ in steps}]
        places = (i for i in range(len(tokens) - 2, 0, -4) if (text := tokens[i]) and any([sign in text for sign in signs]))
    else:
        places = range(len(tokens) - 2, 0, -4)
    for i in places:
        if (tag := tokens[i - 1]) and not tokens[i - 2]:
            tag = tag.lower()
            if any(step.possible(tag, tokens[i]) for step, _ in steps):
                return i - 3
    return -1


def _taken(html: str | None, rules: Mapping[str, Rule]) -> dict[str, _Taken]:
    """What the rules take of a page. Open elements are those of ``_Walk``, as a list of tags and one of elements."""
    root = _Element(1, "", [])
    taken = root.start(rules)
    tokens, raw = _tokens(html or "")
    tags, elements, top = [None], [root], root
    own, last = 0, None  # open elements that steps led to, and behind which place no step leads anywhere
    steps = root.steps
    for i, text, end, tag, attributes in zip(range(0, len(tokens), 4), tokens[::4], tokens[1::4], tokens[2::4], tokens[3::4]):
        if text and top.texts is not None:
            top.texts.append(text if i in raw else unescape(text))
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tags[-1] == tag:
                tags.pop()
                own -= elements.pop().own
                top = elements[-1]
                steps = top.steps
                ends = ()
            else:
                ends = ((tag, ()),) if tag in tags else ()
        elif "p" in tags and tag in _ENDS_PARAGRAPH:
            ends = (("p", _PARAGRAPH_LIMITS), *(((tag, _CLOSED_BY_SIBLING[tag]),) if tag in _CLOSED_BY_SIBLING else ()))
        elif tag in _CLOSED_BY_SIBLING and tag in tags:
            ends = ((tag, _CLOSED_BY_SIBLING[tag]),)
        else:
            ends = ()
        for closed, limits in ends:
            for depth in range(len(tags) - 1, 0, -1):
                if tags[depth] == closed:
                    own -= sum([element.own for element in elements[depth:]])
                    del tags[depth:], elements[depth:]
                    top = elements[-1]
                    steps = top.steps
                    break
                if tags[depth] in limits:
                    break
        if end:
            if not own and not root.direct:
                if last is None:
                    last = _last_possible(tokens, root.lasting)
                if i > last:
                    break
            continue
        if top.counts is not None:
            top.counts[tag] = top.counts.get(tag, 0) + 1
        element = None
        for step, followers in steps:
            if step.tag is not None and step.tag != tag:
                continue
            if step.sign and step.sign not in attributes and "&" not in attributes:
                continue
            if element is None:
                nth = 1 if top.counts is None else top.counts[tag]
                element = _Element(nth, attributes, top.lasting, top.plain, top.counted)
            if step.accepts(element):
                for taken_on, at in followers:
                    element.follow(taken_on, at + 1)
        if top is root and root.direct:  # a path from the document begins at its first element
            root.direct, root.steps = [], root.lasting
            steps = root.steps
        if tag in _EMPTY:
            continue
        if element is None or element.texts is None and element.steps is top.lasting:
            element = top.below()
        else:
            element.own = True
        own += element.own
        tags.append(tag)
        elements.append(element)
        top, steps = element, element.steps
    else:
        text = tokens[-1]
        if text and top.texts is not None:
            top.texts.append(text if len(tokens) - 1 in raw else unescape(text))
    return taken


class _Matcher:
    """What ``rules`` take of a page."""

    def __init__(self, rules: Mapping[str, Rule]):
        self.rules, self.taken = rules, {}

    def read(self, html: str | None) -> _Matcher:
        self.taken = _taken(html, self.rules)
        return self


def page_reader(rules: Mapping[str, Rule]):
    """An Arrow function from pages to a struct with one field per rule; null and malformed pages give nulls and empty
    lists. As ``read_page`` it is not repeated by filters on its result."""
    rules, shape = dict(rules), rules_type(rules)

    @F.arrow_udf(shape)
    def read(pages: pa.Array) -> pa.Array:
        found = [values_of(_Matcher(rules).read(html).taken) for html in pages.to_pylist()]
        return pa.array(found, to_arrow_type(shape))

    return read.asNondeterministic()
