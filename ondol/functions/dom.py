"""A tolerant mini DOM with the CSS subset that board layouts need: tag, #id, .class, [attr], [attr*=v], :not(.class), descendant
and child combinators, comma lists."""

from __future__ import annotations

import re
from html.parser import HTMLParser

#: Elements without an end tag, and elements that end where one of these starts.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
ENDS = {"p": {"p", "div", "ul", "ol", "table", "section", "h1", "h2", "h3"}, "li": {"li"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


class Element:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []

    def elements(self):
        for c in self.children:
            if isinstance(c, Element):
                yield c
                yield from c.elements()

    def strings(self):
        for c in self.children:
            if isinstance(c, str):
                yield c
            elif c.tag not in ("script", "style"):
                yield from c.strings()

    def text(self, separator: str = "") -> str:
        """The stripped texts of all nodes, joined, with runs of white space made one space."""
        return re.sub(r"\s+", " ", separator.join(s.strip() for s in self.strings() if s.strip())).strip()

    def select(self, selector: str) -> list[Element]:
        """The elements below this one that match, in document order."""
        groups = [_parsed(g) for g in selector.split(",")]
        return [e for e in self.elements() if any(_matches(e, g, self) for g in groups)]

    def first(self, selector: str) -> Element | None:
        return next(iter(self.select(selector)), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        node = self.at
        while node.tag in ENDS and tag in ENDS[node.tag]:
            node = node.parent
        self.at = node
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Element:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


_PART = re.compile(r"(?P<comb>\s*>\s*|\s+)|(?P<tag>[a-zA-Z][\w-]*|\*)|#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>\*?\^?\$?=)[\"']?(?P<val>[^\"'\]]*)[\"']?)?\]|:not\(\.(?P<no>[\w-]+)\)")


def _parsed(selector: str) -> list[tuple[str, list[tuple]]]:
    """Compound selectors with the combinator before each."""
    out: list[tuple[str, list[tuple]]] = [("", [])]
    for m in _PART.finditer(selector.strip()):
        if m["comb"] is not None:
            out.append((">" if ">" in m["comb"] else " ", []))
        elif m["tag"]:
            out[-1][1].append(("tag", m["tag"].lower()))
        elif m["id"]:
            out[-1][1].append(("id", m["id"]))
        elif m["cls"]:
            out[-1][1].append(("cls", m["cls"]))
        elif m["no"]:
            out[-1][1].append(("no", m["no"]))
        else:
            out[-1][1].append(("attr", m["attr"], m["op"], m["val"]))
    return out


def _fits(e: Element, tests: list[tuple]) -> bool:
    classes = e.attrs.get("class", "").split()
    for t in tests:
        if t[0] == "tag" and t[1] not in ("*", e.tag) or t[0] == "id" and e.attrs.get("id") != t[1] or t[0] == "cls" and t[1] not in classes or t[0] == "no" and t[1] in classes:
            return False
        if t[0] == "attr":
            value = e.attrs.get(t[1])
            if value is None or t[2] == "=" and value != t[3] or t[2] == "*=" and t[3] not in value or t[2] == "^=" and not value.startswith(t[3]) or t[2] == "$=" and not value.endswith(t[3]):
                return False
    return True


def _matches(e: Element, chain: list[tuple[str, list[tuple]]], top: Element) -> bool:
    comb, tests = chain[-1]
    if not _fits(e, tests):
        return False
    if len(chain) == 1:
        return True
    p = e.parent
    while p is not None and p is not top.parent:
        if p.tag != "#root" and _matches(p, chain[:-1], top):
            return True
        if comb == ">":
            return False
        p = p.parent
    return False
