"""Small HTML helper used inside Arrow batches (``mapInPandas``): build an element tree
with the standard library parser and pick elements by simple CSS selectors.

Supported selectors: descendant chains of compound parts made of a tag name, ``.class``
(any number), ``[attr]``, ``[attr=value]`` and ``[attr*=value]``. That covers every
selector the listing pages need; anything richer is out of scope.

Plain markup (most pages) is cut into tags by one regular expression; a page with anything else in
it (comments, bare ``<``, references in attributes, open scripts) goes through ``HTMLParser``. Both
build the same tree.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_HIDDEN = {"script", "style", "template"}


class Node:
    #: ``index``, of a tree's root only: its elements by tag and by ``[attribute]``, in document order.
    __slots__ = ("tag", "attrs", "children", "parent", "index")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent, self.index = tag, attrs, [], parent, None

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def strings(self, hidden: bool = False):
        todo = self.children[::-1]  # a stack: pages may nest deeper than Python's calls
        while todo:
            ch = todo.pop()
            if isinstance(ch, str):
                yield ch
            elif hidden or ch.tag not in _HIDDEN:
                todo.extend(reversed(ch.children))

    def text(self, sep: str = " ") -> str:
        """Text of the subtree: each string stripped, empty ones dropped, joined."""
        return sep.join([t for s in self.strings() if (t := s.strip())])

    def raw_text(self) -> str:
        return "".join(self.strings(hidden=True))

    def descendants(self):
        todo = self.children[::-1]
        while todo:
            ch = todo.pop()
            if isinstance(ch, Node):
                yield ch
                todo.extend(reversed(ch.children))


class _Tree:
    """The tree so far: the root with its index, and the element that is open."""

    def __init__(self):
        self.root = self.cur = Node("#root", {}, None)
        self.root.index = defaultdict(list)

    def start(self, tag: str, attrs: dict, opens: bool) -> None:
        node = Node(tag, attrs, self.cur)
        self.cur.children.append(node)
        self.root.index[tag].append(node)
        for name in attrs:
            self.root.index[f"[{name}]"].append(node)
        if opens:
            self.cur = node

    def end(self, tag: str) -> None:
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tree = _Tree()

    def handle_starttag(self, tag, attrs):
        self.tree.start(tag, {k: (v or "") for k, v in attrs}, tag not in _VOID)

    def handle_startendtag(self, tag, attrs):
        self.tree.start(tag, {k: (v or "") for k, v in attrs}, False)

    def handle_endtag(self, tag):
        self.tree.end(tag)

    def handle_data(self, data):
        self.tree.cur.children.append(data)


_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n\f][^<>]*)?)>([^<]*)")
_NAME = r"[a-zA-Z_][-a-zA-Z0-9_.:]*"
_ATTRS = re.compile(rf"(?:[ \t\r\n\f]+{_NAME}(?:=\"[^\"&]*\")?)*[ \t\r\n\f]*")
_ATTR = re.compile(rf"({_NAME})(?:=\"([^\"]*)\")?")
_DOCTYPE = re.compile(r"(\s*)<!doctype(?:\s[^<>]*)?>", re.I)
#: Elements whose text is no markup for the parser.
_RAW = set(HTMLParser.CDATA_CONTENT_ELEMENTS)


@lru_cache(maxsize=4096)
def _plain_attrs(text: str) -> tuple[dict, list[str]] | None:
    """A tag's attributes and their keys in the index, None if they are not all ``name`` or ``name="value"``.
    Tags that are written alike share them."""
    if not _ATTRS.fullmatch(text):
        return None
    attrs = {k.lower(): v for k, v in _ATTR.findall(text)}
    return attrs, [f"[{name}]" for name in attrs]


def _plain_tree(html: str) -> Node | None:
    """The tree of a page of plain markup only; None for any other."""
    tree, at = _Tree(), 0
    if doctype := _DOCTYPE.match(html):
        at = doctype.end()
        if doctype[1]:
            tree.root.children.append(doctype[1])
    tags = _TAG.findall(html, at)
    if len(tags) != html.count("<", at):  # a "<" that begins no plain tag
        return None
    first = html.find("<", at)
    if lead := html[at:] if first < 0 else html[at:first]:
        tree.root.children.append(unescape(lead))
    cur, index, raw = tree.root, tree.root.index, None
    for close, tag, attrs, text in tags:
        tag = tag.lower()
        if close:
            if (raw and tag != raw) or (attrs and attrs.strip(" \t\r\n\f")):
                return None
            raw = None
            if tag == cur.tag:
                cur = cur.parent
            else:
                tree.cur = cur
                tree.end(tag)
                cur = tree.cur
        else:
            if raw:
                return None
            node = Node(tag, {}, cur)
            cur.children.append(node)
            index[tag].append(node)
            if attrs:
                known = _plain_attrs(attrs)
                if known is None:
                    return None
                node.attrs = known[0]
                for key in known[1]:
                    index[key].append(node)
            if tag not in _VOID:
                cur = node
            if tag in _RAW:
                raw = tag
        if text:
            cur.children.append(unescape(text) if "&" in text and not raw else text)
    return None if raw else tree.root


def parse(html: str | None, strict: bool = False) -> Node:
    """The page's tree; markup that the parser rejects is raised if ``strict``, else the page
    ends there."""
    root = _plain_tree(html or "")
    if root is not None:
        return root
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except (AssertionError, ValueError):
        if strict:
            raise
    return b.tree.root


_PART = re.compile(r"([a-zA-Z0-9]+)|\.([-\w]+)|\[([-\w]+)(?:(\*?=)\"?([^\]\"]*)\"?)?\]")


def _compile(part: str):
    tag, checks = None, []
    for m in _PART.finditer(part):
        if m.group(1):
            tag = m.group(1).lower()
        elif m.group(2):
            checks.append(("class", m.group(2)))
        else:
            checks.append(("attr", m.group(3), m.group(4), m.group(5)))
    return tag, checks


@lru_cache(maxsize=256)
def _compiled(selector: str) -> list:
    return [_compile(p) for p in selector.split()]


def _candidates(root: Node, compiled):
    """The descendants that can match, in document order: of a whole tree those its index names."""
    tag, checks = compiled
    if root.index is None or not (tag or checks):
        return root.descendants()
    return root.index.get(tag or ("[class]" if checks[0][0] == "class" else f"[{checks[0][1]}]"), [])


@lru_cache(maxsize=4096)
def _words(text: str) -> list[str]:
    return text.split()


def _matches(node: Node, compiled) -> bool:
    tag, checks = compiled
    if tag and node.tag != tag:
        return False
    for chk in checks:
        if chk[0] == "class":
            if chk[1] not in _words(node.attrs.get("class") or ""):
                return False
        else:
            _, name, op, value = chk
            if name not in node.attrs:
                return False
            if op == "=" and node.attrs[name] != value:
                return False
            if op == "*=" and value not in node.attrs[name]:
                return False
    return True


def _found(root: Node, selector: str):
    parts = _compiled(selector)
    below = {}  # whether the elements around match the rest of the chain, by parent
    for node in _candidates(root, parts[-1]):
        if not _matches(node, parts[-1]):
            continue
        if len(parts) > 1:
            key = id(node.parent)
            if key not in below:
                i, anc = len(parts) - 2, node.parent
                while i >= 0 and anc is not None:
                    if _matches(anc, parts[i]):
                        i -= 1
                    anc = anc.parent
                below[key] = i < 0
            if not below[key]:
                continue
        yield node


def select(root: Node, selector: str) -> list[Node]:
    """Elements matching a descendant-chain selector, in document order."""
    return list(_found(root, selector))


def select_one(root: Node, selector: str) -> Node | None:
    return next(_found(root, selector), None)


def _texts(root: Node, selector: str) -> list[str]:
    return [n.text(" ") for n in select(root, selector)]


def _scalar(v) -> str | None:
    return None if isinstance(v, (dict, list)) else _text(v)


def _text(v) -> str | None:
    """A JSON value as text (a price's number is then read from it); null stays null."""
    return None if v is None else str(v)


def json_ld_offers(root: Node) -> list[dict]:
    """Every object (pre-order, blocks in page order) whose @type is or lists 'Offer'."""
    out = []
    for script in select(root, 'script[type="application/ld+json"]'):
        raw = script.raw_text()
        if not raw.strip():
            continue
        try:
            data = json.loads(raw)
        except ValueError:
            continue
        stack = [data]
        while stack:
            v = stack.pop()
            if isinstance(v, dict):
                t = v.get("@type")
                if (isinstance(t, list) and "Offer" in t) or t == "Offer":
                    spec = v.get("priceSpecification")
                    out.append(
                        {
                            "url": _scalar(v.get("url")) if v.get("url") is not None else None,
                            "url_text": str(v.get("url", "")),
                            "price": _text(v.get("price")),
                            "spec_price": _text(spec.get("price")) if isinstance(spec, dict) else None,
                            "has_spec": bool(spec),
                        }
                    )
                stack.extend(reversed(list(v.values())))
            elif isinstance(v, list):
                stack.extend(reversed(v))
    return out


PRICE_SELECTORS = [".sticky-price", "[class*=price]", "h4"]


def _first_text(root: Node, *selectors: str) -> str | None:
    found = next((n for s in selectors if (n := select_one(root, s)) is not None), None)
    return found.text(" ") if found is not None else None


_PARTS = {
    "h1": lambda root: _first_text(root, "h1"),
    "description": lambda root: _first_text(root, ".cms-content-inner", ".cms-content"),
    "main_items": lambda root: _texts(root, ".property__main-details ul li"),
    "amenity_items": lambda root: _texts(root, ".property__amenities ul li"),
    "location_items": lambda root: _texts(root, ".property__location ul li"),
    "offers": json_ld_offers,
    "price_texts": lambda root: [t for sel in PRICE_SELECTORS for t in _texts(root, sel)],
}


def listing_parts(html: str | None, wanted: list[str] | None = None) -> dict:
    """Raw pieces of a listing page (or those ``wanted``); all interpretation happens in Spark expressions."""
    root = parse(html, strict=True)
    return {name: _PARTS[name](root) for name in wanted or _PARTS}


def card_links(html: str | None, card_selector: str, link_selectors: list[str]) -> list[str | None]:
    """For each card, the href of the first link found by the first selector that
    finds one (None for a card without links)."""
    root = parse(html)
    out = []
    for card in select(root, card_selector):
        href = None
        for sel in link_selectors:
            link = select_one(card, sel)
            if link is not None:
                href = link.attrs.get("href")
                break
        out.append(href)
    return out


def filter_group_links(html: str | None, heading_text: str) -> list[tuple[str, str]]:
    """(name, data-url) of the links of the first filter group whose heading contains
    ``heading_text`` (case-insensitive); blank data-urls skipped."""
    root = parse(html)
    for group in select(root, ".filtergroup"):
        heading = select_one(group, ".heading")
        if heading is None or heading_text.lower() not in heading.text(" ").lower():
            continue
        out = []
        for link in select(group, "a[data-url]"):
            data_url = (link.attrs.get("data-url") or "").strip()
            if data_url:
                out.append((link.text(" "), data_url))
        return out
    return []
