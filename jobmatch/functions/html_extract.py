"""Per-page helper for the extraction job (P14, P16): a tolerant element tree and
child-index paths.  Runs inside ``mapInPandas``; one call per page.

Tree rules (the parts of HTML5 tree building the selectors depend on):
html, head and body are implied when left out; void elements take no children; an open ``<p>`` closes at the next block start
tag; an open ``<li>`` closes at the next ``<li>`` of its list; an end tag closes
up to its matching open element, and is ignored when none is open.

Paths: ``/``-separated steps ``tag``, ``tag[n]`` (n-th child of that tag,
1-based), ``*``, ``text()`` (direct text children); a leading ``//`` or an empty
step means "any depth".  A path starts at the element with ``root_id`` when given,
else at the document.  The string value of an element is all its text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset((
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt"
).split())
RAW_TEXT = frozenset(("script", "style"))
HEAD_TAGS = frozenset(("title", "meta", "link", "style", "script", "base", "noscript"))


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "ids")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.ids = None     # on the document node: id -> first element with it

    def text(self) -> str:
        """All text below this element, in document order."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self, clean):
        super().__init__(convert_charrefs=True)
        self.clean = clean
        self.root = Node("#document", {}, None)
        self.root.ids = {}
        self.cur = self.root

    def _open(self, tag: str) -> bool:
        n = self.cur
        while n is not None:
            if n.tag == tag:
                return True
            n = n.parent
        return False

    def _close(self, tag: str) -> None:
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def _implied(self, tag: str) -> None:
        """html, head and body exist even when a page leaves them out: head-only tags
        seen before any body content go to head, anything else opens body."""
        if tag == "html":
            return
        root = self.root
        html = next((c for c in root.children if not isinstance(c, str) and c.tag == "html"), None)
        if html is None:
            html = Node("html", {}, root)
            root.children.append(html)
            if self.cur is root:
                self.cur = html
        if self.cur is not html:
            return
        kids = [c for c in html.children if not isinstance(c, str)]
        has_body = any(c.tag == "body" for c in kids)
        if tag in ("head", "body"):
            return
        if tag in HEAD_TAGS and not has_body:
            head = next((c for c in kids if c.tag == "head"), None)
            if head is None:
                head = Node("head", {}, html)
                html.children.append(head)
            self.cur = head
        else:
            body = next((c for c in kids if c.tag == "body"), None)
            if body is None:
                body = Node("body", {}, html)
                html.children.append(body)
            self.cur = body

    def handle_starttag(self, tag, attrs):
        if self.cur.tag == "head" and tag not in HEAD_TAGS and self.cur.parent is not None:
            self.cur = self.cur.parent          # a body tag ends the head
        if self.cur is self.root or self.cur.tag == "html":
            self._implied(tag)
        if tag in CLOSES_P and self._open("p"):
            self._close("p")
        if tag == "li":
            # close an open li of the same list (not one of an outer list)
            n = self.cur
            while n is not None and n.tag not in ("ul", "ol", "li"):
                n = n.parent
            if n is not None and n.tag == "li":
                self.cur = n.parent
        node = Node(tag, dict(attrs), self.cur)
        self.cur.children.append(node)
        ident = node.attrs.get("id")
        if ident is not None and ident not in self.root.ids:
            self.root.ids[ident] = node
        if tag not in VOID:
            self.cur = node

    def parse_marked_section(self, i, report=1):
        """``<![foo[ ... ]]>`` is a comment up to the next ``>``; parsing goes on after it."""
        return self.parse_bogus_comment(i)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(tag)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if self._open(tag):
            self._close(tag)

    def handle_data(self, data):
        if self.cur.tag in RAW_TEXT:
            return
        t = self.clean(data)
        if t:   # text that cleans to nothing no longer exists
            self.cur.children.append(t)


def parse(html_text: str, clean=lambda s: s) -> Node:
    b = _Builder(clean)
    try:
        b.feed(html_text)
        b.close()
    except Exception:   # a broken page keeps whatever was built
        pass
    return b.root


_STEP = re.compile(r"^([\w*]+|text\(\))(?:\[(\d+)\])?$")


def _descendants(n: Node):
    """Elements below ``n`` in document order (iterative: pages may nest deeply)."""
    stack = [c for c in reversed(n.children) if not isinstance(c, str)]
    while stack:
        d = stack.pop()
        yield d
        stack.extend(c for c in reversed(d.children) if not isinstance(c, str))


def _find_id(n: Node, ident: str) -> Node | None:
    if n.ids is not None:          # the document node indexes ids while parsing
        return n.ids.get(ident)
    for d in _descendants(n):
        if d.attrs.get("id") == ident:
            return d
    return None


def select(root: Node, path: str, root_id: str | None = None) -> list:
    """Nodes (elements or text strings) matched by ``path``."""
    start = _find_id(root, root_id) if root_id else root
    if start is None:
        return []
    cur: list = [start]
    steps = path.strip().split("/")
    if steps and steps[0] == "" and not root_id:
        steps = steps[1:]          # absolute path from the document
    deep = False
    for st in steps:
        if st == "":
            deep = True
            continue
        m = _STEP.match(st)
        if not m:
            return []
        name, idx = m.group(1), m.group(2)
        nxt: list = []
        for n in cur:
            if isinstance(n, str):
                continue
            pool = [n, *_descendants(n)] if deep else [n]
            for p in pool:
                if name == "text()":
                    nxt.extend(c for c in p.children if isinstance(c, str))
                    continue
                kids = [c for c in p.children if not isinstance(c, str) and (name == "*" or c.tag == name)]
                if idx is not None:
                    i = int(idx)
                    kids = kids[i - 1:i] if 0 < i <= len(kids) else []
                nxt.extend(kids)
        cur, deep = nxt, False
    return cur


def string_value(n) -> str:
    return n if isinstance(n, str) else n.text()
