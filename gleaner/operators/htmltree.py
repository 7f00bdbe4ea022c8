"""Per-page HTML -> flat node rows (the only Python stage of the engine).

Runs inside ``mapInArrow`` tasks: Spark partitions the pages, each task turns
its pages into node rows with the standard library ``html.parser`` and a
small tree builder.  The builder approximates HTML5 tree construction where it
matters for sibling positions: void elements, implied end of ``p``/``li``/
``dt``/``dd``/``option``, end tags that close everything above their match,
raw ``script``/``style``, adjacent text merged into one node, doctype dropped,
comments kept as nodes.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input keygen link meta param source track wbr".split()
)
# start tags that close an open <p>
CLOSES_P = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt listing main menu nav ol p plaintext pre
    search section summary table ul xmp""".split()
)
# start tag -> tags it closes when one of them is the current-ish open element
IMPLIED_END = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "option": ("option",),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}
# elements that stop the search for an implied-end target
SCOPE_BARRIERS = frozenset("ul ol table html body div".split())

# markup that every tokenizer reads alike: text, end tags, start tags with quoted attributes; a few words of their own
# change how the text behind them is read
_PLAIN = re.compile(r'''([^<]+)|</([a-z][a-z0-9]*)>|<([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"&\0]*")*)>''')
_PLAIN_ATTR = re.compile(r''' ([a-z][a-z0-9-]*)="([^"]*)"''')
_OWN_TEXT = frozenset("script style textarea title plaintext xmp iframe noembed noframes noscript listing".split()) | frozenset(
    HTMLParser.CDATA_CONTENT_ELEMENTS)


class _TreeBuilder(HTMLParser):
    __slots__ = ("kind", "name", "text", "attrs", "parent", "stack", "children", "open")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.kind = ["document"]
        self.name = [None]
        self.text = [None]
        self.attrs = [None]
        self.parent = [None]
        self.children = [[]]
        self.stack = [0]
        self.open = Counter()  # open elements by name

    # -- helpers -----------------------------------------------------------
    def _new(self, kind, name, text, attrs):
        nid = len(self.kind)
        parent = self.stack[-1]
        self.kind.append(kind)
        self.name.append(name)
        self.text.append(text)
        self.attrs.append(attrs)
        self.parent.append(parent)
        self.children.append([])
        self.children[parent].append(nid)
        return nid

    def _close_to(self, idx):
        for i in self.stack[idx:]:
            self.open[self.name[i]] -= 1
        del self.stack[idx:]

    def _close_p(self):
        if not self.open["p"]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            n = self.name[self.stack[i]]
            if n == "p":
                self._close_to(i)
                return
            if n in SCOPE_BARRIERS or n in ("button", "td", "th"):
                return

    def read(self, text: str) -> None:
        """The whole page: plain markup here, and from the first token that is not plain the rest by the parser."""
        token, at = _PLAIN.scanner(text).match, 0
        while m := token():
            data, end, tag, attrs = m.groups()
            if data:
                self.handle_data(unescape(data) if "&" in data else data)
            elif end:
                self.handle_endtag(end)
            elif tag in _OWN_TEXT:
                break
            else:
                self.handle_starttag(tag, _PLAIN_ATTR.findall(attrs) if attrs else ())
            at = m.end()
        if at < len(text):
            self.feed(text[at:])
        self.close()

    # -- parser callbacks --------------------------------------------------
    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close_p()
        closes = IMPLIED_END.get(tag)
        if closes and any(self.open[x] for x in closes):
            for i in range(len(self.stack) - 1, 0, -1):
                n = self.name[self.stack[i]]
                if n in closes:
                    self._close_to(i)
                    break
                if n in SCOPE_BARRIERS:
                    break
        amap = {}
        for k, v in attrs:
            if k not in amap:
                amap[k] = "" if v is None else v
        nid = self._new("element", tag, None, amap)
        if tag not in VOID:
            self.stack.append(nid)
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        # HTML5 ignores the slash on elements that are not void, but for foreign content
        if tag not in VOID and (tag in ("svg", "math") or self.open["svg"] or self.open["math"]):
            self._close_to(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
            return
        if tag in VOID:
            return
        if self.open[tag]:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.name[self.stack[i]] == tag:
                    self._close_to(i)
                    return
        if tag == "p":  # stray </p> makes an empty paragraph
            self._new("element", "p", None, {})

    def handle_data(self, data):
        parent = self.stack[-1]
        kids = self.children[parent]
        # HTML5: a newline right after a <pre>/<textarea>/<listing> start tag is dropped
        if not kids and data.startswith("\n") and self.name[parent] in ("pre", "textarea", "listing"):
            data = data[1:]
        if not data:
            return
        if kids and self.kind[kids[-1]] == "text":
            self.text[kids[-1]] += data
        else:
            self._new("text", None, data, None)

    def handle_comment(self, data):
        self._new("comment", None, data, None)

    def handle_decl(self, decl):
        pass

    # HTML5 keeps these as comments
    def unknown_decl(self, data):
        self._new("comment", None, f"[{data}]", None)

    def handle_pi(self, data):
        self._new("comment", None, f"?{data}", None)


def _escape_text(s: str) -> str:
    return s.replace("&", "&amp;").replace("\u00a0", "&nbsp;").replace("<", "&lt;").replace(">", "&gt;")


def _escape_attr(s: str) -> str:
    return s.replace("&", "&amp;").replace("\u00a0", "&nbsp;").replace('"', "&quot;")


def _serialize_children(b: _TreeBuilder, nid: int, out: list) -> None:
    """Inner HTML of ``nid`` (iterative: deeply nested markup cannot exhaust the stack)."""
    stack = [("kids", nid)]
    while stack:
        op, x = stack.pop()
        if op == "raw":
            out.append(x)
            continue
        parent_name = b.name[x]
        items = []
        for c in b.children[x]:
            k = b.kind[c]
            if k == "text":
                items.append(("raw", b.text[c] if parent_name in ("script", "style") else _escape_text(b.text[c])))
            elif k == "comment":
                items.append(("raw", "<!--" + b.text[c] + "-->"))
            else:
                name = b.name[c]
                attrs = "".join(f' {k}="{_escape_attr(v)}"' for k, v in b.attrs[c].items())
                items.append(("raw", f"<{name}{attrs}>"))
                if name not in VOID:
                    items.append(("kids", c))
                    items.append(("raw", f"</{name}>"))
        stack.extend(reversed(items))


def parse_html(html: str, inner_html_tags=frozenset()) -> dict:
    """Parse one page into column lists (node_id is the pre-order index, root = 0).

    A page the parser cannot handle yields a single root row of kind ``error`` whose text
    is the error, so one bad page is quarantined (FLT1) instead of failing the task."""
    b = _TreeBuilder()
    # HTML input preprocessing: CR LF and lone CR become LF before tree building
    text = (html or "").replace("\r\n", "\n").replace("\r", "\n")
    try:
        b.read(text)
    except Exception as e:  # noqa: BLE001 - any parser failure is data, not a job failure
        b = _TreeBuilder()
        b.kind[0] = "error"
        b.text[0] = f"{type(e).__name__}: {e}"
    n = len(b.kind)
    sib_no = [0] * n
    depth = [0] * n
    for p in range(n):
        for i, c in enumerate(b.children[p]):
            sib_no[c] = i
    # node ids are allocated in document order == pre-order, so parents precede children
    for i in range(1, n):
        depth[i] = depth[b.parent[i]] + 1
    inner = [None] * n
    if inner_html_tags:
        for i in range(n):
            if b.kind[i] == "element" and b.name[i] in inner_html_tags:
                out: list = []
                _serialize_children(b, i, out)
                inner[i] = "".join(out)
    n_children = [len(ch) for ch in b.children]
    # ordinal of each element among the page's elements with the same tag (document order)
    tag_ord = [None] * n
    seen: dict = {}
    for i in range(n):
        if b.kind[i] == "element":
            k = b.name[i]
            tag_ord[i] = seen.get(k, 0)
            seen[k] = tag_ord[i] + 1
    return {
        "node_id": list(range(n)),
        "parent_id": b.parent,
        "sib_no": sib_no,
        "depth": depth,
        "n_children": n_children,
        "tag_ord": tag_ord,
        "kind": b.kind,
        "name": b.name,
        "text": b.text,
        "attrs": [None if a is None else list(a.items()) for a in b.attrs],
        "inner_html": inner,
    }
