"""Main text of web pages by tree scoring.

A page becomes a tree of its elements.  Every block of text outside boilerplate is worth one point, one
for each comma and up to three for its length; it passes them to the block around it in full, to the next
one by half, and to three more by ever smaller shares.  A container's points are discounted by its
link density.  The best container is kept, or the ``article``/``main`` that holds it, or the wrapper that holds no other
text, with all unmarked siblings that are not mostly links: headings, lead paragraphs, lists, tables and short sections
beside it are parts of the article whatever their points.  Of equally good containers the first counts.

Scripts, styles, frames, controls and hidden elements hold no text.  Menus, asides, page headers and footers, forms,
and elements whose class, id or role names a menu, sidebar, notice, advert or reader comments only carry a mark,
which is judged once the page's points are known (``Page.left_out``): wrappers of the page's articles or of most of its
points stay, headings are never marked, doubtful words leave nothing out of an article but lists of links, and a page of
which nothing would be left is scored again without marks.  The parser is a small linear scan for this purpose, not an
HTML5 tree builder.

Defined cases: null or empty html, and a page without text, give an empty text and 0 characters;
unclosed tags close with their parents; an unclosed script or comment runs to the end of the page;
repeated rows stay separate; an empty table gives no rows; extra columns are ignored.  Long pages are read whole, in time that
grows with their length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.tables import bound_batches

_MARKUP = re.compile(r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<odd>[!?][^>]*>?)|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
_BARE = re.compile(r"(?:^|\s)hidden(?:\s|$)", re.I)

RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("html body address article aside blockquote br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul option select title".split())
#: blocks that hold text themselves; text elsewhere counts for its container
TEXT_BLOCK = frozenset("p pre blockquote li dd dt td th h1 h2 h3 h4 h5 h6 figcaption caption summary address".split())
DROPPED = frozenset("script style button select option textarea noscript iframe template svg object head title canvas audio video map input label datalist noembed noframes annotation annotation-xml".split())
#: elements beside the text, left out but for those that hold <main>; and boxes that may hold the whole page
BESIDE, BOXES = frozenset("nav footer aside menu header".split()), frozenset("form fieldset dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {  # an open element (key) ends when one of these starts
    "p": frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split()),
    "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]), "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]),
    "a": frozenset(["a"]),
}
SCOPES = frozenset("table td th ul ol dl div section article main body aside nav header footer form blockquote".split())
#: whole words of a class, id or role that mark what is not article text
MARKED = frozenset("""ad ads advert adverts advertisement adsense adslot sponsored promo sidebar sidebars nav navbar breadcrumb breadcrumbs pagination
pager masthead topbar bottombar comment comments commentlist disqus cookie cookies gdpr popup modal overlay newsletter contentinfo complementary""".split())
#: words that also name parts of an article
DOUBTFUL = frozenset("""advertising sponsor promotion promoted banner menu menus navigation toc header footer foot reply replies respond discussion notice
notices consent alert subscribe subscription signup login share sharing social related recommended recommendations widget widgets skip search form
disclaimer copyright""".split())
READERS = frozenset("comment comments commentlist disqus".split())
#: first parts of a name that tell how a wrapper is laid out, and parts that name the article itself
STATES, OWN = frozenset("has with without no not is hide show".split()), frozenset("article post entry content story section main text chapter".split())
DOUBT, PART, BOX, STRICT, ASIDE = 1, 2, 3, 4, 5  # marks: doubtful word, part of a name, form, whole word, element beside the text
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
ENOUGH = 10  # points that are text whatever a doubtful name says
LEVELS = 5  # containers a block passes points to


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)}


def _is_hidden(attrs: dict[str, str], raw: str) -> bool:
    style = attrs.get("style", "").replace(" ", "").lower()
    return "display:none" in style or "visibility:hidden" in style or attrs.get("aria-hidden", "").lower() == "true" or bool(_BARE.search(re.sub(r"""=\s*("[^"]*"|'[^']*')""", "=", raw)))


def _name_mark(name: str) -> int:
    """The mark of one class, id or role."""
    parts = _WORD.findall(_CAMEL.sub(" ", name).lower())
    if name.lower() in MARKED:
        return STRICT
    if not parts or parts[0] in STATES or "with" in parts or "has" in parts:
        return 0
    if not READERS.isdisjoint(parts):
        return STRICT
    if not MARKED.isdisjoint(parts):
        return PART
    words = DOUBTFUL.intersection(parts)
    return DOUBT if words and not (words == {"header"} and not OWN.isdisjoint(parts)) else 0


def _mark(tag: str, attrs: dict[str, str], inside: bool) -> int:
    """The mark of an element; ``inside`` an article, a header is the article's own."""
    if tag in BESIDE and not (tag == "header" and inside):
        return ASIDE
    if tag in HEADINGS or tag in ("html", "body", "article", "main"):
        return 0
    mark = BOX if tag in BOXES else 0
    for name in f"{attrs.get('class', '')} {attrs.get('role', '')}".split():
        mark = max(mark, _name_mark(name))
    for name in attrs.get("id", "").split():
        found = _name_mark(name)
        # the id of a section or paragraph is the target of a link and may be any word of its heading
        mark = max(mark, min(found, DOUBT) if (tag == "section" or tag in TEXT_BLOCK) and READERS.isdisjoint(_WORD.findall(name.lower())) else found)
    return 0 if mark == DOUBT and tag not in BLOCK else mark


class Page:
    """Elements in page order: ``tag``, ``parent``, ``out`` (without text), ``mark`` and whether it is ``inside`` an article;
    blocks of text with their element."""

    def __init__(self, source: str):
        self.tag = ["#root"]
        self.parent = [-1]
        self.out = [False]
        self.mark = [0]
        self.inside = [False]
        self.articles = [0]  # articles and mains that are no reader's comment; then those within an element
        self.above = [-1]  # nearest block or marked element around an element
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self._read(source)

    def _read(self, source: str) -> None:
        stack, scopes = [0], []  # open elements; places on the stack of those in SCOPES
        places: dict[str, list[int]] = {}  # and of every name, so that no tag walks the stack
        parts: list[str] = []
        owner, linked, at, size = 0, 0, 0, len(source)

        def end_block() -> None:
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text and not self.out[owner]:
                    self.blocks.append((owner, text, min(linked, len(text))))
                parts.clear()
            linked = 0

        def add_text(raw: str) -> None:
            nonlocal owner, linked
            here = stack[-1]
            if not raw or self.out[here]:
                return
            text = entities.unescape(raw) if "&" in raw else raw
            if not parts:
                owner = here if self.tag[here] in BLOCK or self.mark[here] else max(0, self.above[here])
            parts.append(text)
            if places.get("a"):
                linked += len(text.strip())

        def pop() -> None:
            places[self.tag[stack.pop()]].pop()
            if scopes and scopes[-1] == len(stack):
                scopes.pop()

        while at < size:
            m = _MARKUP.search(source, at)
            if m is None:
                add_text(source[at:])
                break
            add_text(source[at:m.start()])
            at = m.end()
            if not m["tag"]:
                continue
            tag = m["tag"].lower()
            if m["close"]:
                if places.get(tag):
                    if tag in BLOCK:
                        end_block()
                    # an inline end tag does not reach through its block
                    if tag not in BLOCK and scopes and scopes[-1] > places[tag][-1]:
                        continue
                    left = self.out[stack[-1]]
                    while True:
                        last, marked = self.tag[stack[-1]], self.mark[stack[-1]]
                        if marked:
                            end_block()
                        pop()
                        if last == tag:
                            break
                    if left != self.out[stack[-1]]:
                        end_block()
                elif tag == "br":
                    end_block()
                continue
            while len(stack) > 1 and (name := _closes(tag, places, scopes)):
                end_block()
                while True:
                    last = self.tag[stack[-1]]
                    pop()
                    if last == name:
                        break
            if tag in BLOCK:
                end_block()
            if tag in VOID:
                continue
            raw_attrs = m["attrs"] or ""
            top = stack[-1]
            attrs = _attributes(raw_attrs) if raw_attrs.strip(" /\n\t") else {}
            inside = bool(places.get("article") or places.get("main"))
            out = self.out[top] or tag in DROPPED or bool(raw_attrs) and tag not in ("html", "body", "article", "main") and _is_hidden(attrs, raw_attrs)
            mark = 0 if out else _mark(tag, attrs, inside)
            if mark or out and not self.out[top]:
                end_block()
            if tag in RAW:
                end = RAW[tag].search(source, at)
                at = size if end is None else source.find(">", end.end()) + 1 or size
                continue
            self.tag.append(tag)
            self.parent.append(top)
            self.above.append(top if top == 0 or self.tag[top] in BLOCK or self.mark[top] else self.above[top])
            self.out.append(out)
            self.mark.append(mark)
            self.inside.append(inside)
            self.articles.append(int(tag == "main" or tag == "article" and all(_name_mark(x) < PART for x in attrs.get("class", "").split())))
            places.setdefault(tag, []).append(len(stack))
            if tag in SCOPES:
                scopes.append(len(stack))
            stack.append(len(self.tag) - 1)
        end_block()

    def left_out(self) -> tuple[list[bool], list[bool]]:
        """(left out, doubtful) by element, from the marks and the points of the texts that are not links.

        An element that holds all articles of the page stays, and so does one that holds most of its points: by a
        doubtful word, a part of a name or as a form, with any mark of a name if it also holds an h1.  What is beside the text
        stays where it holds main.  A doubtful word inside an article leaves out only what is links by half; elsewhere,
        and for forms, ``ENOUGH`` points stay, though nothing in them is taken for the article.
        """
        n = len(self.tag)
        points, chars, linked, h1, main = [0.0] * n, [0] * n, [0] * n, [t == "h1" for t in self.tag], [t == "main" for t in self.tag]
        articles = list(self.articles)
        for element, text, in_links in self.blocks:
            points[element] += (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - in_links / len(text))
            chars[element] += len(text)
            linked[element] += in_links
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            points[up] += points[i]
            chars[up] += chars[i]
            linked[up] += linked[i]
            articles[up] += articles[i]
            h1[up] |= h1[i]
            main[up] |= main[i]
        out, doubtful = [False] * n, [False] * n
        for i in range(1, n):
            up, mark = self.parent[i], self.mark[i]
            out[i], doubtful[i] = out[up], doubtful[up]
            if not mark or out[i] or main[i] or mark < ASIDE and 0 < articles[i] == articles[0]:
                continue
            if mark == ASIDE:
                out[i] = True
            elif 2 * points[i] > points[0] and (mark < STRICT or h1[i]):
                continue
            elif mark == DOUBT and self.inside[i]:
                out[i] = 2 * linked[i] >= chars[i]
            elif mark in (DOUBT, BOX) and points[i] >= ENOUGH and 2 * linked[i] < chars[i]:
                doubtful[i] = True
            else:
                out[i] = True
        return out, doubtful

    def main_text(self) -> str:
        out, doubtful = self.left_out()
        blocks = [b for b in self.blocks if not out[b[0]]]
        if not blocks:  # nothing is left: menus and footers alone are no text
            out, doubtful = [False] * len(self.tag), [False] * len(self.tag)
            for i in range(1, len(self.tag)):
                out[i] = out[self.parent[i]] or self.tag[i] in ("nav", "menu", "footer")
            blocks = [b for b in self.blocks if not out[b[0]]]
        return self._best(blocks, out, doubtful) if blocks else ""

    def _best(self, blocks: list[tuple[int, str, int]], out: list[bool], doubtful: list[bool]) -> str:
        n = len(self.tag)
        points, chars, linked = [0.0] * n, [0] * n, [0] * n
        for element, text, in_links in blocks:
            worth = 1 + text.count(",") + min(len(text) / 100, 3)
            chars[element] += len(text)
            linked[element] += in_links
            up = self.above[element] if self.tag[element] in TEXT_BLOCK else element
            for level in range(LEVELS):
                if up < 0:
                    break
                points[up] += worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
                up = self.above[up]
        for i in range(n - 1, 0, -1):  # an element comes after its parent
            chars[self.parent[i]] += chars[i]
            linked[self.parent[i]] += linked[i]
        score = [points[i] * (1 - linked[i] / chars[i]) if chars[i] else 0.0 for i in range(n)]
        bonus = {"article": 25, "main": 25, "section": 5, "div": 5}
        total = [score[i] + bonus.get(self.tag[i], 0) if score[i] > 0 and not doubtful[i] else 0.0 for i in range(n)]
        best = max(range(n), key=lambda i: (total[i], -i))
        if total[best] <= 0:  # nothing but links: the whole page outside boilerplate
            best = 0
        up = best
        while up >= 0:
            if self.tag[up] in ("article", "main"):
                best = up
            up = self.parent[up]
        # wrappers that hold no other text
        while best > 0 and self.tag[best] not in ("article", "main", "body", "html") and (up := self.parent[best]) > 0 and not self.mark[up] and chars[up] == chars[best]:
            best = up
        around = best > 0 and self.tag[best] not in ("body", "html")
        kept = [False] * n
        for i in range(n):
            kept[i] = i == best or i > 0 and kept[self.parent[i]] or around and self.parent[i] == self.parent[best] and not out[i] and not self.mark[i] and self._goes_with(i, chars, linked)
        return " ".join(text for element, text, _ in blocks if kept[element])

    def _goes_with(self, i: int, chars: list[int], linked: list[int]) -> bool:
        """Whether an unmarked sibling of the best container is part of the article: anything but lists of links."""
        if not chars[i]:
            return False
        return linked[i] / chars[i] < (0.25 if self.tag[i] in ("p", "h1", "h2", "h3", "blockquote", "pre") else 0.5)


def _closes(tag: str, places: dict[str, list[int]], scopes: list[int]) -> str:
    """The open element that the start of ``tag`` ends, if any: the nearest of its name, unless a wall stands in between."""
    for name, by in CLOSED_BY.items():
        if tag in by and places.get(name):
            walls = places.get("table") if name in ("td", "th", "tr") else scopes
            # an element may be a wall itself
            if not walls or places[name][-1] >= walls[-1]:
                return name
    return ""


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x.as_py()) for x in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["row", "text", "n_chars"])


def extract(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep`` of every page with its main ``text`` and ``n_chars``; one narrow pass."""
    bound_batches(pages.sparkSession)
    row = F.struct(*[F.col(c) for c in keep]).alias("row")
    kinds = pages.select(row).schema["row"].dataType.simpleString()
    out = pages.select(row, F.col(html_col).cast("string").alias("html")).mapInArrow(_texts, f"row {kinds}, text string, n_chars long")
    return out.select("row.*", "text", "n_chars")
