"""Main text of web pages by scoring the element tree.

A page is read into a tree (end tags may be missing, as HTML allows).  Elements that
never hold the article are taken out: scripts, styles, forms, navigation, footers,
asides, page headers, adverts, notices, comments and the like, by tag, role or the
words of class and id (not those of a state, as in has-sidebar or comments-open).  An
element that is or holds an ``article`` or ``main``, or more than half of the page's
paragraph points, is not taken out: its score and those inside are lowered instead, and
it goes only if it turns out not to hold the best container and scores below a sibling
worth keeping; a form is then a plain container.  Every paragraph of ``LEAST`` characters or more earns a point,
one per comma and up to three for its length, and passes them to its ancestors (all to
the parent, half to the next, a third, ...).  An element's score is discounted by the
share of its text that stands in links.  The best container is widened to the
``article`` or ``main`` around it, if any, and its siblings are kept when they score
well or are long paragraphs with few links.  A page without such paragraphs falls back
to its ``article``, ``main`` or body.

Text: character references decoded, white space (also line breaks) inside a block made
one blank, blocks trimmed and joined by a line feed in page order; blocks without text
are left out.  A null, empty or text-free page gives an empty text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import small_batches

LEAST = 25
SIBLING_SHARE = 0.2
LINK_LIST = 0.66

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary
table tbody tfoot thead tr ul""".split())
CELL = frozenset(("td", "th"))
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "tfoot", "thead", "tr"}
#: What a start tag ends, up to the given containers (the optional end tags of HTML).
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
            "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
#: Tags that are never part of an article.
NEVER = frozenset("""script style textarea title noscript iframe noembed noframes xmp head template svg canvas object
embed nav footer aside form button input select option datalist dialog menu""".split())
#: Those that never hold text of the page, whatever is in them.
HARD = RAW | frozenset("head template svg canvas object embed input select option datalist".split())
LOWERED = 0.25
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of class or id that mark what is not the article; the second set only outside an article.
NAMES = frozenset("""nav navbar navigation menu sidebar footer ad ads advert advertisement adverts advertising sponsor
sponsored promo promotion cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login
breadcrumb breadcrumbs pagination pager comment comments disqus replies respond social share sharing related recommended
widget toolbar masthead skip""".split())
OUTER_NAMES = frozenset("header banner notice notices alert topbar search".split())
#: Words that make a name a state: all that follows the first kind, all that ends with the second.
STATE_FIRST = frozenset("no not non has have with without is hide allow allows".split())
STATE_LAST = frozenset("open opened closed off on free less layout enabled disabled allowed".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile("[>\"']")
_ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")


class Node:
    """An element: tag, attributes, children (elements and strings)."""
    __slots__ = ("tag", "attrs", "children", "parent", "score", "size", "links", "own", "points", "holds", "factor", "named")

    def __init__(self, tag: str, attrs: str, parent: "Node | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list = []
        self.score, self.size, self.links = 0.0, 0, 0
        self.own: float | None = None                 # points of its own paragraph
        self.points, self.holds = 0.0, False          # of all paragraphs inside; is or holds an article
        self.factor, self.named = 1.0, False          # of the score; unwanted but kept

    def attributes(self) -> dict[str, str]:
        return {k.lower(): entities.unescape((v or "").strip("\"'")) for k, v in _ATTR.findall(self.attrs)}


class Scanner:
    """Comments, sections, declarations and tags of a page, found in one pass.

    A tag ends at the first ``>`` outside quotes, or at the first one where its quotes do not
    close.  What lies behind a place is looked up once: the next ``>`` and the next mark (``>`` or a quote) are
    kept while they are ahead, and where a scan outside quotes ends is kept for every mark on its way.
    """

    def __init__(self, page: str):
        self.page = page
        self.marks = {}              # mark met outside quotes -> where the scan ends, -1 if nowhere
        self.mark = self.end = -1    # next mark, next '>'; -1: not looked up, len(page): none

    def _next_mark(self, at: int) -> int:
        if self.mark < at:
            m = _MARK.search(self.page, at)
            self.mark = m.start() if m else len(self.page)
        return self.mark

    def _next_end(self, at: int) -> int:
        if self.end < at:
            found = self.page.find(">", at)
            self.end = found if found >= 0 else len(self.page)
        return self.end

    def _outside(self, at: int) -> int:
        """The first ``>`` outside quotes from ``at`` on, -1 if a quote before it does not close."""
        page, way, found = self.page, [], -1
        q = self._next_mark(at)
        while q < len(page):
            if q in self.marks:
                found = self.marks[q]
                break
            way.append(q)
            if page[q] == ">":
                found = q
                break
            closing = page.find(page[q], q + 1)
            if closing < 0:
                break
            m = _MARK.search(page, closing + 1)
            q = m.start() if m else len(page)
        for w in way:
            self.marks[w] = found
        return found

    def tokens(self):
        """(start, end, kind, tag or text, attributes): kind is '' for what holds nothing, 'cdata', '<' and '</'."""
        page, size, at = self.page, len(self.page), 0
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            head = page[at:at + 1]
            if head in ("!", "?"):
                if page.startswith("!--", at):
                    end = page.find("-->", at + 3)
                    at = size if end < 0 else end + 3
                    yield start, at, "", None, None
                elif page.startswith("![CDATA[", at):
                    end = page.find("]]>", at + 8)
                    inner = page[at + 8:size if end < 0 else end]
                    at = size if end < 0 else end + 3
                    yield start, at, "cdata", inner, None
                elif (end := self._next_end(at + 1)) < size:
                    at = end + 1
                    yield start, at, "", None, None
                continue
            m = _TAG.match(page, at)
            if not m:
                continue
            if self._next_end(m.end()) == size:     # no tag can end any more: what is left is text, or open to the end
                rest = [k for k in (page.find("<!--", at), page.find("<![CDATA[", at)) if k >= 0]
                if not rest:
                    return
                at = min(rest)
                continue
            end = self._outside(m.end())
            if end < 0:
                end = self.end
            at = end + 1
            jump = yield start, at, "</" if m[1] else "<", m[2].lower(), page[m.end():end]
            if jump is not None:
                at = jump


class Path:
    """The open elements, and where each kind of them is open."""

    def __init__(self, root: "Node"):
        self.nodes, self.places, self.blocks = [root], {}, []

    def push(self, node: "Node") -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in BLOCK or node.tag in CELL:
            self.blocks.append(at)

    def leave(self, at: int) -> None:
        """Close the element at ``at`` and all inside."""
        while len(self.nodes) > at:
            node = self.nodes.pop()
            self.places[node.tag].pop()
            if self.blocks and self.blocks[-1] == len(self.nodes):
                self.blocks.pop()

    def nearest(self, tags) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def end(self, tags, limit) -> None:
        """Leave the nearest open element of ``tags``, unless one of ``limit`` is nearer."""
        at = self.nearest(tags)
        if at and at >= self.nearest(limit):
            self.leave(at)

    def end_paragraph(self) -> None:
        if self.blocks and self.nodes[self.blocks[-1]].tag == "p":
            self.leave(self.blocks[-1])

    def close(self, tag: str) -> None:
        """An end tag; an inline one does not close a block, most do not leave a table or its cell."""
        places = self.places.get(tag)
        if not places:
            return
        if tag not in BLOCK and tag not in CELL:
            if not self.blocks or places[-1] > self.blocks[-1]:
                self.leave(places[-1])
        elif tag in TABLE_PARTS:
            self.leave(places[-1])
        else:
            self.end((tag,), TABLE_LIMITS)


TABLE_PARTS = frozenset("table tbody thead tfoot tr td th body html".split())
TABLE_LIMITS = ("table", "td", "th")


def parse(page: str) -> Node:
    """The element tree of a page; unclosed elements end where HTML ends them, or with their parent."""
    root = Node("#root", "", None)
    path, at, size = Path(root), 0, len(page)
    tokens = Scanner(page).tokens()
    token = next(tokens, None)
    while token is not None:
        start, end, kind, tag, attrs = token
        if start > at:
            path.nodes[-1].children.append(entities.unescape(page[at:start]))
        at, jump = end, None
        if kind == "cdata":
            if tag:
                path.nodes[-1].children.append(tag)
        elif kind == "</":
            path.close(tag)
        elif kind == "<":
            if tag in CLOSES_P:
                path.end_paragraph()
            if tag in ENDED_BY:
                path.end(*ENDED_BY[tag])
            node = Node(tag, attrs, path.nodes[-1])
            path.nodes[-1].children.append(node)
            if tag in RAW:
                m = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                at = jump = m.end() if m else size
            elif tag not in VOID and not attrs.endswith("/"):
                path.push(node)
        try:
            token = tokens.send(jump)
        except StopIteration:
            token = None
    if at < size:
        path.nodes[-1].children.append(entities.unescape(page[at:]))
    return root


def _unwanted(n: Node, in_article: bool) -> bool:
    if n.tag in NEVER or n.tag == "header" and not in_article:
        return True
    if not n.attrs or n.tag in ("html", "body", "article", "main"):
        if not (n.attrs and n.tag == "article"):
            return False
    a = n.attributes()
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    if a.get("role", "").lower() in ROLES:
        return True
    names: set[str] = set()
    for token in (a.get("class", "") + " " + a.get("id", "")).split():
        words = [w.lower() for w in _NAME.findall(token)]
        if words and words[-1] not in STATE_LAST:
            names.update(words[:next((k for k, w in enumerate(words) if w in STATE_FIRST), None)])
    return bool(names & NAMES) or not in_article and bool(names & OUTER_NAMES)


def _order(root: Node) -> list[Node]:
    """All elements in page order."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [c for c in reversed(n.children) if not isinstance(c, str)]
    return order


def _weigh(order: list[Node]) -> None:
    for n in reversed(order):
        n.size = sum(c.size if isinstance(c, Node) else len(" ".join(c.split())) for c in n.children)
        n.links = n.size if n.tag == "a" else sum(c.links for c in n.children if isinstance(c, Node))


def _drop(n: Node, inside: bool, most: float) -> bool:
    """Is ``n`` to be taken out?  If it is unwanted but holds what may be the article, its score is lowered."""
    if not _unwanted(n, inside):
        return False
    if n.tag in HARD or not n.holds and n.points <= most:
        return True
    if n.tag == "form":
        n.tag, n.own = "div", None
        if not _unwanted(n, inside):
            return False
    n.factor *= LOWERED
    n.named = True
    return False


def _measure(root: Node) -> list[Node]:
    """Drop what is unwanted, measure the rest; elements in page order."""
    every = _order(root)
    _weigh(every)
    for n in reversed(every):
        n.own = _points(n)
        if n.tag not in HARD:
            inner = [c for c in n.children if isinstance(c, Node)]
            n.points = (n.own * (1 - n.links / n.size) if n.own else 0.0) + sum(c.points for c in inner)
            n.holds = n.tag in ("article", "main") or any(c.holds for c in inner)
    most = root.points / 2
    order: list[Node] = []
    stack = [(root, False)]
    while stack:
        n, inside = stack.pop()
        order.append(n)
        inside = inside or n.tag in ("article", "main")
        kept: list = []
        for c in n.children:
            if isinstance(c, Node):
                c.factor = n.factor
                if _drop(c, inside, most):
                    up: Node | None = n      # the paragraph that an inline element stood in is another one now
                    while c.tag not in BLOCK and up is not None:
                        up.own = None
                        up = None if up.tag in BLOCK or up.tag in CELL else up.parent
                    continue
            kept.append(c)
        n.children = kept
        stack += [(c, inside) for c in reversed(kept) if not isinstance(c, str)]
    _weigh(order)
    return order


def _paragraph(n: Node) -> str:
    """Text of a paragraph, or what stands directly in a container, with inline elements."""
    if n.tag in ("p", "pre", "blockquote", "li", "td", "dd") or n.tag in ("div", "section", "article", "main", "center"):
        parts, stack = [], list(reversed(n.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                parts.append(c)
            elif c.tag not in BLOCK and c.tag not in CELL:
                stack += reversed(c.children)
        return " ".join(" ".join(parts).split())
    return ""


def _points(n: Node) -> float:
    t = _paragraph(n)
    return 1 + t.count(",") + min(3.0, len(t) / 100) if len(t) >= LEAST else 0.0


def _score(order: list[Node]) -> Node | None:
    for n in order:
        points = _points(n) if n.own is None else n.own
        if not points:
            continue
        share = 1.0
        up = n.parent if n.tag in ("p", "pre", "blockquote", "li", "td", "dd") else n
        level = 1
        while up is not None and up.tag != "#root":
            up.score += points * share
            level += 1
            share = 1.0 / level
            up = up.parent
    best = None
    for n in order:
        if n.score and n.size:
            n.score *= n.factor * (1 - n.links / n.size)
            if best is None or n.score > best.score:
                best = n
    return best


def _containers(order: list[Node]) -> list[Node]:
    best = _score(order)
    if best is None:
        for tag in ("article", "main", "body", "#root"):
            found = [n for n in order if n.tag == tag and n.size]
            found = [n for n in found if n.factor == 1] or found
            if found:
                return [n for n in found if not _under(n, found)]
        return []
    n, wide = best, None
    while n is not None:
        if n.tag == "article" or n.tag == "main" and (wide is None or wide.tag != "article"):
            wide = n
        n = n.parent
    around, n = set(), best
    while n is not None:
        around.add(id(n))
        n = n.parent
    top = best.score
    for n in order:
        if n.named and id(n) not in around and n.score < max(10.0, SIBLING_SHARE * top):
            n.parent.children = [c for c in n.parent.children if c is not n]
    best = wide or best
    if best.parent is None:
        return [best]
    keep = []
    for c in best.parent.children:
        if isinstance(c, str):
            continue
        density = c.links / c.size if c.size else 0.0
        if c is best or c.score and c.score >= max(10.0, SIBLING_SHARE * top) or (
                c.tag == "p" and (c.size > 80 and density < 0.25 or 0 < c.size <= 80 and density == 0)):
            keep.append(c)
        elif c.tag in ("h1", "h2") and c.size and wide is None:
            keep.append(c)
    return keep


def _under(n: Node, others: list[Node]) -> bool:
    p = n.parent
    while p is not None:
        if any(p is o for o in others):
            return True
        p = p.parent
    return False


def _link_list(n: Node) -> bool:
    """A list or box of links inside the article: a menu."""
    return n.tag in ("ul", "ol", "dl") and n.size > 0 and n.links > LINK_LIST * n.size and sum(
        1 for c in n.children if isinstance(c, Node)) >= 3


def _blocks(container: Node) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        t = " ".join("".join(run).split())
        if t:
            out.append(t)
        run.clear()

    stack: list = [container]
    breaks = 0
    while stack:
        c = stack.pop()
        if c is None:
            flush()
        elif isinstance(c, str):
            run.append(c)
            breaks = breaks if not c.strip() else 0
        elif c.tag == "br":
            breaks += 1
            run.append(" ")
            if breaks > 1:
                flush()
        elif c is not container and _link_list(c):
            flush()
        else:
            block = c.tag in BLOCK or c is container
            if block:
                flush()
                stack.append(None)
            if c.tag in CELL or c.tag in ("option", "img"):
                run.append(" ")
            stack += reversed(c.children)
            breaks = 0 if block else breaks
    flush()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    order = _measure(parse(page))
    return "\n".join(b for c in _containers(order) for b in _blocks(c))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                rows = batch.slice(k, 256)
                texts = [main_text(h) for h in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return small_batches(pages).select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(
        run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")
