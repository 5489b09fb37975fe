"""Main text of web pages by tree scoring.

A page becomes a tree of elements with its text in blocks (runs of text between block-level tags). Elements that are
page furniture by tag are set aside; so are those that are it by role or a class or id word, unless they hold the article
or their text, discounted, is still more than all that stands around them; readers' comments never are where the page
has a block of prose outside furniture. Formulas, labels and the fallback texts of objects are text like any other. Each block of some length
passes points, for its length and commas and discounted by its share of link text, to the element around it, and half,
a third, ... of them to the ancestors above. The element with the most points, discounted by its own link
density, is the container; an article or main element around it takes its place. Siblings with a fair share of its
points, other articles, and headings and paragraphs beside it are kept with it. All blocks of what is kept are given, in
page order; lists and tables made of links beside the container are not, nor those of bare short links (menus) inside it.

Defined cases: null and empty html give empty text; a page without scored blocks gives what text its body has outside
furniture; text cut off inside a tag ends there; elements left open end with their parents; nesting of any depth is
walked without recursion; repeated rows give repeated results; an empty table gives no rows; only the named columns
are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RAW = "script|style|noscript|template|iframe|textarea|title|noframes"
#: Elements whose contents are no text either, which a tag ending in "/>" closes at once, or which stay open for ever.
_MEDIA = "svg|select|audio|video|canvas|annotation|annotation-xml"
#: Tags, comments and the contents of elements that hold no text. No alternative can match one text in two ways.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<media>{_MEDIA})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<!/)>(?=(?P<inside>.*?</(?P=media)\s*>))(?P=inside)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|</?[a-zA-Z!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that never hold main text.
FURNITURE = frozenset("nav footer aside button menu dialog head".split())
#: Elements that are furniture unless they hold the article or most of the page's text, as a form around a whole page does.
WRAPPERS = frozenset("form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
#: Words of classes and ids that name furniture.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar sidebars menu navbar nav navigation"
    " breadcrumb breadcrumbs footer masthead notice notices cookie cookies consent gdpr banner popup modal overlay newsletter subscribe"
    " signup login related recommended share sharing social pagination pager widget toolbar disclaimer alert alerts".split()
)
#: Words that name readers' comments: these do not win against prose by their length.
READERS = frozenset("comment comments disqus respond replies discussion".split())
#: Words that make a class or id tell what an element has, not what it is.
STATES = frozenset("has with without no".split())
#: Elements that a start tag closes when they are open.
_CLOSES = {t: frozenset({"p"}) for t in BLOCK - {"body", "html", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}}
_CLOSES |= {
    "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}), "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"}),
}
#: What an implied end tag does not reach beyond.
_SCOPE = {"li": frozenset({"ul", "ol", "menu"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"}), "tr": frozenset({"table"}), "td": frozenset({"table", "tr"}), "th": frozenset({"table", "tr"})}
_WALLS = frozenset({"article", "section", "div", "main", "td", "th", "table", "body", "html", "aside", "nav", "footer", "header", "form", "blockquote", "ul", "ol", "dl"})

LEAST_CHARS = 25
LEVELS = 5
SIBLING_SHARE = 0.2
#: What text in an element of a furniture name weighs, on a page without and with an article.
NAMED = (0.2, 0.05)
#: Characters of a block outside furniture that is prose.
PROSE = 100
#: Characters between two links of a menu.
BETWEEN_LINKS = 3


class Page:
    """Elements by number (parents before children) and blocks: (element, text, characters in links, links)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.soft, self.hard, self.readers = ["html"], [-1], [False], [False], [False]
        self.blocks: list[tuple[int, str, int, int]] = []
        self._read(source)

    def _open(self, tag: str, parent: int, attrs: str) -> int:
        hard, soft, readers = tag in FURNITURE or self.hard[parent], tag in WRAPPERS, False
        if attrs and not hard:
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if name in ("class", "id"):
                    named = [words for words in map(_WORD.findall, value.split()) if STATES.isdisjoint(words)]
                    readers = readers or any(not READERS.isdisjoint(words) for words in named)
                    soft = soft or readers or any(not NAMES.isdisjoint(words) for words in named)
                elif name == "role":
                    soft = soft or value in ROLES
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                    hard = True
        self.tag.append(tag)
        self.parent.append(parent)
        self.soft.append(soft and tag not in ("html", "body", "main"))
        self.hard.append(hard)
        self.readers.append(readers and self.soft[-1])
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack = [0]
        pieces: list[str] = []
        linked: list[str] = []
        links = anchors = 0  # open anchors; anchors begun in this block

        def flush() -> None:
            nonlocal anchors
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    at = next(n for n in reversed(stack) if self.tag[n] in BLOCK)
                    self.blocks.append((at, text, len(" ".join("".join(linked).split())), anchors))
                    anchors = 0
                pieces.clear()
                linked.clear()

        def text(part: str) -> None:
            if part and not self.hard[stack[-1]]:
                part = html.unescape(part)
                pieces.append(part)
                if links:
                    linked.append(part)

        at = 0
        for m in _TOKEN.finditer(source):
            text(source[at : m.start()])
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            if m["end"]:
                if tag == "a":
                    links = max(0, links - 1)
                if tag == "p" and not any(self.tag[n] == "p" for n in stack) or tag in ("html", "body"):
                    continue
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == tag:
                        if tag in BLOCK or any(self.tag[n] in BLOCK for n in stack[k:]):
                            flush()
                            links = 0 if tag in BLOCK else links
                        del stack[k:]
                        break
                    if tag not in BLOCK and self.tag[stack[k]] in BLOCK:
                        break  # an inline end tag does not close blocks
                continue
            if tag in BLOCK:
                flush()
                closed, stop = _CLOSES.get(tag), _SCOPE.get(tag, frozenset()) | (_WALLS - _CLOSES.get(tag, frozenset()))
                if closed:
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[k]] in closed:
                            del stack[k:]
                            links = 0
                        elif self.tag[stack[k]] in stop:
                            break
            elif tag == "br":
                text("\n")
            if tag == "a":
                links, anchors = 1, anchors + (not self.hard[stack[-1]])
            if tag not in VOID and not (m["attrs"].endswith("/") and tag not in BLOCK and tag != "a"):
                if tag == "body":
                    if any(self.tag[n] == "body" for n in stack):
                        continue
                elif tag == "html":
                    continue
                stack.append(self._open(tag, stack[-1], m["attrs"]))
        text(source[at:])
        flush()


def main_text(source: str | None) -> str:
    page = Page(source or "")
    n = len(page.tag)
    # An article that is furniture itself (a reader's comment) does not shield what it stands in.
    holds = [page.tag[k] in ("article", "main") and not page.soft[k] and not page.hard[k] for k in range(n)]
    for k in range(n - 1, 0, -1):
        holds[page.parent[k]] = holds[page.parent[k]] or holds[k]
    in_article = [False] * n
    named = [False] * n
    around = [0] * n  # the named element around each one, or the page
    for k in range(1, n):
        p = page.parent[k]
        in_article[k] = in_article[p] or page.tag[p] in ("article", "main")
        header = page.tag[k] == "header" and not in_article[k]
        named[k] = (page.soft[k] or header) and not holds[k]
        around[k] = p if named[p] else around[p]
    # Text outside links, of each element without its named ones, and with these discounted.
    plain, weighed, heaviest = [0] * n, [0.0] * n, [0.0] * n
    for at, text, linked, _ in page.blocks:
        plain[at] += len(text) - linked
        weighed[at] += len(text) - linked
    prose = any(len(text) - linked >= PROSE and not named[at] and around[at] == 0 for at, text, linked, _ in page.blocks)
    article = any(holds[k] and plain[k] for k in range(n))
    for k in range(n - 1, 0, -1):
        if named[k]:
            weighed[k] *= NAMED[article]
            heaviest[around[k]] = max(heaviest[around[k]], weighed[k])
        else:
            plain[page.parent[k]] += plain[k]
        weighed[page.parent[k]] += weighed[k]
    out = [False] * n
    for k in range(1, n):
        c = around[k]
        heavy = weighed[k] > plain[c] and weighed[k] >= SIBLING_SHARE * heaviest[c]
        furniture = named[k] and not (heavy and not (page.readers[k] and prose))
        out[k] = out[page.parent[k]] or page.hard[k] or furniture
    text_of, link_of, links_in = [0] * n, [0] * n, [0] * n
    points = [0.0] * n
    live = [b for b in page.blocks if not out[b[0]]]
    if not live:
        live = [b for b in page.blocks if not page.hard[b[0]]]
    for at, text, linked, links in live:
        text_of[at] += len(text)
        link_of[at] += linked
        links_in[at] += links
        if len(text) < LEAST_CHARS or page.tag[at] in HEADINGS:
            continue
        score = (1.0 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))
        up = page.parent[at] if page.tag[at] in ("p", "pre", "blockquote", "li", "dd", "dt", "figcaption", "summary") else at
        for level in range(LEVELS):
            if up < 0:
                break
            points[up] += score / (level + 1)
            up = page.parent[up]
    for k in range(n - 1, 0, -1):
        text_of[page.parent[k]] += text_of[k]
        link_of[page.parent[k]] += link_of[k]
        links_in[page.parent[k]] += links_in[k]
    best, most = 0, 0.0
    for k in range(n):
        score = points[k] * (1 - link_of[k] / text_of[k]) if text_of[k] else 0.0
        if score > most:
            best, most = k, score
    for wanted in ("article", "main"):
        up = best
        while up > 0 and page.tag[up] != wanted:
            up = page.parent[up]
        if up > 0:
            best = up
            break
    kept, inside = [False] * n, [False] * n
    kept[best] = inside[best] = True
    beside = best
    if page.tag[best] in ("article", "main"):
        while page.parent[beside] > 0 and text_of[page.parent[beside]] == text_of[beside]:
            beside = page.parent[beside]  # a wrapper of nothing else
    if beside > 0 and page.tag[beside] != "body":
        for k in range(page.parent[beside] + 1, n):
            if page.parent[k] != page.parent[beside] or not text_of[k]:
                continue
            loose = 1 - link_of[k] / text_of[k]
            kept[k] = kept[k] or points[k] * loose >= SIBLING_SHARE * most or page.tag[k] in HEADINGS or (page.tag[k] in ("p", "pre", "blockquote") or holds[k]) and loose > 0.5
    listed = [False] * n
    for k in range(1, n):
        p = page.parent[k]
        kept[k] = kept[k] or kept[p]
        inside[k] = inside[k] or inside[p]
        listed[k] = listed[p]
        if page.tag[k] in ("ul", "ol", "dl", "table", "div") and links_in[k] >= 3 and link_of[k] > 0.6 * text_of[k]:
            menu = text_of[k] - link_of[k] <= BETWEEN_LINKS * links_in[k] and link_of[k] < LEAST_CHARS * links_in[k]
            listed[k] = listed[k] or menu or not inside[k]
    return "\n\n".join(text for at, text, _, _ in live if kept[at] and not listed[at])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(source).cast("string").alias("html"))
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
