"""The main text of web pages by tag-path ratios.

Every text leaf has a path of tags from the root. Leaves with the same path are taken together:
their text length and their punctuation, each per leaf, are the path's ratios. The two sequences
of ratios, in page order, are smoothed and fused by their product; paths above a threshold, whose
text is not mostly links, hold content. The article element around most of the content's text is
the article; on a page without, the main element; else the smallest container that holds all
content. All its text belongs to it, also headings and short paragraphs, but for side matter:
menus, notices, comments and the like, told by element, by the name of a class, id or role, or by
structure. A side element that holds the page itself, as a form or a layout's wrapper may, is none.

Elements are numbered in page order and know their parent's number, so sums run from the last
element to the first and marks from the first to the last: time and memory grow with the page,
whatever its depth.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.common import ship_package

SMOOTHING = 1.0  # standard deviation, in leaves
THRESHOLD = 0.5  # of the mean fused ratio
SHARE = 0.8  # of the content's text that an article or main element must hold

# Elements by what HTML says about them.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
NEVER = {"head", "button", "select", "option", "svg", "canvas", "object", "audio", "video", "map"}
SIDE = {"nav", "header", "footer", "aside", "form", "label", "fieldset", "menu", "dialog"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr",
    "math", "menclose", "merror", "mfenced", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover",
    "mpadded", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup",
    "mtext", "munder", "munderover", "semantics",
}
# Elements that may hold a whole article; others are parts of one.
CONTAINERS = {"", "html", "body", "main", "article", "div"}
# Words that, first or last in the name of a class, id or role, say that a part is
# no article text ("site-footer", "comment-list"), and words that make a name speak of a layout
# instead ("has-sidebar", "no-comments").
SIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
    "breadcrumbs", "contentinfo", "cookie", "cookies", "consent", "footer", "form", "header",
    "login", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "alert", "pagination", "pager", "popup", "promo", "promoted", "related", "search",
    "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
    "teaser", "toolbar", "widget", "complementary", "masthead",
}
COMMENT_NAMES = {
    "comment", "comments", "disqus", "discussion", "replies", "reply", "respond",
}
LAYOUT_WORDS = {"has", "have", "hide", "no", "not", "show", "with", "without"}
# Words that name the writer of a comment, and headings above comments.
WRITER_NAMES = {
    "author", "avatar", "commenter", "nick", "nickname", "poster", "reply", "user", "username", "vcard",
}
COMMENT_HEADING = re.compile(
    r"[\W\d]*(?:(?:reader|leave a|all) )?(?:comments?|responses|replies|kommentare|commentaires"
    r"|comentarios|commenti)[\W\d]*",
    re.I,
)
COMMENT_ITEMS = {"article", "dd", "div", "li", "section"}
LEAST_LEFT = 0.1  # of the content's text that must lie outside of side matter
LEAST_PAGE = 0.25  # of the text outside of links that side matter must hold to be looked into
LINKED = 0.5  # a leaf with more of its text in links is no content
PUNCTUATION = re.compile(r"[.,;:!?。、，！？；：…]")

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(
    r"""(?<![\w:.-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I
)
_WORDS = re.compile(r"[a-z]+")
_END = re.compile("[>\"']")
_CLOSES_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section",
    "table", "ul",
}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _tag_end(page: str, at: int) -> int:
    """The offset behind the tag that starts at ``at``; quoted signs do not end it."""
    plain = page.find(">", at)
    if plain >= 0 and page.find('"', at, plain) < 0 and page.find("'", at, plain) < 0:
        return plain + 1
    found = _END.search(page, at)
    while found and found.group() != ">":
        close = page.find(found.group(), found.end())
        if close < 0:
            break
        found = _END.search(page, close + 1)
    if found and found.group() == ">":
        return found.end()
    return plain + 1 if plain >= 0 else len(page)


def _names(page: str, start: int, end: int) -> tuple[bool, bool, bool, str]:
    """Whether a tag's names say side matter, comments, a writer; and its class."""
    side = comments = writer = False
    class_ = ""
    if end - start < 6:  # too short for an attribute
        return side, comments, writer, class_
    for kind, *values in _ATTRIBUTE.findall(page, start, end):
        value = "".join(values)
        if kind.lower() == "class":
            class_ = value
        for name in value.split():
            words = _WORDS.findall(re.sub("(?<=[a-z])(?=[A-Z])", "-", name).lower())
            if not words:
                continue
            writer |= not WRITER_NAMES.isdisjoint(words)
            if LAYOUT_WORDS.isdisjoint(words):
                ends = {words[0], words[-1]}
                comments |= not COMMENT_NAMES.isdisjoint(ends)
                side |= not SIDE_NAMES.isdisjoint(ends)
    return side or comments, comments, writer, class_


class _Page:
    """The elements of a page, by number, and its text leaves in page order."""

    def __init__(self, page: str):
        # Lists by element; number 0 is the page itself.
        self.tag, self.parent, self.depth, self.path = [""], [-1], [0], [0]
        self.never, self.side, self.comments = [False], [False], [False]
        self.writer, self.class_ = [False], [""]
        self.owner: list[int] = []  # of each leaf
        self.text: list[str] = []
        self.linked: list[float] = []  # share of the leaf's text in links
        self._read(page)

    def _add(self, paths: dict, tag: str, parent: int, names: tuple[bool, bool, bool, str]) -> int:
        named, comments, writer, class_ = names
        if tag in ("html", "body", "article", "main"):
            named = False
            comments = comments and tag == "article"
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.path.append(paths.setdefault((self.path[parent], tag), len(paths) + 1))
        self.never.append(self.never[parent] or tag in NEVER)
        self.side.append(named or comments or tag in SIDE)
        self.comments.append(comments)
        self.writer.append(writer)
        self.class_.append(class_)
        return len(self.tag) - 1

    def _read(self, page: str) -> None:
        paths: dict[tuple[int, str], int] = {}
        node, open_tags = 0, Counter()
        at, broken, links = 0, True, 0
        pieces: list[str] = []
        sizes = [0, 0]  # of the leaf's text outside and inside of links

        def finish() -> None:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                self.owner.append(leaf)
                self.text.append(text)
                self.linked.append(sizes[1] / max(1, sum(sizes)))
            pieces.clear()
            sizes[:] = 0, 0

        leaf = 0

        def text(piece: str) -> None:
            nonlocal broken, leaf
            if broken or leaf != node:
                if not piece.strip():
                    return
                finish()
                leaf, broken = node, False
            pieces.append(piece)
            sizes[links > 0] += len(piece.strip())

        while at < len(page):
            open_ = page.find("<", at)
            if open_ < 0:
                text(page[at:])
                break
            if open_ > at:
                text(page[at:open_])
            if page.startswith("<!--", open_):
                close = page.find("-->", open_ + 4)
                at = close + 3 if close >= 0 else len(page)
                continue
            if page[open_ + 1 : open_ + 2] in ("!", "?"):
                at = _tag_end(page, open_ + 1)
                continue
            name = _NAME.match(page, open_ + 1)
            if not name:
                text("<")
                at = open_ + 1
                continue
            at = _tag_end(page, name.end())
            tag = name.group(1).lower()
            if page[open_ + 1] == "/":
                if tag == "a":
                    links = 0
                if tag in INLINE:
                    continue
                broken, links = True, 0
                while open_tags[tag]:  # what is open inside ends as well
                    ended = self.tag[node]
                    open_tags[ended] -= 1
                    node = self.parent[node]
                    if ended == tag:
                        break
                continue
            if tag in INLINE:
                links = 1 if tag == "a" else links
                if _names(page, name.end(), at)[2]:
                    self.writer[node] = True
                continue
            if tag in RAW:
                close = re.compile(f"</{tag}", re.I).search(page, at)
                at = _tag_end(page, close.end()) if close else len(page)
                broken = True
                continue
            if tag == "br":
                text(" ")
                continue
            if tag in VOID:
                continue
            broken = True
            closes = _SIBLINGS.get(tag, {"p"} if tag in _CLOSES_P else set())
            while node and self.tag[node] in closes | ({"p"} if closes else set()):
                open_tags[self.tag[node]] -= 1
                node = self.parent[node]
            node = self._add(paths, tag, node, _names(page, name.end(), at))
            open_tags[tag] += 1
        finish()

    def below(self, values: np.ndarray) -> list:
        """Each element's sum of ``values`` over itself and all elements inside it."""
        sums = values.tolist()
        for i in range(len(sums) - 1, 0, -1):
            sums[self.parent[i]] += sums[i]
        return sums

    def inside(self, marked: list[bool]) -> np.ndarray:
        """Whether each element is marked or lies in a marked one."""
        found = list(marked)
        for i in range(1, len(found)):
            found[i] = found[i] or found[self.parent[i]]
        return np.array(found, bool)

    def above(self, i: int) -> Iterator[int]:
        """The element and those around it, innermost first."""
        while i >= 0:
            yield i
            i = self.parent[i]


def _smooth(values: np.ndarray) -> np.ndarray:
    reach = np.arange(-2, 3)
    weights = np.exp(-(reach**2) / (2 * SMOOTHING**2))
    inside = slice(2, 2 + len(values))
    return np.convolve(values, weights)[inside] / np.convolve(np.ones(len(values)), weights)[inside]


def _weights(page: _Page, used: np.ndarray) -> np.ndarray:
    """The text length of each content leaf among the ``used`` ones; 0 for the others."""
    weights = np.zeros(len(page.text))
    if not used.any():
        return weights
    at = np.flatnonzero(used)
    _, of = np.unique([page.path[page.owner[i]] for i in at], return_inverse=True)
    length = np.array([len(page.text[i]) for i in at], float)
    marks = np.array([len(PUNCTUATION.findall(page.text[i])) for i in at], float)
    many = np.bincount(of)
    text_ratio = (np.bincount(of, length) / many)[of]
    mark_ratio = (np.bincount(of, marks) / many)[of]
    fused = _smooth(text_ratio) * _smooth(mark_ratio)
    content = fused >= THRESHOLD * fused.mean()
    plain = content & (np.array(page.linked)[at] <= LINKED)
    weights[at] = np.where(plain if plain.any() else content, length, 0)
    return weights


def _unwrap(page: _Page, owner: np.ndarray, used: np.ndarray) -> None:
    """Takes the side mark from elements that hold the page itself.

    That is an element around the article element with most of the content, or, if hardly any
    content lies outside of side matter, one that holds most and has a page's parts inside it.
    Side matter with less than a quarter of the text outside of links holds no page.
    """
    plain = np.array([len(t) for t in page.text]) * (1 - np.array(page.linked)) * used
    if plain[page.inside(page.side)[owner]].sum() < LEAST_PAGE * plain.sum():
        return
    weights = _weights(page, used)
    total = weights.sum()
    held = page.below(np.bincount(owner, weights, len(page.tag)))
    articles = [i for i, t in enumerate(page.tag) if t in ("article", "main") and not page.side[i]]
    best = max(articles, key=lambda i: held[i], default=-1)
    if best > 0 and held[best] >= total / 2 and not any(page.comments[i] for i in page.above(best)):
        for i in page.above(best):
            page.side[i] = False
    parts = page.below(np.array([t in ("article", "main", "h1", "nav", "header", "footer", "aside") for t in page.tag], int))
    while True:
        hidden = page.inside(page.side)[owner]
        if not total or weights[~hidden].sum() >= LEAST_LEFT * total:
            return
        wrappers = [
            i
            for i, side in enumerate(page.side)
            if side
            and not page.comments[i]
            and page.tag[i] not in ("nav", "header", "footer", "aside")
            and held[i] >= total / 2
            and parts[i]
        ]
        if not wrappers:
            return
        page.side[wrappers[0]] = False  # the outermost


def _mark_comments(page: _Page, owner: np.ndarray, used: np.ndarray) -> None:
    """Marks as side matter: items of one tag and class beside each other that each name a writer,
    articles inside an article that do, and what follows a heading such as "Comments" in its
    element; unless the content starts with them."""
    marked = [False] * len(page.tag)
    if any(page.writer):
        writers = page.below(np.array(page.writer, int))
        items: dict[tuple[int, str, str], list[int]] = {}
        for i, tag in enumerate(page.tag):
            if tag in COMMENT_ITEMS and (page.class_[i] or tag == "article") and writers[i]:
                items.setdefault((page.parent[i], tag, page.class_[i]), []).append(i)
        beside = Counter(zip(page.parent, page.tag, page.class_, strict=True))
        for key, group in items.items():
            if len(group) > 1 and len(group) == beside[key]:
                for i in group:
                    marked[i] = True
    ends: dict[int, int] = {}  # element with such a heading, the heading's number
    for at, text in zip(page.owner, page.text, strict=True):
        if page.tag[at] in ("h2", "h3", "h4", "h5", "h6") and len(text) < 60 and COMMENT_HEADING.fullmatch(text):
            ends.setdefault(page.parent[at], at)
    if not ends and not any(marked):
        return
    for i in range(1, len(marked)):
        marked[i] = marked[i] or (page.parent[i] in ends and i >= ends[page.parent[i]])
    dropped = page.inside(marked)[owner]
    content = np.flatnonzero(_weights(page, used & ~dropped) > 0)
    first = np.flatnonzero(dropped & used)
    if len(first) and len(content) and content[0] < first[0]:
        page.side = [a or b for a, b in zip(page.side, marked, strict=True)]


def main_text(html_text: str) -> str:
    """The article of one page; empty if there is none."""
    page = _Page(html_text)
    if not page.text:
        return ""
    owner = np.array(page.owner)
    possible = ~np.array(page.never, bool)[owner]
    _unwrap(page, owner, possible)
    _mark_comments(page, owner, possible & ~page.inside(page.side)[owner])
    used = possible & ~page.inside(page.side)[owner]
    if not used.any():
        return ""
    weights = _weights(page, used)
    held = page.below(np.bincount(owner, weights, len(page.tag)))
    total = float(weights.sum())

    def smallest(share: float) -> int:
        return max((i for i, size in enumerate(held) if size >= share), key=page.depth.__getitem__)

    around = list(page.above(smallest(SHARE * total)))
    chosen = [i for i in around if page.tag[i] == "article"] or [i for i in around if page.tag[i] == "main"]
    article = chosen[-1] if chosen else smallest(total)
    while page.tag[article] not in CONTAINERS:
        article = page.parent[article]
    kept = page.inside([i == article for i in range(len(page.tag))])[owner]
    if page.tag[article] == "article":  # its title may stand before it in the main element
        main = [i for i in around if page.tag[i] == "main" and i < article]
        titles = page.inside([i in main for i in range(len(page.tag))])
        kept |= np.array([titles[i] and i < article and page.tag[i] == "h1" for i in page.owner])
    elif not chosen:
        kept &= ~_menus(page, owner, used, weights)[owner]
    return " ".join(t for t, keep in zip(page.text, kept & used, strict=True) if keep)


def _menus(page: _Page, owner: np.ndarray, used: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Whether each element lies in a list of links: several leaves, nearly all links, no content."""
    size = np.array([len(t) for t in page.text], float) * used
    lengths = page.below(np.bincount(owner, size, len(page.tag)))
    links = page.below(np.bincount(owner, size * np.array(page.linked), len(page.tag)))
    many = page.below(np.bincount(owner, used, len(page.tag)))
    content = page.below(np.bincount(owner, weights, len(page.tag)))
    menu = [
        tag in ("ul", "ol", "div", "section", "table") and many[i] > 2 and links[i] >= 0.9 * lengths[i] and not content[i]
        for i, tag in enumerate(page.tag)
    ]
    return page.inside(menu)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` and ``n_chars`` (its code points).

    NULL and empty pages have an empty text, as do pages without any text outside menus, forms and
    the like. Broken markup is read as browsers do in the main: a new block ends an open paragraph,
    an end tag closes what is open inside it, a quote that never ends is no quote. Nothing is
    shuffled; repeated rows give repeated results and an empty table gives no rows.
    """
    ship_package(pages.sparkSession)
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes],
                names=["id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    found = rows.mapInArrow(run, f"id {id_type}, url string, text string, n_chars long")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
