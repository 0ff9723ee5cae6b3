"""HTML extraction: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clusters.

``html.parser`` streams its events over a page.  Block tags end a line; a line holds its text, the
number of its tags, and the chain of elements that enclose it.  Lines inside menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and comment sections (by tag, ARIA role
or a word of class and id) are marked as boilerplate and count with ratio 0.  Headings and sections are
never marked by a word of their id, and inside an ``article`` or ``main`` a word of class or id marks an element only if
half of its text is links and buttons or it holds a field to fill in.  Whole tokens of class that leave no doubt (``comments``,
``comment-body``, ``advertisement``, ``cookie-notice``, ``newsletter``, ``sidebar``, ...) and reader comments by ``itemprop`` mark
any block element, also in the article and an article itself as a comment, unless it encloses the article.  The ratio of text
characters to tags is smoothed over the lines with a Gaussian kernel, and lines above the threshold
(the standard deviation of the smoothed ratios, or their mean if that is lower) form the clusters.

The clusters say where the article is: every outermost ``article`` with a line of a cluster, if these hold half
of the largest cluster's text, else every such ``main``, else the smallest element that encloses all lines of all clusters.
All unmarked lines in there are returned in page order, also short ones between clusters, so nothing
of the article is dropped.

Defined cases: null or empty html, or no line with text: empty text; markup that is never closed is
closed by the end of the page; plain text without tags is returned whole; rows that repeat an id or url are read row by
row; long pages are read whole; an empty table gives no rows; columns besides the html and ``keep`` don't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from .common import map_batches

#: HTML elements that end a line.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option "
    "p pre search section summary table tbody td tfoot th thead title tr ul".split())
#: HTML elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose whole content is left out.
DROPPED = frozenset(
    "nav header footer aside form script style noscript template head title button select textarea iframe "
    "object svg canvas menu dialog audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of class and id that name boilerplate.
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget "
    "cookie cookies consent gdpr notice notices notification popup modal overlay alert disclaimer "
    "comment comments commentlist disqus replies reply respond discussion "
    "share sharing social related recommended newsletter subscribe signup login search pagination pager form".split())
#: Whole tokens of class that name boilerplate beyond doubt, wherever they stand; an article is marked by the first kind alone.
READERS = re.compile(r"(?:user-?|reader-?)?comments?|comments?[-_](?:list|body|content|text|section|area|thread|item|wrapper|container|form|box|block|meta)|"
                     r"commentlist|disqus.*")
SURE = re.compile(r"advert|adverts|advertisements?|advertising|advert[-_].*|advertisement[-_].*|ads?|ads?[-_](?:slot|box|unit|banner|container|wrapper|block|label)|"
                  r"sponsor|sponsored|sponsored[-_].*|cookies?|cookies?[-_].*|gdpr|gdpr[-_].*|newsletter|newsletter[-_].*|sidebar|sidebar[-_].*|"
                  r"site[-_]notice|breadcrumbs?")
#: Ids that do the same.
SURE_IDS = frozenset("comments comment-list disqus_thread sidebar newsletter".split())
#: A wrapper of the article itself may carry such a word ("post has-sidebar"): these elements are never marked by class.
NEVER_MARKED = frozenset("html body article main".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")
#: Open elements that a new one ends, as a browser does it.
ENDS = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
        "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
        "option": frozenset(["option"])}
#: Elements that end an open paragraph.
ENDS_P = frozenset(BLOCK - {"br", "p", "li", "dt", "dd", "tr", "td", "th", "option", "legend", "caption", "summary",
                            "tbody", "thead", "tfoot", "body", "html", "head", "title"})
#: Elements that may hold an article as a whole; single paragraphs and inline elements don't.
HOLDERS = frozenset("html body article main section div table tbody tr td center".split())
#: Elements that an id alone never marks: it is the target of a link to a part of the article.
PARTS = frozenset("section h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("input select textarea button".split())
SCOPE = frozenset("table td th ul ol dl div article section main body html blockquote".split())


def _boilerplate(tag: str, attrs: list) -> str:
    """``sure`` (by tag, role or as hidden), ``class`` (a token beyond doubt), ``word`` (a word of class or id) or nothing."""
    if tag in DROPPED:
        return "sure"
    if tag in NEVER_MARKED and tag != "article":
        return ""
    said = ""
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            if tag != "article":
                return "sure"
        if not value:
            continue
        low = value.lower()
        if name == "role" and low in ROLES and tag != "article":
            return "sure"
        if tag in BLOCK:
            tokens = low.split()
            if name == "itemprop" and "comment" in tokens or name == "itemtype" and low.rstrip("/").endswith("schema.org/comment"):
                return "class"
            if name == "class" and any(READERS.fullmatch(t) or tag != "article" and SURE.fullmatch(t) for t in tokens):
                return "class"
            if name == "id" and tag not in PARTS and tag != "article" and low.strip() in SURE_IDS:
                return "class"
        if tag != "article" and (name == "class" or name == "id" and tag not in PARTS) and not WORDS.isdisjoint(_SPLIT.split(low)):
            said = "word"
    return said


class _Lines(HTMLParser):
    """Collects (text, tags, innermost element, boilerplate) for each line of a page.

    Elements are numbered as they open; ``names`` and ``parents`` describe them, so a line needs
    one number for all the elements around it and work stays linear in the page.
    ``doubted`` are the elements in the article that a word alone marks, ``wrapping`` those that a class marks and
    that hold an article or main; those in ``spared`` aren't marked.
    """

    def __init__(self, spared: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.spared = spared
        self.doubted: list[int] = []
        self.wrapping: set[int] = set()
        self.by_class: list[int] = []  # open elements that a token of class marks
        # By element: inside an article or main, inside a link or button, letters, those in links, fields.
        self.central, self.linked, self.size, self.linked_size, self.fields = [False], [False], [0], [0], [0]
        self.lines: list[tuple[str, int, int, bool]] = []
        self.names: list[str] = ["#page"]
        self.parents: list[int] = [-1]
        self.open: list[tuple[str, int, bool]] = [("#page", 0, False)]  # the flag holds for all inside
        self.count: Counter = Counter()
        self.text: list[str] = []
        self.tags = 0

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip() if self.text else ""
        if text:
            self.lines.append((text, max(1, self.tags), *self.open[-1][1:]))
            self.tags = 0
        self.text = []

    def close_to(self, depth: int) -> None:
        while self.by_class and self.by_class[-1] >= self.open[depth][1]:
            self.by_class.pop()
        for name, _, _ in self.open[depth:]:
            self.count[name] -= 1
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        said = _boilerplate(tag, attrs)
        if said in ("word", "class") and len(self.names) in self.spared:
            said = ""
        if tag in BLOCK or said:
            self.end_line()
        ends = ENDS.get(tag) or (ENDS["p"] if tag in ENDS_P else ())
        if any(self.count[x] for x in ends):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] in ends:
                    self.close_to(i)
                    break
                if self.open[i][0] in SCOPE:
                    break
        self.tags += 1
        if tag not in VOID:
            _, parent, inside = self.open[-1]
            if said == "word" and self.central[parent]:
                self.doubted.append(len(self.names))
            if tag in ("article", "main") and not said:
                self.wrapping.update(e for e in self.by_class if not self.central[e])
            if said == "class":
                self.by_class.append(len(self.names))
            self.central.append(self.central[parent] or tag in ("article", "main"))
            self.linked.append(self.linked[parent] or tag == "button" or tag == "a" and any(n == "href" for n, _ in attrs))
            self.size.append(0)
            self.linked_size.append(0)
            self.fields.append(int(tag in CONTROLS and tag != "button"))
            self.open.append((tag, len(self.names), bool(said) or inside))
            self.names.append(tag)
            self.parents.append(parent)
            self.count[tag] += 1
        elif tag == "input" and not any(n == "type" and v == "hidden" for n, v in attrs):
            self.fields[self.open[-1][1]] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            name, _, marked = self.open[i]
            if name == tag:
                if tag in BLOCK or marked:
                    self.end_line()
                self.close_to(i)
                return
            if name in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
                return  # a stray end tag doesn't close what encloses the article

    def handle_data(self, data):
        self.text.append(data)
        name, e, _ = self.open[-1]
        if name not in ("script", "style"):
            n = len(data) - data.count(" ")
            self.size[e] += n
            self.linked_size[e] += n * self.linked[e]

    def wrongly_marked(self) -> frozenset[int]:
        """The doubted elements whose text is neither mostly links nor around fields."""
        for e in range(len(self.names) - 1, 0, -1):
            for held in (self.size, self.linked_size, self.fields):
                held[self.parents[e]] += held[e]
        return frozenset(e for e in self.doubted if not self.fields[e] and 2 * self.linked_size[e] < self.size[e]) | self.wrapping


def smoothed(values: list[float], radius: int) -> list[float]:
    """Gaussian smoothing with sigma = radius, cut at one radius on each side, weights renormalised at the ends."""
    if radius <= 0:
        return list(values)
    kernel = [math.exp(-(i * i) / (2.0 * radius * radius)) for i in range(-radius, radius + 1)]
    out = []
    for at in range(len(values)):
        total = weight = 0.0
        for i, k in zip(range(at - radius, at + radius + 1), kernel):
            if 0 <= i < len(values):
                total += k * values[i]
                weight += k
        out.append(total / weight)
    return out


def _read(html: str, spared: frozenset[int] = frozenset()) -> _Lines:
    page = _Lines(spared)
    page.feed(html)
    page.close()
    page.end_line()
    return page


def main_text(html: str | None, radius: int = 2) -> str:
    """The main text of one page; blocks are joined by one space."""
    if not html:
        return ""
    page = _read(html)
    if (page.doubted or page.wrapping) and (spared := page.wrongly_marked()):
        page = _read(html, spared)
    lines = page.lines
    if not any(not x[3] for x in lines):
        return ""
    ratios = [0.0 if marked else len(text) / tags for text, tags, _, marked in lines]
    smooth = smoothed(ratios, radius)
    mean = sum(smooth) / len(smooth)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    threshold = min(mean, deviation)
    clusters: list[list[int]] = []
    last = -2
    for i, x in enumerate(smooth):
        if x >= threshold and not lines[i][3]:
            if last == i - 1:
                clusters[-1].append(i)
            else:
                clusters.append([i])
            last = i
    if not clusters:
        clusters = [[i for i, x in enumerate(lines) if not x[3]]]
    best = max(clusters, key=lambda c: sum(len(lines[i][0]) for i in c))
    # The elements that hold the article: articles, else mains, else the smallest that encloses all clusters.
    def weights(at: list[int]) -> list[int]:
        weight = [0] * len(page.names)
        for i in at:
            weight[lines[i][2]] += len(lines[i][0])
        for e in range(len(weight) - 1, 0, -1):  # an element opens after its parent
            weight[page.parents[e]] += weight[e]
        return weight

    largest, weight = weights(best), weights([i for c in clusters for i in c])
    roots: list[int] = []
    for name in ("article", "main"):
        within = [False] * len(weight)
        for e in range(1, len(weight)):
            within[e] = within[page.parents[e]] or page.names[page.parents[e]] == name
        outer = [e for e in range(len(weight)) if page.names[e] == name and not within[e] and weight[e]]
        if outer and 2 * sum(largest[e] for e in outer) >= largest[0]:
            roots = outer
            break
    if not roots:
        roots = [max(e for e in range(len(weight)) if weight[e] == weight[0] and (e == 0 or page.names[e] in HOLDERS))]
    inside = [False] * len(weight)
    for e in roots:
        inside[e] = True
    for e in range(1, len(weight)):
        inside[e] = inside[e] or inside[page.parents[e]]
    return " ".join(text for text, _, e, marked in lines if inside[e] and not marked)


def extract(pages: DataFrame, radius: int = 2, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: the columns ``keep`` and ``text``, the main text of the whole page."""
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(cols: dict) -> dict:
        return {c: cols[f"k{i}"] for i, c in enumerate(keep)} | {"text": [main_text(h, radius) for h in cols["h"]]}

    frame = pages.select(*[pages[c].alias(f"k{i}") for i, c in enumerate(keep)], pages[html_col].alias("h"))
    return map_batches(frame, run, f"{fields}, text string")
