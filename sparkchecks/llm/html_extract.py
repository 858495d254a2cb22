"""Main text of web pages by scoring the element tree.

A page is read into arrays: parent, tag and flags of each element, and its texts in page order.
Elements that never hold an article (menus, forms, adverts and so on) are marked with all they
contain; those known by class or id alone are spared, with fewer points, if they contain the
article or most points of the page. Each paragraph earns points for its length and commas and passes them up: all to its
parent, a half to the next, less to those above. An element's score is discounted by the share of
its text inside links. The best element is kept, with siblings that score well or read like
paragraphs; an ``article`` around the best one is taken whole.

Defined cases: NULL or empty html, and pages without text, give an empty text; a page without
paragraphs gives all text that is not marked; broken markup is repaired as browsers do for
paragraphs, list items and cells; a tag cut off at the end of a page is dropped; texts are never
cut. Repeated rows give repeated results.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'/=>][^\s/=>]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?|\"[^\"]*\"|'[^']*'")

# Element names of HTML by their role in parsing and layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg math".split())
END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul br".split()
)
CLOSES_P = BLOCK - {"br", "button", "option", "optgroup", "select", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "body", "html", "head"}
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NEVER = frozenset("head nav aside footer button select option input label fieldset menu dialog object audio video canvas map dir applet".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner\w*|sponsor\w*|promo\w*|cookies?\w*|consent\w*|gdpr|notice\w*|notif\w*|alert\w*|popup\w*|modal\w*|overlay\w*|"
    r"newsletter\w*|subscribe\w*|subscription\w*|signup|sidebar\w*|side|aside|menu\w*|nav|navbar\w*|navigation|breadcrumbs?|footer\w*|foot|header|masthead|topbar|"
    r"comments?|commentlist|comment\w*|disqus\w*|respond|reply|replies|shar(?:e|ing)\w*|social\w*|related\w*|recommend\w*|widgets?|toolbar|pagination|pager|paging|login|search\w*|"
    r"disclaimer\w*|copyright|skip|tags?|tagcloud|outbrain|taboola|legal)(?:$|[\s_-])",
    re.I,
)
COMMENT = re.compile(r"(?:^|[\s_-])comment|disqus|repl(?:y|ies)(?:$|[\s_-])", re.I)
#: Names of parts that may well have more text than the article: most of the points don't make them one.
WORDY = re.compile(COMMENT.pattern + r"|respond|cookie|consent|gdpr|advert|sponsor|promo|popup|modal|overlay|newsletter|subscri|disclaimer|legal|related|recommend|outbrain|taboola", re.I)
#: Names that only sound like the above: "has-sidebar" or the heading of an article.
HARMLESS = re.compile(r"^(?:has|with|no|without|is|js)[-_]|^(?:article|post|entry|story)[-_]?(?:header|title)$", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SCORED = frozenset("p pre td blockquote li dd div section article main body figcaption h1 h2 h3 h4 h5 h6".split())
CONTAINER = frozenset("div section article main body td blockquote html li ul ol table tbody tr dl center".split())
#: Elements that are dropped only if a whole class or id is a name: "copyright", but not "copyright-history".
PROSE = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6".split())
WHOLE = re.compile(NAMES.pattern.replace(r"(?:^|[\s_-])", "^").replace(r"(?:$|[\s_-])", "$"), re.I)
#: Ancestors that get points of a paragraph; what others would get is next to nothing.
LEVELS = 32
#: Share of its points that an element keeps if its name is that of a part without article.
SPARED = 0.25
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FAVOURED = {"article": 25.0, "main": 15.0, "div": 5.0, "section": 3.0, "ul": -3.0, "ol": -3.0, "li": -3.0, "table": -3.0}


def _flags(attributes: str) -> tuple[str, str, bool]:
    names, role, hidden, seen = [], "", False, set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in seen:
            continue  # the first of equal names counts
        seen.add(name)
        if name in ("class", "id"):
            names.append(value)
        elif name == "role":
            role = value.lower()
        elif name == "style":
            hidden = hidden or bool(HIDDEN.search(value))
        elif name == "hidden" or name in ("aria-hidden", "aria-modal") and value.lower() == "true":
            hidden = True
    return " ".join(names), role, hidden


class Page:
    """Elements and texts of one page."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.dropped = ["#"], [-1], [False]
        self.named, self.wordy = [False], [False]  # not wanted by its class or id alone; one of WORDY
        self.texts: list[tuple[int, str]] = []  # element and text; a block's edge is an empty text
        self._read(source)

    def _read(self, source: str) -> None:
        stack, at = [0], 0
        opened: dict[str, list[int]] = {}  # where the open elements of a name are in the stack

        def pop_to(depth: int) -> None:
            while len(stack) > depth:
                gone = self.tag[stack.pop()]
                opened[gone].pop()
                if gone in BLOCK:
                    self.texts.append((stack[-1], ""))

        def depth_of(wanted, limits=()) -> int:
            last = max((opened[x][-1] for x in wanted if opened.get(x)), default=0)
            return last if last >= max((opened[x][-1] for x in limits if opened.get(x)), default=0) else 0

        while m := TOKEN.search(source, at):
            if m.start() > at:
                self.texts.append((stack[-1], source[at : m.start()]))
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                if m[0].startswith("<![CDATA["):
                    self.texts.append((stack[-1], m[0][9:].removesuffix("]]>")))
                continue
            if m[5] and not m[0].endswith(">"):
                break  # a tag cut off by the end of the page
            name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            if closing:
                if name == "br":
                    self.texts.append((stack[-1], ""))
                elif opened.get(name):
                    limits = ("td", "th", "table") if name not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "body", "html") else ()
                    if depth := depth_of((name,), limits):
                        pop_to(depth)
                continue
            if name in RAW:
                if not attributes.endswith("/") or name in ("script", "style", "title", "textarea"):
                    end = END[name].search(source, at)
                    at = len(source) if end is None else source.find(">", end.start()) + 1 or len(source)
                continue
            if name in CLOSES_P and opened.get("p") and (depth := depth_of(("p",), ("button", "td", "th", "table", "object"))):
                pop_to(depth)
            if name in ENDED_BY:
                ended, limits = ENDED_BY[name]
                while any(opened.get(x) for x in ended) and (depth := depth_of(ended, limits)):
                    pop_to(depth)
            if name in BLOCK:
                self.texts.append((stack[-1], ""))
            if name in VOID:
                continue
            node, up = len(self.tag), stack[-1]
            self.tag.append(name)
            self.parent.append(up)
            never, named = self._never(name, attributes, opened)
            self.dropped.append(self.dropped[up] or never)
            self.named.append(named)
            self.wordy.append(named and bool(WORDY.search(_flags(attributes)[0])))
            if not (attributes.endswith("/") and name not in BLOCK):
                opened.setdefault(name, []).append(len(stack))
                stack.append(node)
        else:
            if at < len(source):
                self.texts.append((stack[-1], source[at:]))

    def _never(self, name: str, attributes: str, opened: dict[str, list[int]]) -> tuple[bool, bool]:
        """Whether an element never holds an article, and whether its class or id says so."""
        if name in NEVER or name == "header" and not (opened.get("article") or opened.get("main")):
            return True, False
        if not attributes:
            return False, name == "form"
        names, role, hidden = _flags(attributes)
        if hidden or role in ROLES:
            return True, False
        if name in ("body", "html", "main"):
            return False, False
        if name in ("article", "header"):
            return bool(COMMENT.search(names)), False
        pattern = WHOLE if name in PROSE else NAMES
        return False, name == "form" or any(pattern.search(x) and not HARMLESS.search(x) for x in names.split())

    def _spare(self, points: list[float]) -> list[bool]:
        """Drop elements by name, but those around the article or most points; tells which were spared."""
        n = len(self.tag)
        total = points[:]
        for i in range(n - 1, 0, -1):
            total[self.parent[i]] += total[i]
        inside = [False] * n
        for i in range(1, n):
            inside[i] = self.named[i] or inside[self.parent[i]]
        spared = [self.named[i] and total[i] > (0.999 if self.wordy[i] else 0.5) * total[0] for i in range(n)]
        for tag in ("article", "main"):
            if found := [i for i in range(1, n) if self.tag[i] == tag and not self.dropped[i] and total[i]]:
                if all(inside[i] for i in found):
                    up = max(found, key=lambda i: (total[i], -i))
                    while up > 0:
                        spared[up] = self.named[up]
                        up = self.parent[up]
                break
        for i in range(1, n):
            self.dropped[i] = self.dropped[i] or self.dropped[self.parent[i]] or self.named[i] and not spared[i]
        return spared

    def main_text(self) -> str:
        """The article's text, blocks joined by one space."""
        n = len(self.tag)
        own, linked, in_link = [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            in_link[i] = self.tag[i] == "a" or in_link[self.parent[i]]
        commas, direct = [0] * n, [0] * n  # of the text outside of inner blocks
        holder = list(range(n))
        for i in range(1, n):
            holder[i] = i if self.tag[i] in BLOCK else holder[self.parent[i]]
        for node, text in self.texts:
            if text and not self.dropped[node]:
                commas[holder[node]] += text.count(",") + text.count("、") + text.count("，")
                direct[holder[node]] += len(text.strip())
        points = [0.0] * n
        for i in range(1, n):
            if direct[i] and self.tag[i] in SCORED and not in_link[i] and not self.dropped[i]:
                points[i] = (1.0 if direct[i] >= 25 else 0.2) + commas[i] + min(direct[i] / 100, 3.0)
        spared = self._spare(points) if any(self.named) else [False] * n
        # Again without the text of elements that were dropped by name.
        commas, direct = [0] * n, [0] * n
        for node, text in self.texts:
            if text and not self.dropped[node]:
                size = len(text.strip())
                own[node] += size
                commas[holder[node]] += text.count(",") + text.count("、") + text.count("，")
                direct[holder[node]] += size
                if in_link[node]:
                    linked[node] += size
        for i in range(n - 1, 0, -1):
            own[self.parent[i]] += own[i]
            linked[self.parent[i]] += linked[i]
        if not own[0]:
            return ""
        score, links = [0.0] * n, [0] * n
        lists = [-1] * n  # the nearest list or box at or above an element
        for i in range(1, n):
            lists[i] = i if self.tag[i] in ("ul", "ol", "div", "section", "table") else lists[self.parent[i]]
        for i in range(1, n):
            tag = self.tag[i]
            if self.dropped[i]:
                continue
            if tag == "a" and (up := lists[self.parent[i]]) >= 0:
                links[up] += 1
            if direct[i] and tag in SCORED and not in_link[i]:
                points = (1.0 if direct[i] >= 25 else 0.2) + commas[i] + min(direct[i] / 100, 3.0)
                up, level = (i, 0) if tag in CONTAINER and tag not in ("li", "td") else (self.parent[i], 0)
                while up > 0 and level < LEVELS:
                    score[up] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                    points *= SPARED if spared[up] else 1
                    up, level = self.parent[up], level + 1
        best, factor = 0, [1.0] * n
        for i in range(1, n):
            factor[i] = factor[self.parent[i]] * (SPARED if spared[i] else 1)
            if score[i] and not self.dropped[i] and self.tag[i] in CONTAINER:
                score[i] = (score[i] + FAVOURED.get(self.tag[i], 0.0)) * (1 - linked[i] / max(own[i], 1))
                if not best or score[i] * factor[i] > score[best] * factor[best]:
                    best = i
        chosen = {best}
        up = best
        while up > 0:
            if self.tag[up] == "article":
                chosen = {up}
            up = self.parent[up]
        if best and best in chosen and self.tag[best] not in ("article", "body", "html"):
            enough = max(10.0, 0.2 * score[best])
            for i in range(1, n):
                if self.parent[i] == self.parent[best] and i != best and not self.dropped[i] and not spared[i]:
                    share = linked[i] / max(own[i], 1)
                    reads = self.tag[i] in ("p", "pre", "blockquote", "ul", "ol") and own[i] and share < 0.25
                    if score[i] >= enough or reads or self.tag[i] in HEADINGS:
                        chosen.add(i)
        around, up = set(), best  # the best element and those that contain it
        while up > 0:
            around.add(up)
            up = self.parent[up]
        kept = [False] * n
        kept[0] = 0 in chosen
        for i in range(1, n):
            menu = links[i] >= 3 and linked[i] >= 0.8 * own[i] and i not in chosen
            kept[i] = not self.dropped[i] and not menu and (i in chosen or kept[self.parent[i]] and (not spared[i] or i in around or not best))
        words = "".join(html.unescape(t) if t else " " for node, t in self.texts if not t or kept[node]).split()
        return " ".join(words)


def main_text(source: str | None) -> str:
    """Main text of one page."""
    return Page(source).main_text() if source else ""


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, text, n_chars."""
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = f"page_id {base.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return base.mapInArrow(run, schema)
