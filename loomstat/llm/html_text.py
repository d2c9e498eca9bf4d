"""Main text of web pages by line-block distribution.

``lines_of`` strips the markup: one line for each block-level stretch of text,
with its length outside links and whether it stands in page furniture (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments) or in a
declared main part (``article``, ``main``). ``keep`` sums the text lengths over
sliding windows of ``WINDOW`` lines: text starts where the sum surges above
``SURGE`` and ends where it dives to zero; furniture and link lists weigh
nothing. Each line of a declared part weighs ``SURGE`` more, and windows do not
reach over its borders; beside declared text a stretch is kept where it
outweighs that text. Where no window surges, the longest stretch of weighing
lines is the text.

An element is furniture by its tag, its role or a whole class name or id with a
word of ``NAMES`` (``has-sidebar`` and the like tell of a neighbour and do not
count). A name that is not of reader comments is not believed of an element
that holds over half of the page's text.

A header inside an article belongs to it, a footer does not. Blocks have their
character references decoded, white space turned into one space and trimmed;
they are joined in page order by a blank line.

Defined results: null or empty html, or a page without text, gives the empty
text; unclosed elements end with their parents, an unclosed comment or script
with the page; repeated rows stay repeated; null ids and urls pass through;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C

WINDOW = 3
SURGE = 80

_TOKEN = re.compile(r"""<!--|<!\[CDATA\[|<[!?][^>]*+>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^<>"']|"[^"]*+"|'[^']*+'|["'])*+)>""")
_ATTR = re.compile(r"""(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNCLOSED = re.compile(r"<!--|<!\[CDATA\[")  # all that can start after the last ">"
_WORD = re.compile(r"[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")

HIDDEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "head", "title", "textarea", "select"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
MAIN = {"article", "main"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br", "input"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# words of class, id and role that name page furniture
NAMES = {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "aside", "complementary",
         "ad", "ads", "adv", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent",
         "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "login", "search", "form", "share", "sharing", "social",
         "related", "recommended", "teaser", "widget", "pagination", "pager", "contentinfo", "toolbar", "tags", "skip"}
COMMENTS = {"comment", "comments", "reply", "replies", "disqus", "discussion", "respond"}
ABOUT = {"has", "with", "no", "without", "is", "not"}  # a name that starts so tells of something beside


def _furniture(tag: str, attrs: str, in_main: bool) -> int:
    """0: none, 1: by a name, 2: by its tag or as reader comments."""
    if tag in FURNITURE:
        return 0 if tag == "header" and in_main else 2
    if tag in ("html", "body") or "=" not in attrs:
        return 0
    named = 0
    for m in _ATTR.finditer(attrs):
        for name in (m[2] or m[3] or m[4] or "").split():
            words = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
            if not words or words[0] in ABOUT or in_main and words[-1] == "header":
                continue
            if COMMENTS.intersection(words):
                return 2
            named = named or int(not NAMES.isdisjoint(words))
    return named


class _Page:
    """Open elements and the lines found so far. Elements that are furniture by
    a name are numbered; ``up`` has the number around each, -1 for none."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool, int, bool]] = []  # text, own characters, surely furniture, named element, main
        self.up: list[int] = []
        self.stack: list[tuple[str, bool, int, bool]] = []       # tag, surely furniture, named element, main
        self.open: dict[str, list[int]] = {}                     # places of each tag in the stack
        self.blocks: list[int] = []                              # places of block elements
        self.parts: list[str] = []
        self.in_link, self.linked = False, 0
        self.state = (False, -1, False)

    def add(self, raw: str):
        if raw:
            self.parts.append(raw)
            if self.in_link:
                self.linked += len(raw)

    def flush(self):
        if self.parts:
            text = _SPACE.sub(" ", unescape("".join(self.parts))).strip()
            if text:
                self.lines.append((text, max(0, len(text) - self.linked), *self.state))
            self.parts.clear()
        self.linked = 0

    def pop(self):
        tag = self.stack.pop()[0]
        self.open[tag].pop()
        if tag not in INLINE:
            self.blocks.pop()

    def start(self, tag: str, attrs: str):
        if tag == "a":
            self.in_link = True
        if tag == "p":  # a paragraph ends the one before
            while self.stack and (self.stack[-1][0] == "p" or self.stack[-1][0] in INLINE):
                self.pop()
        _, sure, named, main = self.stack[-1] if self.stack else ("", False, -1, False)
        kind = _furniture(tag, attrs, main)
        if kind == 1 and not sure:
            self.up.append(named)
            named = len(self.up) - 1
        self.open.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, sure or kind == 2, named, main or tag in MAIN))

    def end(self, tag: str):
        if tag == "a":
            self.in_link = False
        at = self.open.get(tag)
        if at and (tag not in INLINE or not self.blocks or at[-1] > self.blocks[-1]):
            for _ in range(len(self.stack) - at[-1]):
                self.pop()

    def settle(self):
        """After a block tag: where the next line stands."""
        self.state = self.stack[-1][1:] if self.stack else (False, -1, False)
        self.in_link = self.in_link and bool(self.open.get("a"))


def lines_of(html: str) -> list[tuple[str, int, bool, bool]]:
    """``(text, characters outside links, furniture, main)`` of each block with text."""
    page, never = _Page(), set()  # never: hidden tags that no end follows
    at, n, last = 0, len(html), html.rfind(">") + 1
    while at < n:
        m = (_TOKEN.search(html, at, last) if at < last else None) or _UNCLOSED.search(html, max(at, last))
        if not m:
            page.add(html[at:])
            break
        page.add(html[at:m.start()])
        at = m.end()
        if m[0] in ("<!--", "<![CDATA["):
            end = "-->" if m[0] == "<!--" else "]]>"
            k = html.find(end, at)
            at = n if k < 0 else k + 3
            continue
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag == "br":
            page.add(" ")
            continue
        if tag not in INLINE:
            page.flush()
        single = m[3].rstrip().endswith("/")
        if m[1]:
            page.end(tag)
        elif tag in HIDDEN and not single:
            end = None if tag in never else re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            if not end:
                never.add(tag)
            if end or tag not in ("head", "svg", "math", "object", "select"):
                at = end.end() if end else n
        elif tag not in VOID and not single:
            page.start(tag, m[3])
        if tag not in INLINE:
            page.settle()
    page.flush()
    holds = [0] * len(page.up)
    for _, own, sure, named, _ in page.lines:
        if named >= 0 and not sure:
            holds[named] += own
    for i in range(len(holds) - 1, -1, -1):
        if page.up[i] >= 0:
            holds[page.up[i]] += holds[i]
    total = sum(own for _, own, sure, _, _ in page.lines if not sure)
    out = []
    for i, up in enumerate(page.up):
        out.append(2 * holds[i] <= total or up >= 0 and out[up])
    return [(text, own, sure or named >= 0 and out[named], main) for text, own, sure, named, main in page.lines]


def _stretches(weight: list[int], window: int, surge: int) -> list[list[int]]:
    """Weighing lines from each surge point to its dive point."""
    n = len(weight)
    total = [0] * (n + 1)
    for i, w in enumerate(weight):
        total[i + 1] = total[i] + w
    block = [total[min(i + window, n)] - total[i] for i in range(n)]
    out, i = [], 0
    while i < n:
        if block[i] < surge or not weight[i]:
            i += 1
            continue
        j = i
        while j < n and block[j]:
            j += 1
        out.append([k for k in range(i, j) if weight[k]])
        i = j + 1
    return out


def keep(lines: list[tuple[str, int, bool, bool]], window: int = WINDOW, surge: int = SURGE) -> list[int]:
    """Lines of the main text."""
    weight = [0 if furniture or 2 * own < len(text) and not main else max(own, 1) + (surge if main else 0) for text, own, furniture, main in lines]
    found, lo = [], 0
    for hi in range(1, len(lines) + 1):  # windows stay within or without a declared part
        if hi == len(lines) or lines[hi][3] != lines[lo][3]:
            found += [[lo + k for k in part] for part in _stretches(weight[lo:hi], window, surge)]
            lo = hi
    declared = sum(lines[k][1] for part in found for k in part if lines[k][3])
    out = [k for part in found if lines[part[0]][3] or sum(lines[k][1] for k in part) > declared for k in part]
    if out or not any(weight):
        return out
    runs, run = [], []
    for k in range(len(lines) + 1):
        if k < len(lines) and weight[k]:
            run.append(k)
        elif run:
            runs.append(run)
            run = []
    return max(runs, key=lambda r: sum(weight[k] for k in r))


def main_text(html: str | None) -> str:
    lines = lines_of(html or "")
    return "\n\n".join(lines[k][0] for k in keep(lines))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page."""
    def go(batches):
        for b in batches:
            text = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(go, "page_id long, url string, text string, n_chars long")


def op1_line_block_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(C.documents(spark, sf_dir, "pages"))
