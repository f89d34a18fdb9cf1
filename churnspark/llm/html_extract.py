"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block (paragraph, heading, list item,
table row ...).  Every line weighs its code points outside links; lines of
menus, page headers, footers, sidebars, notices, adverts, forms and reader
comments are blank (weight 0), as scripts and styles leave no line at all.  The
text lengths of ``WINDOW`` following lines are summed; the curve of these sums
surges where a window first reaches text and dives where a whole window is
blank.  The text between a surge and its dive is kept if the curve's peak there
reaches ``PEAK_SHARE`` of the page's highest peak.

Markup decides what is blank: elements by tag, role, and words of class and id.
Where a page names its article (``article``, ``main``, role or an article body
class), lines outside are blank windows, and what is stripped inside leaves no
blank line, so that nothing between two paragraphs splits the text.  Where it
names none, an advert of a line or two is too short for a dive, and short lines that aren't headings or sentences are cut off at both
ends of the text.  If class words alone would blank a page of more than
``WRAPPER`` code points, they are ignored.

The scanner reads a page once, whatever its markup: unclosed comments, quotes,
tags and elements end where the next one does or with the page.

Defined cases: null or empty html, and pages of nothing but links, adverts and
the like, give an empty text;
rows with equal or null ids are judged one by one; very long pages are read
whole (memory follows the longest page of a task); ties don't occur (every span
is judged by itself); an empty table gives an empty table; extra columns aren't
read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import map_arrow

#: Lines in a window of the distribution.
WINDOW = 3
#: Part of the highest peak that a span's peak must reach.
PEAK_SHARE = 0.2
#: Code points below which a line at an end of an unnamed text must be a
#: heading or a sentence.
SHORT = 40
#: Code points that no advert or notice has: a class that blanks a page of more
#: names a wrapper.
WRAPPER = 1000

# Names of HTML elements and of roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
                   "select summary table tbody tfoot thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title template svg math object canvas audio video".split())
BLANK = frozenset("nav footer aside form button select dialog menu fieldset head".split())
ARTICLE = frozenset("article main".split())
BLANK_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ARTICLE_ROLES = frozenset("main article".split())
#: Words of class and id that mark what isn't the article.
BLANK_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promos banner "
                        "cookie cookies consent gdpr notice notices notification popup modal overlay nav navbar navigation navi menu menus "
                        "menubar breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer foot header masthead topbar toolbar "
                        "comment comments commentlist reply replies respond disqus discussion share sharing social related recommended "
                        "recommendations newsletter subscribe subscription signup login search pagination pager copyright legal skip "
                        "disclaimer hidden".split())
#: Beside these a class names a wrapper or an article's own part.
NOT_BLANK_WORDS = frozenset("has with no without wrapper wrap container page layout".split())
OWN_WORDS = frozenset("entry post article content story".split())
ARTICLE_NAMES = frozenset("article post entry story content article-body articlebody article-content article-text entry-content "
                          "post-content post-body story-body main-content content-main maincontent".split())

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_END = re.compile(r"=\s*([\"'])|>")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_LEGAL = re.compile(r"©|\bcopyright\b|all rights reserved|\bcookies?\b", re.IGNORECASE)
_SENTENCE = tuple(".!?…。！？:;\"”»’'")
_ASKED = ("class", "id", "role", "itemprop", "hidden", "style")


class Line(NamedTuple):
    text: str
    weight: int
    inside: bool
    heading: bool


class _Tags:
    """End of a tag at a position; each kind of missing end is looked for once."""

    def __init__(self, page: str):
        self.page, self.missing = page, {}

    def find(self, what: str, at: int) -> int:
        if self.missing.get(what, len(self.page) + 1) <= at:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing[what] = at
        return found

    def end(self, at: int) -> int:
        """Index after the tag that starts before ``at``; quoted values may hold ``>``."""
        if self.page[at:at + 1] == ">":
            return at + 1
        while m := _END.search(self.page, at):
            if not m[1]:
                return m.end()
            close = self.find(m[1], m.end())
            # a quote that never closes, or closes in a later tag, is a plain character
            at = close + 1 if close >= 0 and not _TAG.search(self.page, m.end(), close) else m.end()
        return len(self.page)


def _attributes(tag: str) -> dict[str, str]:
    low = tag.lower()
    if not any(name in low for name in _ASKED):
        return {}
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(tag)}


def _words(names: str) -> list[set[str]]:
    return [set(_WORD.findall(_CAMEL.sub(" ", name).lower())) for name in names.split()]


def _kind(name: str, tag: str, inside: bool, use_classes: bool) -> int:
    """-1 for an element that isn't the article, 1 for the article, else 0."""
    if tag == ">":
        return -1 if name in BLANK or name == "header" and not inside else int(name in ARTICLE)
    found = _attributes(tag)
    role, names = found.get("role", "").lower(), f"{found.get('class', '')} {found.get('id', '')}"
    if name in BLANK or role in BLANK_ROLES or "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "")):
        return -1
    if name == "header" and not inside:
        return -1
    if name not in ("html", "body", *ARTICLE) and use_classes:
        for words in _words(names):
            hit = words & BLANK_WORDS
            if hit and not words & NOT_BLANK_WORDS and not (hit <= {"header"} and (inside or words & OWN_WORDS)):
                return -1
    if name in ARTICLE:
        # a reader's comment is often an article of its own
        comment = use_classes and any(words & {"comment", "comments", "reply"} for words in _words(names))
        return -1 if comment else 1
    named = found.get("itemprop", "") == "articleBody" or any(x.lower() in ARTICLE_NAMES for x in names.split())
    return 1 if role in ARTICLE_ROLES or named else 0


def page_lines(page: str, use_classes: bool = True) -> list[Line | None]:
    """The lines of a page in order; None for each blank line."""
    tags, lines = _Tags(page), []
    stack: list[tuple[str, int]] = []
    open_names: Counter[str] = Counter()
    state = {"blank": 0, "inside": 0, "link": 0, "heading": 0}
    chunks: list[str] = []
    free = [0]  # code points outside links in the line at hand
    last_close: dict[str, int] = {}
    low = page.lower() if len(page.lower()) == len(page) else page

    def flush() -> None:
        text = " ".join("".join(chunks).split())
        if text and not state["blank"]:
            # mostly links: blank, but kept between two other lines
            weight = min(free[0], len(text)) if 2 * free[0] >= len(text) else 0
            lines.append(Line(text, weight, state["inside"] > 0, state["heading"] > 0))
        elif text and not state["inside"]:
            lines.append(None)
        chunks.clear()
        free[0] = 0

    def change(name: str, kind: int, by: int) -> None:
        if kind < 0:
            state["blank"] += by
        elif kind:
            state["inside"] += by
        if name == "a":
            state["link"] += by
        elif name in HEADINGS:
            state["heading"] += by

    def pop() -> None:
        name, kind = stack.pop()
        open_names[name] -= 1
        if name in BLOCKS or kind:
            flush()
        change(name, kind, -1)

    def add(text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        chunks.append(text)
        if not state["link"]:
            free[0] += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        start = tags.find("<", at)
        if start < 0:
            add(page[at:])
            break
        if start > at:
            add(page[at:start])
        if page.startswith("<!--", start):
            end = tags.find("-->", start + 4)
            # without an end only the opening tag is a comment
            at = end + 3 if end >= 0 else tags.end(start + 4)
            continue
        if page[start + 1:start + 2] in ("!", "?"):
            at = tags.end(start + 2)
            continue
        found = _TAG.match(page, start)
        if not found:
            if page.startswith("</", start):
                at = tags.end(start + 2)
            else:  # a plain character
                add("<")
                at = start + 1
            continue
        name, closing = found[1].lower(), page[start + 1] == "/"
        at = tags.end(found.end())
        if closing:
            if open_names[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name in BLOCKS:
                flush()
            continue
        if name in RAW and page[at - 2:at] != "/>":
            # scripts and their like hold no text of the page
            end = re.compile(f"</{name}", re.IGNORECASE).search(page, at) if last_close.get(name, n) > at else None
            if end:
                at = tags.end(end.end())
            else:
                last_close[name] = at
                if name in ("script", "style"):
                    break
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name in ("br", "input"):
                add(" ")
            continue
        if name in ("td", "th"):
            add(" ")
        if name in BLOCKS:
            flush()
            # what a new block closes by itself
            for was in {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "option": ("option",)}.get(name, ()) + ("p", "a"):
                if open_names[was]:
                    k = len(stack) - 1
                    while k >= 0 and stack[k][0] != was and (stack[k][0] not in BLOCKS or stack[k][0] == "p"):
                        k -= 1
                    if k >= 0 and stack[k][0] == was and (was != "a" or any(x[0] == "p" for x in stack[k:])):
                        while len(stack) > k:
                            pop()
        kind = _kind(name, page[found.end():at], state["inside"] > 0, use_classes)
        if kind < 0 and name not in last_close:
            last_close[name] = low.rfind(f"</{name}")
        if kind < 0 and last_close[name] < at:
            kind = 0 if name != "head" else -1  # never closed: it would blank the rest of the page
        if kind:
            flush()
        stack.append((name, kind))
        open_names[name] += 1
        change(name, kind, 1)
        if name == "body":
            while open_names["head"]:
                _drop_head(stack, open_names, state)
    flush()
    return lines


def _drop_head(stack: list, open_names: Counter, state: dict) -> None:
    """The body closes a head that has no end tag."""
    k = next(i for i, x in enumerate(stack) if x[0] == "head")
    del stack[k]
    open_names["head"] -= 1
    state["blank"] -= 1


def spans(weights: list[int]) -> list[tuple[int, int]]:
    """(surge, dive) of every stretch between blank windows whose peak counts:
    lines ``surge`` to ``dive - 1``, without weightless lines at the ends."""
    if not any(weights):
        return []
    n, sums, found = len(weights), [], []
    total = sum(weights[:WINDOW])
    for i in range(n):  # sum of the lines i to i + WINDOW - 1
        sums.append(total)
        total += (weights[i + WINDOW] if i + WINDOW < n else 0) - weights[i]
    need, i = PEAK_SHARE * max(sums), 0
    while i < n:
        if not weights[i]:
            i += 1
            continue
        surge = dive = i
        peak = 0
        while i < n and sums[i]:
            peak = max(peak, sums[i])
            if weights[i]:
                dive = i + 1
            i += 1
        if peak >= need:
            found.append((surge, dive))
    return found


def main_text(page: str | None) -> tuple[str, int]:
    """The main text of a page and its number of lines."""
    if not page:
        return "", 0
    lines = page_lines(page)
    if not any(lines) and len(page) > WRAPPER:
        whole = page_lines(page, use_classes=False)
        if sum(x.weight for x in whole if x) > WRAPPER:
            lines = whole
    named = any(x and x.inside for x in lines)
    if named:
        spread: list[Line | None] = []
        for x in lines:
            if x is None or x.inside:
                spread.append(x)
            else:
                spread.extend([None] * WINDOW)
        lines = spread
    weights = [0 if x is None else max(x.weight, 1) if named else x.weight for x in lines]
    kept: list[Line] = []
    for a, b in spans(weights):
        kept += [x for x in lines[a:b] if x is not None]
    a, b = 0, len(kept)
    if not named:
        while b - a > 1 and _edge(kept[a]):
            a += 1
        while b - a > 1 and _edge(kept[b - 1], end=True):
            b -= 1
    return "\n".join(x.text for x in kept[a:b]), b - a


def _edge(line: Line, end: bool = False) -> bool:
    """Whether a line at an end of an unnamed text isn't part of it."""
    if len(line.text) < 4 * SHORT and _LEGAL.search(line.text) and not line.heading:
        return True
    return len(line.text) < SHORT and not line.text.endswith(_SENTENCE) and (end or not line.heading)


def extract(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: the id and url as given, text, n_chars, n_lines."""
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = {c: src.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):  # output batches of bounded size
                part = batch.slice(i, 64)
                found = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([t for t, _ in found], pa.string()),
                     pa.array([len(t) for t, _ in found], pa.int64()), pa.array([k for _, k in found], pa.int64())],
                    names=["page_id", "url", "text", "n_chars", "n_lines"])

    return map_arrow(src, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_lines long")
