"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element, with blank lines where containers begin and end.
A line weighs its characters outside links; lines in menus, headers, footers, sidebars, notices,
adverts, forms and comments weigh nothing. Sums over a sliding window of lines surge where a dense
region begins and dive to zero behind it. Regions inside an article or main element are kept whole;
of a page's other regions those whose peak passes the threshold, and without such an element also
those between the first and the last of them. A part is a menu, sidebar and so on by its tag, or by
a whole class, id or role name; one skipped by name alone is read after all if it holds what the page
is about (see Lines._uncover).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import slices, table

#: Lines of a window; characters that the densest window of a region must have (less on short pages:
#: half of what the page's densest window has).
WINDOW, THRESHOLD = 3, 86

RAW = frozenset("script style title textarea noscript template iframe object svg math canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog select option fieldset".split())
#: Parts of a line that are not read, but don't end it.
MUTED = frozenset("button label".split())
CONTAINERS = frozenset("article main nav header footer aside form body".split())
BLOCKS = CONTAINERS | frozenset(
    "address blockquote center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li menu ol "
    "option p pre section select summary table tbody td tfoot th thead tr ul head".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Block elements whose class, id or role names never skip them. Ids of other elements than LISTED are
#: places that links lead to.
PLAIN = frozenset(("html", "body", "article", "main", *HEADINGS))
LISTED = frozenset("div ul ol table".split())
#: Whole class, id and role names that mark what isn't the article, also joined by - or _.
MARKS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "sidebar footer header masthead breadcrumb breadcrumbs comment comments reply replies disqus cookie cookies "
    "consent gdpr notice notification alert newsletter subscribe signup login share sharing social related "
    "recommended popup modal overlay widget pagination pager toolbar search complementary contentinfo".split())

#: Names of reader comments, also with what holds them (comment-list, comments-area), on articles too.
COMMENTS = frozenset("comment comments reply replies disqus".split())
HOLDERS = frozenset("area list section thread threads box block wrap wrapper container item items tree feed stream root".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAMES = re.compile(r"""(?<![A-Za-z-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_JOINTS = re.compile("[-_]+")
_SENTENCE = re.compile(r"[.!?\u2026][\"'\u201d\u2019\u00bb)\]]*$")


def _marked(name: str, attributes: str, in_article: bool) -> bool:
    """Whether a name of the element says that it isn't the article: one of MARKS, or several joined."""
    if name not in BLOCKS or name in PLAIN and name != "article":
        return False
    for m in _NAMES.finditer(attributes):
        if m[1].lower() == "id" and name not in LISTED:
            continue
        for token in (m[2] or m[3] or m[4] or "").lower().split():
            parts = set(_JOINTS.split(token))
            if parts & COMMENTS and parts <= COMMENTS | HOLDERS:
                return True
            if name not in PLAIN and all(part in MARKS for part in _JOINTS.split(token)) and not (in_article and token in ("header", "masthead")):
                return True
    return False


class Lines:
    """The lines of a page: text, weight, and whether it is in a part that is never the article."""

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.weights: list[int] = []
        self.inside: list[bool] = []  # of an article or main element
        self.kinds: list[str] = []  # h: a heading; p: a paragraph
        # Parts skipped by name: the part around; the h1 elements, then the article and main ones, inside.
        # For each line its innermost one, or -1.
        self._parts: list[list[int]] = []
        self._part, self._of = -1, []
        self._pieces: list[str] = []
        self._linked = 0
        self._open: list[tuple[str, bool, int]] = []
        self._names: Counter = Counter()
        self._muted = self._skipped = self._links = self._articles = self._titles = self._mains = 0
        self._read(page)
        self._end()
        while self._part >= 0:
            self._leave(self._part)
        self.densest = 0
        if self._parts and self.texts:
            self._uncover()

    def _end(self, blanks: int = 0) -> None:
        """Close the line; blanks adds empty lines behind it."""
        if self._pieces:
            text = " ".join(html.unescape("".join(self._pieces)).split())
            if text:
                inside = not self._skipped
                self.texts.append(text if inside else "")
                linked = 0 if self._articles and any(self._names[h] for h in HEADINGS) else self._linked
                self.weights.append(max(0, len(text) - linked) if inside else 0)
                self.inside.append(self._articles > 0)
                self.kinds.append("h" if any(self._names[h] for h in HEADINGS) else "p" if self._names["p"] else "")
                self._of.append(self._part)
            self._pieces, self._linked = [], 0
        if blanks and self.texts:
            self.texts += [""] * blanks
            self.weights += [0] * blanks
            self.inside += [self._articles > 0] * blanks
            self.kinds += [""] * blanks
            self._of += [-1] * blanks

    def _text(self, text: str) -> None:
        if text and not self._muted:
            self._pieces.append(text)
            if self._links:
                self._linked += len(text)

    def _read(self, page: str) -> None:
        at, quoted, lower = 0, True, None
        while True:
            sign = page.find("<", at)
            if sign < 0:
                self._text(page[at:])
                return
            self._text(page[at:sign])
            following = page[sign + 1:sign + 2]
            if page.startswith("<!--", sign):
                close = page.find("-->", sign + 4)
                at = len(page) if close < 0 else close + 3
            elif following in ("!", "?"):
                close = page.find(">", sign)
                at = len(page) if close < 0 else close + 1
            elif following == "/" or following.isascii() and following.isalpha():
                m = _TAG.match(page, sign) if quoted else None
                if m is None:
                    # A quote that is never closed: from here on tags end at the next sign.
                    close = page.find(">", sign)
                    if close < 0:
                        return
                    quoted = False
                    m = re.match(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>", page[sign:close + 1])
                    at = close + 1
                    if m is None:
                        continue
                else:
                    at = m.end()
                name = m[2].lower()
                if name in ("svg", "math") and not m[1] and m[3].endswith("/"):
                    self._text(" ")  # closed by itself: nothing inside
                elif name in RAW and not m[1]:
                    lower = lower or page.lower()
                    if len(lower) != len(page):
                        close = re.compile("</" + name, re.I).search(page, at)
                        close = close.start() if close else -1
                    else:
                        close = lower.find("</" + name, at)
                    end = page.find(">", close) if close >= 0 else -1
                    at = len(page) if end < 0 else end + 1
                    self._text(" ")
                elif m[1]:
                    self._close(name)
                else:
                    self._begin(name, m[3])
            else:
                self._text("<")
                at = sign + 1

    def _begin(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            if self._open and self._open[-1][0] == "p":
                self._close("p")
            self._end(WINDOW if name in CONTAINERS else 1 if name in ("div", "ul", "ol", "table", "section") else 0)
        elif name == "br":
            self._text(" ")
        if name in VOID or attributes.endswith("/"):
            return
        skipped = name in BOILERPLATE and not (name == "header" and self._articles)
        part = -1
        if not skipped and not self._skipped and attributes and _marked(name, attributes, self._articles > 0):
            self._end(WINDOW)
            part = len(self._parts)
            self._parts.append([self._part, -self._titles, -self._mains])
            self._part = part
        if skipped and not self._skipped:
            self._end(WINDOW)
        self._open.append((name, skipped, part))
        self._names[name] += 1
        self._skipped += skipped
        self._links += name == "a"
        self._muted += name in MUTED
        self._articles += name in ("article", "main")
        self._titles += name == "h1" and not self._skipped
        self._mains += name in ("article", "main") and not self._skipped

    def _leave(self, part: int) -> None:
        # The counts began at minus those before the part.
        self._part = self._parts[part][0]
        self._parts[part][1] += self._titles
        self._parts[part][2] += self._mains

    def _close(self, name: str) -> None:
        if name in BLOCKS:
            self._end()
        if not self._names[name]:
            return
        while self._open:
            opened, skipped, part = self._open.pop()
            self._names[opened] -= 1
            if part >= 0:
                self._end()
                self._leave(part)
                self._end(WINDOW)
            if skipped:
                self._end()
                self._skipped -= 1
                if not self._skipped:
                    self._end(WINDOW)
            self._links -= opened == "a"
            self._muted -= opened in MUTED
            self._articles -= opened in ("article", "main")
            if opened == name:
                break
        if name in BLOCKS:
            self._end(WINDOW if name in CONTAINERS else 1 if name in ("div", "ul", "ol", "table", "section") else 0)


    def _covered(self, read: set[int]) -> list[bool]:
        """Of each line, whether a part that isn't in read covers it."""
        parts: list[bool] = []
        for i, (around, _, _) in enumerate(self._parts):
            parts.append(i not in read or around >= 0 and parts[around])
        return [part >= 0 and parts[part] for part in self._of]

    def _uncover(self) -> None:
        """Empty the lines of parts skipped by name. A part around the page's densest window is read
        if all article and main elements are in it (or there are none), and either there is such an
        element or an h1, all of them inside, or the rest of the page has no window that would pass
        the threshold. densest: the densest window before."""
        def shown() -> list[int]:
            return [0 if c else w for c, w in zip(self._covered(read), self.weights)]

        read: set[int] = set()
        sums = window_sums(self.weights)
        at = int(sums.argmax())
        limit = min(THRESHOLD, sums[at] / 2)
        top = self.densest = int(window_sums(shown()).max())
        around: list[set[int]] = []
        for line in range(at, min(at + WINDOW, len(self.weights))):
            if self.weights[line]:
                part, chain = self._of[line], set()
                while part >= 0:
                    chain.add(part)
                    part = self._parts[part][0]
                around.append(chain)
        own = set(self._of)
        for part in sorted(set.intersection(*around) if around else ()):  # from the outermost inwards
            _, titles, mains = self._parts[part]
            all_inside = titles + mains > 0 and titles == self._titles
            if mains < self._mains or not all_inside and top > limit:
                break
            read.add(part)
            if part in own:
                top = int(window_sums(shown()).max())
        for line, covered in enumerate(self._covered(read)):
            if covered:
                self.texts[line], self.weights[line] = "", 0


def window_sums(weights: list[int]) -> np.ndarray:
    """Of each line and those behind it, a window in all."""
    return np.convolve(np.array(weights, np.int64), np.ones(WINDOW, np.int64))[WINDOW - 1:]


def regions(weights: list[int], inside: list[bool] | None = None, densest: int = 0) -> list[tuple[int, int]]:
    """Surge and dive points (first line, line after) of the kept regions. inside tells the lines of
    article and main elements; densest is the window that short pages are measured by, if not the
    densest of all."""
    if not weights:
        return []
    sums = window_sums(weights)
    dense = np.concatenate([[False], sums > 0, [False]])
    surges = np.flatnonzero(~dense[:-1] & dense[1:])
    dives = np.flatnonzero(dense[:-1] & ~dense[1:])
    limit = min(THRESHOLD, (densest or sums.max()) / 2)
    kept = [bool(sums[a:b].max() > limit) for a, b in zip(surges, dives)]
    if inside is not None and any(inside):
        kept = [k or any(i and w for i, w in zip(inside[a:b], weights[a:b])) for k, a, b in zip(kept, surges, dives)]
    elif any(kept):
        first, last = kept.index(True), len(kept) - kept[::-1].index(True)
        kept[first:last] = [True] * (last - first)
    return [(int(a), int(b)) for k, a, b in zip(kept, surges, dives) if k]


def _beside(lines: Lines, kept: list[tuple[int, int]]) -> list[int]:
    """Of a page without article and main elements: the headings in the lines next to the kept regions'
    first one, and the paragraphs in those next to the last one, up to the first line of another kind."""
    found, (first, last) = [], (kept[0][0], kept[-1][1])
    for places, kind in ((range(first - 1, -1, -1), "h"), (range(last, len(lines.texts)), "p")):
        for i in places:
            if lines.texts[i]:
                if lines.kinds[i] != kind or not lines.weights[i] or kind == "p" and not _SENTENCE.search(lines.texts[i]):
                    break
                found.append(i)
    return found


def main_text(page: str | None) -> str:
    """The kept lines, with an empty line between; empty if the page has no text outside boilerplate.
    Lines of an article or main element are all kept, those of links alone too."""
    lines = Lines(page or "")
    found = regions(lines.weights, lines.inside, lines.densest)
    kept = {i for a, b in found for i in range(a, b)}
    if any(lines.inside):
        kept.update(i for i, inside in enumerate(lines.inside) if inside)
    elif found:
        kept.update(_beside(lines, found))
    return "\n\n".join(lines.texts[i] for i in sorted(kept) if lines.texts[i])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, pages in slices(batches, "html"):
        texts = [main_text(page) for page in pages]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars. No html is an empty page; a page without text has
    an empty one. Pages are read one by one: repeated rows each get their row, an empty table gives an
    empty result, other columns are not read."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
