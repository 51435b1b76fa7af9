"""Main text of web pages by the distribution of text over lines.

Markup is stripped: scripts, styles, forms, menus, page headers and footers, sidebars,
notices, adverts and comments give no text, inline tags vanish, and every block
element starts a line. A line weighs the characters of its text outside links. Weights
are summed over sliding windows of lines; the text surges where a window's sum reaches
the threshold and dives where it falls to nothing. Runs of lines between surge and dive,
with the unlinked lines right before them, are kept if they hold a share ``RUN`` of the
heaviest run's text. No element is left out by its class if it holds most of the text.
An article or main element, if a page has one with text, bounds the lines looked at; inside
it the threshold is ``INSIDE`` and every run is kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import slices

WINDOW = 3
SURGE = 86
#: A run of lines is kept if it holds this share of the heaviest run's text.
RUN = 0.1
#: Threshold of the lines inside an article or main element.
INSIDE = 20

# HTML element names by role.
_RAW = "script|style|noscript|template|svg|math|textarea|iframe|object|select|title|canvas|audio|video"
_SKIP = frozenset("nav header footer aside form button dialog menu fieldset".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frame h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
option p pre section summary table tbody td tfoot th thead tr ul""".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = re.compile(r"""role\s*=\s*["']?main|itemprop\s*=\s*["']?articleBody""", re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_BOILER = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banners?|sponsor(?:ed|s)?|promos?|cookies?|consent|gdpr|"
    r"notices?|alerts?|popups?|modals?|overlays?|menus?|nav|navbar|navigation|breadcrumbs?|sidebars?|side-bar|"
    r"comments?|commentlist|respond|replies|disqus|share|sharing|social|related|recommended|newsletter|subscribe|"
    r"signup|login|search|pagination|pager|toolbar|widgets?|footer|masthead|site-header|page-header|site-footer|"
    r"complementary|contentinfo|skip-link|tags?|byline-share)(?:$|[\s_-])", re.I)
_TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
                    r"|<(?:svg|math)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<=/)>"
                    rf"|<({_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>.*?(?:</\2\s*>|$)|$)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|$)", re.S | re.I)


def lines(page: str, kept: frozenset = frozenset()) -> list:
    """[(text, weight, in article)] of the lines of a page that may hold its main text.

    ``kept``: numbers of elements that their class, id or role would leave out, but that
    hold most of the page's unlinked text."""
    out, text, linked = [], [], 0
    mass: list = []        # unlinked text of each element left out by name
    named: list = []       # those open now
    total = hidden = 0     # hidden: open ones that are not kept
    stack: list = []       # open elements: (name, skips, main, named)
    opened: Counter = Counter()  # their names
    skips = mains = links = 0
    at = 0

    def add(piece: str):
        nonlocal linked, total
        if piece and not skips:
            piece = html.unescape(piece)
            if not links:
                total += len(piece.strip())
                if named:
                    mass[named[-1]] += len(piece.strip())
            if hidden:
                return
            text.append(piece)
            if links:
                linked += len(piece.strip())

    def close(depth: int):
        """Close the open elements from this depth; what they hold counts for those around them."""
        nonlocal skips, mains, hidden
        while len(stack) > depth:
            name, s, a, k = stack.pop()
            opened[name] -= 1
            skips -= s
            mains -= a
            if k is not None:
                named.pop()
                hidden -= k not in kept
                if named:
                    mass[named[-1]] += mass[k]

    def flush():
        nonlocal linked
        line = " ".join("".join(text).split())
        if line:
            out.append((line, max(0, len(line) - linked), mains > 0))
        text.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        if m[1] is not None:
            add(m[1])
            continue
        if not m[4]:
            continue
        name, attrs = m[4].lower(), m[5]
        if name in _BLOCK:
            flush()
        if m[3]:
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            if name == "a":
                links = 0
            continue
        if name in _VOID or attrs.rstrip().endswith("/"):
            continue
        if name == "p":  # a paragraph ends where the next begins
            while stack and stack[-1][0] == "p":
                close(len(stack) - 1)
        said = " ".join(x for n in _NAMED.findall(attrs) for x in n if x)
        main = name in ("article", "main") or bool(_MAIN.search(attrs))
        skip, number = name in _SKIP, None
        if name not in ("html", "body", "main") and (name != "article" or mains) and _BOILER.search(said):
            number = len(mass)
        if mains and name == "header":
            skip, number = False, None
        links = 1 if name == "a" else links
        if name != "a":
            if number is not None:
                mass.append(0)
                named.append(number)
                hidden += number not in kept
            stack.append((name, int(skip), int(main), number))
            opened[name] += 1
            skips += int(skip)
            mains += int(main)
    if not re.match(r"<[a-zA-Z/!?]", page[at:at + 2]):
        add(page[at:])
    flush()
    close(0)
    most = frozenset(k for k, m in enumerate(mass) if 2 * m > total)
    return lines(page, most) if most and not kept else out


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of one page; lines joined by one space."""
    every, share = lines(page or ""), RUN
    if any(x[2] for x in every):  # nothing around the element competes: low surges, all runs
        every, share, surge = [x for x in every if x[2]], 0, min(surge, INSIDE)
    weight = [x[1] for x in every]
    total = sum(weight)
    if not total:  # only links: no surge, whole if an element bounds them
        return "" if share else " ".join(x[0] for x in every)
    sums = [sum(weight[i:i + window]) for i in range(len(weight))]
    level = min(surge, max(sums) / 2)
    runs, i = [], 0
    while i < len(sums):
        if sums[i] < level:
            i += 1
            continue
        start = i
        while start < len(weight) and not weight[start]:
            start += 1
        while start and weight[start - 1] and (not runs or start > runs[-1][2]):
            start -= 1  # title and short lead before the surge
        j = i
        while j < len(sums) and sums[j] > 0:
            j += 1
        runs.append((sum(weight[start:j]), start, j))
        i = j + 1
    least = share * max(runs)[0]
    return " ".join(x[0] for mass, start, j in runs if mass >= least for x in every[start:j])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Null or empty html, and pages without main text, give an empty text; null ids and
    urls stay null; repeated rows each give a row; an empty table gives an empty
    result. Narrow; other columns are not read.
    """
    def run(batches):
        for b in slices(batches, 2):
            text = [main_text(p) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()),
                                              pa.array(list(map(len, text)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
