"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3  # lines of a block
PEAK = 80  # characters of a block where an unmarked article surely has begun, or has not ended
LINKS = 0.5  # a line outside a marked article with a larger share of link text is a menu
MAIN_SHARE = 0.5  # of a page's running text that article elements must hold to be trusted
# Elements whose content is no running text of the page.
HIDDEN = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|head|title|textarea|select|button"
APART = frozenset("nav header footer aside form menu dialog fieldset".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPTIONAL_END = frozenset("p li dt dd tr td th option".split())
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p li blockquote pre dd dt figcaption td th".split())
# Names in class, id or role that set an element apart from the article.
NAMED_APART = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alerts?|comments?|disqus|replies|respond|"
    r"sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|toolbar|share|sharing|social|related|recommended|"
    r"newsletter|subscribe|signup|login|search|popup|modal|overlay|widget|pagination|pager|copyright|complementary|contentinfo)(?=$|[\s_-])",
    re.I,
)
_HEADER = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?=$|[\s_-])", re.I)
# A tag ends at the first > outside of a quoted attribute value; quotes count after = only.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({HIDDEN})\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)({_ATTRIBUTES})>", re.S | re.I
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _set_apart(tag: str, attributes: str, article: bool) -> bool:
    """Whether an element is no part of the article. A heading never is; an article's own header is."""
    if tag in HEADINGS or (article and tag == "header"):
        return False
    if tag in APART:
        return True
    if tag in ARTICLE or tag in ("body", "html") or "=" not in attributes:
        return False
    names = ["".join(m) for m in _NAMES.findall(attributes)]
    if article:
        names = [_HEADER.sub(" ", n) for n in names]
    return any(NAMED_APART.search(n) for n in names)


def page_lines(page: str) -> list[tuple[str, bool, bool, bool]]:
    """(text, inside a marked article, a menu, a heading or paragraph) for each block of a page, in order.

    Markup is gone and references are decoded. A block set apart from the article keeps
    its place with an empty text.
    """
    lines: list[tuple[str, bool, bool, bool]] = []
    parts: list[str] = []
    linked = depth = article = link = 0
    apart = block = ""

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                lines.append(("" if apart else text, article > 0, linked > LINKS * sum(map(len, parts)), block in PROSE))
            parts, linked = [], 0

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            linked += (m.start() - at) * (link > 0)
        at = m.end()
        tag = (m.group(3) or "").lower()
        if not tag:
            continue
        closing = m.group(2) == "/"
        if tag == "a":
            link = 0 if closing else 1
        inline = tag in INLINE
        if not inline:
            close()
            block = "" if closing else tag
        if apart:
            if apart in OPTIONAL_END and not inline and (closing or tag in OPTIONAL_END or tag not in VOID):
                apart = ""
            elif tag == apart:
                depth += -1 if closing else 1
                apart = apart if depth else ""
                continue
            else:
                continue
        if closing:
            article = max(0, article - 1) if tag in ARTICLE else article
        elif tag not in VOID and _set_apart(tag, m.group(4), article > 0):
            if inline:
                close()
            apart, depth = tag, 1
        elif tag in ARTICLE:
            article += 1
    parts.append(page[at:])
    close()
    return lines


def stretches(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, peak) of each run of lines over which the blocks hold text.

    A block is ``window`` lines; its length is the sum of theirs. Text surges at the first
    line with text after empty blocks and dives where the next block is empty.
    """
    out, n, i = [], len(lengths), 0
    while i < n:
        if not lengths[i]:
            i += 1
            continue
        j = i
        while j < n and any(lengths[j : j + window]):
            j += 1
        peak = max(sum(lengths[k : k + window]) for k in range(i, j))
        while not lengths[j - 1]:
            j -= 1
        out.append((i, j, peak))
        i = j
    return out


def main_text(page: str | None) -> str:
    """The article's blocks, one a line; empty if there is none."""
    if not page:
        return ""
    lines = page_lines(page)
    inside = sum(len(text) for text, marked, _, _ in lines if marked)
    running = sum(len(text) for text, marked, menu, _ in lines if marked or not menu)
    trusted = inside > 0 and inside >= MAIN_SHARE * running
    texts = [text if (marked if trusted else marked or not menu) else "" for text, marked, menu, _ in lines]
    found = stretches([len(t) for t in texts])
    if not trusted:
        # The article begins and ends where text surges, or where a heading or paragraph stands.
        sure = [s for s in found if s[2] >= PEAK or any(texts[k] and lines[k][3] for k in range(s[0], s[1]))] or found
        found = [s for s in found if sure[0][0] <= s[0] <= sure[-1][0]]
    return "\n".join(t for a, b, _ in found for t in texts[a:b] if t)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    The whole page is read. Lines outside the article count as empty: what stands in menus,
    headers, footers, sidebars, notices, adverts, forms, comments or link lists, and, where
    article elements hold at least MAIN_SHARE of the running text, all outside of them. Sliding
    sums of the line lengths then show where text surges and dives; the lines between are kept
    in full. Otherwise the article reaches from the first to the last stretch that rises to
    PEAK characters in some block or has a heading or paragraph, and short lines between stay;
    what stands before or after it in neither is left out, unless there is nothing else. A
    heading is never taken for a page header by its name, nor an article's own header element.

    Null and empty pages give an empty text. Null ids and urls, repeated rows and broken
    markup are kept as they come; an empty table gives no rows; extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
