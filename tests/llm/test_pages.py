"""Main text: pages that tempt the extractor, and every page of the test data read another way."""

from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from fleetpulse.llm.pages import INLINE, main_text

LONG = "A long paragraph of the article that goes on for well over eighty characters, as articles do."


@pytest.mark.parametrize(
    "page, want",
    [
        # a teaser in an article element does not hold the page's text
        (f"<body><div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div><article>Teaser</article></body>", f"Title\n{LONG}\n{LONG}\nTeaser"),
        # a heading and a closing paragraph parted from the body by link lists
        (
            f"<div><h2>Head</h2><ul><li><a href=a>one</a></li><li><a href=b>two</a></li><li><a href=c>three</a></li></ul><div>{LONG}</div>"
            "<ul><li><a href=a>one</a></li><li><a href=b>two</a></li><li><a href=c>three</a></li></ul><p>The end.</p></div>",
            f"Head\n{LONG}\nThe end.",
        ),
        # a tag ends outside of quotes
        (f'<p>{LONG} <a title="a > b" href=x>link</a> rest</p>', f"{LONG} link rest"),
        (f"<p it's>{LONG} it's</p>", f"{LONG} it's"),
        (f'<script data-x="a > b">var x = "<p>no</p>";</script><p>{LONG}</p>', LONG),
        # an article's own header and a heading called header
        (f'<header>Site</header><article><header><h1>Title</h1></header><h2 class="header">Part</h2><p>{LONG}</p></article>', f"Title\nPart\n{LONG}"),
        # short lines between, and bare short lines outside
        (f"<div>Site name</div><div>{LONG}</div><div>Short.</div><div>{LONG}</div>", f"Site name\n{LONG}\nShort.\n{LONG}"),
        (f"<div>Site name</div><nav>a</nav><nav>b</nav><nav>c</nav><aside>x</aside><aside>y</aside><aside>z</aside><div>{LONG}</div>", LONG),
        ("<p>only</p>", "only"),
        ("<div>only</div>", "only"),
        ("", ""),
        (None, ""),
        ("<nav><a href=x>menu</a></nav>", ""),
        ("&lt;b&gt; &amp;amp; " + LONG, "<b> &amp; " + LONG),
        ("<p>" + "word " * 200_000 + "</p>", ("word " * 200_000).strip()),
    ],
)
def test_pages_that_tempt(page, want):
    assert main_text(page) == want


class Reader(HTMLParser):
    """Article text of the generated pages by the standard parser's events."""

    GONE = {"script", "style", "nav", "aside", "form", "footer", "header"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skip, self.blocks, self.now = 0, [], [], []

    def cut(self):
        text = " ".join("".join(self.now).split())
        if text:
            self.blocks.append(text)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.cut()
        names = (dict(attrs).get("class") or "") + " " + (dict(attrs).get("id") or "")
        if tag == "article":
            self.inside += 1
        elif self.skip:
            self.skip += [tag] if tag == self.skip[0] else []
        elif tag in self.GONE or set(names.split()) & {"ad", "ads", "notice", "cookie", "comments", "comment", "sidebar", "promo", "related", "share", "banner"}:
            self.skip = [tag]

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.cut()
        if tag == "article":
            self.inside -= 1
        elif self.skip and tag == self.skip[0]:
            self.skip.pop()

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.now.append(data)


def test_every_page_against_the_standard_parser():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    for page in pages:
        reader = Reader()
        reader.feed(page or "")
        reader.close()
        reader.cut()
        assert main_text(page) == "\n".join(reader.blocks)
