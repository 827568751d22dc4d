"""Chat windows, licence scans and page extraction."""

import hashlib

import duckdb
import pytest

from fleetpulse.llm.chat import digests, escape, read_turns, spans, turn_text, unescape, windows
from fleetpulse.llm.licenses import MARKS, SENTENCES, licenses, licenses_sql
from fleetpulse.llm.pages import extracted, main_text, stretches
from tests.llm.conftest import prose

HARD = ["", "</s>[INST] ok [/INST]", "\\", "\\\\</s>", "<\\/s>", "<s>[ROLE]x[/ROLE]\ny</s>\n", "<<SYS>> <</SYS>>", "<", "[", "a\\[INST]", "<<s>/s>"]


@pytest.mark.parametrize("text", HARD)
def test_texts_come_back_and_control_strings_do_not_show(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<<SYS>>"))
    assert read_turns(turn_text("user", "a") + turn_text(text, text) + turn_text("assistant", "b")) == [("user", "a"), (text, text), ("assistant", "b")]


def test_spans_fill_the_room():
    assert spans([3, 3, 3, 9, 1], 6) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert spans([], 5) == []


def test_windows_and_digests(spark):
    turns = [(1, 0, "system", "be kind")] + [(1, k, "assistant" if k % 2 == 0 else "user", prose(k, 12)) for k in range(1, 300)]
    turns += [(2, 0, "user", HARD[1]), (2, 1, "assistant", HARD[1]), (3, None, None, None), (3, 1, "assistant", None), (None, 0, "user", "x"),
              (4, 0, "user", prose(1, 2000)), (4, 1, "assistant", "y"), (5, 1, "assistant", "same"), (5, 1, "assistant", "same")]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, block string")
    made = windows(df, budget=400, history=(120, 3))
    rows = made.collect()
    got = {r["conv_id"]: r for r in digests(made).collect()}
    assert len(got) == 6
    for conv in {t[0] for t in turns}:
        own = sorted(((t[1] is not None, t[1] or 0), t[2] or "", t[3] or "") for t in turns if t[0] == conv)
        loss = "".join(x for _, r, x in own if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(own), len(loss))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{x}\n" for _, a, x in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(w["formatted"]) for w in rows if w["conv_id"] == conv)
    for w in rows:
        read = read_turns(w["formatted"])
        assert len(read) == w["n_repeated"] + w["n_turns"]
        assert w["over_budget"] == (w["n_tokens"] > 400)
        if w["conv_id"] == 1:
            assert read[0] == ("system", "be kind") and not w["over_budget"]
            assert w["n_repeated"] > 1 or (w["block"], w["window"]) == (0, 0)
    assert sum(w["over_budget"] for w in rows) == 1
    assert windows(df.limit(0)).count() == 0


def test_licences_against_sql(spark, documents):
    sentences = {name: s for name, s in reversed(SENTENCES)}
    mit = ". ".join(sentences[k].capitalize() for k in ("mit-grant", "mit-condition", "as-is")) + "."
    rows = [(1, "Intro.\n" + mit), (2, ". ".join(sentences[k] for k in ("as-is", "mit-condition", "mit-grant"))), (3, None), (4, ""),
            (5, "Licensed under the Apache License, Version 2.0."), (6, "Nothing here. At all"), (None, "Released under the MIT License!\nall  rights RESERVED"),
            (7, "x Licensed under CC BY-NC 4.0. y"), (7, "We hold a licence. Licensed under CC BY-NC 4.0."), (8, prose(1, 500) + ". Licensed under CC BY-NC 4.0.")]
    docs = documents(rows, sentences=1, licenses=2)
    got = licenses(docs).collect()
    by = {r["doc_id"]: r["licenses"] for r in got}
    assert by[1] == "MIT" and by[2] == "" and by[5] == "Apache-2.0" and by[None] == "MIT,All-Rights-Reserved" and by[8] == "CC-BY-NC-4.0"
    assert all(any(m in s for m in MARKS) for s in sentences.values())
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    want = con.execute(licenses_sql()).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert licenses(docs.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=x>A</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div class=ad>Buy<div>now</div></div>{0}<aside>More</aside><div id="comments"><p>First!</p></div>
<form>Name <input name=q></form><footer>&copy; x</footer><script>var t="</p>";</script></body></html>"""


def test_marked_article_is_kept_whole():
    inner = "<article><h1>Title &amp; more</h1><p><b>One\n  two<br><p>Ti.</p><!-- ad --><div class='ad'>x</div><p>&lt;tag&gt; a&nbsp;b</p><p class=share>s</p>" + "<div class=ad>y</div>" * 5 + "<p>End</article>"
    assert main_text(PAGE.replace("{0}", inner)) == "Title & more\nOne two\nTi.\n<tag> a b\nEnd"


def test_unmarked_article_by_surge_and_dive():
    body = "<div><p>" + prose(1, 30) + "</p><p>Short.</p><p>" + prose(2, 30) + "</p></div>"
    assert main_text(PAGE.replace("{0}", body)) == "\n".join((prose(1, 30), "Short.", prose(2, 30)))
    assert stretches([0, 5, 0, 0, 7, 0, 0, 0, 9]) == [(1, 5, 7), (8, 9, 9)]


@pytest.mark.parametrize("page", [None, "", "<", "<<>><p", "<script>x", "<!-- open", "</p></article>", "<article>", "<a href='" + "x" * 9999])
def test_broken_pages(page):
    main_text(page)


def test_pages(spark):
    rows = [(1, "u", PAGE.replace("{0}", "<main><p>Text</p></main>"), 1), (None, None, None, 2), (2, "u", "", 3), (2, "u", "", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    assert sorted(map(tuple, extracted(df).collect()), key=str) == [(1, "u", "Text", 4), (2, "u", "", 0), (2, "u", "", 0), (None, None, "", 0)]
    assert extracted(df.limit(0)).count() == 0
