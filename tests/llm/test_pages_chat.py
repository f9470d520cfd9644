"""Page text on hand-made pages; chat windows read back from their own output."""

from __future__ import annotations

import hashlib
import html
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from martloom.llm.chat import parsed, read_back, unescaped, windows
from martloom.llm.page_text import extracted, main_text

LONG = "many words in a row make a line long enough to rise above the threshold"
PAGES = [
    (None, ""),
    ("", ""),
    ("<p>a</p>", "a"),
    (
        "<html><body><div class='menu'><a href=x>Home</a></div><div id='content'><h1>T</h1><p>Hello <b>wor</b>ld &amp; &eacute;&nbsp; x</p>"
        "<div class=ad>Buy</div><p>Two</p></div><div id=comments><p>Nice</p></div></body></html>",
        "T\nHello world & é x\nTwo",
    ),
    (
        "<body><header><h1>Site</h1></header><nav>m</nav><main><article><header><h1>Title</h1><span>by me</span></header><p>One<p>Two"
        "<form><input>go</form><aside>s</aside><p>Three</article><section class=comments><article class=comment><p>c</p></article></section>"
        "</main><footer>f",
        "Title\nOne\nTwo\nThree",
    ),
    (
        "<body><div class='cookie-notice'>We use cookies</div><article><p>x < y and <i>z</i></p><script>var a='</p>';</script>"
        "<style>p{}</style><!-- <p>no</p> --><p>end</p></article>",
        "x < y and z\nend",
    ),
    ("<body class='has-sidebar'><div class='wrapper sidebar-right'><article><p>A</p></article><div class='sidebar'>S</div></div>", "A"),
    ("<nav>menu<article><p>A</p></article>", "A"),
    (f"<div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul><div><p>{LONG}</p><p>short</p><p>{LONG}</p></div><div>foot</div></div>", f"{LONG}\nshort\n{LONG}"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("closing,stays", [("c" * 31, True), ("c" * 30, False)])
def test_surge_and_dive_decide_on_unmarked_pages(closing, stays):
    parts = f"<div>Short line before</div><div></div><div><p>{LONG}</p><p>in it</p></div><div><p>{closing}</p></div>"
    assert main_text(f"<div>{parts}</div>") == "\n".join([LONG, "in it", *([closing] if stays else [])])
    # marked as an article, element rules decide and every line stays
    assert main_text(f"<article>{parts}</article>") == "\n".join(["Short line before", LONG, "in it", closing])


TEASER, LEAD = "a teaser of a few words", "words of the lead"
GAPS = "<div></div><div></div>"


@pytest.mark.parametrize(
    "page,text",
    [
        # surges outside the marks are main text, in page order
        (f"<article><p>{TEASER}</p></article><div><p>{LONG}</p><p>in it</p></div><div>foot</div>", f"{TEASER}\n{LONG}\nin it"),
        (f"<div><p>{LONG}</p></div><main><p>A</p></main>", f"{LONG}\nA"),
        (f"<div class=post-date>3 May</div><div class=text><p>{LONG}</p></div>", f"3 May\n{LONG}"),
        # links and less than half of the article's densest block are none
        (f"<article><p>{TEASER}</p></article><div><a href=x>{LONG}</a></div>", TEASER),
        (f"<article><p>{LONG} {LONG} {LEAD}</p></article><div><p>{LONG}</p></div>", f"{LONG} {LONG} {LEAD}"),
        (f"<article><p>{LONG} {LEAD}</p></article><div><p>{LONG}</p></div>", f"{LONG} {LEAD}\n{LONG}"),
        # text beside the article's first and last lines doesn't surge with them
        (f"<table><tr><td>before</td><td class=content>{LONG}</td><td>after</td></tr></table>", LONG),
        (f"<p>before</p><article><p>{LONG}</p></article><p>after</p>", LONG),
        # inside the marks a dive ends the text and crumbs don't start it again
        (f"<article><p>{LONG}</p>{GAPS}<p>7</p>{GAPS}<p>*</p><p>x</p>{GAPS}<p>Yes</p>{GAPS}<p>{LONG}</p></article>", f"{LONG}\nYes\n{LONG}"),
        (f"<article><p>7</p>{GAPS}<p>{LONG}</p><p>7</p><p><a href=x>y</a></p></article>", f"{LONG}\n7\ny"),
        # a short article stays whole
        (f"<article><p>7</p>{GAPS}<p>few words</p>{GAPS}<p>8</p></article>", "7\nfew words\n8"),
    ],
)
def test_surge_and_dive_decide_on_marked_pages(page, text):
    assert main_text(page) == text


@given(st.text(alphabet="<>/!-\"'= abpdivscript&;#\n", max_size=200))
def test_any_markup_is_read_without_error(page):
    assert isinstance(main_text(page), str)


def test_articles_of_the_test_pages(spark, data_dir):
    pages = spark.read.parquet(f"{data_dir}/pages.parquet")
    for r in extracted(pages.withColumnRenamed("url", "text"), "html", "body").collect():
        source = next(p.html for p in pages.filter(f"page_id = {r.page_id}").collect()) if r.page_id < 5 else None
        if source:
            article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
            blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article)]
            assert r.body == "\n".join(b for b in blocks if b)


def test_empty_page_table(spark):
    assert extracted(spark.createDataFrame([], "page_id long, html string"), "html").columns == ["page_id", "text"]


ROWS = (
    [(1, 0, "system", "be <|brief|>"), (1, 1, "user", "a " * 300), (1, 2, "assistant", "b " * 40), (1, 3, "user", None), (1, 4, "assistant", "<|end|>\n\\p")]
    + [(2, t, "assistant" if t % 2 else "user", f"turn {t} " * 10) for t in range(60)]
    + [(3, 0, "system", "alone")]
    + [(4, 0, None, "x"), (4, 0, None, "x"), (None, 0, "user", "q"), (None, 1, "assistant", "|r|")]
    + [(5, None, "assi|stant", "odd role"), (5, 1, "assistant", "")]
    + [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
)


def formatted(spark, budget=128, history_turns=2, history_budget=32):
    turns = spark.createDataFrame([(*r, "extra", 0) for r in ROWS], "conv_id long, turn long, role string, text string, window string, rn int")
    return windows(turns, budget, history_turns, history_budget)


def test_conversations_come_back(spark):
    got = {r.conv_id: r for r in read_back(formatted(spark)).collect()}
    expected = {}
    for conv, turn, role, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        expected.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(expected)
    for conv, turns in expected.items():
        everything = "".join(f"{r}\n{t}\n" for r, t in turns).encode()
        target = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(everything).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())


def test_windows_keep_budget_system_and_history(spark):
    rows = formatted(spark).collect()
    for r in rows:
        turns = parsed(r.formatted)
        new = [t for t in turns[r.repeated :] if t[0] != "system"]
        assert r.tokens <= 128 or len(new) == 1
        if r.conv_id == 1:
            assert turns[0] == ("system", "be <|brief|>")
        for span in r.loss:
            assert unescaped(r.formatted[span.start : span.end]) in [t for _, t in turns[r.repeated :]]
    assert any(r.conv_id == 2 and r.repeated for r in rows)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(windows(empty)).count() == 0
