import html
import re

import pytest

from obsmatch.llm.op06_html import extract, main_text

ARTICLE = "<h1>A &amp; B</h1><p>First, long enough, with commas, to be scored as text.\n  <b>Bold</b><br>line<p>Short.<p>Third paragraph, again long, with a <a href=x>link</a> inside."
TEXT = "A & B\n\nFirst, long enough, with commas, to be scored as text. Bold line\n\nShort.\n\nThird paragraph, again long, with a link inside."
NOISE = (
    "<!-- <p>no --><header><h1>Site</h1></header><nav><ul><li><a href=/a>A menu, with, many, commas, in, it, really</a></ul></nav>"
    "<div class='cookie-notice'>We use cookies, yes, many of them, and you accept them all.</div><script>var a='</p><p>bad, bad, bad, bad, bad';</script>"
    "<style>p{}</style><div id=\"sidebar\"><p>Other things, to read, today, and tomorrow, at length.</p></div>"
)
AFTER = (
    "<div class='comments'><article class='comment'><p>I am a reader, and I comment, at length, on all of this, twice, as long as the text itself. "
    + "More, and more, of it. " * 30
    + "</p></article></div><form><p>Subscribe, now, please, to this long letter.</p><input value='a>b'></form><footer>&copy; us, and them, for all time, ok</footer>"
)


@pytest.mark.parametrize("box", ["article", "main", "div", "section", "td"])
def test_article_between_furniture(box):
    body = f"<{box}>{ARTICLE}</{box}>"
    if box == "td":
        body = f"<table><tr>{body}</tr></table>"
    assert main_text(f"<!DOCTYPE html><html><head><title>T, t, t</title></head><body>{NOISE}{body}{AFTER}</body></html>") == TEXT
    assert main_text(f"{NOISE}{body}{AFTER}") == TEXT


def test_furniture_inside_the_article():
    inner = ARTICLE.replace("<p>Short.", "</p><div class=ad>Buy, now, this, very, cheap, thing.</div><aside>Aside, from, that</aside><p>Short.")
    assert main_text(f"<article>{inner}</article>") == TEXT
    links = "<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>"
    assert main_text(f"<article>{ARTICLE}{links}</article>") == TEXT


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p") == main_text("<!-- open") == main_text("<script>x") == ""
    assert main_text("no markup, at all &lt;") == "no markup, at all <"
    assert main_text("<article><p>cut off, in the mid") == "cut off, in the mid"
    assert main_text("<div>" * 20_000 + "deep, down, here, is a text") == "deep, down, here, is a text"
    assert main_text("<p title='open>text, that, is, here, now</p>")  is not None
    long = "word, " * 50_000
    assert main_text(f"<article><p>{long}</article>") == long.strip()
    assert main_text("<article><p>a  b&nbsp;c</article>") == "a b c"


def test_table(llm):
    pages = llm.createDataFrame([(1, "u", ARTICLE, 1), (None, None, None, 1), (1, "u", ARTICLE, 1)], "page_id bigint, url string, html string, text int")
    got = sorted(extract(pages).collect(), key=lambda r: -r["n_chars"])
    assert [tuple(r) for r in got] == [(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0)]
    assert extract(pages.limit(0)).collect() == []


LONG = " ".join(f"Sentence {k} of the text, with a comma, is long enough." for k in range(12))


@pytest.mark.parametrize("name", ["site has-sidebar", "layout-sidebar", "widget", "page banner-top"])
def test_a_furniture_word_on_the_wrapper_of_the_text_does_not_lose_it(name):
    side = "<div class=sidebar><p>Other things, to read, today, and more.</p></div>"
    page = f"<div class='{name}'><div class='content'><p>{LONG}</p><p>{LONG}</p></div>{side}</div><p>Copyright</p>"
    assert LONG + "\n\n" + LONG in main_text(page) and "Other things" not in main_text(page)
    assert main_text(f"<div class='{name}'><p>{LONG}</p></div><div class='{name}'><p>{LONG} Two.</p></div><p>Copyright</p>").startswith(f"{LONG}\n\n{LONG} Two.")
    # Readers' comments that are longer than the text stay out.
    assert main_text(f"<div><p>{LONG}</p></div><ol id=comments><li>{LONG} {LONG} {LONG}</li></ol>") == LONG


@pytest.mark.parametrize("wrap", ["{}", "<div><div>{}</div></div>"])
def test_all_articles_beside_each_other_are_kept(wrap):
    one, two = f"<article><h2>One</h2><p>{LONG}</p><p>{LONG}</p></article>", "<article><p>Part two is short, but it is text.</p></article>"
    for box in ("main", "body", "div"):
        for order in ((one, two), (two, one)):
            got = main_text(f"<{box}>" + "".join(map(wrap.format, order)) + f"</{box}>{AFTER}")
            assert got.count(LONG) == 2 and "One" in got and "Part two is short, but it is text." in got and "reader" not in got


def test_lists_with_links_inside_the_article_are_text():
    items = ["First work, by a writer, on things", "Second work, by others, on more things", "Third work, of an unknown hand"]
    linked = "".join(f"<li><a href=/{k}>{x}</a></li>" for k, x in enumerate(items))
    short = "".join(f"<tr><td><a href=/{k}>Town number {k}</a></td><td>{k}00 people</td></tr>" for k in range(4))
    for box in ("article", "div"):
        got = main_text(f"<{box}><p>{LONG}</p><p>{LONG}</p><ul>{linked}</ul><table>{short}</table></{box}>")
        assert all(x in got for x in items) and "Town number 3" in got and "300 people" in got


@pytest.mark.parametrize("icon", ["<svg class='i'/>", "<svg class='i'><path d='M 1'/><text>icon</text></svg>", "<svg class=i>", "<object data='x.swf'/>", "<canvas/>", "<video src=a/>"])
def test_media_tags_do_not_swallow_the_page(icon):
    assert main_text(f"<body>{icon}<article><p>{LONG}</p>{icon}<p>{LONG}</p></article></body>") == f"{LONG}\n\n{LONG}"


def test_a_form_around_the_page_keeps_it():
    for inner in (f"<article><p>{LONG}</p></article>", f"<div id=content><p>{LONG}</p><p>{LONG}</p></div>"):
        got = main_text(f"<body><form action=x><input type=hidden>{inner}<footer>&copy; us</footer></form></body>")
        assert got.startswith(LONG) and "us" not in got.split()
    assert main_text(f"<div><p>{LONG}</p></div><form><fieldset><label>Your name, please</label><input><p>{LONG[:90]}</p></fieldset></form>") == LONG


@pytest.mark.parametrize("box", ["div", "article"])
def test_readers_never_win_by_volume(box):
    talk = "".join(f"<li><p>{LONG} {LONG}</p></li>" for _ in range(30))
    assert main_text(f"<{box}><h1>Head</h1><p>{LONG}</p></{box}><div class='comments-area'><ol>{talk}</ol></div>") == f"Head\n\n{LONG}"
    assert main_text(f"<{box}><p>{LONG}</p><section id=comments>{talk}</section></{box}>") == LONG
    assert main_text(f"<div class=discussion><p>{LONG}</p></div><p>A forum.</p>").startswith(LONG)  # there is nothing else


def test_formulas_labels_and_alerts():
    page = f"<article><p>{LONG} <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation>tex</annotation></math> and <label>a word</label>.</p><div class='alert alert-info'>Mind, this, notice, please, all.</div></article>"
    assert main_text(page) == f"{LONG} a+b and a word."


def direct(page):
    """The article's paragraphs and heading as the given pages write them, without any tree."""
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    blocks = re.split("</?(?:p|h1)>", inner)
    return "\n\n".join(t for t in (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks) if t)


def test_all_given_pages_equal_a_direct_reading(llm):
    pages = llm.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wanted = {r["page_id"]: direct(r["html"]) for r in pages.collect()}
    assert {r["page_id"]: r["text"] for r in extract(pages).collect()} == wanted and len(wanted) > 200
