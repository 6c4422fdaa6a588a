"""Main text of pages whose article is known."""

import pyarrow.parquet as pq
import pytest
from llm.support import rows

from loanscope.llm.html_extract import extract, main_text

LONG = "The mill was on the river and it was the last of its kind in the valley, as the people there used to say."
MORE = "It was built by a man who had come from the north with his family and who did not stay for long in the end."


def page(body, head=""):
    return f"<!DOCTYPE html><html lang='en'><head><title>The title of it</title>{head}</head><body>{body}</body></html>"


SIDE = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>About the mill and the river</a></li></ul></nav>",
    f"<header><h1>Site</h1><p>{MORE}</p></header>",
    f"<footer><p>{MORE}</p></footer>",
    f"<aside><p>{MORE}</p></aside>",
    f"<div class='sidebar'><p>{MORE}</p></div>",
    f"<div id='cookie-notice'><p>{MORE}</p></div>",
    f"<div class='ad'>{MORE}</div>",
    f"<form action='/x'><label>{MORE}</label><input name='q'><button>Send it</button></form>",
    f"<script>var x = '<p>{MORE}</p>';</script>",
    f"<style>p{{content:'{MORE}'}}</style>",
    f"<noscript><p>{MORE}</p></noscript>",
    f"<!-- <p>{MORE}</p> -->",
    f"<section class='comments'><article><p>{MORE}</p></article></section>",
    f"<div class='comment'><p>{MORE}</p></div>",
    f"<div role='complementary'><p>{MORE}</p></div>",
    f"<div style='display: none'><p>{MORE}</p></div>",
    f"<p><a href='/more'>{MORE}</a></p>",
    f"<p class='advert'>{MORE}</p>",
    f"<p hidden>{MORE}</p>",
    f"<article class='related'><p>{MORE}</p></article>",
]


@pytest.mark.parametrize("side", SIDE)
@pytest.mark.parametrize("article", ["<article>{}</article>", "<main>{}</main>", "<div class='story'>{}</div>"])
def test_only_the_article(side, article):
    body = article.format(f"<h1>Short title</h1><p>{LONG}</p><p>Yes.</p><p>{LONG}</p>")
    want = f"Short title\n{LONG}\nYes.\n{LONG}"
    assert extract(page(body + side)) == want
    # Inside the article and before it; the header of an article belongs to it.
    assert extract(page(side + body)) == want
    if not side.startswith("<header"):
        inside = article.format(f"<h1>Short title</h1><p>{LONG}</p><p>Yes.</p>{side}<p>{LONG}</p>")
        assert extract(page(inside)) == want


def test_text_is_decoded_and_blanks_are_joined():
    body = "<article><p>a &lt;b&gt; &amp; &eacute;&#33;\n  <b>bo</b>ld&nbsp;<br>next\t</p><p> </p><p>2 &lt 3 &am</p></article>"
    assert extract(page(body)) == "a <b> & é! bold next\n2 < 3 &am"


def test_formulas_and_fallbacks_are_text():
    formula = "<math display='block'><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='TeX'>x=2</annotation></semantics></math>"
    body = f"<article><p>So {formula} holds.</p><object data='a.pdf'><param name='p'><p>The text of it.</p></object>"
    body += "<map name='m'><p>Places: <area href='/a' alt='A'>north</p></map><svg><text>drawn</text></svg></article>"
    assert extract(page(body)) == "So x=2 holds.\nThe text of it.\nPlaces: north"


def test_missing_end_tags():
    assert extract("<article><p>One<p><b>Two<br><p>Three<footer>foot") == "One\nTwo\nThree"
    assert extract("<body><nav><ul><li><a href='x'>Home<li><a href='y'>Away</nav><article><h2>Hi<p>You") == "Hi\nYou"


def test_all_blocks_of_an_article_stay():
    blocks = ["Ha.", "By. Than.", "Zxcv " * 60, "x", "1 2 3", LONG]
    body = "".join(f"<p>{b}</p>" for b in blocks)
    assert extract(page(f"<article>{body}</article>")) == "\n".join(b.strip() for b in blocks)


def test_short_blocks_take_the_nearest_label():
    links = "<p><a href='/a'>One link here</a></p>" * 3
    body = f"<div>{links}<p>near the links</p>{links}<p>{LONG}</p><p>near the text</p><p>{LONG}</p></div>"
    assert extract(page(body)) == f"{LONG}\nnear the text\n{LONG}"


@pytest.mark.parametrize("around", ["<div>{}</div>", "<article><p>Card.</p></article><div>{}</div>"])
def test_blocks_with_few_stop_words_stay_without_a_mark(around):
    names = "Zxcv qwer tyui " * 8
    blocks = ["Head", LONG, names.strip(), "Yes.", names.strip(), names.strip(), "No."]
    body = "<h1>Head</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
    got = extract(page("<nav><a href='/'>Home</a></nav>" + around.format(body) + f"<footer>{MORE}</footer>"))
    assert got.removeprefix("Card.\n") == "\n".join(blocks)
    # Nor does a page need a clear block, or a long one without a mark.
    body = f"<h1>Head</h1><p>{names}</p><p>Yes.</p>"
    got = extract(page("<nav><a href='/'>Home</a></nav>" + around.format(body) + f"<footer>{MORE}</footer>"))
    assert got.removeprefix("Card.\n") == f"Head\n{names.strip()}\nYes."


def test_few_stop_words_with_links_are_not_text():
    tags = "Zxcv qwer tyui " * 4 + "<a href='/t'>zxcv qwer tyui zxcv qwer</a>"
    assert extract(page(f"<div><p>{LONG}</p><p>{MORE}</p><p>{tags}</p></div>")) == f"{LONG}\n{MORE}"


def test_given_pages_without_their_mark():
    given = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist()
    for html in given:
        assert extract(html.replace("<article>", "<div>").replace("</article>", "</div>")) == extract(html)


def test_marked_parts_of_a_line_are_left_out():
    body = f"<article><p>{LONG} <span class='share-links'>Share <b>this</b></span>{MORE}</p></article>"
    assert extract(page(body)) == f"{LONG} {MORE}"


def test_names_of_the_whole_page_say_nothing():
    body = f"<div class='story'><h2>Head</h2><p>{LONG}</p></div>"
    for mark in ("nav-open has-sidebar", "ads", "cookie-consent"):
        assert extract(f"<html class='{mark}'><body class='{mark}'>{body}</body></html>") == f"Head\n{LONG}"
        assert extract(page(f"<div class='{mark}'>{body}</div>")) == f"Head\n{LONG}"
        assert extract(page(f"<main class='{mark}'>{body}</main>")) == f"Head\n{LONG}"
    assert extract(page(f"<article class='post has-sidebar'>{body}</article>")) == f"Head\n{LONG}"


@pytest.mark.parametrize("mark", ["<article>{}</article>", "<main>{}</main>", "<div role='article'>{}</div>"])
def test_a_body_beside_a_marked_card_stays(mark):
    card, body = mark.format("<p>Read on.</p>"), f"<div><h1>Head</h1><p>{LONG}</p><p>Yes.</p><p>{MORE}</p></div>"
    assert extract(page(card + body)) == f"Read on.\nHead\n{LONG}\nYes.\n{MORE}"
    assert extract(page(body + card)) == f"Head\n{LONG}\nYes.\n{MORE}\nRead on."
    # A short line outside is not a body.
    assert extract(page("<div>All of it for you</div>" + mark.format(f"<p>{LONG}</p><p>{MORE}</p>"))) == f"{LONG}\n{MORE}"


OTHER = "Старая мельница стояла над рекой, и жители долины говорили, что второй такой нет во всём крае. "


@pytest.mark.parametrize(
    "notice", ["<div class='cookie-notice'><p>{}</p></div>", "<footer>{}</footer>", "<p><a href='/x'>{}</a></p>"]
)
def test_a_notice_says_nothing_about_a_page_in_another_language(notice):
    links = "<ul><li><a href='/a'>Домой</a></li><li><a href='/b'>Новости</a></li></ul>"
    blocks = ["Мельница", OTHER.strip(), (OTHER * 3).strip(), (OTHER * 2).strip(), "Да."]
    body = "<div><h1>Мельница</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:]) + "</div>"
    for html in (links + body + notice.format(MORE), notice.format(MORE) + body + links):
        assert extract(page(html)) == "\n".join(blocks)
    # A notice without a mark stays, but does not cost the body.
    assert extract(page(f"{links}{body}<div>{MORE}</div>")) == "\n".join([*blocks, MORE])


def test_marked_notices_stay_out_if_a_short_text_is_left():
    notice = f"<div class='cookie-notice'><p>{MORE}</p></div>"
    assert extract(page(f"<div><h1>Head</h1><p>One short line of it.</p></div>{notice}")) == "Head\nOne short line of it."
    body = f"<p>{LONG}</p><p>{MORE}</p>"
    assert extract(page(f"<p>Acme</p><div class='has-sidebar'>{body}</div>")) == f"Acme\n{LONG}\n{MORE}"


@pytest.mark.parametrize("around", ["<form action='/x'>{}</form>", "<form id='aspnetForm'>{}</form>", "<dialog open>{}</dialog>"])
@pytest.mark.parametrize("article", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_a_form_around_the_page(around, article):
    side = f"<nav><a href='/'>Home</a></nav><div class='sidebar'><p>{MORE}</p></div>"
    body = article.format(f"<h1>Head</h1><p>{LONG}</p><p>Yes.</p><p>{MORE}</p>")
    assert extract(page(around.format(side + body))) == f"Head\n{LONG}\nYes.\n{MORE}"
    assert extract(page(around.format(side + body) + f"<footer>{LONG}</footer>")) == f"Head\n{LONG}\nYes.\n{MORE}"
    # What is in a form beside the text, or has only labels, is no text.
    assert extract(page(f"<div><p>{LONG}</p></div>" + around.format(f"<label>{MORE}</label><p>{MORE}</p>"))) == LONG
    assert extract(page(around.format("<legend>Sign in</legend><label>Name of it</label><input name='q'>"))) == ""


def test_a_header_inside_an_article_belongs_to_it():
    body = f"<div class='layout has-sidebar'><article><header><h1>Head</h1></header><p>{LONG}</p></article></div>"
    assert extract(page(body)) == f"Head\n{LONG}"


@pytest.mark.parametrize("odd", [None, "", " ", "<", "<<<>>>", "<p", "</p>", "<!--", "<script>", "a<b", "&", '<p title="x>y'])
def test_odd_pages(odd):
    assert isinstance(extract(odd), str)


def test_plain_text_is_text():
    assert extract("just words") == "just words"
    assert extract("3 < 4 and 5 > 2") == "3 < 4 and 5 > 2"


def test_a_very_long_page_is_read_whole():
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(20_000))
    text = extract(page(f"<article>{body}</article>"))
    assert text.count("\n") == 19_999 and text.endswith(" 19999")


@pytest.mark.parametrize(
    "unit", ["<a ", "<a '", "<div>", "</div>", "<div></span>", "<a href='", "<p>x", "<", "&", "<!--", "<b><i>", "x>"]
)
def test_work_grows_with_the_page_only(unit):
    """Pages of one odd thing over and over; a quadratic step would take minutes."""
    for n in (1, 2, 200_000):
        extract(unit * n)


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    data = [(1, None, None, 5, "z"), (1, None, None, 5, "z"), (None, "u", "<p>x", None, None)]
    assert rows(main_text(spark.createDataFrame(data, schema))) == rows(
        spark.createDataFrame([(1, None, "", 0), (1, None, "", 0), (None, "u", "x", 1)], "a long, b string, c string, d long")
    )
    assert main_text(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize(
    "part",
    ["<p class='share-price'>{}</p>", "<section id='social-impact'><p>{}</p></section>", "<div class='widget-text'>{}</div>",
     "<div class='menu-of-the-day'>{}</div>", "<p class='skip-level ad-hoc'>{}</p>", "<div id='bannerImageStory'><p>{}</p></div>"],
)
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div class='post'>{}</div>"])
def test_a_single_word_of_a_name_marks_nothing(part, around):
    for text in (MORE, "Up by 3 to 14."):
        assert extract(page(around.format(f"<p>{LONG}</p>{part.format(text)}<p>{LONG}</p>"))) == f"{LONG}\n{text}\n{LONG}"


@pytest.mark.parametrize("around", ["<div class='content has-sidebar'>{}</div>", "<div class='menu-open'>{}</div>", "<div class='sidebar'>{}</div>", "<div id='page-widget'>{}</div>"])
def test_a_name_around_the_page_leaves_other_names_believed(around):
    side = f"<div class='ad'>{MORE}</div>"
    body = f"<div><h1>Head</h1><p>{LONG}</p>{side}<p>{LONG}</p></div>"
    assert extract(page(around.format(side + body) + f"<div class='footer'>{MORE}</div>")) == f"Head\n{LONG}\n{LONG}"
    assert extract(page("<p>Acme</p>" + around.format(body))) == f"Acme\nHead\n{LONG}\n{LONG}"


@pytest.mark.parametrize("times", [1, 2, 6])
def test_length_alone_is_not_clear_outside_an_article_in_another_language(times):
    article = f"<article><h1>Мельница</h1><p>{(OTHER * 9).strip()}</p></article>"
    notice = f"<div><p>{(OTHER * times).strip()}</p></div>"
    for html in (article + notice, notice + article):
        assert extract(page(html)) == f"Мельница\n{(OTHER * 9).strip()}"


def plain(html):
    """The paragraphs and headings of the only article, by a parser of its own, without what stands in it but is none."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open, self.lines = [], []

        def handle_starttag(self, tag, attributes):
            if tag in ("p", "h1", "h2", "h3", "li"):
                self.lines.append("")
            if tag not in ("br", "img", "meta", "link", "input", "hr"):
                self.open.append(tag if dict(attributes).get("class") != "ad" else "aside")

        def handle_endtag(self, tag):
            while self.open and self.open.pop() not in (tag, "aside"):
                pass

        def handle_data(self, data):
            if "article" in self.open and not {"nav", "footer", "aside", "form", "script", "style", "section"} & set(self.open) and self.lines:
                self.lines[-1] += data

    reader = Article()
    reader.feed(html)
    return "\n".join(t for line in reader.lines if (t := " ".join(line.split())))


def test_given_pages_by_a_plain_parser():
    given = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist()
    for html in given:
        assert extract(html) == plain(html)
