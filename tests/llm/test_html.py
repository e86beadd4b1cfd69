"""The given pages against their own article elements, and written pages of other layouts."""

import html as characters
import re
import time

import pytest

from lexmill.llm.html import boilerplate, extract, main_text

ARTICLE = "<h1>Head &amp; line</h1><p>First para, with <i>so</i>me text. And more\n of it, so that it is long.<p>Second &eacute; para.<ul><li>One</li><li>Two</li></ul><blockquote>Quoted, here.</blockquote><p>Third para, which is longer, and says more. It ends.</p>"
TEXT = "Head & line First para, with some text. And more of it, so that it is long. Second é para. One Two Quoted, here. Third para, which is longer, and says more. It ends."
NOISE = "Words of others, that do not belong here. They go on, and on, and on."


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"<(?!/?b>)[^>]*>", "\0", body)).split("\0")
        want = " ".join(x for x in (" ".join(characters.unescape(b).split()) for b in blocks) if x)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


@pytest.mark.parametrize("page", [
    f"<body><header><p>{NOISE}</p></header><main>{ARTICLE}</main><aside>{NOISE}</aside><footer>{NOISE}</footer></body>",
    f"<body><div id='cookie-notice'><p>{NOISE}</div><div class='menu'><a href=x>Home</a></div><div class='layout has-sidebar'><div class=content>{ARTICLE}"
    f"<form><label>Mail, please.</label><input></form></div><div class=sidebar><p>{NOISE}</p></div></div></body>",
    f"<body><article>{ARTICLE}</article><section id=comments><p>{NOISE}</p><p>{NOISE}</p><p>{NOISE}</p><p>{NOISE}</p></section></body>",
    f"<body><div class='ad'>{NOISE}</div><div class='post'>{ARTICLE}<div class='share'>Share this, now.</div></div><div class='comment-list'>{NOISE * 9}</div>",
    f"<table><tr><td class=nav><a>One</a><td id=main>{ARTICLE}</table><script>if (a < b) document.write('<p>{NOISE}</p>')</script><style>p {{}}</style>",
    f"<body><!-- <p>{NOISE}</p> --><noscript>{NOISE}</noscript><article>{ARTICLE}<aside>{NOISE}</aside><!-- open",
])
def test_other_layouts(page):
    assert main_text(page) == TEXT


PARAGRAPHS = "".join(f"<p>Paragraph {i}, with some text, and a little more of it.</p>" for i in range(12))
BODY = " ".join(f"Paragraph {i}, with some text, and a little more of it." for i in range(12))


@pytest.mark.parametrize(("page", "text"), [
    (f"<div class=post><h1>Title</h1><p>lead</p><div class=entry>{PARAGRAPHS}</div><p>End note</p></div>", f"Title lead {BODY} End note"),
    (f"<body><div class=nav><a>One</a></div><div class=post><h2>Title</h2><ul>{PARAGRAPHS.replace('p>', 'li>')}</ul><p>End.</p></div><div class=footer>{NOISE}</div>",
     f"Title {BODY} End."),
    (f"<div class=post><p>Intro.</p><blockquote>{PARAGRAPHS}</blockquote></div>", f"Intro. {BODY}"),
    (f"<body><div class='post hentry comments-open'>{PARAGRAPHS}</div></body>", BODY),
    (f"<article><h1>Title</h1><div class='modal-body'>{PARAGRAPHS}</div></article>", f"Title {BODY}"),
    (f"<article><h1>Title</h1><div class='related-work'>{PARAGRAPHS}</div></article>", f"Title {BODY}"),
    (f"<article><h1>Title</h1><div id='search-basics'>{PARAGRAPHS}</div><div class='related'>{NOISE}</div></article>", f"Title {BODY}"),
    (f"<article><h1>Title</h1><div class='modal'>{PARAGRAPHS}</div></article>", f"Title {BODY}"),
    (f"<body><div id=top><h1>Site</h1></div><div class=post>{PARAGRAPHS}</div><p>Copyright, someone.</p></body>", BODY),
    (f"<body><div class=post>{PARAGRAPHS}</div><div id=comments>{PARAGRAPHS.replace('Paragraph', 'Opinion') * 3}</div></body>", BODY),
    (f"<body><article>{PARAGRAPHS}</article><div class='site-sidebar'>{PARAGRAPHS.replace('Paragraph', 'Other') * 3}</div></body>", BODY),
    (f"<body><div class=comments>{PARAGRAPHS}</div></body>", BODY),
])
def test_no_block_of_an_article_is_lost(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(("words", "kind"), [
    ("sidebar", "other"), ("side-bar", "other"), ("site_footer", "other"), ("share-buttons", "other"), ("cookie-notice", "other"), ("widget-2", "other"),
    ("comment-list", "comments"), ("post-comments", "comments"), ("comments-open", None), ("comments-closed hentry", None), ("modal-body", None), ("related-work", None),
    ("search-basics", None), ("no-sidebar-layout", None), ("address", None), ("advertise-with-care", None), ("content", None), ("--", None)])
def test_names_of_boilerplate(words, kind):
    assert boilerplate(words) == kind


def test_odd_markup_is_linear():
    for page, want in (("", ""), (None, ""), ("<", "<"), ("plain, text", "plain, text"), ("<p>a<p>b", "a b"), ("<p>a<b>b</b>c<br>d", "abc d"),
                       ("<b>" * 50_000 + "x", "x"), ("<a \"" * 20_000, ""), ("<!--" * 50_000, ""), ("<div>" * 30_000 + "deep, text.", "deep, text."),
                       ("</i>" * 50_000 + "y", "y"), ("<p title='x > y'>t</p>", "t"), ("a &#233; &lt;b&gt;", "a é <b>")):
        start = time.perf_counter()
        assert main_text(page) == want
        assert time.perf_counter() - start < 10


def test_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (1, "u", "<p>a</p>", "t"), (None, "u", "<p>a</p>", "t")], "page_id bigint, url string, html string, text string")
    assert sorted(map(tuple, extract(pages).collect()), key=repr) == sorted([(1, None, "", 0), (1, "u", "a", 1), (None, "u", "a", 1)], key=repr)
    assert extract(pages.limit(0)).count() == 0
