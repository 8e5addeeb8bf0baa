from __future__ import annotations

import pytest

from vayumark.llm import html_text as op

GOOD = "The cat sat on the mat and it was a good day for all of the cats that were in the house."
MORE = "When the dog came to the door with a bone, the cat was not in the mood to share the mat with it."
PAGE = f"""<!doctype html><html><head><title>no</title><style>p {{}}</style><script>if (a < b) "</p>";</script></head>
<body class="sidebar-left"><header><a href="/">Home</a> The site of the cat and of the dog and of all the others in it.</header>
<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav><div class="cookie-notice">{GOOD} notice</div>
<article class="post"><header><h1>A &amp; B</h1></header><p>{GOOD}</p><!-- {GOOD} --><p>Short   one.<br>two</p>
<ul><li>item <a href=x>one</a> of the list<li>item two</ul><p>{MORE}<div class="AdBox advert">{GOOD} ad</div>
<p>&lt;b&gt; &#233;&nbsp;&copy;<p><a href=1>All of it</a> <a href=2>is links</a></p></article>
<aside><p>{GOOD} aside</p></aside><section id="comments"><p>{GOOD} comment</p></section>
<form><p>{GOOD} form</p><input name=q></form><footer><p>{GOOD} footer</p></footer></body></html>"""


def test_article_without_the_rest():
    assert op.main_text(PAGE).split("\n") == [
        "A & B", GOOD, "Short one. two", "item one of the list", "item two", MORE, "<b> é ©",
    ]


def test_two_passes_without_an_article():
    short = "Just a line"
    links = "".join(f"<a href={n}>Some page of the site number {n}</a> " for n in range(9))
    page = f"<div><p>{short} one</p><p>{GOOD}</p><p>{short} two</p><p>{MORE}</p></div><div>{links}</div><p>{short} three</p>"
    assert op.main_text(page).split("\n") == [f"{short} one", GOOD, f"{short} two", MORE]


def test_other_layouts():
    text = f"<p>{GOOD}</p><p>Tail.</p>"
    rest = f"<div class=share>Share this</div><div class='related-posts'><p>{MORE}</p></div>"
    want = f"{GOOD}\nTail."
    assert op.main_text(f"<main><article>{text}</article><p>More to read</p>{rest}</main>") == want
    assert op.main_text(f"<div id=header><p>{MORE}</p></div><div class='page content'>{text}</div><div id=footer>{MORE}</div>") == want
    assert op.main_text(f"<article>{text}<ol class=commentlist><li>{MORE}</ol></article><article class='comment'>{MORE}</article>") == want
    assert op.main_text(f"<article><div class='entry-header'><h1 id=comments>On comments</h1></div>{text}</article>") == f"On comments\n{want}"
    assert op.main_text(f"<body class='has-sidebar'><div class=cookieBar>{MORE}</div><main>{text}{rest}</main></body>") == want


def test_small_article_does_not_hide_the_text():
    prose = "".join(f"<div><p>{GOOD} {n}</p></div>" for n in range(90))
    for card in ("article", "main"):
        got = op.main_text(f"<div>{prose}</div><{card}><p>{MORE[:60]}</p></{card}>").split("\n")
        assert got[:90] == [f"{GOOD} {n}" for n in range(90)]


def test_article_in_an_unknown_language():
    strange = " ".join(f"kissa{n} istui matolla koko päivän" for n in range(12))
    short = "Kissa istui matolla."
    for inside in (f"<p>{strange}</p><p>{strange}</p>", f"<p>{short}</p>" * 20):
        page = f"<div>{GOOD}</div><article>{inside}</article><div>{' '.join(f'ilmoitus{n}' for n in range(13))}</div>"
        assert set(op.main_text(page).split("\n")) == ({strange} if strange in inside else {short})


def test_two_passes_inside_an_article():
    promo = "Fresh offers weekly: discounts, coupons, bargains, gadgets, phones, laptops, cameras, shoes, watches, tickets, hotels"
    text = f"<h1>Title</h1><p>By me</p><p>{GOOD}</p><p>One line</p><p>{MORE}</p>"
    page = f"<article>{text}<p>{promo}</p><p>Buy now</p><p>{promo}</p></article>"
    assert op.main_text(page).split("\n") == ["Title", "By me", GOOD, "One line", MORE]


@pytest.mark.parametrize("page", ["", "   ", "<", "<a", "<p class='x", "<!-- open", "<script>open", "a < b & c &amp d", "</p></div>", "<p>" * 3000])
def test_broken_markup_ends(page):
    assert "\n" not in op.main_text(page)


def test_plain_text_stays():
    assert op.main_text("just text") == "just text"
    assert op.main_text("<p>" + "x " * 50_000 + "</p>") == ("x " * 50_000).strip()


def test_rows(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, "t"), (None, "v", "", None), (3, "w", "<p>hello", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = op.extract(pages, "page_id", "url").collect()
    assert [(r.page_id, r.url, r.text) for r in got] == [(i, u, op.main_text(h or "")) for i, u, h, _ in rows]
    assert op.extract(pages.limit(0), "page_id").count() == 0
