"""Main texts of pages of many shapes, by hand; and pages that a scan with backtracking would not end on."""

import time

import pytest

from tidewatch.llm import html_text

LEAD = "The harbour board met on Tuesday, and after a long debate, it agreed to the new berth."
MORE = "Two members voted against it, three were away, and the chair, as ever, did not vote at all."
LAST = "Work is to begin in spring, once the tide tables, the tenders, and the weather allow for it."
BODY = f"<p>{LEAD}</p><p>{MORE}</p><p>{LAST}</p>"
TEXT = f"{LEAD}\n\n{MORE}\n\n{LAST}"
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'
FOOT = "<footer><p>Copyright, the Harbour Post, all rights reserved, since 1871</p></footer>"

SHAPES = {
    "article": (f"<body>{NAV}<article><h1>Berth</h1>{BODY}</article>{FOOT}</body>", f"Berth\n\n{TEXT}"),
    "main": (f"<body>{NAV}<main><h1>Berth</h1>{BODY}</main>{FOOT}</body>", f"Berth\n\n{TEXT}"),
    "plain div": (f"<body>{NAV}<div><h1>Berth</h1>{BODY}</div>{FOOT}</body>", f"Berth\n\n{TEXT}"),
    "header in article": (f"<article><header><h1>Berth</h1></header>{BODY}</article>", f"Berth\n\n{TEXT}"),
    "header of page": (f"<header><h2>The Harbour Post</h2></header><article>{BODY}</article>", TEXT),
    "aside": (f"<article>{BODY}<aside><p>See also, our guide, to the port</p></aside></article>", TEXT),
    "sidebar": (f'<div class="content">{BODY}</div><div class="sidebar"><p>Tides, moons, and more</p></div>', TEXT),
    "advert": (f'<article><p>{LEAD}</p><div class="ad">Buy, buy, buy</div><p>{MORE}</p><p>{LAST}</p></article>', TEXT),
    "cookie notice": (f'<div id="cookie-notice"><p>We use cookies, and so on, and on</p></div><article>{BODY}</article>', TEXT),
    "comments": (f'<article>{BODY}<section id="comments"><p>First, as ever, and proud of it</p></section></article>', TEXT),
    "more comments than article": (f'<article>{BODY}</article><div class="comments">{BODY * 9}</div>', TEXT),
    "form": (f'<article>{BODY}<form><p>Your mail, please, and thanks</p><input name="x"></form></article>', TEXT),
    "script and style": (f'<article><style>p{{x:"<p>y</p>"}}</style>{BODY}<script>var t="</p><p>no, no, no</p>";</script></article>', TEXT),
    "noscript and template": (f"<article>{BODY}<noscript><p>Turn it on, please</p></noscript><template><p>x, y, z</p></template></article>", TEXT),
    "references": ("<article><p>A &amp; B &lt;c&gt;, &eacute;t&#233; &#x41;, and &nbsp; so on, as it was said before</p></article>", "A & B <c>, été A, and so on, as it was said before"),
    "white space": ("<article><p>  one,\n\ttwo   three, four and five, which is all that there is  </p></article>", "one, two three, four and five, which is all that there is"),
    "unclosed paragraphs": (f"<article><p>{LEAD}<p>{MORE}<p>{LAST}</article>", TEXT),
    "list": (f"<article><p>{LEAD}</p><ul><li>cod<li>ling</ul><p>{MORE}</p></article>", f"{LEAD}\n\ncod\n\nling\n\n{MORE}"),
    "line breaks": ("<article><p>one,<br>two, three<br/>four, five, six, seven, eight</p></article>", "one, two, three four, five, six, seven, eight"),
    "comments in markup": (f"<article><!-- <p>hidden, text, here</p> -->{BODY}</article>", TEXT),
    "hidden": (f'<article>{BODY}<div style="display: none"><p>not, to be, seen</p></div><p hidden>nor, this, one</p></article>', TEXT),
    "upper case tags": (f"<ARTICLE><P>{LEAD}</P><P CLASS='x'>{MORE}</P><SCRIPT>1</SCRIPT><P>{LAST}</P></ARTICLE>", TEXT),
    "quoted brackets": (f'<article><p title="a > b">{LEAD}</p><p>{MORE}</p><p>{LAST}</p></article>', TEXT),
    "page in a form": (f'<body><form id="aspnetForm" action="x">{NAV}<div><h1>Berth</h1>{BODY}</div><input name="x">{FOOT}</form></body>', f"Berth\n\n{TEXT}"),
    "page in an aside": (f"<body><aside>{BODY}</aside></body>", TEXT),
    "more stories": (f'<article>{BODY}<div class="more-stories"><h3>More stories</h3><ul><li><a href="1">One fish, two fish</a></li><li><a href="2">Red fish, blue fish</a></li></ul></div></article>', TEXT),
    "links in a list of the text": (f'<article><p>{LEAD}</p><ul><li>cod, by <a href="1">boat</a>, at dawn</li><li>ling, by <a href="2">net</a>, at dusk</li></ul><p>{MORE}</p></article>', f"{LEAD}\n\ncod, by boat, at dawn\n\nling, by net, at dusk\n\n{MORE}"),
    "opinions": (f'<article>{BODY}<div id="reader-opinions"><p>I, for one, disagree, strongly</p></div></article>', TEXT),
    "feedback beside the article": (f'<article>{BODY}</article><p class="feedback">I, for one, disagree, strongly, as this is more than eighty characters long, or so it seems</p>', TEXT),
    "stray cdata": (f"<article><p>{LEAD}</p><![CDATA[ no end ><p>{MORE}</p><p>{LAST}</p></article>", TEXT),
    "share links": (f'<article>{BODY}<div class="share"><a href="#">Tell, a, friend</a></div></article>', TEXT),
}


@pytest.mark.parametrize("name", SHAPES)
def test_shape(name):
    page, want = SHAPES[name]
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("name", ["post comments-open", "entry has-sidebar", "content search-result", "article-share", "form-article", "widget", "related-post", "promo", "notice", "no-comments"])
def test_class_names_empty_no_page(name):
    assert html_text.main_text(f'<html><body>{NAV}<div class="{name}">{BODY}</div>{FOOT}</body></html>') == TEXT


ODD = {
    "open tags": "<b" * 100_000,
    "brackets": "<" * 100_000,
    "open script": "<script>" + "</script" * 50_000,
    "inline and closing blocks": "<b>" * 30_000 + "</div>" * 30_000,
    "rules under inline": "<p><td>" + "<b>" * 30_000 + "<hr>" * 30_000,
    "quotes": '<a ">" ' * 50_000 + "'",
    "other quotes": "<a x='" * 20_001 + '<a "' * 20_000,
    "open comments": "<!--" * 50_000,
    "doubts in doubts": "<div class=ad>" * 20_000 + "x",
    "deep": "<div>" * 30_000 + "<p>a, b" * 1000,
}


@pytest.mark.parametrize("name", ODD)
def test_odd_pages_end(name):
    began = time.time()
    assert isinstance(html_text.main_text(ODD[name]), str)
    assert time.time() - began < 5
