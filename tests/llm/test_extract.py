import pytest

from quayside.llm.extract import extract_text, main_text, smoothed, threshold

PARA = "This is a long paragraph of article text that goes on for quite a while, with many words in it."
OTHER = "Another paragraph that is part of the same article and also has a good number of words."
CASES = {
    "article among everything else": (
        f'<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><div id="cookie-notice">We use cookies to '
        f'improve your long experience here.</div><nav><a href=x>Home</a></nav><main><article><header><h1>Title</h1></header><p>{PARA}</p><p>Short.'
        f'</p><ul><li>Item one<li>Item two</ul><div class="ad-slot">Buy now this product which has a long text</div><p>{OTHER} &amp; &eacute; '
        f'<a href=q>link</a></p><form><p>Sign up with a long text here and there</p><input></form></article><section class="comments"><h2>Comments'
        f'</h2><p>{PARA} I disagree</p></section></main><aside><p>{PARA}</p></aside><footer>copyright {PARA}</footer></body></html>',
        ["Title", PARA, "Short.", "Item one", "Item two", f"{OTHER} & é link"]),
    "no article element": (
        f'<div class="menu"><ul><li><a>A</a><li><a>B</a></ul></div><div class="wrap"><div class="content"><h1>Head</h1><p>{PARA}<p>Tiny<p>{OTHER}'
        f'</div><div class="sidebar"><a href=x>{PARA}</a></div></div><div id="footer">{PARA}</div>', ["Head", PARA, "Tiny", OTHER]),
    "white space and inline elements": (f"<article><p>a <b>b</b>\n\t c<br>d &nbsp; e<!-- no --> f</p><p>{PARA}</p></article>", ["a b c d e f", PARA]),
    "script inside a paragraph": (f'<article><p>{PARA}<script>var a="<p>no</p>";</script></p></article>', [PARA]),
    "unfinished": (f'<article><p>{PARA}</p><p>end <a href="x', [PARA, "end"]),
    "stray end tags": (f"</div></p><article></b><p>{PARA}</i></p></article></article>", [PARA]),
    "plain text": ("plain text only", ["plain text only"]),
    "empty": ("", []), "no text": ("<div><p> </p></div>", []), "only a script": ("<script>x()</script>", []),
}


@pytest.mark.parametrize("name", CASES)
def test_case(name):
    html, want = CASES[name]
    assert main_text(html) == "\n\n".join(want)


BOTH = f"<p>{PARA}</p><p>{OTHER}</p>"
NAMED_CONTENT = {  # pages and the text that a class or id word, or a form, must not take
    "article with a state": (f'<article class="post has-comments">{BOTH}</article>', [PARA, OTHER]),
    "article with a word": (f'<article class="social">{BOTH}</article>', [PARA, OTHER]),
    "content name wins": (f'<div class="article-body social-share-enabled">{BOTH}</div>', [PARA, OTHER]),
    "content id wins": (f'<div id="content" class="with-sidebar">{BOTH}</div>', [PARA, OTHER]),
    "content beside an aside word": (f'<div class="post related"><p>{PARA}</p></div><div class="sidebar"><p>{OTHER}</p></div>', [PARA]),
    "wrapper": (f'<div class="layout-sidebar">{BOTH}<div class="sidebar"><p>Short note.</p></div></div>', [PARA, OTHER]),
    "heading ids": (f'<article><h2 id="related-work">Related work</h2><p>{PARA}</p><h3 id="search-algorithms">Search algorithms</h3><p>{OTHER}</p>'
                    f'</article>', ["Related work", PARA, "Search algorithms", OTHER]),
    "heading class": (f'<article><h2 class="widget">Widgets</h2>{BOTH}</article>', ["Widgets", PARA, OTHER]),
    "section ids": (f'<article><p>{PARA}</p><section id="discussion"><h2>Discussion</h2><p>{OTHER}</p></section></article>',
                    [PARA, "Discussion", OTHER]),
    "section ids without an article": (f'<div><section id="related"><p>{PARA}</p></section><section id="discussion"><p>{OTHER}</p></section></div>',
                                       [PARA, OTHER]),
    "a topic in a class": (f'<article><p class="notice-period">{PARA}</p><p>{OTHER}</p></article>', [PARA, OTHER]),
    "a topic in an id": (f'<article><div id="related-work"><p>{PARA}</p></div><p>{OTHER}</p></article>', [PARA, OTHER]),
    "page in a form": (f'<body><form id="aspnetForm"><div class="menu"><a href=x>A</a></div><div>{BOTH}</div><select><option>x</select></form></body>',
                       [PARA, OTHER]),
    "article in a form": (f'<form role="form"><nav>{PARA}</nav><article>{BOTH}</article></form>', [PARA, OTHER]),
    "main with a word": (f'<main class="sidebar">{BOTH}</main>', [PARA, OTHER]),
}


@pytest.mark.parametrize("name", NAMED_CONTENT)
def test_words_and_forms_take_no_content(name):
    html, want = NAMED_CONTENT[name]
    assert main_text(html) == "\n\n".join(want)


@pytest.mark.parametrize("junk", [
    f'<div class="comments-area"><p>{PARA * 9}</p></div>', f'<section id="comments"><p>{PARA * 9}</p></section>',
    f'<ul class="menu-items"><li>{PARA}</ul>', f'<div class="footer text-center"><p>{OTHER}</p></div>', f'<div id="cookie-notice">{OTHER}</div>',
    f'<div class="related-posts"><p>{OTHER}</p></div>', f'<div class="widget widget_text" id="text-3"><p>{OTHER}</p></div>',
    f'<form class="search"><p>{OTHER}</p></form>', f'<div class="ad">{OTHER * 9}</div>', f'<div id="div-gpt-ad-1-0">{OTHER}</div>',
    f'<div id="sidebar-left"><article>{OTHER}</article></div>', f'<div class="alert alert-info">{OTHER}</div>'])
def test_named_asides_still_go(junk):
    assert main_text(f"<article><p>{PARA}</p></article>{junk}") == PARA


def test_an_advert_inside_a_paragraph_goes_and_the_paragraph_stays():
    assert main_text(f'<article><p>{PARA} <span class="ad">Buy <a>now</a></span>end</p></article>') == f"{PARA} end"
    assert main_text(f'<article><p>{PARA}</p><article class="comment"><p>{OTHER}</p></article></article>') == PARA


INTRO = "An introduction that stands in an element of its own, before the rest of the text and apart from it."
BODY = [f"{i} {PARA} {OTHER}" for i in range(8)]
PARAS = "".join(f"<p>{b}</p>" for b in BODY)
SPLIT = {  # content that is not all in the deepest element with 80 % of the marked text
    "intro beside the body": (f'<div id="c"><div class="intro"><p>{INTRO}</p></div><div class="body">{PARAS}</div></div>', [INTRO, *BODY]),
    "end beside the body": (f'<div id="c"><div class="body">{PARAS}</div><div class="end"><p>{INTRO}</p></div></div>', [*BODY, INTRO]),
    "title in a wrapper": (f'<div id="c"><div class="top"><h1>T</h1></div><div class="body">{PARAS}</div></div>', ["T", *BODY]),
    "title, author and intro": (f'<div id="c"><div class="top"><h1>T</h1><p>By A</p><p>{INTRO}</p></div><div class="body">{PARAS}</div></div>',
                                ["T", "By A", INTRO, *BODY]),
    "blockquote": (f"<div><p>{INTRO}</p><blockquote>{PARAS}</blockquote><p>{OTHER}</p></div>", [INTRO, *BODY, OTHER]),
    "cell": (f"<div><p>{INTRO}</p><table><tr><td>{PARAS}</td></tr></table><p>{OTHER}</p></div>", [INTRO, *BODY, OTHER]),
    "section": (f"<div><p>{INTRO}</p><section>{PARAS}</section><p>{OTHER}</p></div>", [INTRO, *BODY, OTHER]),
    "title and lead in main": (f"<main><h1>T</h1><p>{INTRO}</p><article>{PARAS}</article></main>", ["T", INTRO, *BODY]),
    "title and short lead in main": (f"<main><h1>T</h1><p>lead</p><article>{PARAS}</article></main>", ["T", "lead", *BODY]),
    "title and lead before an article": (f"<body><nav>N</nav><div><h1>T</h1><p>{INTRO}</p><article>{PARAS}</article></div></body>", ["T", INTRO, *BODY]),
    "two articles": (f"<div><article>{PARAS}</article><article><p>{INTRO}</p></article></div>", [*BODY, INTRO]),
    "links outside stay out": (f"<div><p><a href=x>{INTRO}</a></p><article>{PARAS}</article></div>", BODY),
    "short text outside an article stays out": (f"<div><div>Site</div><article>{PARAS}</article><div>2020</div></div>", BODY),
    "intro beside main": (f"<body><div>Site</div><div><p>{INTRO}</p></div><main>{PARAS}</main><div>2020</div></body>", [INTRO, *BODY]),
}


@pytest.mark.parametrize("name", SPLIT)
def test_region_holds_all_content_lines(name):
    html, want = SPLIT[name]
    assert main_text(html) == "\n\n".join(want)


def test_lists_of_links_in_an_article_stay():
    sources = "".join(f"<li><a href=s{i}>Source {i}</a>" for i in range(9))
    want = "\n\n".join([*BODY, "Sources", *(f"Source {i}" for i in range(9))])
    assert main_text(f"<article>{PARAS}<h2>Sources</h2><ul>{sources}</ul></article>") == want
    assert main_text(f"<div><article>{PARAS}<h2>Sources</h2><ul>{sources}</ul></article><p>{INTRO}</p></div>") == f"{want}\n\n{INTRO}"
    assert main_text(f"<article>{PARAS}<h2>Sources</h2><ul>{sources}</ul><nav><ul>{sources}</ul></nav></article>") == want


def test_deep_and_long_pages():
    assert main_text("<div>" * 3000 + f"<article><p>{PARA}</p></article>") == PARA
    long = "<article>" + f"<p>{PARA}</p>" * 5000 + "</article>"
    assert main_text(long) == "\n\n".join([PARA] * 5000)


def test_smoothing_and_threshold():
    import numpy as np

    assert np.allclose(smoothed(np.ones(5)), 1)
    assert 1 < threshold(np.array([0.5, 0.6, 5.0, 5.2])) < 5
    assert threshold(np.array([4.0, 4.2, 4.4])) < 4.0  # one cluster: all is content


def test_rows(spark):
    rows = [(1, "u1", CASES["no article element"][0], "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract_text(pages).collect()}
    assert got[(2, None)] == ("", 0) and got[(None, "u")] == ("", 0) and got[(1, "u1")][1] == len(got[(1, "u1")][0])
    assert extract_text(pages).count() == 4 and extract_text(pages.limit(0)).count() == 0


def test_whole_table_keeps_every_article_word(spark):
    """The tables' pages have their article in one element: its text is the result."""
    import html as entities
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") + 9:].split("</article>")[0]
        blocks = [entities.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n\n".join(" ".join(b) for b in blocks if b)
