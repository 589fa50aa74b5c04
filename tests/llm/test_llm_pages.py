"""Main text of pages."""

from __future__ import annotations

from kalendra.llm.main_text import extract, main_text

LONG = "This is the story of a man and the sea, that was to be in the book for the people of the town. "


def test_article_and_what_surrounds_it():
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>x</article>";</script></head>
    <body><nav><a href=x>Home</a></nav><div class="ad">Buy &amp; buy</div>
    <article><h1>Head &amp; tail</h1><p>First <b>bo</b>ld<br>line &lt;x&gt;.<p>Second&nbsp;one
    <aside>Side</aside><form><input>Name</form><p class="notice">Cookies!</p><p>Third</p></article>
    <div class="comments"><article><p>{LONG * 4}</p></article></div><footer>&copy; x</footer></body></html>"""
    assert main_text(page) == "Head & tail First bold line <x>. Second one Third"


def test_without_an_article_density_decides():
    page = (
        f'<div id="menu"><a href=x>Home</a></div><h1>Title of it</h1><p>{LONG * 3}</p><p>Short one.</p><p>{LONG * 3}</p>'
        f'<ul><li><a href=1>Other story of the day</a></li></ul><div class="cookie-notice"><p>{LONG}</p></div>'
    )
    assert main_text(page) == f"Title of it {(LONG * 3).strip()} Short one. {(LONG * 3).strip()}"


def test_broken_pages():
    assert main_text(None) == main_text("") == main_text("<") == main_text("<!-- never closed") == ""
    assert main_text("<article><p>a &am") == "a &am"
    assert main_text("<article><p>a<a hre") == "a"
    assert main_text("<article><p title='x>y'>a</p></article></article></div>") == "a"
    assert main_text('<div class="has-sidebar"><article>a</article></div>') == "a"
    assert main_text('<article><header class="entry-header"><h1>H</h1></header>b</article>') == "H b"


def test_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", f"<article>é {'x ' * 50000}</article>", "t", "n"), (None, None, None, None, None), (2, "u", "", "t", "n"), (2, "u", "", "t", "n")]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 100001), (2, 0), (2, 0)]
    assert extract(spark.createDataFrame([], schema)).count() == 0
