"""Pages whose layout or names mislead simple rules."""

from __future__ import annotations

from kalendra.llm.main_text import main_text

LONG = "This is the story of a man and the sea, that was to be in the book for the people of the town. " * 3
BARE = "Fishermen repaired wooden boats yesterday; storms damaged seventeen harbours along northern coasts, leaving villages without electricity, drinking water, medicine, telephones."
RU = "Вчера вечером жители города собрались на площади, чтобы отметить праздник весны и послушать музыку до утра. "
ZH = "昨天晚上市民们聚集在广场上庆祝春天的到来并欣赏音乐。" * 3


def test_a_teaser_marked_as_article_does_not_narrow_the_page():
    page = f'<article class="teaser">teaser text</article><div id="text"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>'
    assert main_text(page).count(LONG.strip()) == 3
    page = f"<article><p>{LONG}</p><p>Short end.</p></article><p>{'Buy it. ' * 12}</p>"
    assert main_text(page) == f"{LONG.strip()} Short end."


def test_a_part_of_a_name_yields_to_what_the_page_is():
    page = f'<div class="cookie-notice"><p>{LONG}</p></div><div class="share-your-story"><h1>Title</h1><p>{LONG}</p></div>'
    assert main_text(page) == f"Title {LONG.strip()}"
    assert main_text(f'<div class="cookie-notice"><p>{LONG}</p></div><footer><p>{LONG}</p></footer>') == ""
    page = f'<p>{LONG}</p><div class="share-your-story"><p>{LONG}</p></div>'
    assert main_text(page) == LONG.strip()


def test_where_nothing_is_decided_the_longest_run_is_text():
    for sentence, times in ((BARE, 40), (RU.strip(), 40), (ZH, 40)):
        body = "".join(f"<p>{sentence}</p>" for _ in range(times))
        page = f"<nav><p>{sentence}</p></nav><p>Hello</p><ul><li><a href=x>Other news</a></li></ul>{body}<footer>End</footer>"
        assert main_text(page) == " ".join([sentence] * times)
    assert main_text("<p>Hello</p><p>you</p>") == ""


def test_links_around_blocks_are_links():
    cards = "".join(f'<a href="/{i}"><div>{LONG}</div><div>More of it</div></a>' for i in range(5))
    assert main_text(f"{cards}<p>{LONG}</p><p>{LONG}</p>") == f"{LONG.strip()} {LONG.strip()}"
    open_link = f"<p><a href=x>Never closed<p>{LONG}</p><p><a href=y></p><p>{LONG}</p><a name=top><p>{LONG}</p>"
    assert main_text(open_link).count(LONG.strip()) == 3
    assert main_text(f"<div><a href=x><p>Card</p></div><p>{LONG}</p>") == LONG.strip()
