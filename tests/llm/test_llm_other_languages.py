"""Pages in languages without a list of stop words."""

from __future__ import annotations

import pytest

from kalendra.llm import main_text

RU = "Вчера вечером жители города собрались на площади, чтобы отметить праздник весны и послушать музыку. "
PL = "Wczoraj wieczorem mieszkańcy miasta zebrali się na rynku, żeby świętować nadejście wiosny i posłuchać muzyki. "
ZH = "昨天晚上市民们聚集在广场上庆祝春天的到来并欣赏音乐。"


@pytest.mark.parametrize("sentence, times", [(RU, 4), (PL, 4), (ZH, 12)])
def test_long_paragraphs_of_other_languages(sentence, times):
    body = (sentence * times).strip()
    page = (
        "<html><body><div><a href='/'>Home</a> <a href='/x'>News and more of the same</a></div>"
        f"<h1>Title</h1><p>{body}</p><p>{body}</p></body></html>"
    )
    text = main_text.main_text(page)
    assert text.count(body) == 2 and "News" not in text
