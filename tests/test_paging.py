"""Listings over many pages against following one link after the other."""

from __future__ import annotations

import random

import pytest

from kalendra.sources.paging import follow, listing_pages, paged_listing
from kalendra.sources.selectors import Field, Site

NEXT = Field('a[rel="next"]', "@href")
SITE = Site("s", ".", "li", {"name": Field("", scope="self")})


def plain(links, starts):
    by_url = {u: (n, k) for u, n, k in links}
    out = []
    for listing, url in starts:
        if url not in by_url:
            out.append((listing, 0, None, 0, "gap", url))
            continue
        seen, before, no = set(), 0, 1
        while True:
            seen.add(url)
            following, n = by_url[url]
            ending = None
            if following is None:
                ending = "end"
            elif following not in by_url:
                ending = "gap"
            elif following in seen:
                ending = "loop"
            out.append((listing, no, url, before, ending, following))
            if ending:
                break
            before, no, url = before + n, no + 1, following
    return sorted(out, key=repr)


def found(spark, links, starts):
    df = follow(
        spark.createDataFrame(links, "url string, next_url string, n_items int"),
        spark.createDataFrame(starts, "listing long, url string"),
    )
    assert df.columns == ["listing", "page_no", "url", "items_before", "ending", "next_url"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_random_links(spark):
    rng = random.Random(1)
    links = [
        (f"u{k}", rng.choice([None, f"u{rng.randrange(70)}", f"u{k + 1}", f"u{k + 1}"]), rng.randrange(4))
        for k in range(60)
    ]
    starts = [(k, f"u{rng.randrange(64)}") for k in range(40)]
    assert found(spark, links, starts) == plain(links, starts)


@pytest.mark.parametrize("back", [None, "u70"])
def test_long_listing(spark, back):
    links = [(f"u{k}", f"u{k + 1}", k % 3) for k in range(99)] + [("u99", back, 5)]
    starts = [(1, "u0"), (2, "u95"), (3, "nowhere")]
    assert found(spark, links, starts) == plain(links, starts)


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    from kalendra.sources import paging

    steps = []
    cut = paging.cut_lineage
    monkeypatch.setattr(paging, "cut_lineage", lambda df: (steps.append(1), cut(df))[1])
    links = [(f"u{k}", f"u{k + 1}" if k < 1023 else None, 1) for k in range(1024)]
    rows = found(spark, links, [(7, "u0")])
    assert rows[-1][1] and max(r[1] for r in rows) == 1024
    assert len(steps) <= 4 + 2 * 12


def test_no_listings(spark):
    assert found(spark, [], [(1, "a")]) == [(1, 0, None, 0, "gap", "a")]
    assert found(spark, [("a", "a", 1)], []) == []


def page(names, following=None):
    link = f'<a rel="next" href="{following}">more</a>' if following is not None else ""
    return "<ul>" + "".join(f"<li>{n}" for n in names) + f"</ul>{link}"


def test_items_are_numbered_across_pages(spark):
    rows = [
        (3, "http://x.example/a", page("AB", "b?p=2#top")),
        (1, "http://x.example/a", page("CD", "/b?p=2")),  # the smaller page_id counts
        (4, "http://x.example/b?p=2", page("", "http://y.example/c")),
        (5, "http://y.example/c", page("EFG", " ")),
        (6, None, page("Z")),
        (7, "http://x.example/z", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    starts = spark.createDataFrame([(9, "http://x.example/a")], "listing long, url string")
    items, trail = paged_listing(pages, starts, SITE, NEXT)
    got = sorted((r.item_no, r.page_no, r.page_id, r.fields["name"][0]) for r in items.collect())
    assert got == [(1, 1, 1, "C"), (2, 1, 1, "D"), (3, 3, 5, "E"), (4, 3, 5, "F"), (5, 3, 5, "G")]
    assert sorted((r.page_no, r.ending) for r in trail.collect()) == [(1, None), (2, None), (3, "end")]
    assert listing_pages(pages, SITE, NEXT).count() == 3
