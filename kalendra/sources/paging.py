"""Listings that go over many pages: following the links from page to page.

Every page names at most one next page, so a listing is a path through the pages. It is followed by
doubling: a table says where 1, 2, 4, … links lead and how many items lie on the way, and each round
takes what is reached twice as far. A listing of n pages takes log n rounds, and the items before a
page are known when it is reached.
"""

from __future__ import annotations

from urllib.parse import urldefrag, urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendra.session import cut_lineage
from kalendra.sources.selectors import Element, Field, Site, css, elements, page_items, selected, taken

_ITEMS = pa.list_(
    pa.struct([("pos", pa.int32()), ("fields", pa.map_(pa.string(), pa.list_(pa.string())))])
)
_PAGES = (
    "page_id long, url string, next_url string, "
    "items array<struct<pos: int, fields: map<string, array<string>>>>"
)
#: Pages that leave a task at a time.
_ROWS = 500


def listing_pages(pages: DataFrame, site: Site, following: Field) -> DataFrame:
    """(`page_id`, `url`, `next_url`, `items`): what each page shows and where it leads.

    The address of the next page is completed by that of the page; its fragment does not count. Pages
    without address or markup are left out, and of pages with one address that of the smallest page_id
    counts.
    """
    steps = css(following.selector)

    def next_url(page: list[Element], text: str, url: str) -> str | None:
        fitting = [k for k in range(len(page)) if selected(page, k, steps)]
        links = (taken(text, page[k], following.value) for k in fitting[following.nth : following.nth + 1])
        return next((urldefrag(urljoin(url, x.strip()))[0] for x in links if x and x.strip()), None)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        page_id, url, following_url, items = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(page_id, pa.int64()), pa.array(url, pa.string()),
             pa.array(following_url, pa.string()), pa.array(items, _ITEMS)],
            names=["page_id", "url", "next_url", "items"],
        )

    def run(batches):
        rows = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html"))
            for page_id, url, text in zip(*columns, strict=True):
                page = elements(text)
                items = [{"pos": k, "fields": list(v.items())} for k, v in page_items(text, url, site, page)]
                rows.append((page_id, url, next_url(page, text, url), items))
                if len(rows) >= _ROWS:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)

    some = pages.filter(F.col("url").isNotNull() & F.col("html").isNotNull())
    first = some.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = first.mapInArrow(run, _PAGES).filter(F.col("page_id").isNotNull())
    shown = F.min_by(F.struct("page_id", "next_url", "items"), "page_id").alias("shown")
    return found.groupBy("url").agg(shown).select("shown.page_id", "url", "shown.next_url", "shown.items")


def follow(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(`listing`, `page_no`, `url`, `items_before`, `ending`, `next_url`): the pages of each listing.

    `links` has `url` (each once), `next_url` and `n_items`; `starts` has `listing` (each once) and the
    `url` of its first page. `ending` is null but for the last page reached: `end` if it names no next
    page, `gap` if that page (`next_url`) is not there, `loop` if the listing has been there before. A
    listing whose first page is not there has one row with page_no 0 and ending `gap`. Listings may
    share pages.

    All tables here grow with the pages, and addresses are far smaller on disk than in memory, so none is
    ever broadcast.
    """
    links = cut_lineage(links.select("url", "next_url", F.col("n_items").cast("long").alias("n_items")))
    starts = cut_lineage(starts.select("listing", "url"))
    there = links.select("url")
    jump = cut_lineage(
        links.join(there.withColumnRenamed("url", "next_url").hint("merge"), "next_url", "left_semi").select(
            "url", F.col("next_url").alias("to"), F.col("n_items").alias("between")
        )
    )
    reached = cut_lineage(
        starts.join(there.hint("merge"), "url", "left_semi").select(
            "listing", "url", F.lit(1).cast("long").alias("page_no"), F.lit(0).cast("long").alias("items_before")
        )
    )
    step, size = 1, reached.count()
    while True:
        further = reached.join(jump.hint("merge"), "url").select(
            "listing", F.col("to").alias("url"), (F.col("page_no") + step).alias("page_no"),
            (F.col("items_before") + F.col("between")).alias("items_before"),
        )
        # A page met again on a loop keeps the number it had first.
        earliest = F.min(F.struct("page_no", "items_before")).alias("first")
        reached = cut_lineage(
            reached.unionByName(further).groupBy("listing", "url").agg(earliest)
            .select("listing", "url", "first.page_no", "first.items_before")
        )
        before, size = size, reached.count()
        if size == before:
            break
        onward = jump.toDF("to", "further", "more")
        jump = cut_lineage(
            jump.join(onward.hint("merge"), "to").select(
                "url", F.col("further").alias("to"), (F.col("between") + F.col("more")).alias("between")
            )
        )
        step *= 2
    known = links.select(F.col("url").alias("next_url"), F.lit(True).alias("known"))
    placed = reached.select("listing", F.col("url").alias("next_url"), F.col("page_no").alias("next_no"))
    ending = (
        F.when(F.col("next_url").isNull(), "end")
        .when(F.col("known").isNull(), "gap")
        .when(F.col("next_no") <= F.col("page_no"), "loop")
    )
    columns = ["listing", "page_no", "url", "items_before", ending.alias("ending"), "next_url"]
    trail = (
        reached.join(links.select("url", "next_url").hint("merge"), "url")
        .join(known.hint("merge"), "next_url", "left")
        .join(placed.hint("merge"), ["listing", "next_url"], "left")
        .select(*columns)
    )
    absent = starts.join(there.hint("merge"), "url", "left_anti").select(
        "listing", F.lit(0).cast("long").alias("page_no"), F.lit(None).cast("string").alias("url"),
        F.lit(0).cast("long").alias("items_before"), F.lit("gap").alias("ending"), F.col("url").alias("next_url"),
    )
    return trail.unionByName(absent)


def paged_listing(
    pages: DataFrame, starts: DataFrame, site: Site, following: Field
) -> tuple[DataFrame, DataFrame]:
    """(items, trail): the items of each listing, numbered from 1 across its pages (`listing`,
    `page_no`, `item_no`, `page_id`, `fields`), and the pages themselves as `follow` gives them.

    The pages are read once.
    """
    found = cut_lineage(listing_pages(pages, site, following))
    trail = cut_lineage(follow(found.select("url", "next_url", F.size("items").alias("n_items")), starts))
    shown = trail.join(found.select("url", "page_id", "items").hint("merge"), "url")
    items = shown.select(
        "listing", "page_no", "items_before", "page_id", F.posexplode("items").alias("k", "item")
    ).select(
        "listing", "page_no", (F.col("items_before") + F.col("k") + 1).alias("item_no"), "page_id", "item.fields"
    )
    return items, trail
