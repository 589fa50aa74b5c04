"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass labels a block by where it stands
(menus, headers, footers, side bars, notices, adverts, forms and comments are named by tags,
classes and roles) and by length, link density and stop-word density. Blocks that are too short or
too mixed to tell stay open; the second pass gives them the label of the nearest decided neighbours.

An article or main element narrows the page to itself only where it holds as much text as the rest. A
page without any block that is surely text is read again: containers that only a part of a name speaks
against (`share-your-story`) count as others do, and at last the longest run of open blocks is text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame

from kalendra.llm.quality import STOP_WORDS
from kalendra.llm.words import pieces

# Names of HTML elements.
UNSEEN = (
    "head script style noscript template iframe object embed svg canvas math audio video "
    "select textarea button datalist"
).split()
APART = "nav footer aside form menu dialog".split()
MAIN = ("article", "main")
BLOCK = (
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead title tr ul"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
# Elements whose end may be left out, or that only mark words: they hold no place on the path.
LOOSE = frozenset(VOID) | frozenset("p li dt dd tr td th option html body".split())
# Words in class names, ids and roles that name what is not the article.
NAMES = (
    "ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs captcha comment "
    "comments complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promotion related reply replies respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget"
).split()

#: A block this long (characters) with this share of stop words is text; between the lengths it
#: must have more of them.
LONG, SHORT = 200, 70
STOP_LONG, STOP_MIDDLE = 0.10, 0.25
#: Share of stop words in a page's longer blocks from which its language counts as one of the list.
STOP_LISTED = 0.05
#: A block with a greater share of its characters in links is not text.
MOST_LINKED = 0.4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<unseen>script|style|noscript|template|textarea|iframe|svg|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</(?P=unseen)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([\w-]+)")
_WORD = re.compile(r"[^\W\d_]+")
_NAME_PARTS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HEADING = re.compile(r"h[1-6]$")
_BLOCKS, _UNSEEN, _APART = frozenset(BLOCK), frozenset(UNSEEN), frozenset(APART)
_NAMES, _STOPS = frozenset(NAMES), frozenset(STOP_WORDS)
_OF_READERS = frozenset(("comment", "comments", "disqus", "replies", "reply", "respond"))
_LAYOUT = frozenset(("has", "no", "with", "without"))  # as in has-sidebar, of a page's frame


@dataclass
class Block:
    text: str
    linked: int  # characters of it that stand in links
    apart: int  # inside something that is not the article: 0 no, 1 by a part of a name, 2 and 3 surely
    main: bool  # inside an article or main element
    heading: bool


def _is_apart(name: str, rest: str, in_main: bool) -> int:
    """How surely an element, by its name and attributes, is no part of an article: 0 not, 1 by a part
    of a longer name, 2 by a whole name, though a frame around the page may bear that too, 3 for sure."""
    if name in _APART or (name == "header" and not in_main):
        return 3
    if not rest or rest.isspace():
        return 0
    found = 0
    for key, a, b, c, alone in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), a or b or c
        if alone.lower() == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return 3
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return 3
        if key not in ("class", "id", "role") or name in ("body", "html", "main"):
            continue
        for whole in value.split():
            parts = [x.lower() for x in _NAME_PARTS.split(whole) if x]
            named = 2 * sum(part in _NAMES for part in parts) >= len(parts)
            for before, part in zip([""] + parts, parts):
                if part in _OF_READERS:
                    return 3
                if part in _NAMES and before not in _LAYOUT and name != "article":
                    found = max(found, 0 if part == "header" and in_main else 1 + named)
    return found


def blocks_of(page: str) -> list[Block]:
    """The non-empty blocks of a page in their order. Tags that are never closed, closed twice or
    cut off at the page's end are taken as far as they go."""
    blocks: list[Block] = []
    path: list[tuple[str, int, bool]] = []  # open elements: name, apart, main
    parts: list[str] = []
    linked, link, heading, at = 0, 0, False, 0
    around, within = False, 0  # whether the open link may go around blocks; elements open at its start
    mark = 0  # what a paragraph's own attributes say; its end may be left out, so it is not on the path

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            _, apart, main = path[-1] if path else ("", 0, False)
            blocks.append(Block(text, min(linked, len(text)), max(apart, mark), main, heading))
        parts.clear()
        linked = 0

    def read(raw: str) -> None:
        nonlocal linked, around
        text = html.unescape(raw)
        parts.append(text)
        if link:
            size = len("".join(text.split()))
            linked += size
            around &= link > 1 or not size

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            read(page[at : token.start()])
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue  # a comment, a declaration, or an element that is never shown
        ends = bool(token["end"] or token["end2"])
        rest = token["rest"] or token["rest2"] or ""
        if name == "a":
            link, around, within = int(not ends), not ends and "href" in rest.lower(), len(path)
            continue
        if name in _BLOCKS or name in _UNSEEN:
            close()
            if link == 1:  # a link that was never closed, unless blocks begin right behind it
                link = 2 if around and not ends else 0
            mark = mark if name == "br" else 0
            if _HEADING.match(name):
                heading = not ends
            elif name != "br":
                heading = False
        if ends:
            names = [x[0] for x in path]
            if name in names:
                close()
                del path[len(names) - 1 - names[::-1].index(name) :]
                link = link if len(path) >= within else 0
        elif name not in LOOSE and not rest.endswith("/"):
            _, apart, main = path[-1] if path else ("", 0, False)
            own = 3 if name in _UNSEEN else _is_apart(name, rest, main)
            if name in MAIN and apart in (1, 2):
                apart = 0
            if own:
                close()
            if name in _BLOCKS or name in _UNSEEN or own:
                path.append((name, max(apart, own), main or name in MAIN))
        elif name in _BLOCKS and name not in VOID and name in LOOSE:
            mark = _is_apart(name, rest, bool(path and path[-1][2]))
    if at < len(page):
        read(page[at:])
    close()
    return blocks


def _stop_share(texts: list[str]) -> float:
    words = [w for text in texts for w in _WORD.findall(text.lower())]
    return sum(w in _STOPS for w in words) / len(words) if words else 0.0


def first_pass(block: Block, has_main: bool, listed: bool = True) -> bool | None:
    """True for text, False for what is not, None where it is too short or mixed to tell. Where the
    page's language has no stop words here (`listed`), length and links decide."""
    if block.apart or (has_main and not block.main):
        return False
    size = len(block.text)
    linked = block.linked / size
    if block.main and has_main:
        return True if linked <= MOST_LINKED else None
    if linked > MOST_LINKED:
        return False
    if block.heading or size < SHORT:
        return None
    if not listed:
        return True if size >= LONG else None
    stops = _stop_share([block.text])
    if size >= LONG:
        return stops >= STOP_LONG
    return True if stops >= STOP_MIDDLE else None


def second_pass(labels: list[bool | None]) -> list[bool]:
    """Open blocks take the label of the nearest decided block; of two as near the following one
    decides, as a heading belongs to what it heads. Without any decided block nothing is text."""
    before, after = [], []
    last: tuple[int, bool] | None = None
    for i, label in enumerate(labels):
        last = (i, label) if label is not None else last
        before.append(last)
    last = None
    for i in range(len(labels) - 1, -1, -1):
        last = (i, labels[i]) if labels[i] is not None else last
        after.append(last)
    after.reverse()
    out = []
    for i, label in enumerate(labels):
        if label is None:
            a, b = before[i], after[i]
            near = b if a is None or (b is not None and b[0] - i <= i - a[0]) else a
            label = near is not None and near[1]
        out.append(label)
    return out


def _labels(blocks: list[Block]) -> list[bool | None]:
    """The first pass over a page."""
    plain = [b for b in blocks if not b.apart and b.linked <= MOST_LINKED * len(b.text)]
    told = [b for b in plain if not b.heading and len(b.text) >= SHORT]
    inside = sum(len(b.text) for b in plain if b.main)
    has_main = any(b.main and not b.apart for b in blocks)
    has_main &= inside >= sum(len(b.text) for b in told if not b.main)
    listed = has_main or _stop_share([b.text for b in told]) >= STOP_LISTED
    return [first_pass(b, has_main, listed) for b in blocks]


def _longest_run(blocks: list[Block], labels: list[bool | None]) -> list[bool | None]:
    """`labels` with the longest run of open blocks as text, where it is as long as a long block."""
    best, most, start, size = range(0), LONG - 1, 0, 0
    for i, (block, label) in enumerate(zip(blocks, labels, strict=True)):
        if label is False:
            start, size = i + 1, 0
        elif not block.heading:
            size += len(block.text)
        if size > most:
            best, most = range(start, i + 1), size
    return [True if i in best else label for i, label in enumerate(labels)]


def main_text(page: str | None) -> str:
    """The text blocks of a page, joined by one space; empty for a null or empty page."""
    blocks = blocks_of(page or "")
    labels = _labels(blocks)
    if True not in labels and any(b.apart == 1 for b in blocks):
        labels = _labels([replace(b, apart=b.apart * (b.apart > 1)) for b in blocks])
    if True not in labels:
        labels = _longest_run(blocks, labels)
    labels = second_pass(labels)
    return " ".join(b.text for b, keep in zip(blocks, labels, strict=True) if keep)


def _texts(batches):
    for whole in batches:
        for batch in pieces(whole, "html", 4 << 20):
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(x) for x in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """(`page_id`, `url`, `text`, `n_chars`) of every page. Each page is judged by itself, so rows
    need no shuffle; repeated rows give repeated results. A null or empty html has an empty text; texts
    of any length are read whole, and no rows give no rows. Other columns are ignored."""
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(
        _texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
