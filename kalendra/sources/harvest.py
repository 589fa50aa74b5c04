"""Listing items out of raw pages, with one set of patterns per source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Selector:
    """How the items of one source look.

    `block` matches one item; each field pattern has one group and is applied inside the item.
    Items lacking a required field are skipped. `constants` are columns the source fixes. Fields
    named in `raw` keep their markup, such as addresses; the others become visible text.
    """

    host: str
    block: str
    fields: dict[str, str]
    required: list[str] = field(default_factory=list)
    constants: dict[str, object] = field(default_factory=dict)
    raw: list[str] = field(default_factory=list)


# The named character references that German pages use; the ampersand comes last.
ENTITIES = {
    "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü", "szlig": "ß",
    "eacute": "é", "egrave": "è", "agrave": "à", "ccedil": "ç", "ndash": "–", "mdash": "—",
    "bdquo": "„", "ldquo": "“", "rdquo": "”", "lsquo": "‘", "rsquo": "’", "hellip": "…",
    "euro": "€", "middot": "·", "bull": "•", "copy": "©", "nbsp": " ", "lt": "<", "gt": ">",
    "quot": '"', "apos": "'", "amp": "&",
}


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^\w+://([^/]+)", 1)


def plain_text(html: Column) -> Column:
    """Visible text of a fragment: tags out, character references decoded, blanks folded."""
    bare = _numbers_decoded(F.regexp_replace(html, r"(?s)<[^>]*>", ""))
    for name, letter in ENTITIES.items():
        bare = F.replace(bare, F.lit(f"&{name};"), F.lit(letter))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def _numbers_decoded(text: Column) -> Column:
    """`&#228;` and `&#xE4;` as the characters they stand for; numbers that are none stay."""
    parts = F.regexp_extract_all(text, F.lit(r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|[^&]+|&"), F.lit(0))

    def decoded(part: Column) -> Column:
        digits = F.regexp_replace(part, "[&#;xX]", "")
        number = F.when(part.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        valid = ((number >= 1) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
        letter = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        numeric = part.rlike("^&#[xX]?[0-9a-fA-F]+;$")
        return F.when(numeric & valid, letter).otherwise(part)

    whole = F.array_join(F.transform(parts, decoded), "")
    return F.when(text.contains("&#"), whole).otherwise(text)


def items(pages: DataFrame, block: str, html: str = "html") -> DataFrame:
    """One row per item block, in page order."""
    found = F.regexp_extract_all(F.col(html), F.lit(block), F.lit(0))
    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, F.posexplode(found).alias("pos", "item"))


def field_value(item: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group; NULL where nothing matches. The pattern runs once."""
    return F.get(F.regexp_extract_all(item, F.lit(pattern), F.lit(group)), F.lit(0))


def harvest(pages: DataFrame, selector: Selector) -> DataFrame:
    """`page_id`, `url`, `pos`, the selector's fields and its constants, one row per item."""
    own = pages.filter(host_of(F.col("url")).rlike(selector.host))
    found = items(own, selector.block)
    for name, pattern in selector.fields.items():
        value = field_value(F.col("item"), pattern)
        found = found.withColumn(name, value if name in selector.raw else plain_text(value))
    if selector.required:
        found = found.dropna(subset=selector.required)
    for name, value in selector.constants.items():
        found = found.withColumn(name, F.lit(value))
    return found.drop("item")


def without_previews(found: DataFrame, css_class: str = "class", category: str = "kat") -> DataFrame:
    """Drop preview containers and cinema programmes; a container without class or category stays."""
    preview = F.coalesce(F.col(css_class).contains("vorschau"), F.lit(False))
    cinema = F.coalesce(F.col(category) == "kino", F.lit(False))
    return found.filter(~preview & ~cinema)
