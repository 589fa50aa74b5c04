"""Descriptions composed from other columns. `concat` yields NULL when any part is NULL.

The wordings in quotes are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalendra.functions.dates import load_date_text


def source_and_price(source: Column, price: Column) -> Column:
    return F.concat(source, F.lit(" , Preis: "), price)


def text_and_source(text: Column, source: Column) -> Column:
    return F.concat(text, F.lit(" "), source)


def append_link(text: Column, link: Column) -> Column:
    """A missing link adds nothing."""
    return F.concat(text, F.coalesce(link, F.lit("")))


def name_and_address(name: Column, address: Column) -> Column:
    """A missing part is written as the text `nan`."""
    return F.concat(
        F.coalesce(name, F.lit("nan")), F.lit(" | "), F.coalesce(address, F.lit("nan"))
    )


def load_banner(
    asof: Column, category: Column, description: Column, city: Column, music: Column
) -> Column:
    banner = F.concat(
        F.lit("Ladedatum: "), load_date_text(asof), F.lit(", "),
        category, F.lit(", "), description, F.lit(", "), city,
    )
    return F.when(music, F.concat(banner, F.lit(" Musik"))).otherwise(banner)


def mention_count(counter: Column, description: Column) -> Column:
    told = F.concat(
        F.lit("This event has been mentioned "),
        counter.cast("string"),
        F.lit(" times in our database.\n"),
        F.coalesce(description, F.lit("nan")),
    )
    return F.when(counter > 1, told).otherwise(description)


def creation_stamp(description: Column, run_ts: Column) -> Column:
    return F.concat(
        F.coalesce(description, F.lit("None")),
        F.lit("\n\nEvent created on: "),
        F.date_format(run_ts, "yyyy-MM-dd HH:mm:ss"),
    )
