"""Dates as listing sites write them.

Every function takes the run date as a parameter where "today" matters, and yields NULL for text
that holds no date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# German month names and abbreviations.
MONTH_NAMES = [
    "Januar", "Februar", "März", "April", "Mai", "Juni",
    "Juli", "August", "September", "Oktober", "November", "Dezember",
]
MONTH_ABBREVIATIONS = [
    "Jan", "Feb", "Mär", "Apr", "Mai", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Dez",
]


def _parse(text: Column, pattern: str) -> Column:
    return F.try_to_date(text, pattern)


def _month_number(name: Column, names: list[str]) -> Column:
    pairs = [F.lit(part) for i, n in enumerate(names) for part in (n, f"{i + 1:02d}")]
    return F.try_element_at(F.create_map(*pairs), name)


def _from_parts(year: Column, month: Column, day: Column) -> Column:
    return _parse(F.concat_ws("-", year, month, day), "yyyy-M-d")


def dotted_date(text: Column) -> Column:
    """`7.12.2024` -> 2024-12-07."""
    return F.when(text.contains("."), _parse(text, "d.M.yyyy"))


def iso_date(text: Column) -> Column:
    return _parse(text, "yyyy-MM-dd")


def next_occurrence(text: Column, asof: Column) -> Column:
    """`07.12.` -> that day in this year, or in the next one when it is already over."""
    bare = F.btrim(text, F.lit("."))
    part = [F.split_part(bare, F.lit("."), F.lit(i)) for i in (1, 2, 3)]
    day, month = part[0].try_cast("int"), part[1].try_cast("int")
    passed = (month < F.month(asof)) | ((month == F.month(asof)) & (day < F.dayofmonth(asof)))
    year = F.year(asof) + passed.cast("int")
    return F.when(text.contains(".") & (part[2] == ""), _from_parts(year, month, day))


def current_year_date(text: Column, asof: Column) -> Column:
    """`07.12.` -> that day in the run year; the third part, if any, is ignored."""
    parts = F.split(text, r"\.")
    day, month = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    complete = (F.size(parts) == 3) & (day != "") & (month != "")
    return F.when(complete, _from_parts(F.year(asof), month, day))


def relative_day(text: Column, asof: Column) -> Column:
    """`heute` and `morgen` anywhere in the text become a `dd.MM.` date."""
    return (
        F.when(text.contains("heute"), F.date_format(asof, "dd.MM."))
        .when(text.contains("morgen"), F.date_format(F.date_add(asof, 1), "dd.MM."))
        .otherwise(text)
    )


def replace_today_word(text: Column, asof: Column) -> Column:
    return F.replace(text, F.lit("Heute"), F.date_format(asof, "dd.MM.yyyy"))


def day_month_abbreviated(text: Column) -> Column:
    """`7. Dez.` or `7 Dez.` or `7. Dez` -> `07.12.`; unknown months give NULL."""
    day = F.regexp_extract(text, r"^\s*(\d{1,2})\.?\s+\S+\s*$", 1)
    name = F.regexp_extract(text, r"^\s*\d{1,2}\.?\s+(\S+?)\.?\s*$", 1)
    return F.concat(
        F.lpad(day, 2, "0"), F.lit("."), _month_number(name, MONTH_ABBREVIATIONS), F.lit(".")
    )


def month_number(abbreviation: Column) -> Column:
    """`Dez` or `Dez.` -> `12`."""
    return _month_number(F.regexp_replace(abbreviation, r"\.$", ""), MONTH_ABBREVIATIONS)


def full_month_date(text: Column) -> Column:
    """`1. Dezember 2024` -> 2024-12-01."""
    pattern = r"^\s*(\d{1,2})\.?\s+(\p{L}+)\s+(\d{4})\s*$"
    day, name, year = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    return _from_parts(year, _month_number(name, MONTH_NAMES), day)


def long_date(text: Column) -> Column:
    """`Sonntag, 1. Dezember 2024` -> 2024-12-01, whatever the locale of the cluster."""
    return full_month_date(F.regexp_replace(text, r"^\s*\p{L}+,\s*", ""))


def listing_day_month(text: Column) -> Column:
    """The `dd.MM.` part of `Sa., 7. Dez., 20:00`, of `07.12. um 20:00`, or the text itself."""
    parts = F.split(text, ",")
    return (
        F.when(F.size(parts) >= 3, day_month_abbreviated(F.trim(F.get(parts, F.lit(1)))))
        .when(text.contains("um"), F.get(F.split(F.trim(text), r"\s+"), F.lit(0)))
        .otherwise(text)
    )


def second_comma_part(text: Column) -> Column:
    """`Samstag, 7. Dez` -> `7. Dez`; one space when there is no comma."""
    parts = F.split(text, ",")
    return F.when(F.size(parts) > 1, F.trim(F.get(parts, F.lit(1)))).otherwise(F.lit(" "))


def date_of_timestamp_text(text: Column) -> Column:
    """`2024-12-07T20:00:00+01:00` -> 2024-12-07; plain dates pass too."""
    return F.when(text.contains("T"), _parse(F.left(text, F.lit(10)), "yyyy-MM-dd")).otherwise(
        iso_date(text)
    )


def date_before_clock(text: Column) -> Column:
    """`2024-12-07T20:00` -> 2024-12-07 by cutting the six-character clock part."""
    return iso_date(F.left(text, F.greatest(F.length(text) - 6, F.lit(0))))


def day_range_text(asof: Column, days: int) -> Column:
    return F.concat(
        F.date_format(asof, "dd.MM.yyyy"),
        F.lit(" - "),
        F.date_format(F.date_add(asof, days), "dd.MM.yyyy"),
    )


def load_date_text(asof: Column) -> Column:
    return F.date_format(asof, "dd-MM-yyyy")
