"""Times of day stay text (`HH:mm`), as in the warehouse; these split and tidy them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = " "


def _pair(start: Column, end: Column) -> Column:
    return F.struct(start.alias("start_time"), end.alias("end_time"))


def clock_range(text: Column) -> Column:
    """`20:00 - 22:00 Uhr` -> (20:00, 22:00); `20:00 Uhr` -> (20:00, blank)."""
    ranged = text.contains("-")
    parts = F.split(text, " - ")
    without_unit = F.replace(text, F.lit(" Uhr"), F.lit(""))
    end = F.replace(F.get(parts, F.lit(1)), F.lit(" Uhr"), F.lit(""))
    return _pair(
        F.when(ranged, F.get(parts, F.lit(0))).otherwise(without_unit),
        F.when(ranged, end).when(text.isNotNull(), F.lit(BLANK)),
    )


def until_range(text: Column) -> Column:
    """`20:00 bis 22:00` -> (20:00, 22:00); no `bis` -> (text, NULL)."""
    parts = F.split(text, " bis ")
    return _pair(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))


def digits_range(text: Column) -> Column:
    """`von 20:00 bis 22:00 Uhr` -> (20:00, 22:00), keeping digits, colons and hyphens only."""
    bare = F.regexp_replace(F.replace(text, F.lit("bis"), F.lit("-")), r"[^0-9:\-]", "")
    parts = F.split(bare, "-")
    return _pair(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))


def strict_range(text: Column) -> Column:
    """First `dd:dd - dd:dd` in the text, else two NULLs."""
    pattern = r"(\d{2}:\d{2})\s*-\s*(\d{2}:\d{2})"
    return _pair(
        F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")),
        F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")),
    )


def last_five(text: Column) -> Column:
    return F.right(text, F.lit(5))


def drop_last_four(text: Column) -> Column:
    return F.left(text, F.greatest(F.length(text) - 4, F.lit(0)))


def first_six(text: Column) -> Column:
    return F.trim(F.left(text, F.lit(6)))


def only_with_unit(text: Column) -> Column:
    """`20:00 Uhr` -> `20:00`; text without the unit is no time."""
    return F.when(text.contains("Uhr"), F.replace(text, F.lit(" Uhr"), F.lit("")))


def date_from_clock(text: Column) -> Column:
    """`7. Dezember 2024 ab 20:00 Uhr` -> (date part, `20:00`); without `ab` the time is blank."""
    parts = F.split(text, " ab ")
    has = text.contains("ab")
    return F.struct(
        F.when(has, F.get(parts, F.lit(0))).otherwise(text).alias("date_text"),
        F.when(has, drop_last_four(F.get(parts, F.lit(1))))
        .otherwise(F.lit(BLANK))
        .alias("time_text"),
    )


def normalise_clock(text: Column) -> Column:
    """Pad to five characters with zeros, then write four zeros as midnight."""
    padded = F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)
    return F.replace(padded, F.lit("0000"), F.lit("00:00"))
