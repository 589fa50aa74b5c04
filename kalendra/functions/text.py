"""Text clean-up: titles, keys, token sets and the delimiter formats of the listing sites."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places whose longer names are folded into one key, in matching order.
TARGET_CITIES = ["Hamburg", "Luebeck", "Norderstedt", "Hannover", "Bremen", "Braunschweig"]
# How umlauts are spelled in a city key.
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue", "ß": "ss"}
CITY_KEY_DELETED = "/.,()-"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once where `body` needs it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def title_case(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def title_if_upper(text: Column) -> Column:
    def retitled(t: Column) -> Column:
        return F.when((t == F.upper(t)) & (t != F.lower(t)), title_case(t)).otherwise(t)

    return _let(text, retitled)


def city_key(text: Column) -> Column:
    spelled = text
    for umlaut, letters in UMLAUTS.items():
        spelled = F.replace(spelled, F.lit(umlaut), F.lit(letters))

    def folded(key: Column) -> Column:
        name = F.when(key == "inselweit", F.lit("Amrum_inselweit")).otherwise(key)
        for target in reversed(TARGET_CITIES):
            name = F.when(key.contains(target), F.lit(target)).otherwise(name)
        return name

    return _let(F.translate(F.replace(spelled, F.lit(" "), F.lit("_")), CITY_KEY_DELETED, ""), folded)


def alnum_key(text: Column) -> Column:
    """Lower-case ASCII letters and digits; everything else vanishes."""
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]", ""))


def normalised(text: Column, remove_suffix: str | None = None) -> Column:
    """Lower case, punctuation other than `&` to blanks, single blanks; optional suffix cut."""
    spaced = F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}_\s&]", " ")
    clean = F.trim(F.regexp_replace(spaced, r"(?U)\s+", " "))
    if not remove_suffix:
        return clean
    cut = F.trim(F.left(clean, F.length(clean) - len(remove_suffix)))
    return F.when(clean.endswith(remove_suffix), cut).otherwise(clean)


def token_set(text: Column) -> Column:
    """Distinct blank-separated words, sorted."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    return F.sort_array(F.array_distinct(words))


def word_set(text: Column) -> Column:
    """`token_set(normalised(text))` in one pass over the text."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_&]+"), F.lit(0))
    return F.sort_array(F.array_distinct(words))


def token_text(text: Column) -> Column:
    return F.array_join(token_set(text), " ")


def place_date_time(text: Column) -> Column:
    """`Halle, Sa. 07.12.2024, 20:00`: three parts, two, or the whole text as the place."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    n = F.size(parts)
    listed = n.isin(2, 3)
    blank = F.lit(" ")
    return F.struct(
        F.when(listed, F.get(parts, F.lit(0))).otherwise(F.trim(text)).alias("location"),
        F.when(listed, F.get(parts, F.lit(1))).otherwise(blank).alias("date_text"),
        F.when(n == 3, F.get(parts, F.lit(2))).otherwise(blank).alias("time_text"),
    )


def slash_fields(text: Column) -> Column:
    """`07.12.2024 / 20:00 Uhr / Halle / Saal, Kiel` -> date, time, location, city."""
    parts = F.transform(F.split(text, "/"), lambda p: F.trim(p))
    n = F.size(parts)
    enough = n >= 2
    blank = F.lit(" ")
    place = (
        F.when(n >= 3, F.array_join(F.slice(parts, F.lit(3), n), " / "))
        .when(n == 2, F.lit(""))
        .otherwise(blank)
    )
    with_city = r"(?s)^(.*),([^,]*)$"
    return F.struct(
        F.when(enough, F.get(parts, F.lit(0))).otherwise(blank).alias("date_text"),
        F.when(enough, F.get(parts, F.lit(1))).otherwise(blank).alias("time_text"),
        F.when(place.contains(","), F.trim(F.regexp_extract(place, with_city, 1)))
        .otherwise(place)
        .alias("location"),
        F.when(place.contains(","), F.trim(F.regexp_extract(place, with_city, 2)))
        .otherwise(blank)
        .alias("city"),
    )


def word_or_blank(text: Column, index: int) -> Column:
    return F.coalesce(F.get(F.split(text, " "), F.lit(index)), F.lit(" "))


def city_then_place(text: Column) -> Column:
    """`Kiel, Halle 400, Saal` -> (Kiel, `Halle 400, Saal`)."""
    parts = F.split(text, ", ", 2)
    return F.struct(
        F.get(parts, F.lit(0)).alias("city"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit(" ")).alias("location"),
    )


def bar_fields(text: Column) -> Column:
    """`Sa, 7. Dez | 20:00` -> (date, time), empty text where a part is missing."""
    parts = F.split(text, r"\|")
    return F.struct(
        F.trim(F.get(parts, F.lit(0))).alias("date_text"),
        F.coalesce(F.trim(F.get(parts, F.lit(1))), F.lit("")).alias("time_text"),
    )


def break_fields(text: Column) -> Column:
    """`Samstag, 7. Dezember 2024 ab 20:00 Uhr<br>Halle, Kiel` -> day text, place, city."""
    lines = F.split(text, "<br>")
    place = F.coalesce(F.trim(F.get(lines, F.lit(1))), F.lit(""))
    pieces = F.split(place, ",")
    return F.struct(
        F.get(F.split(F.trim(F.get(lines, F.lit(0))), ","), F.lit(1)).alias("day_text"),
        F.get(pieces, F.lit(0)).alias("location"),
        F.element_at(pieces, -1).alias("city"),
    )


def cut_more_suffix(text: Column) -> Column:
    """Drop the nine characters of a trailing ` + 3 more`."""
    return F.when(
        text.rlike(r"\s\+\s\d+\smore"), F.left(text, F.greatest(F.length(text) - 9, F.lit(0)))
    ).otherwise(text)


def inner_slice(text: Column, start: int, drop_last: int) -> Column:
    width = F.greatest(F.length(text) - start - drop_last, F.lit(0))
    return F.substring(text, F.lit(start + 1), width)


def before_dash(text: Column) -> Column:
    return F.get(F.split(text, " - "), F.lit(0))


def without_word(text: Column, word: str) -> Column:
    return F.trim(F.replace(text, F.lit(word), F.lit("")))


def path_category(url: Column) -> Column:
    """Second-last path segment of a listing address."""
    return F.try_element_at(F.split(url, "/"), F.lit(-2))
