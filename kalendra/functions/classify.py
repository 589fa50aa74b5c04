"""Music flags and calendar colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category words that mean music, matched case-sensitively.
MUSIC_WORDS = [
    "Konzert", "konzert", "Musik", "musik", "Party", "party", "Tanz", "tanz",
    "Festival", "festival", "Musical", "musical", "Jazz", "jazz", "Blues", "blues",
    "Country", "country", "Folk", "folk", "Rock", "rock", "Pop", "pop",
    "Klassik", "klassik", "Gospel", "gospel", "Chöre", "chöre",
]
NIGHTLIFE = "Nachtleben"
STAGE_CATEGORIES = ["konzert", "theater"]

# Calendar colour numbers.
INITIAL, MULTIPLE, CHANGED, NEW, MUSIC, UNCHANGED, DELETED = 1, 4, 5, 7, 9, 10, 11


def music_by_words(category: Column, words: list[str] = MUSIC_WORDS) -> Column:
    return F.coalesce(category.rlike("|".join(words)), F.lit(False))


def music_by_list(categories: Column) -> Column:
    pattern = "|".join([NIGHTLIFE] + MUSIC_WORDS)
    return F.coalesce(F.exists(categories, lambda c: c.rlike(pattern)), F.lit(False))


def music_exact(category: Column) -> Column:
    return F.coalesce(category == "Musik", F.lit(False))


def music_in_set(category: Column) -> Column:
    return F.coalesce(category.isin(STAGE_CATEGORIES), F.lit(False))


def music_in_label(label: Column) -> Column:
    return F.coalesce(F.lower(label).contains("music"), F.lit(False))


def colour_by_status(status: Column, music: Column | None = None) -> Column:
    colour = F.when(status == "changed", F.lit(CHANGED)).when(status == "deleted", F.lit(DELETED))
    if music is not None:
        colour = colour.when(music, F.lit(MUSIC))
    return colour.otherwise(F.lit(UNCHANGED))


def initial_colour(counter: Column) -> Column:
    return F.when(counter > 0, F.lit(MULTIPLE)).otherwise(F.lit(INITIAL))
