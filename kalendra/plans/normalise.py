"""Raw rows of each listing site to the event table.

A normaliser takes the raw frame (columns in snake case, all text unless said) and the run date. It
is a projection, so a source costs one scan and no shuffle. Intermediate texts get columns of their
own (`_…`), so that each is worked out once per row however often it is used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendra.functions import classify, dates, describe, text, times
from kalendra.plans.sections import sectioned_items
from kalendra.schema import EVENT_SCHEMA, fill_blank

BLANK = " "
Normaliser = Callable[[DataFrame, Column], DataFrame]


def _event_columns(df: DataFrame) -> DataFrame:
    """The event columns, preceded by the order column if the source has one."""
    keep = ["row_seq"] if "row_seq" in df.columns else []
    return df.select(*keep, *[F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA.fields])


def _finish(df: DataFrame) -> DataFrame:
    return fill_blank(_event_columns(df))


def biunsinnorden(raw: DataFrame, asof: Column) -> DataFrame:
    return _finish(
        raw.withColumn("start_date", dates.date_before_clock(F.col("start_text")))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("start_time", F.coalesce(times.drop_last_four(F.col("clock")), F.lit(BLANK)))
        .withColumn("end_time", F.lit(BLANK))
        .withColumn("city", text.title_case(F.col("city")))
        .withColumn("music_label", F.lit(True))
    )


def eventbrite(raw: DataFrame, asof: Column) -> DataFrame:
    return _finish(
        raw.withColumn("_when", text.cut_more_suffix(F.col("date_and_time")))
        .withColumn("_listed", dates.relative_day(F.col("_when"), asof))
        .withColumn("_day_month", dates.listing_day_month(F.col("_listed")))
        .withColumn("start_date", dates.next_occurrence(F.col("_day_month"), asof))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("subject", F.col("title"))
        .withColumn("description", F.col("source"))
        .withColumn("start_time", times.last_five(F.col("_when")))
        .withColumn("end_time", F.lit(BLANK))
        .withColumn("category", F.col("label"))
        .withColumn("music_label", classify.music_in_label(F.col("label")))
    )


def eventim(raw: DataFrame, asof: Column) -> DataFrame:
    last_ten = F.right("_parts.date_text", F.lit(10))
    return _finish(
        raw.withColumn("_parts", text.place_date_time(F.col("location_date_time")))
        .withColumn("description", describe.text_and_source(F.col("description"), F.col("source")))
        .withColumn("location", F.col("_parts.location"))
        .withColumn("city", F.col("location"))
        .withColumn("start_time", F.col("_parts.time_text"))
        .withColumn("end_time", F.lit(BLANK))
        .withColumn("start_date", dates.dotted_date(last_ten))
        .withColumn("end_date", F.col("start_date"))
    )


def slash_listing(raw: DataFrame, asof: Column) -> DataFrame:
    """Hamburg and Schleswig-Holstein list `date / time / place, city` in one field."""
    return _finish(
        raw.withColumn("_parts", text.slash_fields(F.coalesce(F.col("info"), F.lit(BLANK))))
        .withColumn("_clock", times.clock_range(F.col("_parts.time_text")))
        .withColumn("subject", F.coalesce("title", F.lit(BLANK)))
        .withColumn("description", F.coalesce("source", F.lit(BLANK)))
        .withColumn("category", F.coalesce(F.col("category"), F.lit(BLANK)))
        .withColumn("location", F.col("_parts.location"))
        .withColumn("city", F.col("_parts.city"))
        .withColumn("start_date", dates.dotted_date(F.col("_parts.date_text")))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("start_time", F.col("_clock.start_time"))
        .withColumn("end_time", F.col("_clock.end_time"))
        .withColumn("music_label", classify.music_by_words(F.col("category")))
    )


def kiel_magazin(raw: DataFrame, asof: Column) -> DataFrame:
    return _finish(
        raw.withColumn("_parts", text.break_fields(F.col("date_html")))
        .withColumn("_split", times.date_from_clock(F.col("_parts.day_text")))
        .withColumn("_clock", times.until_range(F.col("_split.time_text")))
        .withColumn("subject", text.inner_slice(F.col("link_title"), 19, 1))
        .withColumn("description", F.col("source"))
        .withColumn("location", F.col("_parts.location"))
        .withColumn("city", text.title_case(F.col("_parts.city")))
        .withColumn("start_date", dates.full_month_date(F.col("_split.date_text")))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("start_time", F.col("_clock.start_time"))
        .withColumn("end_time", F.col("_clock.end_time"))
        .withColumn("category", F.trim("category"))
        .withColumn("music_label", F.lit(True))
    )


def kiel_sailing_city(raw: DataFrame, asof: Column) -> DataFrame:
    """`categories` is an array; the category column shows it joined."""
    first_line = F.get(F.split("time_details", "\n"), F.lit(0))
    return _finish(
        raw.withColumn("_when", F.split(dates.replace_today_word(first_line, asof), " ", 2))
        .withColumn("_clock", times.clock_range(F.get("_when", F.lit(1))))
        .withColumn("start_date", dates.dotted_date(F.get("_when", F.lit(0))))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("subject", F.col("title"))
        .withColumn("description", F.col("source"))
        .withColumn("start_time", F.col("_clock.start_time"))
        .withColumn("end_time", F.col("_clock.end_time"))
        .withColumn("city", F.lit("Kiel"))
        .withColumn("category", F.array_join("categories", ", "))
        .withColumn("music_label", classify.music_by_list(F.col("categories")))
    )


def live_gigs(raw: DataFrame, asof: Column) -> DataFrame:
    return _finish(
        raw.withColumn("subject", text.before_dash(F.col("title")))
        .withColumn("description", F.col("source"))
        .withColumn("start_time", times.first_six(F.col("clock")))
        .withColumn("end_time", F.lit(BLANK))
        .withColumn("start_date", dates.dotted_date(F.col("day_text")))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("city", text.title_case(F.col("city")))
        .withColumn("music_label", F.lit(True))
    )


def meine_stadt(raw: DataFrame, asof: Column) -> DataFrame:
    second = F.col("_second")
    without_comma = F.left(second, F.greatest(F.length(second) - 1, F.lit(0)))
    where = text.city_then_place(F.coalesce(F.col("city_location"), F.lit(BLANK)))
    return _finish(
        raw.withColumn("_when", F.coalesce(F.col("date_time"), F.lit(BLANK)))
        .withColumn("_second", F.get(F.split("_when", " "), F.lit(1)))
        .withColumn("_where", where)
        .withColumn("start_date", dates.dotted_date(without_comma))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("start_time", text.word_or_blank(F.col("_when"), 2))
        .withColumn("end_time", F.lit(BLANK))
        .withColumn("city", F.col("_where.city"))
        .withColumn("location", F.col("_where.location"))
        .withColumn("category", text.path_category(F.col("listing_url")))
        .withColumn("music_label", F.lit(True))
    )


def neumuenster(raw: DataFrame, asof: Column) -> DataFrame:
    return _finish(
        raw.withColumn("_clock", times.digits_range(F.col("clock")))
        .withColumn("start_date", dates.date_of_timestamp_text(F.col("start_text")))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("start_time", F.trim("_clock.start_time"))
        .withColumn("end_time", F.trim("_clock.end_time"))
        .withColumn("location", describe.name_and_address(F.col("place"), F.col("address")))
        .withColumn("city", F.lit("Neumünster"))
        .withColumn("category", F.lit(BLANK))
        .withColumn("music_label", F.lit(False))
    )


def rausgegangen(raw: DataFrame, asof: Column) -> DataFrame:
    day_month = dates.day_month_abbreviated(dates.second_comma_part(F.col("_parts.date_text")))
    return _finish(
        raw.withColumn("_parts", text.bar_fields(F.col("date_time")))
        .withColumn("_day_month", day_month)
        .withColumn("description", describe.source_and_price(F.col("source"), F.col("price")))
        .withColumn("start_date", dates.next_occurrence(F.col("_day_month"), asof))
        .withColumn("end_date", F.col("start_date"))
        .withColumn("start_time", F.col("_parts.time_text"))
        .withColumn("end_time", F.lit(BLANK))
        .withColumn("music_label", F.lit(True))
    )


def unser_luebeck(raw: DataFrame, asof: Column) -> DataFrame:
    """`page_id`, `day_text` (`Montag, 2. Dezember 2024`) and `programme`, one row per day."""
    day = dates.long_date(F.col("day_text"))
    base = "https://www.unser-luebeck.de/veranstaltungskalender/eventsnachtag/"
    link = F.concat(
        F.lit(base), F.year("start_date").cast("string"), F.lit("/"),
        F.month("start_date").cast("string"), F.lit("/"),
        F.dayofmonth("start_date").cast("string"),
    )
    days = raw.select("page_id", day.alias("start_date"))
    found = sectioned_items(raw, "page_id", "programme").join(days, "page_id")
    return _finish(
        found.withColumn("end_date", F.col("start_date"))
        .withColumn("start_time", F.col("time_text"))
        .withColumn("end_time", F.lit(BLANK))
        .withColumn("city", F.lit("Lübeck"))
        .withColumn("description", link)
        .withColumn("music_label", classify.music_exact(F.col("category")))
    )


def wasgeht(raw: DataFrame, asof: Column) -> DataFrame:
    """This source leaves gaps as NULL and gives no end."""
    return _event_columns(
        raw.withColumn("subject", F.col("title"))
        .withColumn("start_date", dates.iso_date(F.col("date")))
        .withColumn("start_time", times.only_with_unit(F.col("clock")))
        .withColumn("end_date", F.lit(None).cast("date"))
        .withColumn("end_time", F.lit(None).cast("string"))
        .withColumn("location", text.without_word(F.col("location"), "pin"))
        .withColumn("description", describe.append_link(F.lit(""), F.col("details_link")))
        .withColumn("music_label", classify.music_in_set(F.col("category")))
    )


def aligned_listing(raw: DataFrame, asof: Column) -> DataFrame:
    """The six columns used when two sources are compared: dates `dd.MM.yyyy`, `a - b` times, and
    the categories as description."""
    clock = times.strict_range(F.col("time"))
    keep = ["row_seq"] if "row_seq" in raw.columns else []
    return raw.select(
        *keep,
        F.col("title").alias("subject"),
        dates.dotted_date(F.col("date")).alias("start_date"),
        clock["start_time"].alias("start_time"),
        clock["end_time"].alias("end_time"),
        F.col("location"),
        F.array_join("categories", ", ").alias("description"),
    )


NORMALISERS: dict[str, Normaliser] = {
    "biunsinnorden": biunsinnorden,
    "eventbrite": eventbrite,
    "eventim": eventim,
    "hamburg": slash_listing,
    "kiel_magazin": kiel_magazin,
    "kiel_sailing_city": kiel_sailing_city,
    "live_gigs": live_gigs,
    "meine_stadt": meine_stadt,
    "neumuenster": neumuenster,
    "rausgegangen": rausgegangen,
    "sh_tourismus": slash_listing,
    "unser_luebeck": unser_luebeck,
    "wasgeht": wasgeht,
    "aligned_listing": aligned_listing,
}


def normalise(source: str, raw: DataFrame, asof: Column) -> DataFrame:
    return NORMALISERS[source](raw, asof)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All sources one below the other; columns one lacks are NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
