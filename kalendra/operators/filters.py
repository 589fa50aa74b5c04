"""Row filters of the load and publish steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kalendra.functions.classify import initial_colour
from kalendra.functions.text import city_key, title_if_upper

PUBLISH_HORIZON_DAYS = 30


def with_valid_dates(df: DataFrame) -> DataFrame:
    """Both dates must parse; text dates are cast on the way."""
    cast = df
    for name in ("start_date", "end_date"):
        if dict(df.dtypes)[name] == "string":
            cast = cast.withColumn(name, F.try_to_date(name, "yyyy-MM-dd"))
    return cast.dropna(subset=["start_date", "end_date"])


def with_city_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("city", title_if_upper(city_key(F.col("city"))))


def with_valid_cities(df: DataFrame) -> DataFrame:
    city = F.col("city")
    return df.filter(
        city.isNotNull() & (F.trim(city) != "") & (city != "_") & ~city.rlike("(?i)http")
    )


def clean(df: DataFrame) -> DataFrame:
    """Events with real dates and a usable city key."""
    return with_valid_dates(with_valid_cities(with_city_keys(df)))


def still_running(df: DataFrame, asof: Column) -> DataFrame:
    return df.filter(F.col("end_date") >= asof)


def has_start_date(df: DataFrame) -> DataFrame:
    return df.filter(F.col("start_date").isNotNull())


def within_days(df: DataFrame, asof: Column, days: int) -> DataFrame:
    return df.filter(F.col("start_date").between(asof, F.date_add(asof, days)))


def until_horizon(df: DataFrame, asof: Column, days: int) -> DataFrame:
    return df.filter(F.col("start_date") <= F.date_add(asof, days))


def several_or_music(df: DataFrame) -> DataFrame:
    return df.filter((F.col("counter") > 0) | F.col("music_label"))


def mentioned_again(df: DataFrame) -> DataFrame:
    return df.filter(F.col("counter") > 1)


def noteworthy(df: DataFrame, asof: Column, days: int = PUBLISH_HORIZON_DAYS) -> DataFrame:
    """Events of the coming days that are music or share their cell, with their first colour."""
    chosen = several_or_music(within_days(has_start_date(df), asof, days))
    return chosen.withColumn("colour", initial_colour(F.col("counter")))


def publish_scope(
    df: DataFrame, city: str | None = None, without_deleted: bool = False
) -> DataFrame:
    scoped = df if city is None else df.filter(F.col("city") == city)
    return scoped.filter(F.col("colour") != 11) if without_deleted else scoped


def upcoming(df: DataFrame, now: Column, n: int = 10, tie: str = "row_seq") -> DataFrame:
    """The first n calendar entries from now on, ties in the order of `tie`; an all-day entry starts
    with its day. Entries need no numbers for this, so only n rows of each task travel."""
    return (
        df.withColumn("starts", F.coalesce("start_ts", F.col("start_day").cast("timestamp_ntz")))
        .filter(F.col("starts") >= now)
        .orderBy("starts", tie)
        .limit(n)
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame and the number of its rows (`n`), known once an action has run over the frame; the
    rows are counted as they pass, without another job."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
