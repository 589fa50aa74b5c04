"""Scalar functions on literal cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kalendra.functions import classify, dates, describe, similarity, text, times

D = dt.date


def asof():
    return F.lit("2024-12-15").cast("date")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


CASES = [
    (lambda: dates.dotted_date(F.lit("7.12.2024")), D(2024, 12, 7)),
    (lambda: dates.dotted_date(F.lit("07.12.2024")), D(2024, 12, 7)),
    (lambda: dates.dotted_date(F.lit(" ")), None),
    (lambda: dates.dotted_date(F.lit("31.02.2024")), None),
    (lambda: dates.next_occurrence(F.lit("15.12."), asof()), D(2024, 12, 15)),
    (lambda: dates.next_occurrence(F.lit("14.12."), asof()), D(2025, 12, 14)),
    (lambda: dates.next_occurrence(F.lit("29.02."), asof()), None),
    (lambda: dates.next_occurrence(F.lit("1.2.3"), asof()), None),
    (lambda: dates.next_occurrence(F.lit("bald"), asof()), None),
    (lambda: dates.current_year_date(F.lit("01.01."), asof()), D(2024, 1, 1)),
    (lambda: dates.current_year_date(F.lit("01.01"), asof()), None),
    (lambda: dates.relative_day(F.lit("heute um 20:00"), asof()), "15.12."),
    (lambda: dates.relative_day(F.lit("morgen um 20:00"), asof()), "16.12."),
    (lambda: dates.listing_day_month(F.lit("Sa., 1. Mär., 20:00")), "01.03."),
    (lambda: dates.listing_day_month(F.lit("07.12. um 20:00")), "07.12."),
    (lambda: dates.full_month_date(F.lit("1. März 2025")), D(2025, 3, 1)),
    (lambda: dates.long_date(F.lit("Sonntag, 1. Dezember 2024")), D(2024, 12, 1)),
    (lambda: dates.month_number(F.lit("Dez.")), "12"),
    (lambda: dates.month_number(F.lit("Mai")), "05"),
    (lambda: dates.day_range_text(asof(), 10), "15.12.2024 - 25.12.2024"),
    (lambda: times.clock_range(F.lit("19:00 - 21:00 Uhr"))["end_time"], "21:00"),
    (lambda: times.clock_range(F.lit("19:00 Uhr"))["end_time"], " "),
    (lambda: times.digits_range(F.lit("von 19:00 bis 21:00 Uhr"))["start_time"], "19:00"),
    (lambda: times.only_with_unit(F.lit("19:00")), None),
    (lambda: times.normalise_clock(F.lit("9:00")), "09:00"),
    (lambda: times.normalise_clock(F.lit(" ")), "00:00 "),
    (lambda: times.normalise_clock(F.lit("19:00:00")), "19:00:00"),
    (lambda: text.title_case(F.lit("ST.PETER-ORDING")), "St.Peter-Ording"),
    (lambda: text.title_case(F.lit("3RD o'neil")), "3Rd O'Neil"),
    (lambda: text.title_if_upper(F.lit("Kiel")), "Kiel"),
    (lambda: text.title_if_upper(F.lit("123")), "123"),
    (lambda: text.city_key(F.lit("Lübeck - Travemünde")), "Luebeck"),
    (lambda: text.city_key(F.lit("Bremen/Hamburg")), "Hamburg"),
    (lambda: text.city_key(F.lit("Groß Grönau (SH)")), "Gross_Groenau_SH"),
    (lambda: text.city_key(F.lit("inselweit")), "Amrum_inselweit"),
    (lambda: text.alnum_key(F.lit("Größe 10!")), "gre10"),
    (lambda: text.normalised(F.lit("Rock & Pop, Kiel!"), "kiel"), "rock & pop"),
    (lambda: text.token_text(F.lit("b a b")), "a b"),
    (lambda: text.token_text(F.lit("")), ""),
    (lambda: text.slash_fields(F.lit("a / b / c / d, e, Kiel"))["location"], "c / d, e"),
    (lambda: text.slash_fields(F.lit(" "))["city"], " "),
    (lambda: text.cut_more_suffix(F.lit("20:00 + 3 more")), "20:00"),
    (lambda: text.path_category(F.lit("https://x/kiel/konzerte/alle")), "konzerte"),
    (lambda: describe.name_and_address(F.lit(None).cast("string"), F.lit("a")), "nan | a"),
    (lambda: describe.source_and_price(F.lit("s"), F.lit(None).cast("string")), None),
    (lambda: classify.music_by_words(F.lit("Rock Konzert")), True),
    (lambda: classify.music_by_words(F.lit(None).cast("string")), False),
    (lambda: classify.colour_by_status(F.lit("deleted"), F.lit(True)), 11),
    (lambda: similarity.lcs_length(F.lit("kitten"), F.lit("sitting")), 4),
    (lambda: similarity.ratio(F.lit(""), F.lit("")), 1.0),
    (lambda: similarity.ratio(F.lit(None).cast("string"), F.lit("a")), 0.0),
    (lambda: similarity.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")), 0.0),
    (lambda: similarity.tokens_match(F.lit("haus"), F.lit("maus")), True),
    (lambda: similarity.ratio_above(F.lit("a" * 10), F.lit("a" * 9 + "b"), 10), False),
    (lambda: similarity.ratio_above(F.lit("a" * 11), F.lit("a" * 10 + "b"), 10), True),
]


@pytest.mark.parametrize("index", range(len(CASES)))
def test_case(spark, index):
    make, expected = CASES[index]
    assert value(spark, make()) == expected


def test_word_set_equals_token_set_of_normalised(spark):
    texts = ["Größe: 10 & mehr", "a_b c-d  a_b", "", "!!", "Ärger\tim Büro\n(2)"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for row in df.select(
        text.word_set(F.col("x")).alias("one"),
        text.token_set(text.normalised(F.col("x"))).alias("two"),
    ).collect():
        assert row.one == row.two
