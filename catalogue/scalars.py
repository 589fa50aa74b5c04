"""Date, time, text and classification functions on texts rendered from the test tables.

The texts are written in the formats of the listing sites; the SQL often works from the underlying
date instead of parsing, which checks the parsing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.dedup import city_key_sql, title_if_upper_sql, title_sql
from catalogue.registry import asof, from_sql, query, table, with_views
from catalogue.similar import tokens_sql
from catalogue.views import case_of
from kalendra.functions import classify, dates, describe, text, times

DAY, MONTH, YEAR = (f"cast({part}(o_orderdate) as string)" for part in ("day", "month", "year"))
DD, MM = f"lpad({DAY}, 2, '0')", f"lpad({MONTH}, 2, '0')"
HM = "concat(lpad(cast(hour(ts) as string), 2, '0'), ':', lpad(cast(minute(ts) as string), 2, '0'))"
HM_END = (
    "concat(lpad(cast((hour(ts) + 2) % 24 as string), 2, '0'), ':', "
    "lpad(cast(minute(ts) as string), 2, '0'))"
)
ABBREVIATION = case_of("month(o_orderdate)", dates.MONTH_ABBREVIATIONS)
MONTH_NAME = case_of("month(o_orderdate)", dates.MONTH_NAMES)


def orders_text(expression: str) -> str:
    return (
        "select o_orderkey as row_seq, o_orderstatus as st, cast(o_orderdate as date) as d, "
        f"{expression} as x from {{orders}}"
    )


def events_text(expression: str) -> str:
    return f"select event_id as row_seq, event_type as kind, {expression} as x from {{events}}"


def scalar(name: str, view: str, oracle: str, **columns) -> None:
    """Register `row_seq` and the given columns over the text `x` of a view."""

    def run(spark, sf):
        return from_sql(spark, sf, view).select(
            "row_seq", *[make(F.col("x")).alias(alias) for alias, make in columns.items()]
        )

    query(name, with_views(f"select row_seq, {oracle} from s", s=view))(run)


# ---- dates -------------------------------------------------------------------------------------

scalar(
    "date_dotted",
    orders_text(
        f"case o_orderstatus when 'F' then concat({DAY}, '.', {MONTH}, '.', {YEAR}) "
        f"when 'O' then concat({DD}, '.', {MM}, '.', {YEAR}) else ' ' end"
    ),
    "case when st in ('F', 'O') then d end as day",
    day=dates.dotted_date,
)
NEXT = (
    "make_date(2024 + case when month(d) * 100 + day(d) < 110 then 1 else 0 end, month(d), day(d))"
)
scalar(
    "date_next_occurrence",
    orders_text(f"case o_orderstatus when 'P' then 'bald' else concat({DD}, '.', {MM}, '.') end"),
    f"case when st <> 'P' then {NEXT} end as day",
    day=lambda x: dates.next_occurrence(x, asof()),
)
scalar(
    "date_current_year",
    orders_text(
        f"case o_orderstatus when 'P' then concat('.', {MM}, '.') when 'F' then {DAY} "
        f"else concat({DAY}, '.', {MONTH}, '.') end"
    ),
    "case when st = 'O' then make_date(2024, month(d), day(d)) end as day",
    day=lambda x: dates.current_year_date(x, asof()),
)
scalar(
    "date_relative",
    orders_text(
        f"case o_orderstatus when 'P' then 'heute um 20:00' when 'F' then 'morgen, 19:00' "
        f"else concat({DD}, '.', {MM}, '. um 20:00') end"
    ),
    "case st when 'P' then '10.01.' when 'F' then '11.01.' else x end as listed",
    listed=lambda x: dates.relative_day(x, asof()),
)
scalar(
    "date_today_word",
    orders_text(
        f"case o_orderstatus when 'P' then 'Heute 20:00 Uhr' else concat({DD}, '.', {MM}, '.', {YEAR}, ' 20:00') end"
    ),
    "case when st = 'P' then '10.01.2024 20:00 Uhr' else x end as listed",
    listed=lambda x: dates.replace_today_word(x, asof()),
)
scalar(
    "date_month_abbreviation",
    orders_text(
        f"case o_orderstatus when 'P' then concat({DAY}, '. Unk.') when 'F' "
        f"then concat({DAY}, '. ', {ABBREVIATION}, '.') else concat({DAY}, ' ', {ABBREVIATION}) end"
    ),
    "case when st <> 'P' then strftime(d, '%d.%m.') end as day_month",
    day_month=dates.day_month_abbreviated,
)
scalar(
    "date_full_month",
    orders_text(
        f"case o_orderstatus when 'P' then concat({DAY}, '. Brumaire ', {YEAR}) "
        f"else concat({DAY}, '. ', {MONTH_NAME}, ' ', {YEAR}) end"
    ),
    "case when st <> 'P' then d end as day",
    day=dates.full_month_date,
)
scalar(
    "date_long",
    orders_text(
        f"concat(case o_orderstatus when 'P' then 'Samstag, ' when 'F' then 'Montag, ' else '' end, "
        f"{DD}, '. ', {MONTH_NAME}, ' ', {YEAR})"
    ),
    "d as day",
    day=dates.long_date,
)
scalar(
    "date_listing_part",
    orders_text(
        f"case o_orderstatus when 'P' then concat('Sa., ', {DAY}, '. ', {ABBREVIATION}, '., 20:00') "
        f"when 'F' then concat({DD}, '.', {MM}, '. um 20:00') else 'demnächst, 20:00' end"
    ),
    "case when st in ('P', 'F') then strftime(d, '%d.%m.') else x end as day_month",
    day_month=dates.listing_day_month,
)
scalar(
    "date_second_part",
    orders_text(
        f"case o_orderstatus when 'P' then 'heute' else concat('Samstag, ', {DAY}, '. ', {ABBREVIATION}) end"
    ),
    "case when st = 'P' then ' ' else trim(split_part(x, ',', 2)) end as part",
    part=dates.second_comma_part,
)
scalar(
    "date_of_timestamp",
    orders_text(
        f"case o_orderstatus when 'P' then concat({YEAR}, '-', {MM}, '-', {DD}) "
        f"when 'F' then concat({YEAR}, '-', {MM}, '-', {DD}, 'T20:00:00+01:00') else 'offen' end"
    ),
    "case when st in ('P', 'F') then d end as day",
    day=dates.date_of_timestamp_text,
)
scalar(
    "date_before_clock",
    orders_text(f"concat({YEAR}, '-', {MM}, '-', {DD}, 'T20:00')"),
    "d as day",
    day=dates.date_before_clock,
)


@query(
    "date_run_texts",
    "select o_orderkey as row_seq, strftime(o_orderdate, '%d.%m.%Y') || ' - ' || "
    "strftime(o_orderdate + interval 10 day, '%d.%m.%Y') as days, "
    "strftime(o_orderdate, '%d-%m-%Y') as load_date, o_orderpriority || chr(10) || chr(10) || "
    "'Event created on: ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as stamped from orders",
)
def date_run_texts(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_seq"),
        dates.day_range_text(day.cast("date"), 10).alias("days"),
        dates.load_date_text(day.cast("date")).alias("load_date"),
        describe.creation_stamp(F.col("o_orderpriority"), day).alias("stamped"),
    )


# ---- times -------------------------------------------------------------------------------------


def both(make):
    return {
        "start_time": lambda x: make(x)["start_time"],
        "end_time": lambda x: make(x)["end_time"],
    }


scalar(
    "time_clock_range",
    events_text(
        f"case event_type when 'click' then concat({HM}, ' - ', {HM_END}, ' Uhr') "
        f"when 'error' then null else concat({HM}, ' Uhr') end"
    ),
    "case when kind = 'error' then null else left(x, 5) end as start_time, "
    "case when kind = 'click' then substr(x, 9, 5) when kind <> 'error' then ' ' end as end_time",
    **both(times.clock_range),
)
scalar(
    "time_until_range",
    events_text(
        f"case event_type when 'click' then concat({HM}, ' bis ', {HM_END}) else {HM} end"
    ),
    "left(x, 5) as start_time, case when kind = 'click' then right(x, 5) end as end_time",
    **both(times.until_range),
)
scalar(
    "time_digits_range",
    events_text(
        f"case event_type when 'click' then concat('von ', {HM}, ' bis ', {HM_END}, ' Uhr') "
        f"when 'error' then null else concat('ab ', {HM}, ' Uhr') end"
    ),
    "regexp_extract(x, '[0-9]+:[0-9]+') as start_time, "
    "case when kind = 'click' then regexp_extract_all(x, '[0-9]+:[0-9]+')[2] end as end_time",
    **both(times.digits_range),
)
scalar(
    "time_strict_range",
    events_text(
        f"case event_type when 'click' then concat({HM}, '-', {HM_END}) "
        f"when 'view' then concat('ca. ', {HM}, '   - ', {HM_END}, ' Uhr') else {HM} end"
    ),
    "case when kind in ('click', 'view') then regexp_extract_all(x, '[0-9]+:[0-9]+')[1] end "
    "as start_time, case when kind in ('click', 'view') "
    "then regexp_extract_all(x, '[0-9]+:[0-9]+')[2] end as end_time",
    **both(times.strict_range),
)
scalar(
    "time_cuts",
    events_text(f"concat('   ', {HM}, ' Uhr')"),
    "right(x, 5) as last_five, left(x, len(x) - 4) as no_unit, trim(left(x, 6)) as first_six",
    last_five=times.last_five,
    no_unit=times.drop_last_four,
    first_six=times.first_six,
)
scalar(
    "time_with_unit",
    events_text(
        f"case event_type when 'error' then null when 'click' then {HM} else concat({HM}, ' Uhr') end"
    ),
    "case when kind not in ('error', 'click') then left(x, 5) end as clock",
    clock=times.only_with_unit,
)
scalar(
    "time_from_split",
    events_text(
        f"case event_type when 'click' then '7. Dezember 2024' "
        f"else concat('7. Dezember 2024 ab ', {HM}, ' Uhr') end"
    ),
    "'7. Dezember 2024' as date_text, "
    "case when kind = 'click' then ' ' else substr(x, 21, 5) end as time_text",
    date_text=lambda x: times.date_from_clock(x)["date_text"],
    time_text=lambda x: times.date_from_clock(x)["time_text"],
)
scalar(
    "time_normalise",
    events_text(
        "case event_type when 'click' then concat(cast(hour(ts) as string), ':00') "
        f"when 'error' then null when 'view' then ' ' when 'signup' then '0000' else {HM} end"
    ),
    "case kind when 'view' then '00:00 ' when 'signup' then '00:000' "
    "when 'click' then case when length(x) < 5 then '0' || x else x end else x end as clock",
    clock=times.normalise_clock,
)

# ---- text --------------------------------------------------------------------------------------

scalar(
    "title_case",
    "select doc_id as row_seq, text as x from {documents}",
    # A word that begins with ß begins with Ss in title case; the SQL engine has a capital ß instead.
    f"replace({title_sql('x')}, 'ẞ', 'Ss') as title",
    title=text.title_case,
)
scalar(
    "title_if_upper",
    "select doc_id as row_seq, case when doc_id % 3 = 0 then upper(source) else source end as x "
    "from {documents}",
    f"{title_if_upper_sql('x')} as title",
    title=text.title_if_upper,
)
scalar(
    "city_key",
    "select doc_id as row_seq, text as x from {documents}",
    f"{city_key_sql('x')} as city",
    city=text.city_key,
)
scalar(
    "alnum_key",
    "select doc_id as row_seq, text as x from {documents}",
    "lower(regexp_replace(x, '[^a-zA-Z0-9]', '', 'g')) as k",
    k=text.alnum_key,
)
NORMAL = (
    "trim(regexp_replace(regexp_replace(lower(x), '[^\\p{L}\\p{N}_\\s&]', ' ', 'g'), "
    "'\\s+', ' ', 'g'))"
)
scalar(
    "text_norm",
    "select doc_id as row_seq, text as x from {documents}",
    f"{NORMAL} as clean, case when ends_with({NORMAL}, 'on') "
    f"then trim(left({NORMAL}, len({NORMAL}) - 2)) else {NORMAL} end as cut",
    clean=text.normalised,
    cut=lambda x: text.normalised(x, "on"),
)
scalar(
    "token_set",
    "select doc_id as row_seq, text as x from {documents}",
    f"array_to_string({tokens_sql('x')}, ' ') as tokens",
    tokens=lambda x: text.token_text(text.normalised(x)),
)
PLACES = (
    "select s_suppkey as row_seq, s_suppkey % 4 as kind, concat(s_name, case s_suppkey % 4 "
    "when 0 then ', Sa. 07.12.2024, 20:00' when 1 then ' , So. 08.12.2024' "
    "when 2 then ', a, b, c' else ' ' end) as x from {supplier}"
)
scalar(
    "unpack_place_date_time",
    PLACES,
    "trim(case when kind in (0, 1) then split_part(x, ',', 1) else x end) as location, "
    "case when kind in (0, 1) then trim(split_part(x, ',', 2)) else ' ' end as date_text, "
    "case when kind = 0 then trim(split_part(x, ',', 3)) else ' ' end as time_text",
    location=lambda x: text.place_date_time(x)["location"],
    date_text=lambda x: text.place_date_time(x)["date_text"],
    time_text=lambda x: text.place_date_time(x)["time_text"],
)
SLASHED = (
    "select c_custkey as row_seq, c_custkey % 4 as kind, concat('07.12.2024 ', case c_custkey % 4 "
    "when 0 then concat('/ 20:00 Uhr / ', c_name, ' / Saal, ', c_mktsegment, ', Kiel') "
    "when 1 then concat('/ 19:00 - 21:00 Uhr / ', c_name) when 2 then '/ 20:00 Uhr' else '' end) "
    "as x from {customer}"
)
SLASH_NAMES = ("date_text", "time_text", "location", "city")
scalar(
    "unpack_slashes",
    SLASHED,
    "case when kind < 3 then '07.12.2024' else ' ' end as date_text, "
    "case when kind < 3 then trim(split_part(x, '/', 2)) else ' ' end as time_text, "
    "case kind when 0 then regexp_replace(regexp_extract(x, '^[^/]*/[^/]*/ *(.*),', 1), ' */ *', ' / ', 'g') "
    "when 1 then trim(split_part(x, '/', 3)) when 2 then '' else ' ' end as location, "
    "case when kind = 0 then 'Kiel' else ' ' end as city",
    **{n: (lambda x, n=n: text.slash_fields(x)[n]) for n in SLASH_NAMES},
)
WORDS = (
    "select c_custkey as row_seq, c_custkey % 3 as kind, case c_custkey % 3 "
    "when 0 then concat('Sa. 07.12.2024, 20:00 ', c_name) when 1 then 'Sa. 07.12.2024,' "
    "else 'bald' end as x from {customer}"
)
scalar(
    "unpack_words",
    WORDS,
    "case when kind < 2 then '07.12.2024,' else ' ' end as second, "
    "case when kind = 0 then '20:00' else ' ' end as third",
    second=lambda x: text.word_or_blank(x, 1),
    third=lambda x: text.word_or_blank(x, 2),
)
scalar(
    "unpack_city_place",
    "select c_custkey as row_seq, c_custkey % 2 as kind, case c_custkey % 2 when 0 "
    "then concat('Kiel, ', c_name, ', Saal') else c_name end as x from {customer}",
    "split_part(x, ', ', 1) as city, case when kind = 0 then substr(x, 7) else ' ' end as location",
    city=lambda x: text.city_then_place(x)["city"],
    location=lambda x: text.city_then_place(x)["location"],
)
scalar(
    "unpack_bar",
    f"select event_id as row_seq, event_type as kind, case when event_type = 'error' "
    f"then 'Sa, 7. Dez' else concat('Sa, 7. Dez | ', {HM}) end as x from {{events}}",
    "'Sa, 7. Dez' as date_text, case when kind = 'error' then '' else right(x, 5) end as time_text",
    date_text=lambda x: text.bar_fields(x)["date_text"],
    time_text=lambda x: text.bar_fields(x)["time_text"],
)
scalar(
    "unpack_break",
    "select c_custkey as row_seq, c_custkey % 2 as kind, case c_custkey % 2 when 0 "
    "then concat('Samstag, 7. Dezember 2024 ab 20:00 Uhr<br> ', c_name, ', Saal,KIEL') "
    "else 'Samstag, 7. Dezember 2024' end as x from {customer}",
    "case when kind = 0 then ' 7. Dezember 2024 ab 20:00 Uhr' else ' 7. Dezember 2024' end as day_text, "
    "case when kind = 0 then regexp_extract(x, '<br> ([^,]*)', 1) else '' end as location, "
    "case when kind = 0 then 'KIEL' else '' end as city",
    **{n: (lambda x, n=n: text.break_fields(x)[n]) for n in ("day_text", "location", "city")},
)
scalar(
    "cut_more_suffix",
    "select l_orderkey * 10 + l_linenumber as row_seq, concat(l_returnflag, ' Sa., 7. Dez., 20:00', "
    "case when l_linestatus = 'F' then concat(' + ', cast(l_linenumber as string), ' more') "
    "else '' end) as x from {lineitem}",
    "left(x, 21) as listed",
    listed=text.cut_more_suffix,
)
scalar(
    "slices",
    "select c_custkey as row_seq, concat('Link to the event: ', c_name, ' - Tour)') as x from {customer}",
    "substr(x, 20, len(x) - 20) as inside, split_part(x, ' - ', 1) as before_dash, "
    "trim(replace(x, 'event', '')) as without",
    inside=lambda x: text.inner_slice(x, 19, 1),
    before_dash=text.before_dash,
    without=lambda x: text.without_word(x, "event"),
)
scalar(
    "path_category",
    "select page_id as row_seq, url as x from {pages}",
    "list_extract(string_split(x, '/'), -2) as category",
    category=text.path_category,
)


@query(
    "describe_parts",
    """
    select p_partkey as row_seq, p_name || ' , Preis: ' || p_brand as priced,
           p_name || ' ' || p_type as sourced,
           p_name || coalesce(case when p_size % 2 = 0 then p_type end, '') as linked,
           coalesce(case when p_size % 3 = 0 then p_name end, 'nan') || ' | ' || p_brand as addressed,
           'Ladedatum: 10-01-2024, ' || p_type || ', ' || p_name || ', ' || p_brand
             || case when p_size > 25 then ' Musik' else '' end as banner,
           case when p_size > 1 then 'This event has been mentioned ' || p_size
             || ' times in our database.' || chr(10) || p_name else p_name end as counted
    from part
    """,
)
def describe_parts(spark, sf):
    c = F.col
    return table(spark, sf, "part").select(
        c("p_partkey").alias("row_seq"),
        describe.source_and_price(c("p_name"), c("p_brand")).alias("priced"),
        describe.text_and_source(c("p_name"), c("p_type")).alias("sourced"),
        describe.append_link(c("p_name"), F.when(c("p_size") % 2 == 0, c("p_type"))).alias("linked"),
        describe.name_and_address(F.when(c("p_size") % 3 == 0, c("p_name")), c("p_brand")).alias(
            "addressed"
        ),
        describe.load_banner(asof(), c("p_type"), c("p_name"), c("p_brand"), c("p_size") > 25).alias(
            "banner"
        ),
        describe.mention_count(c("p_size"), c("p_name")).alias("counted"),
    )


# ---- classes -----------------------------------------------------------------------------------

CATEGORY = (
    "case p_size % 6 when 0 then concat('Konzert - ', p_type) when 1 then 'Rockmusik' "
    "when 2 then 'musikfrei' when 3 then 'MUSIC & Dance' when 4 then 'theater' else p_type end"
)
WORD_PATTERN = "|".join(classify.MUSIC_WORDS)


@query(
    "music_flags",
    f"""
    select row_seq, regexp_matches(c, '{WORD_PATTERN}') as by_words,
           regexp_matches(c || '~Nachtleben' || c, '{WORD_PATTERN}|{classify.NIGHTLIFE}') as by_list,
           c = 'Musik' as exact, c in ('konzert', 'theater') as in_set,
           contains(lower(c), 'music') as in_label
    from (select p_partkey as row_seq, {CATEGORY} as c from part)
    """,
)
def music_flags(spark, sf):
    c = F.col("c")
    return (
        table(spark, sf, "part")
        .select(F.col("p_partkey").alias("row_seq"), F.expr(CATEGORY).alias("c"))
        .select(
            "row_seq",
            classify.music_by_words(c).alias("by_words"),
            classify.music_by_list(F.array(c, F.lit("Nachtleben"))).alias("by_list"),
            classify.music_exact(c).alias("exact"),
            classify.music_in_set(c).alias("in_set"),
            classify.music_in_label(c).alias("in_label"),
        )
    )


@query(
    "colours",
    """
    select o_orderkey as row_seq,
           cast(case o_orderstatus when 'F' then 5 when 'O' then 11
                else case when o_totalprice > 200000 then 9 else 10 end end as integer) as with_music,
           cast(case o_orderstatus when 'F' then 5 when 'O' then 11 else 10 end as integer) as plain,
           cast(case when o_custkey % 4 > 0 then 4 else 1 end as integer) as initial
    from orders
    """,
)
def colours(spark, sf):
    status = F.expr("case o_orderstatus when 'F' then 'changed' when 'O' then 'deleted' else 'unchanged' end")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_seq"),
        classify.colour_by_status(status, F.col("o_totalprice") > 200000).alias("with_music"),
        classify.colour_by_status(status).alias("plain"),
        classify.initial_colour(F.col("o_custkey") % 4).alias("initial"),
    )
