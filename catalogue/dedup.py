"""Exact duplicates, group sizes, the co-location roll-up and the load filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import asof, from_sql, query, with_views
from catalogue.views import EV_NEW, EV_OLD
from kalendra.operators import dedup, filters

EVENT = "subject, start_date, end_date, start_time, end_time, location, city, description, category, music_label"
TODAY = "date '2024-01-10'"


def first_per(keys: str, source: str) -> str:
    return (
        f"select row_seq, {EVENT} from {source} "
        f"qualify row_number() over (partition by {keys} order by row_seq) = 1"
    )


KEYS_1 = "subject, start_date, start_time, end_time, city"
KEYS_2 = "start_date, start_time, end_time, location, city"
EXACT_2 = first_per(KEYS_2, f"({first_per(KEYS_1, 'ev_new')})")


@query("dedup_exact_event", with_views(first_per(KEYS_1, "ev_new"), ev_new=EV_NEW))
def dedup_exact_event(spark, sf):
    return dedup.drop_exact(from_sql(spark, sf, EV_NEW), dedup.SAME_EVENT_KEYS)


@query("dedup_exact_slot", with_views(EXACT_2, ev_new=EV_NEW))
def dedup_exact_slot(spark, sf):
    return dedup.drop_exact(dedup_exact_event(spark, sf), dedup.SAME_SLOT_KEYS)


@query(
    "group_size",
    with_views(
        """
        select row_seq, case when start_time is null or city is null then 0
               else count(*) over (partition by start_date, start_time, location, city) - 1
               end as counter
        from ev_new
        """,
        ev_new=EV_NEW,
    ),
)
def group_size(spark, sf):
    return dedup.with_extra_count(from_sql(spark, sf, EV_NEW)).select("row_seq", "counter")


@query(
    "group_size_incl",
    with_views(
        """
        select row_seq, case when start_time is null then null
               else count(*) over (partition by start_date, start_time, location)
               end as group_size
        from ev_new
        """,
        ev_new=EV_NEW,
    ),
)
def group_size_incl(spark, sf):
    return dedup.with_group_size(from_sql(spark, sf, EV_NEW), dedup.MENTION_KEYS).select(
        "row_seq", "group_size"
    )


def collapsed(source: str) -> str:
    """SQL text of the co-location roll-up."""
    return f"""
    select min(row_seq) as row_seq, arg_min(struct_pack(v := subject), row_seq).v as subject,
           start_date, start_time, location, city,
           arg_min(struct_pack(v := end_date), row_seq).v as end_date,
           arg_min(struct_pack(v := end_time), row_seq).v as end_time,
           arg_min(struct_pack(v := category), row_seq).v as category,
           arg_min(struct_pack(v := music_label), row_seq).v as music_label,
           case when count(*) = 1 then arg_min(struct_pack(v := description), row_seq).v
                else concat(count(*) - 1,
                     ' event(s) found at the same time/location. Please check the following:', chr(10),
                     string_agg(concat('Event ', coalesce(subject, 'None'), ': ',
                                       coalesce(description, 'None')), chr(10) order by row_seq)
                       filter (where rn > 1),
                     chr(10), coalesce(arg_min(struct_pack(v := description), row_seq).v, 'None'))
                end as description,
           cast(count(*) - 1 as integer) as counter
    from (select *, row_number() over (partition by start_date, start_time, location, city
                                       order by row_seq) as rn
          from {source}
          where start_date is not null and start_time is not null and location is not null
            and city is not null)
    group by start_date, start_time, location, city
    """


NOTEWORTHY = """
    select *, cast(case when counter > 0 then 4 else 1 end as integer) as colour from {source}
    where start_date between date '2024-01-10' and date '2024-02-09'
      and (counter > 0 or music_label)
"""


@query("collapse_colocated", with_views(collapsed("ev_new"), ev_new=EV_NEW))
def collapse_colocated(spark, sf):
    return dedup.collapse_colocated(from_sql(spark, sf, EV_NEW))


@query(
    "colocated_members",
    with_views(
        """
        select row_seq, cast(count(*) over w - 1 as integer) as counter,
               min(row_seq) over w as first_seq
        from ev_new where start_time is not null and city is not null
        window w as (partition by start_date, start_time, location, city)
        """,
        ev_new=EV_NEW,
    ),
)
def colocated_members(spark, sf):
    return dedup.colocated_members(from_sql(spark, sf, EV_NEW)).select(
        "row_seq", "counter", "first_seq"
    )


MENTIONS = f"""
    select row_seq, subject, start_date, end_date, start_time, end_time, location, city, category,
           music_label,
           case when counter > 1
                then concat('This event has been mentioned ', counter,
                            ' times in our database.', chr(10), coalesce(description, 'nan'))
                else description end as description,
           counter
    from (select *, case when start_time is not null
                         then count(*) over (partition by start_date, start_time, location)
                    end as counter
          from ev_new)
    qualify row_number() over (partition by start_date, start_time, location order by row_seq) = 1
"""


@query("mention_counter", with_views(MENTIONS, ev_new=EV_NEW))
def mention_counter(spark, sf):
    return dedup.mention_counter(from_sql(spark, sf, EV_NEW))


@query(
    "mentioned_again",
    with_views(f"select * from ({MENTIONS}) where counter > 1", ev_new=EV_NEW),
)
def mentioned_again(spark, sf):
    return filters.mentioned_again(mention_counter(spark, sf))


@query(
    "noteworthy",
    with_views(
        NOTEWORTHY.format(source="cells"),
        ev_new=EV_NEW,
        cells=collapsed("ev_new"),
    ),
)
def noteworthy(spark, sf):
    return filters.noteworthy(collapse_colocated(spark, sf), asof())


@query(
    "value_counts",
    with_views(
        f"select counter, count(*) as n from ({collapsed('ev_new')}) group by counter",
        ev_new=EV_NEW,
    ),
)
def value_counts(spark, sf):
    return filters.value_counts(collapse_colocated(spark, sf), "counter")


@query(
    "still_running",
    with_views(f"select row_seq, {EVENT} from ev_new where end_date >= {TODAY}", ev_new=EV_NEW),
)
def still_running(spark, sf):
    return filters.still_running(from_sql(spark, sf, EV_NEW), asof())


@query(
    "harvest_horizon",
    with_views(
        f"select row_seq, start_date from ev_new where start_date <= {TODAY} + interval 10 day",
        ev_new=EV_NEW,
    ),
)
def harvest_horizon(spark, sf):
    return filters.until_horizon(from_sql(spark, sf, EV_NEW), asof(), 10).select(
        "row_seq", "start_date"
    )


# Order dates and supplier names as they would come from a CSV drop: some dates and cities unusable.
LOADED = """
select o.o_orderkey as row_seq, c.c_name as subject,
       case when o.o_orderpriority = '5-LOW' then ' '
            else cast(cast(o.o_orderdate as date) as string) end as start_date,
       case when o.o_orderstatus = 'P' then 'n/a'
            else cast(cast(o.o_orderdate as date) as string) end as end_date,
       case c.c_mktsegment when 'BUILDING' then 'Lübeck - Travemünde, SH' when 'MACHINERY' then '_'
            when 'HOUSEHOLD' then 'https://kiel.example' when 'FURNITURE' then 'inselweit'
            else concat('ST.PETER-ORDING ', upper(n.n_name)) end as city
from {orders} o join {customer} c on c.c_custkey = o.o_custkey
join {nation} n on n.n_nationkey = c.c_nationkey
"""

UMLAUTS = "replace(" * 7 + "{x}" + "".join(
    f", '{a}', '{b}')"
    for a, b in (
        ("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss"),
    )
)
SPELLED = "regexp_replace(replace(" + UMLAUTS + ", ' ', '_'), '[/.,()-]', '', 'g')"


def city_key_sql(column: str) -> str:
    key = SPELLED.format(x=column)
    folds = " ".join(
        f"when contains({key}, '{t}') then '{t}'"
        for t in ("Hamburg", "Luebeck", "Norderstedt", "Hannover", "Bremen", "Braunschweig")
    )
    return f"case {folds} when {key} = 'inselweit' then 'Amrum_inselweit' else {key} end"


def title_sql(column: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({column}, '\\p{{L}}+|[^\\p{{L}}]+'), "
        "lambda s: upper(s[1]) || lower(s[2:])), '')"
    )


def title_if_upper_sql(column: str) -> str:
    return (
        f"case when {column} = upper({column}) and {column} <> lower({column}) "
        f"then {title_sql(column)} else {column} end"
    )


CLEAN = f"""
select row_seq, subject, cast(start_date as date) as start_date, cast(end_date as date) as end_date,
       city
from (select row_seq, subject, start_date, end_date, {title_if_upper_sql('k')} as city
      from (select *, {city_key_sql('city')} as k from loaded))
where try_cast(start_date as date) is not null and try_cast(end_date as date) is not null
  and trim(city) <> '' and city <> '_' and not contains(lower(city), 'http')
"""


@query("clean_load", with_views(CLEAN, loaded=LOADED))
def clean_load(spark, sf):
    return filters.clean(from_sql(spark, sf, LOADED))


@query(
    "distinct_cities",
    with_views(
        "select distinct city from ev_new union select distinct city from ev_old",
        ev_new=EV_NEW,
        ev_old=EV_OLD,
    ),
)
def distinct_cities(spark, sf):
    new, old = from_sql(spark, sf, EV_NEW), from_sql(spark, sf, EV_OLD)
    return new.select("city").union(old.select("city")).distinct()


@query(
    "union_sources",
    with_views(
        """
        select category, count(*) as n, count(music_label) as labelled from
          (select category, music_label from ev_new
           union all by name select category from ev_old)
        group by category
        """,
        ev_new=EV_NEW,
        ev_old=EV_OLD,
    ),
)
def union_sources(spark, sf):
    from kalendra.plans.normalise import union_sources as union_all

    frames = [from_sql(spark, sf, EV_NEW), from_sql(spark, sf, EV_OLD).drop("music_label")]
    return (
        union_all(frames)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"), F.count("music_label").alias("labelled"))
    )
