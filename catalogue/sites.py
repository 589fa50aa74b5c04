"""Per-site normalisers on raw listings rendered from the test tables, page harvesting, and
sectioned programmes.

The oracle builds the expected rows from the same source columns without parsing the raw text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.dedup import title_sql
from catalogue.registry import ORACLES, QUERIES, asof, for_oracle, from_sql, query, table, with_views
from catalogue.scalars import ABBREVIATION, MONTH_NAME, NEXT
from kalendra.functions.dates import MONTH_NAMES
from kalendra.plans.normalise import normalise, union_sources
from kalendra.plans.sections import sectioned_items
from kalendra.sources import harvest as pages_source
from catalogue.views import case_of

# Listings: an order is an event, its customer the subject, the nation its city.
_D = "cast(o_orderdate as date)"
_DAY, _MONTH, _YEAR = (f"cast({p}({_D}) as string)" for p in ("day", "month", "year"))
DOTTED = f"concat(lpad({_DAY}, 2, '0'), '.', lpad({_MONTH}, 2, '0'), '.', {_YEAR})"
ISO = f"concat({_YEAR}, '-', lpad({_MONTH}, 2, '0'), '-', lpad({_DAY}, 2, '0'))"
CLOCK = "concat(lpad(cast(o_orderkey % 24 as string), 2, '0'), ':30')"
CLOCK_END = "concat(lpad(cast((o_orderkey + 2) % 24 as string), 2, '0'), ':00')"
LISTING = f"""
select o_orderkey as row_seq, {_D} as d, {DOTTED} as dotted, {ISO} as iso,
       {_DAY} as day_no, {_YEAR} as year_no,
       {ABBREVIATION} as abbreviation, {MONTH_NAME} as month_name,
       {CLOCK} as clock, {CLOCK_END} as clock_end, o_orderstatus as st,
       o_orderpriority as priority, c_name as name, c_mktsegment as segment, n_name as nation
from {{orders}} join {{customer}} on c_custkey = o_custkey
join {{nation}} on n_nationkey = c_nationkey
"""

COLUMNS = [
    "subject", "start_date", "end_date", "start_time", "end_time", "location", "city",
    "description", "category", "music_label",
]


#: The raw listing of each site, by its name.
RAW_VIEWS: dict[str, str] = {}


def site(name: str, raw: str, **expected: str) -> None:
    """Register `normalise_<name>`: `raw` selects the raw columns from the listing `l`; `expected`
    gives each event column in SQL over `l`. The end date defaults to the start date."""
    expected = {"end_date": expected["start_date"], **expected}
    raw_view = RAW_VIEWS[name] = f"select row_seq, {raw} from ({LISTING}) l"
    wanted = ", ".join(f"{expected[c]} as {c}" for c in COLUMNS)

    def run(spark, sf):
        return normalise(name, from_sql(spark, sf, raw_view), asof())

    query(f"normalise_{name}", with_views(f"select row_seq, {wanted} from l", l=LISTING))(run)


site(
    "biunsinnorden",
    "name as subject, concat(iso, 'T', clock) as start_text, case when st = 'P' then null "
    "else concat(clock, ' Uhr') end as clock, segment as category, nation as location, "
    "upper(nation) as city, priority as description",
    subject="name",
    start_date="d",
    start_time="case when st = 'P' then ' ' else clock end",
    end_time="' '",
    location="nation",
    city=title_sql("upper(nation)"),
    description="priority",
    category="segment",
    music_label="true",
)
site(
    "eventbrite",
    "name as title, priority as source, nation as city, concat(segment, case when st = 'F' "
    "then ' Music' else '' end) as label, segment as location, case st "
    "when 'P' then concat('morgen um ', clock) "
    "when 'F' then concat('Sa., ', day_no, '. ', abbreviation, '., ', clock, ' + 3 more') "
    "else concat(left(dotted, 6), ' um ', clock) end as date_and_time",
    subject="name",
    start_date=f"case when st = 'P' then date '2024-01-11' else {NEXT} end",
    start_time="clock",
    end_time="' '",
    location="segment",
    city="nation",
    description="priority",
    category="concat(segment, case when st = 'F' then ' Music' else '' end)",
    music_label="st = 'F'",
)
site(
    "eventim",
    "name as subject, case when st = 'O' then null else priority end as description, "
    "nation as source, 'Konzert' as category, true as music_label, case st "
    "when 'P' then concat(segment, ', Sa. ', dotted, ', ', clock) "
    "when 'F' then concat(segment, ', ', dotted) else segment end as location_date_time",
    subject="name",
    start_date="case when st <> 'O' then d end",
    start_time="case when st = 'P' then clock else ' ' end",
    end_time="' '",
    location="segment",
    city="segment",
    description="case when st = 'O' then ' ' else priority || ' ' || nation end",
    category="'Konzert'",
    music_label="true",
)
for _name in ("hamburg", "sh_tourismus"):
    site(
        _name,
        "name as title, case when priority = '1-URGENT' then null else concat(segment, "
        "case when st = 'F' then ' Musik' else '' end) end as category, nation as source, case st "
        "when 'P' then concat(dotted, ' / ', clock, ' - ', clock_end, ' Uhr / Halle / ', nation, "
        "', Saal, Kiel') when 'F' then concat(dotted, ' / ', clock, ' Uhr') else null end as info",
        subject="name",
        start_date="case when st <> 'O' then d end",
        start_time="case when st <> 'O' then clock else ' ' end",
        end_time="case when st = 'P' then clock_end else ' ' end",
        location="case st when 'P' then 'Halle / ' || nation || ', Saal' when 'F' then '' else ' ' end",
        city="case when st = 'P' then 'Kiel' else ' ' end",
        description="nation",
        category="case when priority = '1-URGENT' then ' ' "
        "else concat(segment, case when st = 'F' then ' Musik' else '' end) end",
        music_label="st = 'F' and priority <> '1-URGENT'",
    )
site(
    "kiel_magazin",
    "concat('Zur Veranstaltung \"', name, '\"') as link_title, nation as source, "
    "concat(' ', segment, ' ') as category, concat('Samstag, ', day_no, '. ', month_name, ' ', "
    "year_no, case st when 'P' then '' when 'F' then concat(' ab ', clock, ' Uhr') "
    "else concat(' ab ', clock, ' bis ', clock_end, ' Uhr') end, '<br>', nation, ', Saal,KIEL') "
    "as date_html",
    subject="name",
    start_date="d",
    start_time="case when st = 'P' then ' ' else clock end",
    end_time="case when st = 'O' then clock_end else ' ' end",
    location="nation",
    city="'Kiel'",
    description="nation",
    category="segment",
    music_label="true",
)
site(
    "kiel_sailing_city",
    "name as title, nation as location, priority as source, array(segment, case when st = 'F' "
    "then 'Nachtleben' else 'Markt' end) as categories, case st "
    "when 'P' then concat('Heute ', clock, ' Uhr', chr(10), 'mehr') "
    "when 'F' then concat(dotted, ' ', clock, ' - ', clock_end, ' Uhr') "
    "else concat(dotted, ' ', clock, ' Uhr') end as time_details",
    subject="name",
    start_date="case when st = 'P' then date '2024-01-10' else d end",
    start_time="clock",
    end_time="case when st = 'F' then clock_end else ' ' end",
    location="nation",
    city="'Kiel'",
    description="priority",
    category="segment || ', ' || case when st = 'F' then 'Nachtleben' else 'Markt' end",
    music_label="st = 'F'",
)
site(
    "live_gigs",
    "concat(name, ' - Tour - ', year_no) as title, priority as source, case when st = 'P' then null "
    "else concat(' ', clock, ' Uhr') end as clock, case when st = 'F' then null else dotted end "
    "as day_text, segment as category, nation as location, upper(nation) as city",
    subject="name",
    start_date="case when st <> 'F' then d end",
    start_time="case when st = 'P' then ' ' else clock end",
    end_time="' '",
    location="nation",
    city=title_sql("upper(nation)"),
    description="priority",
    category="segment",
    music_label="true",
)
site(
    "meine_stadt",
    "name as subject, priority as description, case st when 'P' then null when 'F' "
    "then concat('Sa. ', dotted, ', ') else concat('Sa. ', dotted, ', ', clock) end as date_time, "
    "case when st = 'F' then nation else concat(nation, ', Halle, Saal') end as city_location, "
    "concat('https://veranstaltungen.example/kiel/', lower(segment), '/alle') as listing_url",
    subject="name",
    start_date="case when st <> 'P' then d end",
    start_time="case st when 'O' then clock when 'F' then '' else ' ' end",
    end_time="' '",
    location="case when st = 'F' then ' ' else 'Halle, Saal' end",
    city="nation",
    description="priority",
    category="lower(segment)",
    music_label="true",
)
site(
    "neumuenster",
    "name as subject, case when st = 'P' then iso else concat(iso, 'T20:00:00+01:00') end "
    "as start_text, case st when 'P' then null when 'F' then concat('von ', clock, ' bis ', "
    "clock_end, ' Uhr') else concat(clock, ' Uhr') end as clock, "
    "case when st = 'P' then null else segment end as place, nation as address, "
    "priority as description",
    subject="name",
    start_date="d",
    start_time="case when st = 'P' then ' ' else clock end",
    end_time="case when st = 'F' then clock_end else ' ' end",
    location="case when st = 'P' then 'nan' else segment end || ' | ' || nation",
    city="'Neumünster'",
    description="priority",
    category="' '",
    music_label="false",
)
site(
    "rausgegangen",
    "name as subject, priority as source, case when st = 'P' then null else '12 €' end as price, "
    "nation as location, 'Kiel' as city, segment as category, case when st = 'O' then 'heute' "
    "else concat('Samstag, ', day_no, '. ', abbreviation, ' | ', clock) end as date_time",
    subject="name",
    start_date=f"case when st <> 'O' then {NEXT} end",
    start_time="case when st = 'O' then '' else clock end",
    end_time="' '",
    location="nation",
    city="'Kiel'",
    description="case when st = 'P' then ' ' else priority || ' , Preis: 12 €' end",
    category="segment",
    music_label="true",
)
site(
    "wasgeht",
    "name as title, iso as date, 'Kiel' as city, case st when 'P' then 'konzert' when 'F' "
    "then 'theater' else segment end as category, case when st = 'F' then null when st = 'O' "
    "then clock else concat(clock, ' Uhr') end as clock, concat(nation, ' pin') as location, "
    "case when st = 'F' then null else priority end as details_link",
    subject="name",
    start_date="d",
    end_date="cast(null as date)",
    start_time="case when st = 'P' then clock end",
    end_time="cast(null as varchar)",
    location="nation",
    city="'Kiel'",
    description="case when st = 'F' then '' else priority end",
    category="case st when 'P' then 'konzert' when 'F' then 'theater' else segment end",
    music_label="st in ('P', 'F')",
)

ALIGNED_RAW = f"""
select row_seq, name as title, dotted as date, case when st = 'P' then clock
       else concat(clock, ' - ', clock_end) end as time, nation as location,
       array(segment, priority) as categories from ({LISTING}) l
"""


@query(
    "normalise_aligned_listing",
    with_views(
        """
        select row_seq, name as subject, d as start_date,
               case when st <> 'P' then clock end as start_time,
               case when st <> 'P' then clock_end end as end_time, nation as location,
               segment || ', ' || priority as description from l
        """,
        l=LISTING,
    ),
)
def aligned(spark, sf):
    return normalise("aligned_listing", from_sql(spark, sf, ALIGNED_RAW), asof())


# ---- sectioned programmes ----------------------------------------------------------------------

# Every conversation becomes a day's programme: its turns are lines, opened by headings.
SECTION_LINES = """
select conv_id, turn, case turn % 3 when 0 then concat('Musik', chr(10)) when 1 then
       concat('Film', chr(10)) else '' end as heading, role,
       concat('20:0', cast(turn % 10 as string)) as clock, replace(text, chr(10), ' ') as line
from {conversations}
"""
PROGRAMMES = f"""
select conv_id as page_id, string_agg(concat(heading, clock, chr(10), line, chr(10), role),
       chr(10) order by turn) as programme from ({for_oracle(SECTION_LINES)}) group by conv_id
"""
SECTIONS = f"""
with recursive p as ({PROGRAMMES}),
lines as (select page_id, unnest(string_split(programme, chr(10))) as line,
                 generate_subscripts(string_split(programme, chr(10)), 1) as pos from p),
marked as (select *, line in ('Theater', 'Musik', 'Film', 'Ausstellungen', 'Kunst', 'Literatur',
                              'Vorträge', 'Sonstiges') as h from lines),
filled as (select page_id, pos, line, h,
                  last_value(case when h then line end ignore nulls)
                    over (partition by page_id order by pos) as category from marked),
numbered as (select *, row_number() over (partition by page_id, category order by pos) - 1 as n
             from filled where not h and category is not null),
items as (select page_id, category, cast(n // 3 as integer) as item_no,
                 list(line order by n) as l from numbered group by all)
select page_id, category, item_no,
       case when category = 'Film' then l[len(l)] else l[1] end as time_text,
       case when category = 'Film' then l[1] else l[2] end as subject,
       case when category = 'Film' then l[2] else l[3] end as location
from items
"""


def _programmes(spark, sf):
    lines = from_sql(spark, sf, SECTION_LINES)
    entry = F.concat("heading", "clock", F.lit("\n"), "line", F.lit("\n"), "role")
    gathered = F.sort_array(F.collect_list(F.struct("turn", entry.alias("e"))))
    return (
        lines.groupBy(F.col("conv_id").alias("page_id"))
        .agg(gathered.alias("es"))
        .select("page_id", F.array_join(F.transform("es", lambda x: x["e"]), "\n").alias("programme"))
    )


@query("sectioned_list", SECTIONS)
def sectioned_list(spark, sf):
    return sectioned_items(_programmes(spark, sf), "page_id", "programme")


_DAY_OF_PAGE = "make_date(2024, 1 + page_id % 12, 1 + page_id % 28)"


@query(
    "normalise_unser_luebeck",
    f"""
    select subject, {_DAY_OF_PAGE} as start_date, {_DAY_OF_PAGE} as end_date,
           time_text as start_time, ' ' as end_time, coalesce(location, ' ') as location,
           'Lübeck' as city,
           'https://www.unser-luebeck.de/veranstaltungskalender/eventsnachtag/2024/'
             || (1 + page_id % 12) || '/' || (1 + page_id % 28) as description,
           category, category = 'Musik' as music_label
    from ({SECTIONS})
    """,
)
def normalise_unser_luebeck(spark, sf):
    return normalise("unser_luebeck", programmes_with_days(spark, sf), asof())


def programmes_with_days(spark, sf):
    """Each programme with the day it is for, as the site writes it."""
    month = case_of("1 + page_id % 12", MONTH_NAMES)
    return _programmes(spark, sf).withColumn(
        "day_text",
        F.expr(f"concat('Montag, ', cast(1 + page_id % 28 as string), '. ', {month}, ' 2024')"),
    )


# ---- pages -------------------------------------------------------------------------------------

NAVIGATION = '<li><a href="([^"]*)">([^<]*)</a></li>'
LINKS = pages_source.Selector(
    host=r".",
    block='<li><a href="[^"]*">[^<]*</a></li>',
    fields={"link": 'href="([^"]*)"', "title": ">([^<]+)</a>"},
    required=["link", "title"],
    constants={"city": "Kiel", "music_label": False},
    raw=["link"],
)


@query(
    "harvest_links",
    """
    select page_id, url, cast(pos - 1 as integer) as pos, regexp_extract(item, 'href="([^"]*)"', 1) as link,
           regexp_extract(item, '>([^<]+)</a>', 1) as title, 'Kiel' as city, false as music_label
    from (select page_id, url, unnest(i) as item, generate_subscripts(i, 1) as pos
          from (select page_id, url, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') as i
                from pages where regexp_matches(url, '^[a-z]+://[^/]')))
    where regexp_matches(item, '>([^<]+)</a>')
    """,
)
def harvest_links(spark, sf):
    return pages_source.harvest(table(spark, sf, "pages"), LINKS)


PARAGRAPH = "(?s)<p>.*?</p>"


@query(
    "harvest_paragraphs",
    """
    select page_id, cast(pos - 1 as integer) as pos, trim(regexp_replace(replace(replace(replace(
           replace(replace(replace(regexp_replace(item, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'),
           '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g')) as body
    from (select page_id, unnest(i) as item, generate_subscripts(i, 1) as pos
          from (select page_id, regexp_extract_all(html, '(?s)<p>.*?</p>') as i from pages))
    """,
)
def harvest_paragraphs(spark, sf):
    found = pages_source.items(table(spark, sf, "pages").select("page_id", "html"), PARAGRAPH)
    return found.select("page_id", "pos", pages_source.plain_text(F.col("item")).alias("body"))


@query(
    "exclude_previews",
    """
    select page_id, url from (select *, regexp_extract(html, '<html lang="([^"]*)"', 1) as lang from pages)
    where not contains(coalesce(url, ''), 'page=2') and lang <> 'fr'
    """,
)
def exclude_previews(spark, sf):
    lang = F.regexp_extract("html", '<html lang="([^"]*)"', 1)
    shaped = table(spark, sf, "pages").select(
        "page_id",
        "url",
        F.replace("url", F.lit("page=2"), F.lit("vorschau")).alias("class"),
        F.when(lang == "fr", F.lit("kino")).otherwise(lang).alias("kat"),
    )
    return pages_source.without_previews(shaped).select("page_id", "url")


def _sites() -> list[str]:
    return sorted(name for name in QUERIES if name.startswith("normalise_"))


@query(
    "all_sources",
    "select city, count(*) as n, coalesce(count_if(music_label), 0) as music, count(start_time) as timed from ("
    + " union all by name ".join(f"select * from ({ORACLES[name]})" for name in _sites())
    + ") group by city",
)
def all_sources(spark, sf):
    """All sites one below the other, counted per city."""
    frames = [QUERIES[name](spark, sf) for name in _sites()]
    return union_sources(frames).groupBy("city").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("music_label").alias("music"),
        F.count("start_time").alias("timed"),
    )
