"""Snapshot comparison, summaries and calendar entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.dedup import NOTEWORTHY, collapsed
from catalogue.registry import asof, from_sql, query, with_views
from catalogue.views import EV_NEW, EV_OLD
from kalendra.operators import diff_ranked as ranked_diff
from kalendra.operators import diff_subject, filters, numbering, payload
from kalendra.plans.workflows import snapshot_b
from kalendra.session import cut_lineage

TODAY = "date '2024-01-10'"


def run_ts():
    return F.lit("2024-01-10 06:30:00").cast("timestamp_ntz")


def diff_sql(key: str) -> str:
    carried = ranked_diff.CARRIED
    columns = ", ".join(f"coalesce(t.{c}, p.{c}) as {c}" for c in carried)
    ranked = """
        select *, rank() over (partition by subject order by start_date nulls first,
                                                            start_time nulls first) as r
        from {0} where end_date >= date '2024-01-10'
    """
    return f"""
    select {columns},
      case when t.subject is null and p.subject is not null
           then p.description || ' | event deleted'
           when t.location <> p.location then t.description || ' | previous location: ' || p.location
           when t.start_date <> p.start_date and t.start_time <> p.start_time
           then t.description || ' | previous date : ' || strftime(p.start_date, '%d.%m.%Y')
                || ' at: ' || p.start_time
           when t.start_date <> p.start_date
           then t.description || ' | previous date: ' || strftime(p.start_date, '%d.%m.%Y')
           when t.start_time <> p.start_time
           then t.description || ' | previous time: ' || p.start_time
           else t.description end as updated_description,
      case when t.subject is null and p.subject is not null then 'deleted'
           when t.location <> p.location or t.start_date <> p.start_date
                or t.start_time <> p.start_time then 'changed'
           else 'unchanged' end as status
    from ({ranked.format('ev_new')}) t full outer join ({ranked.format('ev_old')}) p
      on {key.format('t.subject')} = {key.format('p.subject')} and t.r = p.r and t.city = p.city
    """


ALNUM = "lower(regexp_replace({0}, '[^a-zA-Z0-9]', '', 'g'))"
DIFF_A = diff_sql(ALNUM)
SNAPSHOTS = {"ev_new": EV_NEW, "ev_old": EV_OLD}


@query("diff_a", with_views(DIFF_A, **SNAPSHOTS))
def diff_a(spark, sf):
    new, old = from_sql(spark, sf, EV_NEW), from_sql(spark, sf, EV_OLD)
    return ranked_diff.diff_ranked(new, old, asof())


@query("diff_a_rawkey", with_views(diff_sql("{0}"), **SNAPSHOTS))
def diff_a_rawkey(spark, sf):
    new, old = from_sql(spark, sf, EV_NEW), from_sql(spark, sf, EV_OLD)
    return ranked_diff.diff_ranked(new, old, asof(), normalise_key=False)


@query(
    "diff_a_status",
    with_views(f"select status, count(*) as n from ({DIFF_A}) group by status", **SNAPSHOTS),
)
def diff_a_status(spark, sf):
    return diff_a(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "event_rank",
    with_views(
        """
        select row_seq, rank() over (partition by subject order by start_date nulls first,
                                     start_time nulls first) as event_rank
        from ev_new
        """,
        ev_new=EV_NEW,
    ),
)
def event_rank(spark, sf):
    return numbering.ranked(from_sql(spark, sf, EV_NEW)).select("row_seq", "event_rank")


SUMMARY = f"""
select 'Zusammenfassung der heutigen Veranstaltungen vom 10.01.2024' as subject,
       'You can only see this here. Neumünster, Wyk, Kiel, Heide, Husum, Hamburg, Lübeck' as location,
       {TODAY} as start_date, {TODAY} as end_date, cast(null as varchar) as start_time,
       cast(null as varchar) as end_time, d as description, 'nowhere' as city,
       false as music_label, d as updated_description, 'unchanged' as status
from (select 'Gesamtzahl der Veranstaltungen: ' || count(*) || '. ' || chr(10)
          || 'Anzahl der gelöschten Veranstaltungen: ' || count_if(status = 'deleted') || '.' || chr(10)
          || 'Anzahl der geänderten Veranstaltungen: ' || count_if(status = 'changed') || '.' || chr(10)
          || 'Anzahl der unveränderten/neuen Veranstaltungen: ' || count_if(status = 'unchanged')
          || '.' as d
      from ({DIFF_A}))
"""


@query("summary_row", with_views(SUMMARY, **SNAPSHOTS))
def summary_row(spark, sf):
    return ranked_diff.summary_row(diff_a(spark, sf), asof())


ENTRY_COLUMNS = [
    "subject", "location", "start_day", "end_day", "start_at", "end_at", "entry_text", "color_id",
    "is_valid",
]


def flat(entries):
    """Entry columns with timestamps as the calendar client writes them."""
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return entries.select(
        "subject",
        "location",
        F.col("start_day"),
        F.col("end_day"),
        F.date_format("start_ts", iso).alias("start_at"),
        F.date_format("end_ts", iso).alias("end_at"),
        "entry_text",
        "color_id",
        "is_valid",
    )


def clock_sql(day: str, clock: str) -> str:
    return f"try_cast({day} || ' ' || trim({clock}) || ':00' as timestamp)"


def iso_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"


PAYLOAD_A = f"""
select subject, location, case when d then start_date end as start_day,
       case when d then end_date end as end_day,
       {iso_sql('s')} as start_at,
       {iso_sql('case when e <= s then e + interval 1 day else e end')} as end_at,
       updated_description as entry_text,
       case status when 'changed' then '5' when 'deleted' then '11'
            else case when music_label then '9' else '10' end end as color_id,
       case when d then start_date is not null and end_date is not null
            else s is not null and e is not null end as is_valid
from (select *, start_time is null as d, {clock_sql('start_date', 'start_time')} as s,
             case when start_time is null then null
                  when end_time is null
                  then {clock_sql('end_date', 'start_time')} + interval 27 minute
                  else {clock_sql('end_date', 'end_time')} end as e
      from ({DIFF_A} union all by name {SUMMARY}))
"""


@query("payload_a", with_views(PAYLOAD_A, **SNAPSHOTS))
def payload_a(spark, sf):
    diffed = ranked_diff.add_summary(diff_a(spark, sf), asof())
    return flat(payload.entries(diffed, "a"))


# ---- comparison by subject ---------------------------------------------------------------------

COMPARED = list(diff_subject.COMPARED.items())


def _snapshot_sql(source: str) -> str:
    return NOTEWORTHY.format(source=f"({collapsed(source)})")


def _clocks(source: str) -> str:
    def normal(c: str) -> str:
        padded = f"case when length({c}) < 5 then lpad({c}, 5, '0') else {c} end"
        return f"replace({padded}, '0000', '00:00') as {c}"

    return (
        f"select * replace ({normal('start_time')}, {normal('end_time')}) from {source} "
        "where city is not null"
    )


def _fold(base: str, old: str) -> str:
    """Per base row: `le`, the last effect, and `trail`."""
    differs = " or ".join(f"coalesce(o.{c} <> n.{c}, false)" for c, _ in COMPARED)
    texts = " || ".join(
        f"case when o.{c} <> n.{c} then chr(10) || 'Original {label}: ' || o.{c} else '' end"
        for c, label in COMPARED
    )
    return f"""
    select row_seq, arg_max(effect, old_seq) filter (where effect is not null) as le,
           string_agg(trail, '' order by old_seq) filter (where effect = 5) as trail
    from (select n.row_seq, o.row_seq as old_seq,
                 case when o.colour = 4 then 4 when {differs} then 5 end as effect,
                 {texts} as trail
          from {base} n join {old} o on n.city = o.city and n.subject = o.subject)
    group by row_seq
    """


BY_SUBJECT_VIEWS = {
    **SNAPSHOTS,
    "new_raw": _snapshot_sql("ev_new"),
    "old_raw": _snapshot_sql("ev_old"),
    "n0": _clocks("new_raw"),
    "o0": _clocks("old_raw"),
    "gone": """
        select o.* from o0 o where not exists
          (select 1 from n0 n where n.city = o.city and n.subject = o.subject)
    """,
    "heads": """
        select * from gone where subject is not null
        qualify row_number() over (partition by city, subject order by row_seq) = 1
    """,
    "later": "select * from gone where subject is not null and row_seq not in (select row_seq from heads)",
    "fold_new": _fold("n0", "o0"),
    "fold_gone": _fold("heads", "later"),
}


def _settled(source: str, fold: str, start: str) -> str:
    return f"""
    select b.* replace (
        cast(case when coalesce(f.le, {start}) in (4, 5, 11) then coalesce(f.le, {start}) else 10 end
             as integer) as colour,
        case when length(f.trail) > 0 then coalesce(b.description, '') || f.trail
             else b.description end as description)
    from {source} b left join {fold} f on f.row_seq = b.row_seq
    """


DIFF_B = f"""
{_settled('n0', 'fold_new', 'b.colour')}
union all by name {_settled('heads', 'fold_gone', '11')}
union all by name select * replace (cast(11 as integer) as colour) from gone where subject is null
"""
DIFF_B_NEW = f"""
select * replace (cast(case when not exists
    (select 1 from o0 o where o.city = k.city and o.subject = k.subject) then 7 else k.colour end
    as integer) as colour)
from ({_settled('n0', 'fold_new', 'b.colour')}) k
union all by name select * replace (cast(11 as integer) as colour) from gone
"""


def _two_snapshots(spark, sf):
    """Snapshots are stored before they are compared, as in the daily run."""
    return tuple(
        cut_lineage(snapshot_b(from_sql(spark, sf, view), asof())) for view in (EV_NEW, EV_OLD)
    )


@query("diff_b", with_views(DIFF_B, **BY_SUBJECT_VIEWS))
def diff_b(spark, sf):
    return diff_subject.diff_by_subject(*_two_snapshots(spark, sf))


@query("diff_b_with_new", with_views(DIFF_B_NEW, **BY_SUBJECT_VIEWS))
def diff_b_with_new(spark, sf):
    return diff_subject.diff_by_subject(*_two_snapshots(spark, sf), label_new=True)


@query(
    "deleted_events",
    with_views("select city, subject, row_seq from gone", **BY_SUBJECT_VIEWS),
)
def deleted_events(spark, sf):
    gone = diff_subject.deleted_events(*_two_snapshots(spark, sf))
    return gone.select("city", "subject", "row_seq")


@query(
    "new_events",
    with_views(
        """
        select n.city, n.subject, n.row_seq from n0 n where not exists
          (select 1 from o0 o where n.city = o.city and n.subject = o.subject)
        """,
        **BY_SUBJECT_VIEWS,
    ),
)
def new_events(spark, sf):
    return diff_subject.appeared_events(*_two_snapshots(spark, sf)).select(
        "city", "subject", "row_seq"
    )


def payload_b_sql(source: str) -> str:
    return f"""
    select row_seq, subject, location, case when d then start_date end as start_day,
           case when d then case when coalesce(end_date, start_date) = start_date
                                 then cast(start_date + interval 1 day as date)
                                 else coalesce(end_date, start_date) end end as end_day,
           s as start_ts,
           case when cast(e as date) = cast(s as date) and strftime(e, '%H:%M:%S') = '00:00:00'
                then e + interval 1 day else e end as end_ts,
           coalesce(description, 'None') || chr(10) || chr(10)
             || 'Event created on: 2024-01-10 06:30:00' as entry_text,
           cast(colour as varchar) as color_id,
           case when d then start_date is not null else s is not null and e is not null end as is_valid
    from (select *, start_time is null or trim(start_time) = '' as d,
                 {clock_sql('start_date', 'start_time')} as s,
                 case when end_time is null or trim(end_time) = ''
                      then {clock_sql('start_date', 'start_time')} + interval 1 hour
                      else {clock_sql('end_date', 'end_time')} end as e
          from ({source}))
    """


PAYLOAD_B = f"""
select subject, location, start_day, end_day, {iso_sql('start_ts')} as start_at,
       {iso_sql('end_ts')} as end_at, entry_text, color_id, is_valid
from ({payload_b_sql(DIFF_B)})
"""


@query("payload_b", with_views(PAYLOAD_B, **BY_SUBJECT_VIEWS))
def payload_b(spark, sf):
    return flat(payload.entries(diff_b(spark, sf), "b", run_ts()))


@query(
    "publish_outcome",
    with_views(
        f"""
        select count_if(is_valid) as success_count, count_if(not is_valid) as failure_count
        from ({PAYLOAD_B})
        """,
        **BY_SUBJECT_VIEWS,
    ),
)
def publish_outcome(spark, sf):
    return payload.outcome(payload.entries(diff_b(spark, sf), "b", run_ts()))


@query(
    "publish_scope",
    with_views(
        f"select row_seq, colour from ({DIFF_B}) where city = 'EUROPE' and colour <> 11",
        **BY_SUBJECT_VIEWS,
    ),
)
def publish_scope(spark, sf):
    scoped = filters.publish_scope(diff_b(spark, sf), "EUROPE", without_deleted=True)
    return scoped.select("row_seq", "colour")


# Entries of the raw snapshot by policy b; every event has one number.
INITIAL = "select *, cast(1 as integer) as colour from ev_new"


def _numbered_entries(spark, sf):
    events = from_sql(spark, sf, EV_NEW).withColumn("colour", F.lit(1))
    return payload.with_batches(payload.entries(events, "b", run_ts()), "row_seq")


@query(
    "publish_batches",
    with_views(
        """
        select row_seq, row_number() over (order by row_seq) as entry_no,
               cast((row_number() over (order by row_seq) - 1) // 580 as integer) as batch_no
        from ev_new
        """,
        ev_new=EV_NEW,
    ),
)
def publish_batches(spark, sf):
    return _numbered_entries(spark, sf).select("row_seq", "entry_no", "batch_no")


@query(
    "upcoming_n",
    with_views(
        f"""
        select row_seq, coalesce(start_ts, cast(start_day as timestamp)) as starts
        from ({payload_b_sql(INITIAL)})
        where coalesce(start_ts, cast(start_day as timestamp)) >= timestamp '2024-01-10 06:30:00'
        order by starts, row_seq limit 10
        """,
        ev_new=EV_NEW,
    ),
)
def upcoming_n(spark, sf):
    events = from_sql(spark, sf, EV_NEW).withColumn("colour", F.lit(1))
    entries = payload.entries(events, "b", run_ts())
    return filters.upcoming(entries, run_ts(), 10).select("row_seq", "starts")


@query(
    "entry_json",
    with_views(
        """
        select row_seq, to_json(struct_pack(summary := subject, location := location)) as entry
        from ev_new
        """,
        ev_new=EV_NEW,
    ),
)
def entry_json(spark, sf):
    """The nested record as JSON text, reduced to the parts that SQL renders alike."""
    entries = payload.nested(_numbered_entries(spark, sf))
    record = entries.select("row_seq", "entry.summary", "entry.location")
    text = F.to_json(F.struct("summary", "location"), {"ignoreNullFields": "false"})
    return record.select("row_seq", text.alias("entry"))
