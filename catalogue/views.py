"""Event snapshots and raw listings derived from the test tables.

Each text runs unchanged in Spark SQL and in the oracle; table names stand in braces. All rows of
the tables are used: the two snapshots differ in subjects, times and places, not in coverage.
"""

from __future__ import annotations

_SNAPSHOT = """
select e.event_id as row_seq,
       case when e.value > 400 then null
            else concat(p.p_name, ' live', case when e.event_id % 3 = 0 then '!' else '' end,
                        {suffix}) end as subject,
       cast(e.ts as date) as start_date, cast(e.ts as date) as end_date,
       case when e.event_type = 'error' then null
            {moved}
            else concat(lpad(cast(hour(e.ts) - hour(e.ts) % 4 as string), 2, '0'), ':00')
       end as start_time,
       case when e.event_type = 'click'
            then concat(lpad(cast((hour(e.ts) + 2) % 24 as string), 2, '0'), ':00')
            when e.event_type = 'signup' then ' '
            else null end as end_time,
       {location} as location,
       case when e.value > 300 and e.value < 350 then null else r.r_name end as city,
       e.props as description, e.event_type as category,
       case when e.event_type = 'signup' then null
            else e.event_type in ('view', 'purchase') end as music_label
from (select *, event_id % (select count(*) from {part}) as part_no from {events}) e
join {part} p on p.p_partkey = e.part_no
join {nation} n on n.n_nationkey = e.user_id % 25
join {region} r on r.r_regionkey = n.n_regionkey
"""


def _snapshot(suffix: str, moved: str, location: str) -> str:
    text = _SNAPSHOT
    for name, value in (("suffix", suffix), ("moved", moved), ("location", location)):
        text = text.replace("{" + name + "}", value)
    return text


EV_NEW = _snapshot("case when e.value < 5 then ' extra' else '' end", "", "n.n_name")
EV_OLD = _snapshot(
    "case when e.value > 80 then ' alt' else '' end",
    "when e.event_id % 7 = 0 then '23:00'",
    "case when e.event_id % 13 = 0 then concat(n.n_name, ' old') else n.n_name end",
)


def case_of(expression: str, values: list[str], first: int = 1) -> str:
    whens = " ".join(f"when {i + first} then '{v}'" for i, v in enumerate(values))
    return f"case {expression} {whens} end"
