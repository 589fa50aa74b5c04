"""CSV drops, landing loads and dated snapshots written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogue.dedup import EVENT
from catalogue.registry import ASOF_TEXT, dealt_out, from_sql, query, table, with_views
from catalogue.views import EV_NEW, EV_OLD
from kalendra.operators.dedup import SAME_EVENT_KEYS, drop_exact
from kalendra.operators.filters import counted
from kalendra.schema import CSV_COLUMNS, EVENT_COLUMNS, EVENT_SCHEMA, conform
from kalendra.session import cut_lineage, fresh_folder
from kalendra.sources import calendar, csv_drop, snapshots


def _as_csv_columns(events):
    """Event columns under the names of a CSV drop, a missing text as one blank."""
    filled = events.select(*[F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS]).na.fill(" ")
    return filled.toDF(*CSV_COLUMNS)


def _drop_folder(spark, sf) -> str:
    """Three sources: one with the agreed columns, one with a row index, one with other columns."""
    folder = fresh_folder(spark, "csv-drop")
    new = _as_csv_columns(from_sql(spark, sf, EV_NEW).orderBy("row_seq"))
    indexed = from_sql(spark, sf, EV_OLD).orderBy("row_seq")
    other = table(spark, sf, "customer")
    options = csv_drop.WRITE_OPTIONS
    new.write.options(**options).csv(f"{folder}/plain")
    indexed.select(
        F.col("row_seq").alias("Unnamed: 0"),
        *[F.col(c).cast("string").alias(n) for c, n in zip(EVENT_COLUMNS, CSV_COLUMNS, strict=True)],
    ).na.fill(" ").write.options(**options).csv(f"{folder}/indexed")
    other.write.options(**options).csv(f"{folder}/other")
    return folder


def _read_all(spark, folder):
    return csv_drop.read_event_csvs(spark, f"{folder}/*", CSV_COLUMNS)


BLANKED = ", ".join(
    f"coalesce({c}, ' ') as {c}"
    for c in ("subject", "start_time", "end_time", "location", "city", "description", "category")
)


@query(
    "csv_drop_rows",
    with_views(
        f"""
        select {BLANKED}, start_date, end_date, music_label
        from (select {EVENT} from ev_new union all by name select {EVENT} from ev_old)
        """,
        ev_new=EV_NEW,
        ev_old=EV_OLD,
    ),
)
def csv_drop_rows(spark, sf):
    rows, _ = _read_all(spark, _drop_folder(spark, sf))
    return rows.select(*EVENT_COLUMNS)


@query(
    "csv_keep_first",
    with_views(
        f"""
        select * exclude (nth) from (
            select {BLANKED}, start_date, end_date, music_label,
                   row_number() over (partition by {", ".join(f"coalesce(cast({c} as varchar), ' ')" for c in SAME_EVENT_KEYS)}
                                      order by file, row_seq) as nth
            from (select 2 as file, row_seq, {EVENT} from ev_new
                  union all by name select 1 as file, row_seq, {EVENT} from ev_old))
        where nth = 1
        """,
        ev_new=EV_NEW,
        ev_old=EV_OLD,
    ),
)
def csv_keep_first(spark, sf):
    """The first row of each event, in the order of files and lines."""
    rows, _ = _read_all(spark, _drop_folder(spark, sf))
    return drop_exact(rows, SAME_EVENT_KEYS).select(*EVENT_COLUMNS)


@query(
    "csv_gate",
    """
    select 'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey' as columns, false as accepted
    union all
    select 'Category,City,Description,End_date,End_time,Location,Music_label,Start_date,Start_time,Subject',
           true
    """,
)
def csv_gate(spark, sf):
    folder = _drop_folder(spark, sf)
    cells = csv_drop.read_cells(spark, f"{folder}/*")
    judged = csv_drop.gate(csv_drop.csv_files(cells), CSV_COLUMNS)
    return judged.select(F.array_join("columns", ",").alias("columns"), "accepted").distinct()


_WIDE = [f"c{k:02d}" for k in range(70)]
_OTHER_WIDE = [*_WIDE[:64], *[f"d{k:02d}" for k in range(64, 70)]]


@query(
    "csv_gate_wide",
    with_views(
        f"""
        select 'a' as name, '{",".join(_WIDE)}' as columns, true as accepted, count(*) as n_rows from ev_new
        union all select 'b', '{",".join(_OTHER_WIDE)}', false, count(*) from ev_new
        """,
        ev_new=EV_NEW,
    ),
)
def csv_gate_wide(spark, sf):
    """Two sources of 70 columns that differ in the last six; the first one sets the standard."""
    folder = fresh_folder(spark, "csv-wide")
    rows = dealt_out(from_sql(spark, sf, EV_NEW).select("subject"))
    for name, columns in (("a", _WIDE), ("b", _OTHER_WIDE)):
        cells = [F.concat("subject", F.lit(f", {c}")).alias(c) for c in columns]
        wide = rows.select(*cells).na.fill(" ")
        wide.write.options(**csv_drop.WRITE_OPTIONS, compression="gzip").csv(f"{folder}/{name}")
    cells = csv_drop.read_cells(spark, f"{folder}/*")
    judged = csv_drop.gate(csv_drop.csv_files(cells))
    counts = cells.groupBy("file").agg((F.count(F.lit(1)) - 1).alias("n"))
    name = F.regexp_extract("file", "/([ab])/[^/]*$", 1).alias("name")
    return (
        judged.join(counts, "file")
        .groupBy(name, F.array_join("columns", ",").alias("columns"), "accepted")
        .agg(F.sum("n").alias("n_rows"))
    )


@query(
    "landing_latest",
    with_views(f"select row_seq, {EVENT} from ev_new", ev_new=EV_NEW),
)
def landing_latest(spark, sf):
    """Two loads are landed; the later one is read."""
    folder = fresh_folder(spark, "landing")
    snapshots.land(from_sql(spark, sf, EV_OLD), folder, "20240109_060000")
    snapshots.land(from_sql(spark, sf, EV_NEW), folder, "20240110_060000")
    return snapshots.latest_load(spark, folder).drop("load_ts")


def _snapshot_folder(spark, sf) -> str:
    folder = fresh_folder(spark, "snapshots")
    old, new = from_sql(spark, sf, EV_OLD), from_sql(spark, sf, EV_NEW)
    snapshots.promote(new, folder, "2024-01-08")
    snapshots.promote(old, folder, "2024-01-09")
    snapshots.promote(new, folder, "2024-01-10")
    return folder


@query(
    "snapshot_latest",
    with_views(
        f"select row_seq, {EVENT}, date '2024-01-09' as snapshot_date from ev_old", ev_old=EV_OLD
    ),
)
def snapshot_latest(spark, sf):
    """The newest snapshot strictly before the run day."""
    return snapshots.latest_snapshot_at(spark, _snapshot_folder(spark, sf), before=ASOF_TEXT)


@query(
    "snapshot_latest_named",
    """
    select table_name, day from (
        select 'events_data_' || case when o_orderstatus = 'F' then 'new' else 'old' end
                 || '_events_' || strftime(o_orderdate, '%Y%m%d') as table_name,
               cast(strftime(o_orderdate, '%Y%m%d') as integer) as day, o_orderstatus as st
        from orders)
    where st <> 'F' and day < 20000101 order by day desc limit 1
    """,
)
def snapshot_latest_named(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "F", F.lit("new")).otherwise(F.lit("old"))
    names = table(spark, sf, "orders").select(
        F.concat(
            F.lit("events_data_"), kind, F.lit("_events_"), F.date_format("o_orderdate", "yyyyMMdd")
        ).alias("table_name")
    )
    return snapshots.latest_named(names, "old", before=20000101)


CITY_COLUMNS = ["subject", "start_time", "location", "description", "category"]


@query(
    "city_files",
    with_views(
        f"select city, {', '.join(c for c in CITY_COLUMNS)} from ev_new", ev_new=EV_NEW
    ),
)
def city_files(spark, sf):
    """One CSV folder per city, every row read back."""
    folder = fresh_folder(spark, "city-files")
    events = from_sql(spark, sf, EV_NEW)
    csv_drop.write_event_csvs(events.select(*EVENT_COLUMNS), folder, by_city=True)
    schema = "subject string, start_date string, end_date string, start_time string, " \
        "end_time string, location string, description string, category string, music_label string"
    stored = spark.read.schema(schema + ", city string").option("header", True).option(
        "escape", '"'
    ).csv(folder)
    return stored.select("city", *CITY_COLUMNS)


@query(
    "published_ids",
    with_views("select row_number() over (order by row_seq) as entry_no from ev_new", ev_new=EV_NEW),
)
def published_ids(spark, sf):
    """The calendar is fully replaced, then its entry ids are listed."""
    from catalogue.snapshots import _numbered_entries
    from kalendra.operators.payload import nested

    folder = fresh_folder(spark, "calendar")
    snapshots.publish(nested(_numbered_entries(spark, sf)), folder)
    return snapshots.published_ids(spark.read.parquet(folder))


@query(
    "table_life_cycle",
    with_views(
        """
        select unnest(['created', 'kept', 'appended', 'appended again', 'previous', 'replaced', 'truncated']) as step,
               unnest([0, 0, new, new + old, new + old, new, 0]) as n,
               unnest([true, true, true, true, false, true, true]) as there
        from (select (select count(*) from ev_new) as new, (select count(*) from ev_old) as old)
        """,
        ev_new=EV_NEW,
        ev_old=EV_OLD,
    ),
)
def table_life_cycle(spark, sf):
    """A table is created empty, kept, filled twice, copied as the previous one, replaced and emptied;
    `there` tells whether the table, or the previous one before it was made, existed."""
    name = f"events_{uuid.uuid4().hex}"
    new, old = (conform(from_sql(spark, sf, text)) for text in (EV_NEW, EV_OLD))
    steps = []

    def note(step: str, table_name: str = name, there: bool | None = None) -> None:
        exists = snapshots.table_exists(spark, table_name) if there is None else there
        steps.append((step, spark.table(table_name).count(), exists))

    snapshots.empty_table(spark, name, EVENT_SCHEMA)
    note("created")
    snapshots.ensure_table(spark, name, EVENT_SCHEMA)
    note("kept")
    snapshots.append_rows(new, name)
    note("appended")
    snapshots.append_rows(old, name)
    note("appended again")
    made = snapshots.bootstrap(spark.table(name), f"{name}_old")
    note("previous", f"{name}_old", there=not made)
    snapshots.replace_rows(new, name)
    note("replaced")
    snapshots.truncate(spark, name)
    note("truncated")
    for table_name in (name, f"{name}_old"):
        spark.sql(f"drop table {table_name}")
    return spark.createDataFrame(steps, "step string, n long, there boolean")


@query(
    "row_counts",
    with_views(
        f"""
        select 'before' as stage, count(*) as n from ev_new
        union all
        select 'after', count(*) from (select distinct {", ".join(SAME_EVENT_KEYS)} from ev_new)
        """,
        ev_new=EV_NEW,
    ),
)
def row_counts(spark, sf):
    """Rows before and after a pass, counted while it runs."""
    rows, before = counted(from_sql(spark, sf, EV_NEW), "before")
    kept, after = counted(drop_exact(rows, SAME_EVENT_KEYS), "after")
    cut_lineage(kept)
    counts = [("before", before.get["n"]), ("after", after.get["n"])]
    return spark.createDataFrame(counts, "stage string, n long")


_DELTA_KEY, _DELTA_BODY = ["subject", "city"], [c for c in EVENT_SCHEMA.fieldNames() if c not in ("subject", "city")]
_DELTA = f"""
with old_n as (select {", ".join(EVENT_SCHEMA.fieldNames())}, count(*) as n from ev_old group by all),
new_n as (select {", ".join(EVENT_SCHEMA.fieldNames())}, count(*) as n from ev_new group by all),
bodies as (
    select subject, city, sum(was) as was, sum(now) as now, sum(least(was, now)) as same
    from (select * exclude (n, old), sum(n) filter (old) as was_, sum(n) filter (not old) as now_,
                 coalesce(was_, 0) as was, coalesce(now_, 0) as now
          from (select *, true as old from old_n union all select *, false from new_n)
          group by all)
    group by subject, city),
counted as (
    select 'first' as step, 'insert' as action, subject, city, was as n from bodies
    union all select 'second', 'update', subject, city, least(was, now) - same from bodies
    union all select 'second', 'insert', subject, city, greatest(now - was, 0) from bodies
    union all select 'second', 'delete', subject, city, greatest(was - now, 0) from bodies)
select step, action, subject, city, cast(n as bigint) as n from counted where n > 0
union all select 'again', 'any', null, null, 0
union all select 'published', 'any', subject, city, cast(now as bigint) from bodies where now > 0
"""


@query("publish_delta", with_views(f"select * from ({_DELTA})", ev_new=EV_NEW, ev_old=EV_OLD))
def publish_delta(spark, sf):
    """Yesterday's entries are published, then the difference to today's: half of its calls in a run that
    breaks, the rest in the next one. A further run calls for nothing."""
    old, new = (cut_lineage(conform(from_sql(spark, sf, text))) for text in (EV_OLD, EV_NEW))
    published = calendar.Calendar(fresh_folder(spark, "calendar"), EVENT_SCHEMA, _DELTA_KEY, _DELTA_BODY)

    def counts(step: str, calls):
        by_key = calls.groupBy("action", *_DELTA_KEY).agg(F.count(F.lit(1)).alias("n"))
        return by_key.select(F.lit(step).alias("step"), "action", *_DELTA_KEY, "n")

    first = cut_lineage(published.calls(old))
    published.record(first)
    second = cut_lineage(published.calls(new))
    published.record(second.filter(F.pmod(F.xxhash64("entry_id"), F.lit(2)) == 0))
    published.record(cut_lineage(published.calls(new)))
    again = published.calls(new).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    left = again.select(
        F.lit("again").alias("step"), F.lit("any").alias("action"), none.alias("subject"), none.alias("city"), "n"
    )
    there = published.entries(spark).withColumn("action", F.lit("any"))
    return (
        counts("first", first).unionByName(counts("second", second)).unionByName(left)
        .unionByName(counts("published", there))
    )
