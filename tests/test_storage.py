"""Tables, CSV drops, pages and calendar records."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from kalendra.operators import payload
from kalendra.operators.numbering import dense_number
from kalendra.plans.workflows import remove_duplicates, snapshot_b, workflow_a, workflow_b
from kalendra.schema import CSV_COLUMNS, EVENT_COLUMNS, EVENT_SCHEMA, conform, to_canonical
from kalendra.session import run_folder, shared_folder
from kalendra.sources import csv_drop, harvest, snapshots
from test_brute_force import event_frame, events


def test_tables(spark):
    snapshots.empty_table(spark, "new_events", EVENT_SCHEMA)
    assert snapshots.table_exists(spark, "new_events")
    before = snapshots.table_count(spark)
    snapshots.ensure_table(spark, "new_events", EVENT_SCHEMA)
    assert snapshots.table_count(spark) == before
    df = conform(event_frame(spark, events(__import__("random").Random(1), 5)))
    snapshots.append_rows(df, "new_events")
    snapshots.append_rows(df, "new_events")
    assert spark.table("new_events").count() == 10
    assert snapshots.bootstrap(spark.table("new_events"), "old_events")
    assert not snapshots.bootstrap(spark.table("new_events"), "old_events")
    snapshots.replace_rows(df, "new_events")
    assert spark.table("new_events").count() == 5
    snapshots.truncate(spark, "new_events")
    assert spark.table("new_events").count() == 0
    assert spark.table("old_events").count() == 10


def test_no_snapshot_gives_an_empty_frame(spark, tmp_path):
    path = str(tmp_path / "s")
    snapshots.promote(spark.range(3), path, "2024-01-10")
    stored = spark.read.parquet(path)
    asof = F.lit("2024-01-10").cast("date")
    assert snapshots.latest_snapshot(stored, before=asof).count() == 0
    assert snapshots.latest_snapshot(stored).count() == 3


def test_csv_gate_looks_at_every_column(spark, tmp_path):
    names = [f"c{k}" for k in range(70)]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join("x" * 70) + "\n")
    (tmp_path / "b.csv").write_text(",".join(names[:64] + [f"d{k}" for k in range(6)]) + "\n")
    (tmp_path / "c.csv").write_text("\n" + ",".join(reversed(names)) + "\n")
    judged = csv_drop.gate(csv_drop.csv_files(csv_drop.read_cells(spark, str(tmp_path)))).collect()
    assert {os.path.basename(r.file): r.accepted for r in judged} == {"a.csv": True, "b.csv": False, "c.csv": True}
    assert all(len(r.columns) == 70 for r in judged)


def test_csv_header_over_two_lines(spark, tmp_path):
    """A header whose quoted name holds a line break has more columns than its first line."""
    names = ['"two', 'lines"', *[f"c{k}" for k in range(30)]]
    (tmp_path / "a.csv").write_text("x,y," + "\n".join(names[:2]) + "," + ",".join(names[2:]) + "\n")
    files = csv_drop.csv_files(csv_drop.read_cells(spark, str(tmp_path))).collect()
    assert [len(r.header) for r in files] == [33] and files[0].header[2] == "two\nlines"


def test_csv_gate(spark, tmp_path):
    head = ",".join(CSV_COLUMNS)
    row = '"A, ""b""",2024-01-01,2024-01-01,10:00, ,"Line\nbreak",Kiel,d,c,True\n'
    (tmp_path / "a.csv").write_text(f"{head}\n{row}")
    (tmp_path / "b.csv").write_text(f",{head}\n0,{row}")
    (tmp_path / "c.csv").write_text(f"{head},extra\n{row}")
    (tmp_path / "empty.csv").write_text("")
    rows, rejected = csv_drop.read_event_csvs(spark, str(tmp_path))
    found = rows.select(*EVENT_COLUMNS).collect()
    assert len(found) == 2
    assert found[0].subject == 'A, "b"' and found[0].end_time == " "
    assert found[0].location == "Line\nbreak" and found[0].music_label is True
    assert [os.path.basename(r.file) for r in rejected.collect()] == ["c.csv"]


@pytest.mark.parametrize("cores", [1, 4, 32])
def test_csv_order_is_that_of_files_and_lines(spark, tmp_path, cores):
    """Files of very different sizes and column orders, dealt to tasks in several ways."""
    orders = {"a": CSV_COLUMNS, "b": CSV_COLUMNS[::-1], "c": CSV_COLUMNS[3:] + CSV_COLUMNS[:3]}
    expected = []
    for name, size in (("a", 2), ("b", 500), ("c", 20), ("d", 1)):
        columns = orders.get(name, CSV_COLUMNS)
        lines = [",".join(f'"{c}"' for c in columns)]
        for k in range(size):
            lines.append(",".join(f"{name}{k}" if c == "Subject" else "x" for c in columns))
            expected.append(f"{name}{k}")
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "aa.csv").write_text("")
    key = "spark.sql.files.minPartitionNum"
    spark.conf.set(key, cores)
    try:
        rows, rejected = csv_drop.read_event_csvs(spark, str(tmp_path))
        found = [r.subject for r in rows.orderBy("row_seq").collect()]
        split, _ = csv_drop.read_event_csvs(spark, str(tmp_path), multi_line=False)
        again = [r.subject for r in split.orderBy("row_seq").collect()]
    finally:
        spark.conf.unset(key)
    assert found == expected == again and rejected.count() == 0


def test_shared_folder_is_never_local_to_a_machine(spark):
    class Conf(dict):
        pass

    class Session:
        def __init__(self, **settings):
            self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})

    here = {"spark.sql.warehouse.dir": "file:/w"}
    session = Session()
    session.conf.update(here | {"spark.master": "local[2]"})
    assert shared_folder(session) == "file:/w/steps"
    session.conf.update({"spark.master": "spark://host:7077"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)
    session.conf.update({"spark.checkpoint.dir": "hdfs://x/c/"})
    assert shared_folder(session) == "hdfs://x/c"
    assert run_folder(spark).startswith(shared_folder(spark))


def test_canonical_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Start Date` int, End_Date int, City int")
    assert to_canonical(df).columns == ["start_date", "end_date", "city"]


def test_harvest_skips_incomplete_items(spark):
    html = '<li class="e"><b>A &amp; B</b><i>Kiel</i></li><li class="e"><i>Kiel</i></li>'
    pages = spark.createDataFrame(
        [(1, "https://a.example/x", html), (2, "https://b.example/x", html)],
        "page_id long, url string, html string",
    )
    selector = harvest.Selector(
        host="^a\\.", block='<li class="e">.*?</li>', required=["title"],
        fields={"title": "<b>(.*?)</b>", "city": "<i>(.*?)</i>"}, constants={"music": True},
    )
    found = harvest.harvest(pages, selector).collect()
    assert [(r.page_id, r.pos, r.title, r.city, r.music) for r in found] == [
        (1, 0, "A & B", "Kiel", True)
    ]


def test_visible_text(spark):
    html = "<b>L&uuml;beck</b> &#228;&#xE4;&#x1F600; &ndash; 5&nbsp;&euro; &amp;lt; &#0; & &unknown;"
    (row,) = spark.range(1).select(harvest.plain_text(F.lit(html)).alias("x")).collect()
    assert row.x == "Lübeck ää\U0001f600 – 5 € &lt; &#0; & &unknown;"


def test_latest_by_folder_names(spark, tmp_path):
    path = str(tmp_path / "s")
    for day, n in (("2024-01-08", 1), ("2024-01-09", 2), ("2024-01-10", 3)):
        snapshots.promote(spark.range(n), path, day)
    assert snapshots.latest_snapshot_at(spark, path).count() == 3
    assert snapshots.latest_snapshot_at(spark, path, before="2024-01-10").count() == 2
    assert snapshots.latest_snapshot_at(spark, path, before="2024-01-01").count() == 0


def test_dense_numbers_of_sparse_ids(spark):
    rng = __import__("random").Random(3)
    ids = sorted({rng.randrange(-(2**63), 2**63) for _ in range(500)} | set(range(40)))
    df = spark.createDataFrame([(i,) for i in rng.sample(ids, len(ids))], "row_seq long")
    got = dense_number(df, "row_seq").orderBy("row_seq").collect()
    assert [(r.row_seq, r.row_no) for r in got] == [(x, k + 1) for k, x in enumerate(ids)]


def test_workflows_end_to_end(spark):
    rng = __import__("random").Random(31)
    asof = F.lit("2024-01-10").cast("date")
    new, old = (event_frame(spark, events(rng, 50)).drop("colour") for _ in range(2))
    a = workflow_a(remove_duplicates(new, asof), remove_duplicates(old, asof), asof)
    assert a.filter("is_summary").count() == 1
    stamp = F.lit("2024-01-10 06:00:00").cast("timestamp_ntz")
    b = workflow_b(snapshot_b(new, asof), snapshot_b(old, asof), stamp)
    entry = payload.nested(b).select("entry.*").first()
    assert entry.colorId in {"4", "5", "10", "11"}
    assert "Event created on: 2024-01-10 06:00:00" in entry.description
