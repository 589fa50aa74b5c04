"""The smallest publish against counting by hand, with broken runs, copies and nulls."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalendra.operators import publish_delta as P
from kalendra.sources import versions
from kalendra.sources.calendar import Calendar

SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("title", "city", "place")] + [T.StructField("day", T.IntegerType())]
)
KEY, BODY = ["title", "city"], ["place", "day"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def listed(calendar, spark):
    return Counter((r.title, r.city, r.place, r.day) for r in calendar.entries(spark).collect())


def least_calls(old, new):
    """Calls of each kind and key: equal entries stay, the others of a key become one another."""
    out = Counter()
    for key in {r[:2] for r in [*old, *new]}:
        was = Counter({r: n for r, n in Counter(old).items() if r[:2] == key})
        now = Counter({r: n for r, n in Counter(new).items() if r[:2] == key})
        same = (was & now).total()
        w, p = now.total() - same, was.total() - same
        for action, n in (("update", min(w, p)), ("insert", max(w - p, 0)), ("delete", max(p - w, 0))):
            if n:
                out[(action, *key)] = n
    return out


def told(calls):
    return Counter((r.action, r.title, r.city) for r in calls.collect())


def random_rows(rng, n):
    return [
        (rng.choice(["a", "b", "c", None, ""]), rng.choice(["x", None]), rng.choice(["p", "q", None]), rng.choice([1, 2, None]))
        for _ in range(n)
    ]


def test_random_days(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "PIECE_BITS", 1)
    rng = random.Random(1)
    calendar = Calendar(str(tmp_path / "calendar"), SCHEMA, KEY, BODY)
    old = []
    for n in (30, 45, 0):
        new = random_rows(rng, n)
        calls = calendar.calls(frame(spark, new))
        rows = calls.collect()
        assert told(calls) == least_calls(old, new)
        assert len({r.entry_id for r in rows}) == len(rows)
        calendar.record(spark.createDataFrame(rows, calls.schema))
        assert listed(calendar, spark) == Counter(new)
        ids = [r.entry_id for r in calendar.entries(spark).collect()]
        assert len(set(ids)) == len(ids)
        assert calendar.calls(frame(spark, new)).count() == 0
        old = new


def test_broken_runs_go_on_where_they_stopped(spark, tmp_path):
    rng = random.Random(4)
    calendar = Calendar(str(tmp_path / "calendar"), SCHEMA, KEY, BODY)
    old, new = random_rows(rng, 40), random_rows(rng, 40)
    calendar.record(calendar.calls(frame(spark, old)))
    planned = calendar.calls(frame(spark, new)).count()
    made = 0
    for part in (0, 1):
        calls = calendar.calls(frame(spark, new))
        some = calls.filter(F.pmod(F.xxhash64("entry_id"), F.lit(3)) == part).collect()
        made += len(some)
        calendar.record(spark.createDataFrame(some, calls.schema))
    rest = calendar.calls(frame(spark, new))
    made += rest.count()
    calendar.record(rest)
    assert listed(calendar, spark) == Counter(new)
    assert made <= planned  # nothing was called for twice


def test_ids_stay_while_an_entry_is_published(spark, tmp_path):
    calendar = Calendar(str(tmp_path / "calendar"), SCHEMA, KEY, BODY)
    calendar.record(calendar.calls(frame(spark, [("a", "x", "p", 1), ("b", "x", "p", 1)])))
    before = {r.title: r.entry_id for r in calendar.entries(spark).collect()}
    calendar.record(calendar.calls(frame(spark, [("a", "x", "q", 2), ("b", "x", "p", 1), ("c", "x", "p", 1)])))
    after = {r.title: r.entry_id for r in calendar.entries(spark).collect()}
    assert after["a"] == before["a"] and after["b"] == before["b"] and len(set(after.values())) == 3


def test_only_branches_with_a_difference_are_read_and_written(spark, tmp_path):
    path = str(tmp_path / "calendar")
    calendar = Calendar(path, SCHEMA, KEY, BODY)
    rows = [(f"t{k}", "x", "p", k) for k in range(400)]
    calendar.record(calendar.calls(frame(spark, rows)))
    before = versions.pointer(spark, path)
    changed = [*rows[:-1], ("t399", "x", "elsewhere", 399)]
    calls = calendar.calls(frame(spark, changed))
    leaf = P.identified(frame(spark, [changed[-1]]), KEY, BODY).first().leaf
    opened = P.differing_leaves(
        P.leaf_digests(P.identified(frame(spark, changed), KEY, BODY)), calendar.digests(spark)
    )
    assert opened == [leaf]
    calendar.record(calls)
    after = versions.pointer(spark, path)
    assert {k for k in after if after[k] != before.get(k)} == {f"branch={leaf >> 8}", f"sums={leaf >> 8}"}
    assert listed(calendar, spark) == Counter(changed)


def test_a_pair_of_copies_is_not_taken_for_another(spark):
    """Digests are sums, so that equal copies do not cancel out."""
    one = P.leaf_digests(P.identified(frame(spark, [("a", "x", "p", 1)] * 2), KEY, BODY))
    other = P.leaf_digests(P.identified(frame(spark, [("a", "x", "q", 1)] * 2), KEY, BODY))
    assert P.differing_leaves(one, other) and not P.differing_leaves(one, one)


def test_batches_of_calls(spark, tmp_path):
    calendar = Calendar(str(tmp_path / "calendar"), SCHEMA, KEY, BODY)
    calls = P.with_call_batches(calendar.calls(frame(spark, [("a", "x", "p", k) for k in range(25)])), 10)
    rows = calls.collect()
    assert sorted(r.call_no for r in rows) == list(range(1, 26))
    assert Counter(r.batch_no for r in rows) == {0: 10, 1: 10, 2: 5}


def test_versions_switch_in_one_step(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    assert versions.read_table(spark, path, schema).count() == 0
    versions.replace_table(spark.createDataFrame([(1,), (2,)], schema), path)
    held = versions.read_table(spark, path, schema)
    versions.replace_table(held.filter("n = 2"), path)  # the new rows come from the table itself
    assert [r.n for r in versions.read_table(spark, path, schema).collect()] == [2]
    assert sorted(r.n for r in held.collect()) == [1, 2]  # a reader of the old version still sees it
    staged = versions.stage_parts(spark.createDataFrame([(9, "b")], "n int, part string"), path, "part", ["a", "b"])
    assert staged["part=a"] is None and versions.read_parts(spark, path, "part", schema).count() == 0
    versions.switch_parts(spark, path, staged)
    assert [r.n for r in versions.read_parts(spark, path, "part", schema, ["b", "c"]).collect()] == [9]
    assert [r.n for r in versions.read_table(spark, path, schema).collect()] == [2]


def test_rows_travel_without_long_ids(spark):
    """Hashes are bytes, and what is compared carries neither the ids of entries nor anything as text."""
    rows = P.identified(frame(spark, [("a", "x", "p", 1)]), KEY, BODY)
    row = rows.first()
    assert len(row.key_id) == len(row.body_id) == 16 and rows.schema["key_id"].dataType == T.BinaryType()
    assert row.leaf == int(bytes(row.key_id).hex()[:4], 16)
    published = rows.withColumn("slot", F.lit(0).cast("long"))
    calls = P.calls_between(P.identified(frame(spark, [("a", "x", "q", 1)]), KEY, BODY), published, KEY, BODY)
    assert [(r.action, r.entry_id, r.slot) for r in calls.collect()] == [("update", f"{bytes(row.key_id).hex()}-0", 0)]
