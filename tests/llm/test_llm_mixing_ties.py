"""Repeated rows in a mix, and targets of many sources."""

from __future__ import annotations

import random

import pytest

from kalendra.llm import mixing

SCHEMA = "doc_id long, text string, source string, note string"


@pytest.mark.parametrize("doc_id", [7, None])
def test_rows_of_one_doc_id_meet_the_target(spark, doc_id):
    rows = [(doc_id, "x " * 100, "a", str(i)) for i in range(200)]
    rows += [(1000 + i, "y " * 100, "b", "") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = mixing.mix(docs).collect()
    for size in (20000, 4000):
        own = [r for r in found if r.source_size == size]
        assert len(own) * 100 == size and abs(sum(r.taken for r in own) - own[0].target) <= 100
    copies = mixing.mixed_documents(docs).collect()
    assert len(copies) * 100 == sum(r.taken for r in found)
    times = {}
    for r in copies:
        times[r.source, r.note, r.doc_id] = times.get((r.source, r.note, r.doc_id), 0) + 1
    assert max(times.values()) <= 3
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(str(r) for r in again) == sorted(str(r) for r in found)


def test_targets_of_many_sources(spark):
    rng = random.Random(3)
    sizes = {f"é{i}" if i % 3 else f"Z{i}": int(10 ** rng.uniform(0, 6)) for i in range(300)} | {None: 5, "empty": 0}
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(4))
    got = {r.source: r.target for r in found.collect()}
    low, high = 0.0, 1e9  # the level at which the targets add up to all words
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(3 * sizes[s], level * weight[s]) for s in sizes) < sum(sizes.values()):
            low = level
        else:
            high = level
    assert len(got) == len(sizes)
    assert all(abs(got[s] - min(3 * sizes[s], high * weight[s])) < 1e-3 for s in sizes)
    assert mixing.targets(found.select("source", "source_size").limit(0)).count() == 0
    nothing = spark.createDataFrame([("a", 0), (None, 0)], "source string, source_size long")
    assert [r.target for r in mixing.targets(nothing).collect()] == [0.0, 0.0]
