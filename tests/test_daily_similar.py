"""Greedy removal day by day against one run over all rows."""

from __future__ import annotations

import random

import pytest

from kalendra.operators import daily_similar
from kalendra.operators.daily_similar import SimilarStore
from kalendra.operators.similar import drop_similar_texts
from kalendra.session import fresh_folder

SCHEMA = "row_seq long, city string, subject string, place string"
BLOCK = ["city"]


def some_rows(seed, n):
    """Texts a few letters apart, copies, and rows without city or text."""
    rng = random.Random(seed)
    bases = ["".join(rng.choices("abcdefg ", k=rng.randint(20, 40))) for _ in range(8)]
    rows = []
    for i in range(n):
        letters = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            letters[rng.randrange(len(letters))] = rng.choice("abcxyz")
        text = "".join(letters) if rng.random() < 0.95 else rng.choice([None, "", "a"])
        rows.append((i, rng.choice(["K", "L", None]), text, str(i)))
    return rows


def store_of(spark, frame):
    return SimilarStore(spark, fresh_folder(spark, "test-store"), frame.schema, BLOCK)


def seqs(frame):
    found = [r.row_seq for r in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_three_days_equal_one_run(spark):
    """Also where the index is built anew in between."""
    rows = some_rows(1, 240)
    frame = spark.createDataFrame(rows, SCHEMA)
    store = store_of(spark, frame)
    fates, changed = {}, 0
    for day in range(3):
        if day == 2:
            store.rebuild()
        for r in store.add(frame.filter(f"row_seq >= {day * 80} and row_seq < {day * 80 + 80}")).collect():
            assert fates.get(r.node) == r.fell != r.falls
            changed += r.fell is not None
            fates[r.node] = r.falls
    assert seqs(store.kept_rows(frame)) == seqs(drop_similar_texts(frame, BLOCK)[0])
    assert changed  # some texts of earlier days got another fate
    assert {r.member for r in store.fallen().collect()} == {n for n, falls in fates.items() if falls}


def test_a_day_twice_and_days_without_texts(spark, monkeypatch):
    frame = spark.createDataFrame(some_rows(2, 60), SCHEMA)
    nothing = spark.createDataFrame([(900, None, "x", ""), (901, "K", None, "")], SCHEMA)
    store = store_of(spark, frame)
    assert store.add(nothing).isEmpty() and store.fallen().isEmpty()
    assert not store.add(frame).isEmpty()
    before = seqs(store.kept_rows(frame))
    assert store.add(frame).isEmpty() and store.add(nothing).isEmpty() and store.add(frame.limit(0)).isEmpty()
    monkeypatch.setattr(daily_similar, "DRIFT", 0.0)  # the next day with a text builds the index anew
    more = frame.unionByName(spark.createDataFrame([(950, "M", "alone", "")], SCHEMA))
    store.add(more)
    assert len(store._steps()) == 1
    assert seqs(store.kept_rows(more)) == before | {950} and before == seqs(drop_similar_texts(frame, BLOCK)[0])


def test_a_new_text_may_spare_an_old_one(spark):
    """c falls to b until a, which b falls to and c is not like, comes before both."""
    a, b, c = "aaaaaaaaaabbbbbbbbbbcccccccccc", "aaaaaaaaaabbbbbbbbbbccccccccdd", "aaaaaaaaaabbbbbbbbbbccccccdddd"
    frame = spark.createDataFrame([(1, "K", b, ""), (2, "K", c, ""), (3, "K", a, "")], SCHEMA)
    store = store_of(spark, frame)
    assert {(r.node, r.falls) for r in store.add(frame.filter("row_seq < 3")).collect()} == {(1, False), (2, True)}
    later = {(r.node, r.falls, r.fell) for r in store.add(frame.filter("row_seq = 3")).collect()}
    assert later == {(3, False, None), (1, True, False), (2, False, True)}


def test_copies_come_after_their_text(spark):
    frame = spark.createDataFrame([(5, "K", "same", "")], SCHEMA)
    store = store_of(spark, frame)
    store.add(frame)
    assert store.add(spark.createDataFrame([(6, "K", "same", "")], SCHEMA)).isEmpty()
    with pytest.raises(ValueError, match="row_seq"):
        store.add(spark.createDataFrame([(4, "K", "same", "")], SCHEMA))


def test_a_broken_day_leaves_the_store(spark, monkeypatch):
    frame = spark.createDataFrame(some_rows(3, 40), SCHEMA)
    store = store_of(spark, frame)
    store.add(frame.filter("row_seq < 20"))
    before = seqs(store.fallen().withColumnRenamed("member", "row_seq"))

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(daily_similar, "switch_parts", fail)
    with pytest.raises(RuntimeError):
        store.add(frame)
    assert seqs(store.fallen().withColumnRenamed("member", "row_seq")) == before
    monkeypatch.undo()
    store.add(frame)
    assert seqs(store.kept_rows(frame)) == seqs(drop_similar_texts(frame, BLOCK)[0])
