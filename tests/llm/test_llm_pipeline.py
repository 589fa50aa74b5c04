"""Stages of the corpus pipeline."""

from __future__ import annotations

import random

import corpus_pipeline
from kalendra.llm import near_dedup


def test_agreeing_values():
    assert near_dedup.agreeing(85) == 42 and 30 < near_dedup.agreeing(80) < 39


def test_near_copies_of_four_fifths_go(spark):
    rng = random.Random(21)
    rows = []
    for d in range(150):
        words = [f"v{rng.randrange(10**6)}" for _ in range(100)]
        rows.append((d, " ".join(words)))
        for k in (rng.randrange(10, 40), rng.randrange(50, 90)):
            words[k] = "changed"
        rows.append((1000 + d, " ".join(words)))  # 86 of 106 shingles are shared
        if d < 50:
            for k in (5, 45, 94):
                words[k] = "other"
            rows.append((2000 + d, " ".join(words)))
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(96)} for d, t in rows}
    gone = set()
    for d, own in sets.items():
        for e in (d % 1000, d % 1000 + 1000):
            if e < d and 100 * len(own & sets[e]) >= 80 * len(own | sets[e]):
                gone.add(d)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == set(sets) - gone and len(gone) >= 150
