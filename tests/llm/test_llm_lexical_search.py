"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kalendra.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(docs, items, places):
    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, some in wanted.items():
        scored = []
        for doc, c in counted:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            score = 0
            for t in some & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda x: x[:3])
        out += [(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(scored[:places])]
    return sorted(out, key=repr)


def found(spark, docs, items, places):
    df = S.ranked(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        places,
    )
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def random_docs(rng, n):
    pool = ["the", "The", "THE", "of", "É", "é", "ab1", "1", "日本", "x_y", "z-z", "İ"]
    pool += [f"w{k}" for k in range(60)]
    docs = [
        (rng.choice([None, *range(n)]), " ".join(rng.choices(pool, k=rng.choice([0, 1, 3, 9, 9, 40]))))
        for _ in range(n)
    ]
    return docs + docs[: n // 5] + [(7, None), (8, ""), (9, " .,;\n")], pool


@pytest.mark.parametrize("small", [False, True])
def test_against_every_document(spark, monkeypatch, small):
    """Also with parts, shelves and blocks so small that all of them are cut."""
    if small:
        for name, value in (("PART_DOCS", 3), ("SHELF", 40), ("BLOCK_ITEMS", 2), ("FLOOR_DOCS", 30)):
            monkeypatch.setattr(S, name, value)
    rng = random.Random(3)
    docs, pool = random_docs(rng, 300)
    items = [(k, " ".join(rng.choices(pool, k=rng.choice([1, 4, 12])))) for k in range(7)]
    items += [(None, "the of"), (3, "w1 w2"), (3, None), (50, None), (51, "?!"), (52, "unheard")]
    assert found(spark, docs, items, 20) == plain(docs, items, 20)


def test_crowd_of_copies_and_ties(spark):
    docs = [(k % 40, "one copied text") for k in range(400)] + [(900, "other words"), (901, "copied")]
    items = [(1, "copied text"), (2, "other"), (1, "copied text")]
    assert found(spark, docs, items, 50) == plain(docs, items, 50)


def test_very_long_text(spark):
    docs = [(1, "far " * 300_000 + "needle"), (2, "needle in hay"), (3, "hay")]
    items = [(1, "needle far")]
    assert found(spark, docs, items, 50) == plain(docs, items, 50)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "x")], 5) == []
    assert found(spark, [(1, "x")], [], 5) == []
    assert found(spark, [(1, None)], [(1, "x")], 5) == []


def test_other_columns_do_not_matter(spark):
    noise = {c: F.lit("x") for c in ("item", "term", "terms", "n", "m", "place", "score", "rank", "tfs")}
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, text string").withColumns(noise)
    items = spark.createDataFrame([(5, "b a")], "item_id long, text string").withColumns(noise)
    got = sorted(map(tuple, S.ranked(docs, items).collect()))
    assert got == plain([(1, "a b"), (2, "b")], [(5, "b a")], 50)


def test_only_promising_parts_are_visited():
    """A part whose bound lies below the floor is not scored."""
    import numpy as np

    block = S._block([(1, np.array([3, 5], np.uint64))])
    rows = [(k, np.array([0, 1], "<u4"), np.array([k % 3 + 1, 1])) for k in range(30)]
    weights = np.array([900, 400])
    shelf = [S._part(rows, m, weights) for m in (50, 90, 500)]
    scored = []
    searcher = S.Searcher(block, weights, np.zeros(1, np.int64), 5)
    score = searcher._score
    searcher._score = lambda item, part, held: (scored.append(part), score(item, part, held))
    searcher.visit(shelf)
    assert scored == shelf[:1]


def test_strata_cut_into_parts_and_shelves(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = random.Random(11)
    block = S._block([(k, np.unique(np.array(rng.sample(range(20), 4), np.uint64))) for k in range(9)])
    weights = np.array([rng.randrange(1, 900) for _ in block.terms])
    rows = []
    for doc in range(500):
        held = np.array(sorted(rng.sample(range(len(block.terms)), rng.randrange(1, 6))), "<u4")
        tfs = np.array([rng.randrange(1, 4) for _ in held], "<i8")
        rows.append({"m": doc // 90 + 50, "doc_id": doc, "terms": held.tobytes(), "tfs": tfs.tobytes()})

    def places():
        batches = [pa.RecordBatch.from_pylist(rows[a : a + 70]) for a in range(0, 500, 70)]
        out = S._search(block, weights, np.zeros(9, np.int64), 10)(batches)
        return sorted((r["item"], -r["score"], r["doc_id"]) for b in out for r in b.to_pylist())

    whole = places()
    assert len(whole) == 90
    for name, value in (("PART_DOCS", 3), ("PART_TERMS", 5), ("SHELF", 40)):
        monkeypatch.setattr(S, name, value)
        assert places() == whole
