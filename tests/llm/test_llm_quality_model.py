"""Statistics against plain Python, trees against a walk node by node, held-out accuracy, odd rows."""

from __future__ import annotations

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kalendra.llm import quality_model as Q
from kalendra.llm.words import text_bytes

SF_DIR = "/root/testdata/sf0.01"


def plain_statistics(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = [x for x in data.split(b"\n") if x]
    grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    lengths = [len(w) for w in words]
    mean = sum(lengths) / max(len(words), 1)

    def share(part, whole):
        return part / max(whole, 1)

    def has(w, low):
        return any(97 <= c <= 122 or (not low and (65 <= c <= 90 or c >= 128)) for c in w)

    counts = Counter(data)
    out = [share(sum(counts[b] for b in np.flatnonzero(t).tolist()), len(data)) for t in Q.CLASSES.values()]
    out += [
        math.log1p(len(data)), math.log1p(len(words)), math.log1p(len(lines)), mean,
        math.sqrt(max(0, sum(n * n for n in lengths) / max(len(words), 1) - mean**2)),
        math.log1p(max(lengths, default=0)), share(len(words), len(lines)), share(len(set(words)), len(words)),
        share(max(Counter(words).values(), default=0), len(words)), 1 - share(len(set(grams)), len(grams)),
        share(sum(not has(w, False) for w in words), len(words)),
        share(sum(has(w, False) and not has(w, True) and len(w) > 1 for w in words), len(words)),
        share(sum(n <= 3 for n in lengths), len(words)),
        share(sum(has(w[-1:], False) for w in words), len(words)),
        share(sum(x[-1:] in b".?!\"'" for x in lines), len(lines)), 1 - share(len(set(lines)), len(lines)),
        share(data.count(b"\n") + 1 - len(lines), data.count(b"\n") + 1),
        share(sum(a == b for a, b in zip(data, data[1:], strict=False)), len(data)),
        -sum(n / len(data) * math.log2(n / len(data)) for n in counts.values()) if data else 0.0,
    ]
    return out


def test_statistics_of_odd_texts():
    rng = random.Random(5)
    pool = ["the", "THE", "É", "日本", "a!!", "x" * 50, "$$$", "1.5", "|", "\n", "\n\n", "\t", "end.", "\x01"]
    texts = [None, "", " ", "\n", "a", "a\n", "AB", "x" * 100_000]
    texts += [" ".join(rng.choices(pool, k=rng.randrange(1, 60))) for _ in range(80)]
    got = Q.statistics(*text_bytes(pa.array(texts, pa.string())))
    assert got.shape == (len(texts), len(Q.STATISTICS))
    for row, text in zip(got, texts, strict=True):
        assert np.allclose(row, plain_statistics(text), atol=2e-3), text


def walk(trees, x):
    margin = trees.base
    for f, t, v in zip(trees.feature, trees.threshold, trees.value, strict=True):
        at = 0
        for _ in range(Q.DEPTH):
            at = 2 * at + (2 if x[f[at]] > t[at] else 1)
        margin += v[at - (2**Q.DEPTH - 1)]
    return 1 / (1 + math.exp(-margin))


def test_flat_trees_walk_like_plain_ones_and_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 5)).astype(np.float32)
    x[:, 3] = 1.0  # a statistic without a choice of thresholds
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = Q.learn(x[:500], y[:500], np.ones(500))
    scores = trees.scores(x)
    assert np.allclose(scores, [walk(trees, r) for r in x])
    assert ((scores[500:] >= 0.5) == y[500:]).mean() > 0.93


def test_best_split_is_that_of_all_splits():
    """The first split of the first tree has the gain of the best split among all thresholds."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 20, size=(300, 4)).astype(np.float32)
    y = (x[:, 2] + rng.normal(size=300) * 4 > 9).astype(float)
    trees = Q.learn(x, y, np.ones(300))
    p = y.mean()
    g, h = p - y, np.full(300, p * (1 - p))

    def gain(f, t):
        up = x[:, f] > t
        if h[up].sum() < Q.LEAST_WEIGHT or h[~up].sum() < Q.LEAST_WEIGHT:
            return -np.inf
        return sum(g[s].sum() ** 2 / (h[s].sum() + Q.RIDGE) for s in (up, ~up))

    best = max(gain(f, t) for f in range(4) for t in np.unique(x[:, f]))
    assert abs(gain(trees.feature[0, 0], trees.threshold[0, 0]) - best) < 1e-9


def scored(spark, docs, labels):
    return Q.quality(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def test_odd_rows_and_labels(spark):
    rng = random.Random(8)
    good = ["Plain words stand here in a row. " * rng.randrange(1, 9) for _ in range(150)]
    bad = ["BUY!! NOW!! $$$ " * rng.randrange(1, 9) for _ in range(150)]
    docs = list(enumerate(good + bad)) + [(None, "text"), (None, None), (5, good[5]), (901, None), (902, "")]
    labels = [(k, int(k < 150)) for k in range(300)]
    labels += [(7, 1), (7, 0), (8, None), (None, 0), (9999, 1), (901, 1)]
    rows = scored(spark, docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in docs)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id is not None and r.doc_id < 300:
            assert r.predicted == int(r.doc_id < 150)
    assert len({r.score for r in rows if r.doc_id in (901, 902)}) == 1


def test_nothing_to_learn_from(spark):
    for labels in ([], [(1, 1), (2, 1)], [(1, None)]):
        rows = scored(spark, [(1, "a"), (2, None)], labels).collect()
        assert [(r.score, r.predicted) for r in rows] == [(0.5, 1)] * 2
    assert scored(spark, [], [(1, 0)]).collect() == []


def test_many_labelled_rows_of_one_document_stay_bounded(spark, monkeypatch):
    """The sample holds no more rows than stated, whatever the number of rows that share a doc_id."""
    monkeypatch.setattr(Q, "SAMPLE_PER_LABEL", 40)
    seen = []
    learn = Q.learn
    monkeypatch.setattr(Q, "learn", lambda x, y, w: (seen.append(len(x)), learn(x, y, w))[1])
    hot = next(k for k in range(9) if zlib.crc32(str(k).encode()) % 3 != 1)
    docs = [(hot, f"text {k}") for k in range(500)] + [(k, "LOUD!!") for k in range(10, 200)]
    labels = [(hot, 1)] + [(k, 0) for k in range(10, 200)]
    assert len(scored(spark, docs, labels).collect()) == len(docs)
    assert seen and seen[0] <= 80


def test_other_columns_do_not_matter(spark):
    noise = {c: F.lit("q") for c in ("x", "quality", "score", "good", "turn", "held_out")}
    docs = spark.createDataFrame([(k, "aa bb" if k % 2 else "## ##") for k in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    plain = sorted(map(tuple, Q.quality(docs, labels).collect()))
    noisy = labels.withColumns({c: F.lit("z") for c in ("x", "good", "score")})
    assert sorted(map(tuple, Q.quality(docs.withColumns(noise), noisy).collect())) == plain


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.quality(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    assert len(bad) > 10 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9
