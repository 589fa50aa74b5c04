"""Edited copies of items against aligning every document with every item."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kalendra.llm import decontaminate as D

WORDS = [f"w{k}" for k in range(4000)]


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def plain(docs, items, least=0.5):
    number = {}

    def tokens(text):
        return np.array([number.setdefault(w, len(number)) for w in re.findall(r"\w+", (text or "").lower())], np.int32)

    out = {}
    for doc, text in docs:
        body = tokens(text)
        for item, wanted in items:
            words = tokens(wanted)
            if doc is None or item is None or not len(words):
                continue
            best, _ = D.align(words, body)
            if best >= D.needed_score(len(words), least):
                out[doc, item] = max(out.get((doc, item), 0), best / len(words))
    return out


def found(spark, docs, items):
    rows = D.contaminated(*frames(spark, docs, items)).collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id): r.score for r in rows}


def edited(rng, words, kind):
    if kind == "every 4th changed":
        return [w if (k + 1) % 4 else "other" for k, w in enumerate(words)]
    if kind == "word put in after every 2nd":
        return [x for k, w in enumerate(words) for x in ([w, "put"] if k % 2 else [w])]
    if kind == "half":
        return words[: (len(words) + 1) // 2]
    out = list(words)
    for _ in range(rng.randrange(0, len(words) // 2)):
        at = rng.randrange(len(out))
        out[at : at + rng.choice([0, 1, 1])] = rng.choice([[], ["new"], [rng.choice(WORDS)]])
    return out


KINDS = ["every 4th changed", "word put in after every 2nd", "half", "any", "any", "any"]


def test_every_copy_that_scores_is_found(spark):
    """With verbatim copies of every item in the corpus, from half the score on: all of brute force."""
    rng = random.Random(2)
    items = [(k, " ".join(rng.sample(WORDS, rng.choice([4, 5, 7, 9, 16, 24, 40])))) for k in range(30)]
    docs = []
    for item, text in items:
        words = text.split()
        for body in [words] * 3 + [edited(rng, words, kind) for kind in KINDS]:
            around = rng.choices(WORDS, k=60)
            docs.append((len(docs), " ".join([*around[:30], *body, *around[30:]])))
    expected = plain(docs, items)
    assert sum(0.5 <= s < 0.7 for s in expected.values()) > 40
    assert found(spark, docs, items) == expected


def test_sixty_copies_with_every_fourth_word_changed(spark):
    rng = random.Random(4)
    items = [(k, " ".join(rng.sample(WORDS, 24))) for k in range(60)]
    docs = [(1000 * c + k, t) for c in (1, 2, 3) for k, t in items]
    docs += [(k, " ".join(edited(rng, t.split(), KINDS[0]) + ["end"])) for k, t in items]
    got = found(spark, docs, items)
    assert all((k, k) in got for k in range(60))


def test_a_common_phrase_makes_no_pairs(spark):
    rng = random.Random(6)
    phrase = "which of the following statements is true about"
    items = [(k, f"{phrase} {' '.join(rng.sample(WORDS, 16))}") for k in range(200)]
    docs = [(k, f"{' '.join(rng.choices(WORDS, k=40))} {phrase} {' '.join(rng.choices(WORDS, k=40))}") for k in range(300)]
    pairs = D.candidates(*frames(spark, docs, items)).count()
    assert pairs < 0.01 * len(items) * len(docs)


def test_short_items_and_odd_rows(spark):
    items = [(1, "solo"), (2, "two words"), (3, "just three words"), (4, "now four words here"), (5, ""), (6, None),
             (None, "nobody asks"), (2, "two words"), (7, "the the the the the the")]
    docs = [(1, "a solo b"), (2, "two, WORDS!"), (3, "two other words"), (4, "just three"), (5, "just three words"),
            (6, "now four words"), (7, "now four words here"), (8, None), (9, ""), (None, "two words"), (10, "words two"),
            (2, "again two words"), (11, "the the the x the the the"), (12, "the the")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, [], items) == found(spark, docs, []) == {}


def test_passages_follow_the_length_of_their_items(spark):
    """One very long item does not make the passages of short ones long."""
    rng = random.Random(8)
    long_item = " ".join(rng.choices(WORDS, k=3000))
    items = [(1, long_item), (2, " ".join(WORDS[:12]))]
    docs = [(1, " ".join(rng.choices(WORDS[100:], k=4000) + WORDS[:12] + rng.choices(WORDS[100:], k=4000))), (2, long_item)]
    rows = D.candidates(*frames(spark, docs, items)).filter("item_id = 2").collect()
    assert rows and max(len(r.passage) for r in rows if r.doc_id == 1) < 200
    assert set(found(spark, docs, items)) == {(1, 2), (2, 1)}


@pytest.mark.parametrize("clash", ["_text_key", "place"])
def test_rows_go_by_their_text(spark, clash):
    items = [(1, "alpha beta gamma delta epsilon")]
    docs = [(None, "x alpha beta gamma delta epsilon"), (None, "clean"), (5, "clean too"), (5, "Alpha beta gamma delta epsilon"), (6, None)]
    df, bench = frames(spark, docs, items)
    kept = D.drop_contaminated(df.withColumn(clash, F.lit(1)), bench)
    assert kept.columns == ["doc_id", "text", clash]
    assert sorted((r.text or "" for r in kept.collect())) == ["", "clean", "clean too"]
