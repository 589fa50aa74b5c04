"""The prefix trie against a plain one, on odd rows, deep conversations and narrow bands."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kalendra.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole = tuple(said.get(base, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                children[whole[: d - 1]].add(whole[:d])
        ends[whole].append(c)

    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]),
            leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


def found(spark, rows, band):
    df = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), band)
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("band", [2, 16])
def test_odd_rows(spark, band):
    rng = random.Random(band)
    rows = []
    for _ in range(260):
        conv = rng.choice([None, -205, -101, -7, 0, 1, 2, 100, 101, 150, 199, 250, 300, 301, 302])
        turn = rng.choice([None, 0, 1, 2, 3, 5, 8, 13])
        rows.append((conv, turn, rng.choice([None, "user", "ä"]), rng.choice([None, "", "a", "ab", "日本"])))
    rows += rows[:40]
    rows += [(300, t, "user", "same") for t in range(12)] + [(303, t, "user", "same") for t in range(12)]
    assert found(spark, rows, band) == plain(rows)


def test_deep_conversation_over_many_ranges(spark):
    rows = [(c, t, "user", f"turn {t}") for c, n in ((0, 300), (1, 290), (2, 7), (77, 300)) for t in range(n)]
    rows += [(500 + c, 0, "user", "x") for c in range(30)]
    assert found(spark, rows, 4) == plain(rows)


def test_conversation_of_equal_rows_and_very_long_text(spark):
    rows = [(5, None, "user", "again")] * 200 + [(6, 1, "user", "y" * 200_000), (6, 1, "user", "y" * 199_999 + "z")]
    assert found(spark, rows, 16) == plain(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert found(spark, [], 16) == []
    assert found(spark, [(None, 1, "user", "x")], 16) == []
    short = [(c, 0, "user", "x") for c in range(101, 140)]  # no conversation 100: many have no turn left
    assert found(spark, short, 16) == plain(short)


def test_other_columns_do_not_matter(spark):
    rows = [(c, t, "user", f"{t}") for c in (0, 1, 2) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    noisy = df.withColumns({c: F.lit("x") for c in ("p", "k1", "rep", "n", "place", "i", "chars", "band")})
    assert sorted(map(tuple, prefix_trie.trie(noisy).collect())) == plain(rows)


def test_many_conversations_end_at_one_node(spark):
    rows = [(c, 0, "user", "hello") for c in range(0, 300_000, 100)]
    assert found(spark, rows, 16) == plain(rows)
