"""Greedy removal against visiting nodes one by one."""

from __future__ import annotations

import random

import pytest

from kalendra.operators import settling


def plain(edges):
    likes = {}
    for a, b in edges:
        likes.setdefault(b, set()).add(a)
    fallen = set()
    for node in sorted({x for e in edges for x in e}):
        if any(a not in fallen for a in likes.get(node, ())):
            fallen.add(node)
    return fallen


def found(spark, edges):
    rows = [r.member for r in settling.settle(spark.createDataFrame(edges, "src long, dst long")).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("small", [0, 120, 1 << 16])
def test_random_graphs(spark, monkeypatch, small):
    """In one task, with some components packed, and with rounds alone."""
    monkeypatch.setattr(settling, "COMPONENT_EDGES", small)
    rng = random.Random(small)
    edges = [(k * 100 + i, k * 100 + j) for k, p in enumerate((0.05, 0.2, 0.6)) for i in range(25)
             for j in range(i + 1, 25) if rng.random() < p]
    edges += [(500, 501), (500, 501)]
    assert found(spark, edges) == plain(edges)


def test_chain_of_ten_thousand(spark, monkeypatch):
    """Chains settle in a logarithmic number of rounds, each of which stores a table or two."""
    monkeypatch.setattr(settling, "COMPONENT_EDGES", 0)
    rounds = []
    cut = settling.cut_lineage
    monkeypatch.setattr(settling, "cut_lineage", lambda df: (rounds.append(1), cut(df))[1])
    edges = [(k, k + 1) for k in range(10_000)] + [(20_000 + k, 20_000 + k // 2 + 1000) for k in range(50)]
    assert found(spark, edges) == plain(edges)
    assert len(rounds) < 25


def test_ladder_is_visited(spark):
    """Every node has two earlier neighbours, so no chain tells anything."""
    edges = [(k, k + d) for k in range(3000) for d in (1, 2)]
    assert found(spark, edges) == plain(edges)


def test_no_edges(spark):
    assert found(spark, []) == set()
