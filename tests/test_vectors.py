"""Exact vector search against all pairs, and how many tiles it compares."""

from __future__ import annotations

import numpy as np
import pytest

from kalendra.operators import vectors as V

SCHEMA = "blk int, node long, text string, v array<float>"


def clustered(rng, clusters, each, spread, size=16):
    centres = rng.normal(size=(clusters, size))
    points = np.repeat(centres, each, axis=0) + spread * rng.normal(size=(clusters * each, size))
    return points.astype("float32")


def plain(rows, above):
    out = set()
    for k, (blk, node, text, v) in enumerate(rows):
        for blk2, node2, text2, v2 in rows[k + 1 :]:
            if blk == blk2 and v is not None and v2 is not None:
                a, b = np.array(v, float), np.array(v2, float)
                norms = np.linalg.norm(a) * np.linalg.norm(b)
                if (a @ b / norms if norms else 0.0) > above:
                    ahead = (text, node) < (text2, node2)
                    out.add((node, node2) if ahead else (node2, node))
    return out


@pytest.mark.parametrize("above", [0.9, 0.2, -0.1])
def test_against_all_pairs(spark, above):
    rng = np.random.default_rng(3)
    points = np.concatenate([clustered(rng, 6, 25, 0.2), rng.normal(size=(60, 16)), np.zeros((3, 16))])
    rows = [(k % 2, k, f"t{k % 40}", [float(x) for x in p]) for k, p in enumerate(points)]
    rows += [(0, 900, "null", None), (7, 901, "alone", [1.0] * 16), (8, 902, "a", [1.0] * 16), (8, 903, "b", [2.0] * 16)]
    rows = [(b, n, t, None if v is None else [float(np.float32(x)) for x in v]) for b, n, t, v in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in V.cosine_edges(df, ["blk"], "text", "v", above, tile_rows=12).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, above)


def tiles_of(spark, points, above, tile_rows):
    rows = [(0, k, f"t{k}", [float(x) for x in p]) for k, p in enumerate(points)]
    df = spark.createDataFrame(rows, SCHEMA)
    centres = V.pivots(df, ["blk"], tile_rows)
    placed = V.cut_lineage(V.in_cells(df, centres, ["blk"], tile_rows))
    pairs = V.tile_pairs(V.cell_pairs(placed, centres, ["blk"], above, tile_rows)).count()
    n_tiles = sum(-(-r["count"] // tile_rows) for r in placed.groupBy("blk", "cell").count().collect())
    return pairs, n_tiles * (n_tiles + 1) // 2


def test_far_cells_are_not_compared(spark):
    """On clustered vectors the pairs of tiles grow with the number of tiles, not with its square."""
    rng = np.random.default_rng(5)
    found = [tiles_of(spark, clustered(rng, n, 40, 0.05, 64), 0.8, 20) for n in (20, 40)]
    assert all(formed < square / 5 for formed, square in found)
    assert found[1][0] < 2.5 * found[0][0] and found[1][1] > 3.5 * found[0][1]


def test_no_vectors(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert V.cosine_edges(df, ["blk"], "text", "v", 0.5).collect() == []
