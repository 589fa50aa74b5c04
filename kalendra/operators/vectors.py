"""Pairs of vectors with a cosine above a threshold, exactly, without comparing every tile with every
other.

The vectors of a block lie in cells around pivots, each with the largest angle between its pivot and a
member. By the triangle inequality for angles two cells cannot hold a pair nearer than the angle
between their pivots less both radii, so cells that are too far apart are never compared. A large cell
is cut into tiles, and each pair of tiles that is left is one small matrix product in its own task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendra.functions.similarity import cosine
from kalendra.session import cut_lineage

TILE_ROWS = 2048
#: Cells of a block, at most, and the vectors of it that pivots are picked from, about.
MOST_CELLS, CANDIDATES = 256, 1024
#: Angles are rounded in their last places; cells that seem this little too far apart are compared.
SLACK = 1e-6
EDGES = "src long, dst long"


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    matrix = np.array(vectors.tolist(), dtype="float64")
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms == 0, 1.0, norms)


def _schema(df: DataFrame, names: list[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def pivots(vectors: DataFrame, block: list[str], tile_rows: int) -> DataFrame:
    """Block, `cell` and `pivot`: vectors of each block that lie far from each other, a cell for about
    every tile's worth of vectors. A block that is no larger than a tile has none."""
    sizes = vectors.groupBy(*block).agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("least")
    )
    large = cut_lineage(sizes.filter(F.col("n") > tile_rows))
    drawn = F.pmod(F.xxhash64(F.lit(1), F.col("node")), F.col("n")) < CANDIDATES
    some = vectors.join(large, block).filter(drawn | (F.col("node") == F.col("least")))
    kinds = _schema(vectors, [*block, "v"])
    unit_rows, most = _unit_rows, MOST_CELLS  # named here so that they travel with the task

    def spread_out(pdf: pd.DataFrame) -> pd.DataFrame:
        """The least node first, then always the candidate farthest from all picked ones."""
        pdf = pdf.sort_values("node").reset_index(drop=True)
        units = unit_rows(pdf["v"])
        wanted = min(most, len(pdf), int(pdf["n"].iat[0]) // tile_rows + 1)
        picked, nearest = [0], units @ units[0]
        while len(picked) < wanted and nearest.min() < 1 - 1e-9:
            picked.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, units @ units[picked[-1]])
        out = pdf.iloc[picked][[*block, "v"]].copy()
        out["cell"] = np.arange(len(picked), dtype="int32")
        return out

    chosen = some.select(*block, "node", "n", "v").groupBy(*block).applyInPandas(spread_out, f"{kinds}, cell int")
    return cut_lineage(chosen.withColumnRenamed("v", "pivot"))


def in_cells(vectors: DataFrame, centres: DataFrame, block: list[str], tile_rows: int) -> DataFrame:
    """The vectors with `cell`, that of their nearest pivot, and `angle` to it. A block is dealt out in
    chunks that each meet the block's pivots; one without pivots is one cell."""
    sizes = vectors.groupBy(*block).agg(F.count(F.lit(1)).alias("n"))
    chunks = cut_lineage(
        sizes.withColumn("chunks", F.ceil(F.col("n") / F.lit(tile_rows)).cast("int")).drop("n")
    )
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = vectors.join(chunks, block).withColumn("chunk", chunk).drop("chunks")
    met = (
        centres.join(chunks, block)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .drop("chunks")
    )
    kept = [*block, "node", "text", "v"]
    unit_rows = _unit_rows

    def nearest(rows: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        out = rows[kept].copy()
        if len(around) == 0 or len(rows) == 0:
            out["cell"], out["angle"] = np.int32(0), math.pi
            return out
        products = unit_rows(rows["v"]) @ unit_rows(around["pivot"]).T
        best = products.argmax(axis=1)
        out["cell"] = around["cell"].to_numpy()[best].astype("int32")
        near = products[np.arange(len(rows)), best]
        out["angle"] = np.arccos(np.clip(near, -1.0, 1.0))
        return out

    kinds = _schema(vectors, kept)
    keys = [*block, "chunk"]
    return dealt.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInPandas(nearest, f"{kinds}, cell int, angle double")


def cell_pairs(
    placed: DataFrame, centres: DataFrame, block: list[str], above: float, tile_rows: int
) -> DataFrame:
    """Block, `a`, `tiles_a`, `b`, `tiles_b`: the cells that may hold a pair above the threshold, each
    with itself and with others near enough. A block has at most MOST_CELLS cells."""
    cells = placed.groupBy(*block, "cell").agg(
        F.max("angle").alias("radius"), F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).cast("int").alias("tiles")
    )
    known = cut_lineage(cells.join(centres, [*block, "cell"], "left"))
    names = ["cell", "radius", "tiles", "pivot"]
    a = known.select(*block, *[F.col(c).alias(f"{c}_a") for c in names])
    b = known.select(*block, *[F.col(c).alias(f"{c}_b") for c in names])
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine(F.col("pivot_a"), F.col("pivot_b")))))
    # With a threshold below 0 a vector of length 0, which has no angle, is near to all.
    limit = math.acos(min(above, 1.0)) + SLACK if above >= 0 else math.inf
    near = apart - F.col("radius_a") - F.col("radius_b") <= F.lit(limit)
    return (
        a.join(b, block)
        .filter(F.col("cell_a") <= F.col("cell_b"))
        .filter((F.col("cell_a") == F.col("cell_b")) | F.coalesce(near, F.lit(True)))
        .select(*block, F.col("cell_a").alias("a"), "tiles_a", F.col("cell_b").alias("b"), "tiles_b")
    )


def tile_pairs(cells: DataFrame) -> DataFrame:
    """The pairs of tiles (`a`, `i`), (`b`, `j`) of cell pairs, each once."""
    i, j = (F.explode(F.sequence(F.lit(0), F.col(f"tiles_{c}") - 1)) for c in "ab")
    return (
        cells.withColumn("i", i)
        .withColumn("j", j)
        .filter((F.col("a") != F.col("b")) | (F.col("i") <= F.col("j")))
        .drop("tiles_a", "tiles_b")
    )


def cosine_edges(
    nodes: DataFrame, block: list[str], subject: str, vector: str, above: float, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """`src`, `dst` of every pair of a block with cosine above the threshold, `src` first in text order.

    A null vector is like none; a vector of length 0 has cosine 0 with every other.
    """
    vectors = cut_lineage(
        nodes.filter(F.col(vector).isNotNull()).select(
            *block, "node", F.col(subject).alias("text"), F.col(vector).alias("v")
        )
    )
    sizes = vectors.groupBy(*block).agg(F.count(F.lit(1)).alias("n"))
    if sizes.filter(F.col("n") > tile_rows).isEmpty():  # every block is one tile
        return vectors.withColumn("first", F.lit(True)).groupBy(*block).applyInPandas(_compare(above), EDGES)
    centres = pivots(vectors, block, tile_rows)
    placed = cut_lineage(in_cells(vectors, centres, block, tile_rows))
    cells = cut_lineage(cell_pairs(placed, centres, block, above, tile_rows))
    return _compared(placed, cells, block, above)


def _compare(above: float):
    """Compares the rows of one tile, or of two that `first` tells apart."""
    unit_rows = _unit_rows

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf[pdf["first"]]
        same = len(one) == len(pdf)
        other = one if same else pdf[~pdf["first"]]
        x, y = np.nonzero(unit_rows(one["v"]) @ unit_rows(other["v"]).T > above)
        if same:
            x, y = x[x < y], y[x < y]
        a, b = one["node"].to_numpy()[x], other["node"].to_numpy()[y]
        text_a, text_b = one["text"].to_numpy()[x], other["text"].to_numpy()[y]
        ahead = np.array((text_a < text_b) | ((text_a == text_b) & (a < b)), dtype=bool)
        return pd.DataFrame({"src": np.where(ahead, a, b), "dst": np.where(ahead, b, a)}, dtype="int64")

    return compare


def _compared(placed: DataFrame, cells: DataFrame, block: list[str], above: float) -> DataFrame:
    tiles = cells.filter(F.col("a") == F.col("b")).select(*block, F.col("a").alias("cell"), F.col("tiles_a").alias("tiles"))
    tile = F.pmod(F.xxhash64(F.lit(2), F.col("node")), F.col("tiles")).cast("int")
    cut = cut_lineage(
        placed.join(tiles, [*block, "cell"]).select(*block, "cell", tile.alias("tile"), "node", "text", "v")
    )
    pairs = cut_lineage(tile_pairs(cells))
    keys = [*block, "a", "i", "b", "j"]

    def side(cell: str, number: str, left: bool) -> DataFrame:
        wanted = pairs.withColumns({"cell": F.col(cell), "tile": F.col(number)})
        if not left:
            wanted = wanted.filter((F.col("a") != F.col("b")) | (F.col("i") != F.col("j")))
        return cut.join(wanted, [*block, "cell", "tile"]).select(*keys, F.lit(left).alias("first"), "node", "text", "v")

    spread = side("a", "i", True).unionByName(side("b", "j", False))
    return spread.groupBy(*keys).applyInPandas(_compare(above), EDGES)
