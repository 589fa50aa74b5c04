"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendra.session import cut_lineage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(`node`, `root`): every node of an edge with the least node of its component.

    Large-star and small-star rounds (Kiveris et al. 2014), O(log² n) of them, on pairs of a node
    and a smaller one. Each round is stored in the shared folder, and no node or edge reaches the
    driver. The least neighbours are stored before they are joined by the smaller node, so that
    both sides are plain shuffles and the many pairs of one root can be split. Edges with a null
    end are left out.
    """
    pairs = edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    current = cut_lineage(pairs.distinct())
    while True:
        least = cut_lineage(
            current.groupBy("node").agg(F.min("other").alias("m"), F.count(F.lit(1)).alias("n"))
        )
        below = least.select(F.col("node").alias("other"), "m")
        large = cut_lineage(
            current.join(below, "other", "left").select(
                "node", F.coalesce("m", "other").alias("other"), F.col("m").isNotNull().alias("moved")
            )
        )
        if large.filter("moved").isEmpty() and least.filter("n > 1").isEmpty():
            break  # every node has one smaller neighbour, which has none
        small = large.groupBy("node").agg(F.min("other").alias("m"))
        others = large.join(small, "node").filter(F.col("other") != F.col("m"))
        current = cut_lineage(
            others.select(F.col("other").alias("node"), F.col("m").alias("other"))
            .unionByName(small.select("node", F.col("m").alias("other")))
            .distinct()
        )
    roots = current.select(F.col("other").alias("node")).distinct()
    return current.select("node", F.col("other").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
