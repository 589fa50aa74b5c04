"""Greedy removal over pairs: nodes are visited in order and each survivor drops its later likes.

A node survives if none of its earlier neighbours does. Where a node has a single open earlier
neighbour it does the opposite of that one, so along a chain of such nodes fates alternate, and
pointer jumping that counts steps settles a chain of n nodes in log n rounds. What is left after that
is told apart into connected components; small ones are packed into tasks and visited there, and only
large ones need further rounds. As soon as no more edges are left than one task may visit, it does.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendra.operators.components import components
from kalendra.session import cut_lineage

#: Edges that one task visits at most, of one component or of several packed together.
COMPONENT_EDGES = 1 << 18
#: Rounds before what is left is told apart into components.
ROUNDS_BEFORE_PACKING = 2


def _alternating(open_edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`src` nodes that survive, `member` nodes that fall) as far as chains tell, a node that nothing
    precedes being the head of each."""
    before = cut_lineage(
        open_edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("up"))
    )
    heads = cut_lineage(
        open_edges.select("src").distinct().join(before.select(F.col("dst").alias("src")), "src", "left_anti")
    )
    chain = cut_lineage(
        before.filter("n = 1").select(F.col("dst").alias("node"), "up", F.lit(True).alias("odd"))
    )
    while True:
        above = chain.select(F.col("node").alias("up"), F.col("up").alias("further"), F.col("odd").alias("more"))
        jumped = cut_lineage(
            chain.join(above, "up", "left").select(
                "node", F.coalesce("further", "up").alias("up"),
                (F.col("odd") != F.coalesce("more", F.lit(False))).alias("odd"),
                F.col("further").isNotNull().alias("moved"),
            )
        )
        chain = jumped.select("node", "up", "odd")
        if jumped.filter("moved").isEmpty():
            break
    settled = cut_lineage(chain.join(heads.select(F.col("src").alias("up")), "up", "left_semi"))
    survive = heads.unionByName(settled.filter(~F.col("odd")).select(F.col("node").alias("src")))
    falls = settled.filter("odd").select(F.col("node").alias("member"))
    return survive, falls


def _visit(edges: DataFrame, task: str) -> DataFrame:
    """`member` nodes that fall, found by visiting the edges of each task."""

    def visit(pdf: pd.DataFrame) -> pd.DataFrame:
        """Every node once all its earlier neighbours are known."""
        later: dict = {}
        waiting: dict = {}
        for src, dst in zip(pdf["src"].tolist(), pdf["dst"].tolist(), strict=True):
            later.setdefault(src, []).append(dst)
            waiting[dst] = waiting.get(dst, 0) + 1
        fallen: set = set()
        ready = [node for node in later if node not in waiting]
        for node in ready:
            for dst in later.get(node, ()):
                if node not in fallen:
                    fallen.add(dst)
                waiting[dst] -= 1
                if waiting[dst] == 0:
                    ready.append(dst)
        return pd.DataFrame({"member": pd.Series(list(fallen), dtype=pdf["dst"].dtype)})

    kind = edges.schema["dst"].dataType.simpleString()
    return edges.groupBy(task).applyInPandas(visit, f"member {kind}")


def _visited(open_edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`member` nodes of small components that fall, edges of the large components)."""
    ends = open_edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    roots = components(open_edges, ends).toDF("src", "root")
    rooted = cut_lineage(open_edges.join(roots, "src"))
    sizes = cut_lineage(rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n")))
    small = sizes.filter(F.col("n") <= COMPONENT_EDGES)
    total = small.agg(F.sum("n")).first()[0] or 0
    tasks = total // max(COMPONENT_EDGES, 1) + 1
    packed = rooted.join(small.select("root"), "root", "left_semi").withColumn(
        "task", F.pmod(F.xxhash64("root"), F.lit(tasks))
    )
    falls = _visit(packed, "task")
    large = rooted.join(sizes.filter(F.col("n") > COMPONENT_EDGES).select("root"), "root", "left_semi")
    return cut_lineage(falls), cut_lineage(large.select("src", "dst"))


def settle(edges: DataFrame) -> DataFrame:
    """`member`: the nodes that fall. `src` precedes `dst` in every edge, and each edge comes once or
    more."""
    open_edges = cut_lineage(edges.select("src", "dst").distinct())
    fallen = open_edges.select(F.col("dst").alias("member")).limit(0)
    rounds = 0
    while left := open_edges.count():
        if left <= COMPONENT_EDGES:  # all of them are one task's work
            one = _visit(open_edges.withColumn("task", F.lit(0)), "task")
            return fallen.unionByName(cut_lineage(one))
        if rounds == ROUNDS_BEFORE_PACKING:
            falls, open_edges = _visited(open_edges)
            fallen = fallen.unionByName(falls)
            if open_edges.isEmpty():
                break
        rounds += 1
        survive, odd = _alternating(open_edges)
        dropped = open_edges.join(survive, "src", "left_semi").select(F.col("dst").alias("member"))
        falls = cut_lineage(dropped.unionByName(odd).distinct())
        fallen = fallen.unionByName(falls)
        open_edges = cut_lineage(
            open_edges.join(falls.select(F.col("member").alias("dst")), "dst", "left_anti")
            .join(falls.select(F.col("member").alias("src")), "src", "left_anti")
            .select("src", "dst")
        )
    return fallen
