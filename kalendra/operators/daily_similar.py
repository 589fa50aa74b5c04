"""Greedy removal of similar texts day by day, over a stored index of rare pieces.

The store holds every distinct text of a block (a node), the rare grams by which texts meet, the pairs
found so far and, for every node, its connected component and whether it falls. A day's new texts are
looked up by their rare grams, in the order of grams that was frozen when the index was built, so old
texts are never compared with each other again. Only components that a new pair touches are visited
anew: a new text may precede an old one and take its likes along, or spare them. After any number of
days the fates are those of one run over all rows.

Where the frozen order no longer fits the texts, frequent grams count as rare and more rows meet; the
share of rows that meet is compared with that at the build, and the index is built anew when it has
grown too much. A day's files are written beside the store and become part of it by one rename, so a
run that breaks leaves the store as it was and is simply repeated.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalendra.operators.components import components
from kalendra.operators.settling import settle
from kalendra.operators.similar import (
    _rare_grams,
    alike_pairs,
    drop_similar,
    frequency_levels,
    letter_grams,
    pair_side,
    text_nodes,
)
from kalendra.session import cut_lineage
from kalendra.sources.versions import pointer, read_parts, stage_parts, switch_parts

#: The index is built anew when a day's rows meet so many times as often as those of the build did.
DRIFT = 4.0
#: It is also built anew, and with it all files of the store joined, after so many days.
MOST_DAYS = 64
TABLE = T.StructType([T.StructField("levels", T.BinaryType()), T.StructField("load", T.DoubleType())])


class SimilarStore:
    """The store at `path` for texts in column `subject`, compared within `block`.

    order: a unique number of each row. Copies of a stored text must have larger numbers than its
    first row; other texts may have any.
    """

    def __init__(
        self, spark: SparkSession, path: str, rows_like: T.StructType, block: list[str],
        subject: str = "subject", order: str = "row_seq", slack_percent: int = 10,
    ) -> None:
        self.spark, self.path = spark, path
        self.block, self.subject, self.order, self.slack = block, subject, order, slack_percent
        blocks = [rows_like[c] for c in block]
        text, node = T.StructField("text", T.StringType()), rows_like[order].dataType
        self._schemas = {
            "nodes": T.StructType([*blocks, text, T.StructField("node", node)]),
            "grams": T.StructType(
                [*blocks, text, T.StructField("bits", T.LongType()), T.StructField("node", node),
                 T.StructField("gram", T.StringType())]
            ),
            "edges": T.StructType([T.StructField("src", node), T.StructField("dst", node)]),
            "labels": T.StructType(
                [T.StructField("node", node), T.StructField("root", node),
                 T.StructField("falls", T.BooleanType()), T.StructField("step", T.IntegerType())]
            ),
            "tables": TABLE,
        }

    def _read(self, kind: str) -> DataFrame:
        return read_parts(self.spark, self.path, kind, self._schemas[kind])

    def _stage(self, kind: str, df: DataFrame, step: int) -> dict[str, str | None]:
        columns = self._schemas[kind].fieldNames()
        return stage_parts(df.select(*columns, F.lit(step).alias(kind)), self.path, kind, [str(step)])

    def _steps(self) -> list[int]:
        found = (re.fullmatch(r"nodes=(\d+)", name) for name in pointer(self.spark, self.path))
        return sorted(int(m[1]) for m in found if m)

    def labels(self) -> DataFrame:
        """(`node`, `root`, `falls`) of every node, as of its last visit."""
        last = F.max_by(F.struct("root", "falls"), "step").alias("last")
        return self._read("labels").groupBy("node").agg(last).select("node", "last.*")

    def fallen(self) -> DataFrame:
        """`member`: the nodes that fall to an earlier text."""
        return self.labels().filter("falls").select(F.col("node").alias("member"))

    def kept_rows(self, rows: DataFrame) -> DataFrame:
        """Of all rows given to the store so far, those that are kept: the first row of each text
        that does not fall, and rows with a NULL block column or text."""
        return drop_similar(rows, self.block, self.subject, self.order, self.fallen())[0]

    def _fresh(self, rows: DataFrame) -> DataFrame:
        """Nodes of texts that the store does not hold."""
        found = text_nodes(rows, self.block, self.subject, self.order)
        found = found.withColumnRenamed(self.subject, "text")
        known = self._read("nodes").withColumnRenamed("node", "known")
        met = cut_lineage(found.join(known, [*self.block, "text"], "left"))
        if not met.filter(F.col("node") < F.col("known")).isEmpty():
            raise ValueError(f"a copy of a stored text has a smaller {self.order} than the text's first row")
        return met.filter(F.col("known").isNull()).select(*self.block, "text", "node")

    def _levels(self, nodes: DataFrame) -> bytes:
        grams = nodes.select(F.explode(letter_grams(F.col("text"))).alias("gram"))
        return frequency_levels(grams, "gram")

    def _load(self, fresh: DataFrame, stored: DataFrame) -> float:
        """The share of pairs of rows, one fresh and one of any day, that meet."""
        key = [*self.block, "gram"]
        sizes = cut_lineage(fresh.groupBy(*key).agg(F.count(F.lit(1)).cast("double").alias("c")))
        own = sizes.agg(F.sum(F.col("c") * F.col("c")).alias("met"), F.sum("c").alias("n")).first()
        met = stored.select(*key).join(sizes, key).agg(F.sum("c")).first()[0] or 0.0
        return (own.met + met) / (own.n * (own.n + stored.count()))

    def _found(self, fresh: DataFrame, stored: DataFrame) -> DataFrame:
        """`src`, `dst` (in text order) of the pairs that hold a fresh text."""
        met = pair_side(fresh, self.block, "x", "bits_x", "n").join(
            pair_side(stored.unionByName(fresh), self.block, "y", "bits_y", "m"), [*self.block, "gram"]
        )
        ahead = F.col("x") < F.col("y")
        ends = (("x", "y", "a", "b"), ("bits_x", "bits_y", "bits_a", "bits_b"), ("n", "m", "src", "dst"))
        first = [F.when(ahead, F.col(x)).otherwise(F.col(y)).alias(a) for x, y, a, _ in ends]
        second = [F.when(ahead, F.col(y)).otherwise(F.col(x)).alias(b) for x, y, _, b in ends]
        pairs = met.filter(F.col("x") != F.col("y")).select(*first, *second)
        return cut_lineage(alike_pairs(pairs, self.slack))

    def _visited(self, fresh: DataFrame, edges: DataFrame, step: int) -> tuple[DataFrame, DataFrame]:
        """New labels of the components that `edges` or fresh nodes touch, and their old labels."""
        old = cut_lineage(self.labels())
        new = fresh.select("node", F.col("node").alias("root"))
        ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        rooted = cut_lineage(ends.join(old.select("node", "root").unionByName(new), "node"))
        a, b = rooted.toDF("src", "a"), rooted.toDF("dst", "b")
        between = edges.join(a, "src").join(b, "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        roots = rooted.select(F.col("root").alias("node")).unionByName(new.select("node")).distinct()
        merged = components(between.filter("src != dst").distinct(), roots).toDF("root", "to")
        before = old.join(merged, "root")
        members = cut_lineage(
            before.select("node", "to", "falls").unionByName(
                new.join(merged, "root").select("node", "to", F.lit(None).cast("boolean").alias("falls"))
            )
        )
        touched = self._read("edges").join(members.select(F.col("node").alias("src")), "src", "left_semi")
        fallen = settle(touched.unionByName(edges)).select(F.col("member").alias("node"), F.lit(True).alias("down"))
        after = cut_lineage(
            members.join(fallen, "node", "left").select(
                "node", F.col("to").alias("root"), F.coalesce("down", F.lit(False)).alias("falls"),
                F.lit(step).alias("step"), F.col("falls").alias("fell"),
            )
        )
        return after.drop("fell"), after.filter(~F.col("fell").eqNullSafe(F.col("falls")))

    def add(self, rows: DataFrame) -> DataFrame:
        """Add a day's rows. Returns (`node`, `falls`, `fell`) of every node whose fate is new
        (`fell` is null) or has changed; no rows where the day brings no new text, as when a day is
        given again. Rows with a NULL block column or text form no node."""
        steps = self._steps()
        step = steps[-1] + 1 if steps else 1
        fresh = cut_lineage(self._fresh(rows))
        if fresh.isEmpty():
            return fresh.select("node", F.lit(None).cast("boolean").alias("falls"), F.lit(None).cast("boolean").alias("fell"))
        table = self._read("tables").first()
        levels = bytes(table.levels) if table else self._levels(fresh)
        grams = _rare_grams(fresh, self.block, "text", self.slack, levels)
        grams, stored = cut_lineage(grams), self._read("grams")
        edges, load = self._found(grams, stored), self._load(grams, stored)
        labels, changed = self._visited(fresh, edges, step)
        parts = (
            self._stage("nodes", fresh, step) | self._stage("grams", grams, step)
            | self._stage("edges", edges, step) | self._stage("labels", labels, step)
        )
        if not table:
            parts |= self._stage("tables", self.spark.createDataFrame([(levels, load)], TABLE), step)
        switch_parts(self.spark, self.path, parts)
        if table and (load > DRIFT * table.load or len(steps) >= MOST_DAYS):
            self.rebuild()
        return changed.select("node", "falls", "fell")

    def rebuild(self) -> None:
        """Freeze the order of grams of all stored texts, pick their rare grams by it, and join the
        files of all days. Pairs and fates stay as they are. Files of before are left for readers."""
        steps = self._steps()
        if not steps:
            return
        step = steps[-1] + 1
        nodes = self._read("nodes")
        levels = self._levels(nodes)
        grams = _rare_grams(nodes, self.block, "text", self.slack, levels)
        load = self._load(grams, grams.limit(0))
        gone: dict[str, str | None] = {name: None for name in pointer(self.spark, self.path)}
        parts = self._stage("nodes", nodes, step) | self._stage("grams", grams, step)
        parts |= self._stage("edges", self._read("edges"), step)
        parts |= self._stage("labels", self.labels().withColumn("step", F.lit(step)), step)
        parts |= self._stage("tables", self.spark.createDataFrame([(levels, load)], TABLE), step)
        switch_parts(self.spark, self.path, gone | parts)
