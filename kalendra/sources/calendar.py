"""The published calendar: entries in branches, their digests, and runs that publish the difference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalendra.operators.publish_delta import (
    BRANCH_BITS,
    LEAF_BITS,
    applied,
    branch_of,
    calls_between,
    differing_leaves,
    entry_id,
    hash_of,
    identified,
    leaf_digests,
    leaf_of,
)
from kalendra.session import cut_lineage
from kalendra.sources.versions import read_parts, stage_parts, switch_parts

DIGESTS = T.StructType(
    [
        T.StructField("leaf", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("a", T.DecimalType(30, 0)),
        T.StructField("b", T.DecimalType(30, 0)),
    ]
)
PLACE = ("entry_id", "slot")
#: Files of a branch.
PARTS = 16


class Calendar:
    """A calendar in a shared folder. `key` tells entries apart, `body` is what they show."""

    def __init__(self, path: str, schema: T.StructType, key: list[str], body: list[str]):
        fields = {f.name: f for f in schema.fields}
        self.path, self.key, self.body = path, key, body
        self.schema = T.StructType(
            [
                T.StructField("entry_id", T.StringType()),
                T.StructField("slot", T.LongType()),
                *[fields[c] for c in [*key, *body]],
                T.StructField("leaf", T.IntegerType()),
            ]
        )

    def entries(self, spark: SparkSession, branches: list[str] | None = None) -> DataFrame:
        """The published entries, or those of some branches; other branches' files are not read."""
        return read_parts(spark, self.path, "branch", self.schema, branches)

    def digests(self, spark: SparkSession) -> DataFrame:
        return read_parts(spark, self.path, "sums", DIGESTS)

    def calls(self, wanted: DataFrame) -> DataFrame:
        """What turns the published entries into the wanted ones. The digests of both sides decide which
        leaves are opened; no entry is read where they agree."""
        spark = wanted.sparkSession
        rows = identified(wanted, self.key, self.body)
        opened = differing_leaves(cut_lineage(leaf_digests(rows)), self.digests(spark))
        if not opened:
            names = ["action", *PLACE, *self.key, *self.body]
            kinds = {f.name: f for f in self.schema.fields} | {"action": T.StructField("action", T.StringType())}
            return spark.createDataFrame([], T.StructType([kinds[n] for n in names]))
        here = F.col("leaf").isin(opened)
        branches = sorted({str(x >> (LEAF_BITS - BRANCH_BITS)) for x in opened})
        published = self.entries(spark, branches).filter(here)
        there = identified(published, self.key, self.body, ("slot",))
        return calls_between(rows.filter(here), there, self.key, self.body)

    def record(self, calls: DataFrame) -> None:
        """Note calls that have been made, all or some of those planned. Only branches with a call are
        written anew; their entries and digests change in one step, so a run that breaks here has
        noted nothing, and one that breaks before has made calls that its next plan repeats: they
        carry the same ids. Calls are read twice: store them first where they take long to find."""
        spark = calls.sparkSession
        leaves = calls.select(leaf_of(hash_of(self.key)).alias("leaf"))
        branches = sorted(r[0] for r in leaves.select(branch_of(F.col("leaf")).cast("string")).distinct().collect())
        if not branches:
            return
        now = applied(self.entries(spark, branches), calls, self.key, self.body, PARTS)
        named = now.withColumn("entry_id", entry_id(hash_of(self.key), F.col("slot")))
        staged = stage_parts(
            named.select(*PLACE, *self.key, *self.body, "leaf", "branch"), self.path, "branch", branches
        )
        # The digests are those of the files as they were written.
        files = [f"{self.path}/{folder}/{name}" for name, folder in staged.items() if folder]
        stored = spark.read.schema(self.schema).parquet(*files) if files else spark.createDataFrame([], self.schema)
        sums = leaf_digests(identified(stored, self.key, self.body))
        sums = sums.withColumn("sums", branch_of(F.col("leaf")).cast("string")).coalesce(1)
        switch_parts(spark, self.path, staged | stage_parts(sums, self.path, "sums", branches))
