"""Query registry and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
ASOF_TEXT = "2024-01-10"


def asof():
    return F.lit(ASOF_TEXT).cast("date")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_out(rows: DataFrame) -> DataFrame:
    """Rows of a file that has fewer splits than there are cores, spread over the cores; a table
    with enough splits is read as it lies. For columns that cost much parsing."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def from_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a view text of `views` on the given tables."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def for_oracle(text: str) -> str:
    """The same view text with plain table names."""
    return text.format(**{t: t for t in TABLES})


def with_views(select: str, **views: str) -> str:
    """`with name as (view text), … select …` for the oracle."""
    parts = ",\n".join(f"{name} as ({for_oracle(text)})" for name, text in views.items())
    return f"with {parts}\n{select}"
