"""Dated snapshots of the event table: which is the latest, and how a run becomes the next one."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT = "snapshot_date"
SNAPSHOT_NAME = r"_(new|old)_events_(\d{8})"


def table_count(spark: SparkSession, database: str | None = None) -> int:
    return len(spark.catalog.listTables(database))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def latest_date(table: DataFrame, before: Column | None = None) -> DataFrame:
    """One row with the newest snapshot date, strictly before a day if given; NULL if none."""
    dates = table.select(SNAPSHOT)
    if before is not None:
        dates = dates.filter(F.col(SNAPSHOT) < before)
    return dates.agg(F.max(SNAPSHOT).alias(SNAPSHOT))


def latest_snapshot(table: DataFrame, before: Column | None = None) -> DataFrame:
    """Rows of the newest snapshot; an empty frame with the table's columns if there is none.

    The date is a scalar subquery on the partition column: rows of other partitions are not read,
    but its own maximum looks at every file's partition value. `latest_snapshot_at` takes the date
    from the names of the partitions instead.
    """
    newest = latest_date(table, before).scalar()
    return table.filter(F.col(SNAPSHOT) == newest)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column by the names of its folders: one per load, no file is opened."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")
    store = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.globStatus(pattern) or []
    return sorted(unquote(f.getPath().getName().partition("=")[2]) for f in found)


def latest_snapshot_at(spark: SparkSession, path: str, before: str | None = None) -> DataFrame:
    """Rows of the newest snapshot under a path, strictly before a day (ISO text) if given; an empty
    frame if there is none. Only its folder is read."""
    days = [d for d in partition_values(spark, path, SNAPSHOT) if before is None or d < before]
    table = spark.read.parquet(path)
    newest = F.lit(days[-1]).cast("date") if days else F.lit(None).cast("date")
    return table.filter(F.col(SNAPSHOT) == newest)


def latest_named(names: DataFrame, kind: str, before: int | None = None) -> DataFrame:
    """Newest of the table names `…_new_events_YYYYMMDD` / `…_old_events_YYYYMMDD`."""
    dated = names.select(
        "table_name",
        F.regexp_extract("table_name", SNAPSHOT_NAME, 1).alias("kind"),
        F.regexp_extract("table_name", SNAPSHOT_NAME, 2).try_cast("int").alias("day"),
    ).filter((F.col("kind") == kind) & F.col("day").isNotNull())
    if before is not None:
        dated = dated.filter(F.col("day") < before)
    return dated.agg(
        F.max_by("table_name", "day").alias("table_name"), F.max("day").alias("day")
    )


def empty_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create or replace a table with a declared schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").format("parquet").saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    if not table_exists(spark, name):
        spark.createDataFrame([], schema).write.mode("ignore").format("parquet").saveAsTable(name)


def append_rows(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def replace_rows(df: DataFrame, name: str) -> None:
    """Replace a table's rows. The new rows must not be read from the same table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"truncate table {name}")


def bootstrap(new: DataFrame, old_name: str) -> bool:
    """Create the previous snapshot from the new one if there is none; True if it was created."""
    if table_exists(new.sparkSession, old_name):
        return False
    new.write.format("parquet").saveAsTable(old_name)
    return True


def land(df: DataFrame, path: str, load_ts: str) -> None:
    """Add one load to the landing table; a repeated load replaces itself only."""
    _write_partition(df.withColumn("load_ts", F.lit(load_ts)), path, "load_ts")


def latest_load(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest load, known by the names of the folders."""
    loads = partition_values(spark, path, "load_ts")
    table = spark.read.option("basePath", path).parquet(path)
    return table.filter(F.col("load_ts") == F.lit(loads[-1] if loads else None))


def promote(new: DataFrame, path: str, day: str) -> None:
    """Store today's events as the snapshot of that day, beside the earlier ones."""
    _write_partition(new.withColumn(SNAPSHOT, F.lit(day).cast("date")), path, SNAPSHOT)


def _write_partition(df: DataFrame, path: str, column: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def published_ids(calendar: DataFrame) -> DataFrame:
    return calendar.select("entry_no")


def publish(entries: DataFrame, path: str) -> None:
    """Full refresh of the calendar: the entries replace everything published before.

    Batches lie in ranges of files, sorted, so that a client reads a single batch from one file or
    two, and the number of files follows the size and not the number of batches.
    """
    entries.repartitionByRange("batch_no").sortWithinPartitions("batch_no").write.mode(
        "overwrite"
    ).parquet(path)
