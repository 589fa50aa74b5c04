"""Session settings and lineage cuts shared by the iterative operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Results do not depend on these; they let skewed joins be split and sizes be chosen at run time.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Matching and parsing cost more time than their bytes suggest; do not merge them into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data; where it names none, one in the
    warehouse, which must not be a local path unless everything runs on this machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = warehouse.startswith(("file:", "/"))
    if local and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(
            f"set spark.checkpoint.dir to a folder that all executors share; the warehouse "
            f"{warehouse} is a path of each machine"
        )
    return f"{warehouse}/steps"


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's steps; it is deleted when the application ends."""
    folder = f"{shared_folder(spark)}/kalendra-{spark.conf.get('spark.app.id', 'run')}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a step's folder before the application ends, once its frame is no longer read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from there.

    A loop's plan stays short, the frame is computed once however often it is read, and a lost
    executor costs only re-reading files.
    """
    folder = fresh_folder(df.sparkSession, "step")
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
