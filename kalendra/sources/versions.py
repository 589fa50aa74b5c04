"""Tables that change in one step: new files beside the old ones, then one rename of a pointer.

A table is a folder. Its pointer names, for each part of the table, the folder of files that hold it
now. A new version writes the parts that change into a folder of its own and then replaces the
pointer by a rename, so a reader sees the table before or after, never in between, and a run that
breaks leaves the old version as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_current.json"


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def pointer(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each part, by the part's name; empty where there is no table yet."""
    place, store = _store(spark, f"{path}/{POINTER}")
    if not store.exists(place):
        return {}
    stream = store.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def switch(spark: SparkSession, path: str, parts: dict[str, str]) -> None:
    """Make the given folders the table: the pointer is written beside and renamed over the old."""
    written, store = _store(spark, f"{path}/_next-{uuid.uuid4().hex}.json")
    stream = store.create(written)
    try:
        stream.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        written.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    files.rename(files.makeQualified(written), files.makeQualified(_store(spark, f"{path}/{POINTER}")[0]), options)


def stage_parts(df: DataFrame, path: str, part: str, names: list[str]) -> dict[str, str | None]:
    """Write the named parts' rows, which column `part` tells apart, beside the table, and return what
    a pointer has to say of them: the folder of each, or None for a part without rows."""
    spark = df.sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(part).parquet(f"{path}/{folder}")
    changes: dict[str, str | None] = {}
    for name in names:
        place, store = _store(spark, f"{path}/{folder}/{part}={name}")
        changes[f"{part}={name}"] = folder if store.exists(place) else None
    return changes


def switch_parts(spark: SparkSession, path: str, changes: dict[str, str | None]) -> None:
    """Make staged parts the table's, all in one step; parts not named stay as they are."""
    now = pointer(spark, path) | changes
    switch(spark, path, {name: folder for name, folder in now.items() if folder is not None})


def read_parts(
    spark: SparkSession, path: str, part: str, schema: T.StructType, names: list[str] | None = None
) -> DataFrame:
    """The rows of all parts that column `part` tells apart, or of the named ones alone; no other file
    is read. An empty frame where there are none."""
    now = pointer(spark, path)
    prefix = f"{part}="
    wanted = [n for n in now if n.startswith(prefix)] if names is None else [f"{prefix}{n}" for n in names]
    wanted = sorted(n for n in wanted if n in now)
    frames = []
    for folder in sorted({now[n] for n in wanted}):
        places = [f"{path}/{folder}/{n}" for n in wanted if now[n] == folder]
        frames.append(spark.read.schema(schema).parquet(*places))
    if not frames:
        return spark.createDataFrame([], schema)
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a whole table in one step; the new rows may be read from the table itself."""
    staged = stage_parts(df.withColumn("_part", F.lit("all")), path, "_part", ["all"])
    switch_parts(df.sparkSession, path, staged)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_parts(spark, path, "_part", schema)
