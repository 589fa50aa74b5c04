"""A folder of CSV files, one per source, of which only those with the agreed columns count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalendra.schema import CSV_COLUMNS, canonical_name, typed
from kalendra.session import cut_lineage

# A blank is a value of its own in these files and must survive writing.
WRITE_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

#: Files of a drop, as they are or compressed.
CSV_FILES = "*.csv{,.gz,.bz2}"


def _header_width(spark: SparkSession, path: str) -> int:
    """The most columns that the first line of a file names; one pass over the lines, a row per file
    and task. A quoted comma only makes the width larger than needed."""
    lines = spark.read.option("pathGlobFilter", CSV_FILES).text(path)
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    firsts = (
        lines.filter(F.trim("value") != "")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("id"),
                commas.alias("commas"),
            ).alias("line"),
        )
        .groupBy("file")
        .agg(F.min("line").alias("line"))
    )
    return 1 + (firsts.agg(F.max("line.commas")).first()[0] or 0)


def _records(spark: SparkSession, path: str, multi_line: bool, width: int) -> DataFrame:
    names = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    read = (
        spark.read.schema(schema)
        .option("pathGlobFilter", CSV_FILES)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    cells = F.array(*names)
    last = F.array_max(F.transform(cells, lambda c, i: F.when(c.isNotNull(), i + 1)))
    return cut_lineage(
        read.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("id"),
            F.slice(cells, 1, F.coalesce(last, F.lit(0))).alias("cells"),
        )
    )


def read_cells(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(`file`, `line_no`, `cells`) of every record of every CSV file, header lines included.

    `line_no` counts records in file order, then in the order of the file, over the whole drop, so
    it does not depend on how files are dealt to tasks. Records are read as wide as the widest header,
    whatever that is; empty files have no records. With `multi_line` a record may hold line breaks and
    a file is one task's work; without it large files are split.
    """
    width = _header_width(spark, path)
    while True:
        stored = _records(spark, path, multi_line, width + 1)
        head = F.min(F.struct("start", "id", F.size("cells").alias("n")))
        heads = stored.groupBy("file").agg(head.alias("head"))
        if heads.filter(F.col("head.n") > width).isEmpty():
            break
        width *= 2  # a header that goes on in its second line
    # A stretch of a file lies in one task, in order, so its records have consecutive ids.
    stretches = stored.groupBy("file", "start").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    earlier = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.select(
        "file", "start", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    return stored.join(offsets, ["file", "start"]).select(
        "file", (F.col("before") + F.col("id") - F.col("first")).alias("line_no"), "cells"
    )


def _named(name: Column) -> Column:
    """A header cell without a byte-order mark."""
    return F.trim(F.regexp_replace(name, "^\ufeff", ""))


def csv_files(cells: DataFrame) -> DataFrame:
    """(`file`, `header`, `first`): the header of each file and the number of its line."""
    heads = cells.groupBy("file").agg(F.min(F.struct("line_no", "cells")).alias("head"))
    return heads.select(
        "file",
        F.transform("head.cells", lambda c: F.coalesce(_named(c), F.lit(""))).alias("header"),
        F.col("head.line_no").alias("first"),
    )


def gate(files: DataFrame, reference_columns: list[str] | None = None) -> DataFrame:
    """Add `columns` and `accepted`: whether a file's column set is the agreed one, an unnamed row
    index apart. Without `reference_columns` the first file by name sets the standard.
    """
    named = F.filter("header", lambda c: (c != "") & ~c.startswith("Unnamed:"))
    with_columns = files.withColumn("columns", F.array_sort(F.array_distinct(named)))
    if reference_columns is not None:
        agreed = F.array_sort(F.array(*[F.lit(c) for c in reference_columns]))
        return with_columns.withColumn("accepted", F.col("columns") == agreed)
    first = with_columns.agg(F.min_by("columns", "file").alias("agreed")).scalar()
    return with_columns.withColumn("accepted", F.col("columns") == first)


def read_event_csvs(
    spark: SparkSession,
    path: str,
    reference_columns: list[str] | None = None,
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(accepted event rows with `row_seq` in file and line order, rejected files).

    Each file's own header says where its columns stand, so files of any column order are read in
    one pass, and no list of files leaves the executors.
    """
    cells = read_cells(spark, path, multi_line)
    judged = gate(csv_files(cells), reference_columns)
    rejected = judged.filter("not accepted").select("file", "columns")
    accepted = judged.filter("accepted").select("file", "header", "first")
    lower = F.transform("header", canonical)
    rows = cells.join(accepted, "file").filter(F.col("line_no") > F.col("first"))
    wanted = [F.get("cells", F.array_position(lower, canonical_name(c)).cast("int") - 1).alias(c) for c in CSV_COLUMNS]
    text = rows.select(F.col("line_no").alias("row_seq"), *wanted)
    return typed(text, keep=["row_seq"]), rejected


def canonical(name: Column) -> Column:
    return F.lower(F.replace(F.trim(name), F.lit(" "), F.lit("_")))


def write_event_csvs(df: DataFrame, path: str, by_city: bool = False) -> None:
    """Merged CSV files, or one folder per city."""
    writer = df.write.mode("overwrite").options(**WRITE_OPTIONS)
    if by_city:
        writer = writer.partitionBy("city")
    writer.csv(path)
