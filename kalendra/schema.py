"""The event table every job agrees on, and the column-name dialects it accepts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("music_label", T.BooleanType()),
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()

# A CSV drop is read as text; dates and flags are cast afterwards with try_ functions.
CSV_COLUMNS = [
    "Subject", "Start_date", "End_date", "Start_time", "End_time",
    "Location", "City", "Description", "Category", "Music_label",
]


def canonical_name(name: str) -> str:
    """`Start_date`, `Start_Date` and `Start Date` all become `start_date`."""
    return name.strip().replace(" ", "_").lower()


def to_canonical(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: canonical_name(c) for c in df.columns})


def conform(df: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Select the schema's columns in order; columns the frame lacks become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def typed(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Cast an all-text event frame to the event types; text that does not parse becomes NULL.
    `keep` names further columns that stay as they are."""
    cast = (
        to_canonical(df)
        .withColumn("start_date", F.try_to_date("start_date", "yyyy-MM-dd"))
        .withColumn("end_date", F.try_to_date("end_date", "yyyy-MM-dd"))
        .withColumn("music_label", F.col("music_label").try_cast("boolean"))
    )
    have = {f.name for f in cast.schema.fields}
    return cast.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in EVENT_SCHEMA.fields
        ],
        *(keep or []),
    )


def fill_blank(df: DataFrame) -> DataFrame:
    """Text columns carry one space where a source had nothing."""
    return df.na.fill(" ")
