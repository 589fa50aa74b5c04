"""Exact duplicates, group sizes and the co-location roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalendra.functions.describe import mention_count
from kalendra.session import cut_lineage

# The key columns of the two exact passes and of the co-location cell.
SAME_EVENT_KEYS = ["subject", "start_date", "start_time", "end_time", "city"]
SAME_SLOT_KEYS = ["start_date", "start_time", "end_time", "location", "city"]
CELL_KEYS = ["start_date", "start_time", "location", "city"]
MENTION_KEYS = ["start_date", "start_time", "location"]


def drop_exact(df: DataFrame, keys: list[str], order: str = "row_seq") -> DataFrame:
    """Keep the first row of each key; NULL keys are equal.

    Spark limits each key to its first row inside every map task before it shuffles, so copies of
    a frequent key never travel.
    """
    first = Window.partitionBy(*keys).orderBy(order)
    return (
        df.withColumn("_position", F.row_number().over(first))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def with_group_size(df: DataFrame, keys: list[str], out: str = "group_size") -> DataFrame:
    """Size of each row's group; NULL where a key is NULL.

    Sizes are stored before they are joined back: both sides of the join are then plain shuffles,
    so the rows of a frequent key are split over tasks.
    """
    sizes = cut_lineage(df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(out)))
    return df.join(sizes, keys, "left").select(*df.columns, out)


def with_extra_count(df: DataFrame, keys: list[str] = CELL_KEYS) -> DataFrame:
    """`counter` = other rows in the same cell; 0 where a key is NULL."""
    sized = with_group_size(df, keys, "_size")
    return sized.withColumn(
        "counter", F.coalesce(F.col("_size") - 1, F.lit(0)).cast("int")
    ).drop("_size")


def colocated_members(
    df: DataFrame, keys: list[str] = CELL_KEYS, order: str = "row_seq"
) -> DataFrame:
    """The roll-up in long form: every row with its cell's `counter` and `first_seq`.

    Use it where a cell may hold more text than one row should carry.
    """
    cells = cut_lineage(
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg((F.count(F.lit(1)) - 1).cast("int").alias("counter"), F.min(order).alias("first_seq"))
    )
    return df.join(cells, keys).select(*df.columns, "counter", "first_seq")


def collapse_colocated(
    df: DataFrame, keys: list[str] = CELL_KEYS, order: str = "row_seq"
) -> DataFrame:
    """One row per cell: the first event, its description preceded by a line per other event.

    Rows with a NULL key vanish. Only the text that ends up in the result is gathered, and it is
    combined inside the map tasks first.
    """
    none = F.lit("None")
    line = F.concat(
        F.lit("Event "), F.coalesce("subject", none), F.lit(": "), F.coalesce("description", none)
    )
    rest = [c for c in df.columns if c not in keys]
    cells = (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.min_by(F.struct(*rest), F.col(order)).alias("_head"),
            F.sort_array(F.collect_list(F.struct(F.col(order).alias("seq"), line.alias("line"))))
            .alias("_lines"),
            (F.count(F.lit(1)) - 1).cast("int").alias("counter"),
        )
    )
    others = F.transform(
        F.slice("_lines", F.lit(2), F.greatest(F.col("counter"), F.lit(1))), lambda x: x["line"]
    )
    # The wording of the roll-up.
    told = F.concat(
        F.col("counter").cast("string"),
        F.lit(" event(s) found at the same time/location. Please check the following:\n"),
        F.array_join(others, "\n"),
        F.lit("\n"),
        F.coalesce(F.col("_head.description"), none),
    )
    description = F.when(F.col("counter") > 0, told).otherwise(F.col("_head.description"))
    columns = [
        F.col(c)
        if c in keys
        else (description if c == "description" else F.col(f"_head.{c}")).alias(c)
        for c in df.columns
    ]
    return cells.select(*columns, "counter")


def mention_counter(
    df: DataFrame, keys: list[str] = MENTION_KEYS, order: str = "row_seq"
) -> DataFrame:
    """Keep the first row per key and tell in its description how often the key occurred.

    NULL keys are equal for keeping, but have no count.
    """
    rest = [c for c in df.columns if c not in keys]
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    grouped = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.col(order)).alias("_head"),
        F.count(F.lit(1)).alias("_size"),
    )
    counter = F.when(complete, F.col("_size"))
    columns = [
        F.col(c)
        if c in keys
        else (
            mention_count(counter, F.col("_head.description"))
            if c == "description"
            else F.col(f"_head.{c}")
        ).alias(c)
        for c in df.columns
    ]
    return grouped.select(*columns, counter.alias("counter"))
