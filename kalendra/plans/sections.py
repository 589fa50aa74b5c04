"""A day's programme given as one text: headed sections, three lines per item."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Section headings; film items list the time last.
HEADINGS = [
    "Theater", "Musik", "Film", "Ausstellungen", "Kunst", "Literatur", "Vorträge", "Sonstiges",
]
ROTATED = "Film"
LINES_PER_ITEM = 3


def sectioned_items(pages: DataFrame, key: str, text: str) -> DataFrame:
    """`key`, `category`, `item_no`, `time_text`, `subject`, `location` per item.

    A heading that comes twice continues its section; lines before the first heading are dropped.
    Work stays inside one text, whose lines are numbered by window.
    """
    lines = pages.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    heading = F.col("line").isin(HEADINGS)
    reading = Window.partitionBy(key).orderBy("pos")
    section = Window.partitionBy(key, "category").orderBy("pos")
    placed = (
        lines.withColumn(
            "category", F.last(F.when(heading, F.col("line")), ignorenulls=True).over(reading)
        )
        .filter(~heading & F.col("category").isNotNull())
        .withColumn("n", F.row_number().over(section) - 1)
        .withColumn("item_no", F.floor(F.col("n") / LINES_PER_ITEM).cast("int"))
        .withColumn("slot", F.col("n") % LINES_PER_ITEM)
    )
    gathered = placed.groupBy(key, "category", "item_no").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("line"))).alias(f"line_{i}") for i in range(3)],
        F.max_by("line", "slot").alias("last_line"),
    )
    rotated = F.col("category") == ROTATED

    def pick(film: str, other: str):
        return F.when(rotated, F.col(film)).otherwise(F.col(other))

    return gathered.select(
        key,
        "category",
        "item_no",
        pick("last_line", "line_0").alias("time_text"),
        pick("line_0", "line_1").alias("subject"),
        pick("line_1", "line_2").alias("location"),
    )
