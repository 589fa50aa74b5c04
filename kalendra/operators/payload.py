"""Calendar entries: nested records, batches and outcome counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendra.functions.classify import colour_by_status
from kalendra.functions.describe import creation_stamp
from kalendra.operators.numbering import dense_number

TIME_ZONE = "Europe/Berlin"
BATCH_SIZE = 580
DEFAULT_MINUTES = {"a": 27, "b": 60}


def _at(day: Column, clock: Column) -> Column:
    """Wall-clock timestamp; text that is no time of day yields NULL."""
    text = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), F.trim(clock))
    seconds = F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm:ss"))
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm")), seconds).cast(
        "timestamp_ntz"
    )


def _later(moment: Column, minutes: int) -> Column:
    return moment + F.expr(f"interval {minutes} minutes")


def _blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def _times_a(df: DataFrame) -> DataFrame:
    """All-day without start time. A missing end is 27 minutes after the start time on the end
    day; an end not after the start moves on one day."""
    all_day = F.col("start_time").isNull()
    start = _at(F.col("start_date"), F.col("start_time"))
    end = F.when(
        F.col("end_time").isNull(),
        _later(_at(F.col("end_date"), F.col("start_time")), DEFAULT_MINUTES["a"]),
    ).otherwise(_at(F.col("end_date"), F.col("end_time")))
    return (
        df.withColumn("all_day", all_day)
        .withColumn("start_ts", F.when(~all_day, start))
        .withColumn("_end", F.when(~all_day, end))
        .withColumn(
            "end_ts",
            F.when(F.col("_end") <= F.col("start_ts"), _later(F.col("_end"), 1440)).otherwise(
                F.col("_end")
            ),
        )
        .withColumn("start_day", F.when(all_day, F.col("start_date")))
        .withColumn("end_day", F.when(all_day, F.col("end_date")))
        .drop("_end")
    )


def _times_b(df: DataFrame) -> DataFrame:
    """All-day with a blank start time, then ending at least the day after. A blank end is one
    hour later; an end at midnight of the start day means the next midnight."""
    all_day = _blank(F.col("start_time"))
    start = _at(F.col("start_date"), F.col("start_time"))
    end = F.when(
        _blank(F.col("end_time")), _later(start, DEFAULT_MINUTES["b"])
    ).otherwise(_at(F.col("end_date"), F.col("end_time")))
    last_day = F.coalesce("end_date", "start_date")
    at_midnight = (F.to_date("_end") == F.to_date("start_ts")) & (
        F.date_format("_end", "HH:mm:ss") == "00:00:00"
    )
    return (
        df.withColumn("all_day", all_day)
        .withColumn("start_ts", F.when(~all_day, start))
        .withColumn("_end", F.when(~all_day, end))
        .withColumn(
            "end_ts", F.when(at_midnight, _later(F.col("_end"), 1440)).otherwise(F.col("_end"))
        )
        .withColumn("start_day", F.when(all_day, F.col("start_date")))
        .withColumn(
            "end_day",
            F.when(
                all_day,
                F.when(last_day == F.col("start_date"), F.date_add(last_day, 1)).otherwise(last_day),
            ),
        )
        .drop("_end")
    )


def entries(diffed: DataFrame, policy: str, run_ts: Column | None = None) -> DataFrame:
    """Flat calendar entries with `start_ts`/`end_ts` or `start_day`/`end_day`, and `is_valid`."""
    if policy == "a":
        timed = _times_a(diffed)
        text = F.col("updated_description")
        colour = colour_by_status(F.col("status"), F.col("music_label"))
    elif policy == "b":
        timed = _times_b(diffed)
        text = creation_stamp(F.col("description"), run_ts)
        colour = F.col("colour")
    else:
        raise ValueError("policy must be 'a' or 'b'")
    complete = F.when(
        F.col("all_day"), F.col("start_day").isNotNull() & F.col("end_day").isNotNull()
    ).otherwise(F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull())
    return timed.withColumn("entry_text", text).withColumn(
        "color_id", colour.cast("string")
    ).withColumn("is_valid", complete)


def nested(flat: DataFrame, tz: str = TIME_ZONE) -> DataFrame:
    """Add `entry`, the record a calendar client sends, beside the flat columns."""

    def moment(day: str, ts: str) -> Column:
        return F.struct(
            F.date_format(day, "yyyy-MM-dd").alias("date"),
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("dateTime"),
            F.when(F.col(ts).isNotNull(), F.lit(tz)).alias("timeZone"),
        )

    return flat.withColumn(
        "entry",
        F.struct(
            F.col("subject").alias("summary"),
            F.col("location"),
            moment("start_day", "start_ts").alias("start"),
            moment("end_day", "end_ts").alias("end"),
            F.col("entry_text").alias("description"),
            F.col("color_id").alias("colorId"),
        ),
    )


def with_batches(flat: DataFrame, order: str, size: int = BATCH_SIZE) -> DataFrame:
    """Number the entries and the batches a client may send at once."""
    numbered = dense_number(flat, order, "entry_no")
    return numbered.withColumn(
        "batch_no", F.floor((F.col("entry_no") - 1) / F.lit(size)).cast("int")
    )


def outcome(flat: DataFrame) -> DataFrame:
    return flat.agg(
        F.count_if(F.col("is_valid")).alias("success_count"),
        F.count_if(~F.col("is_valid")).alias("failure_count"),
    )
