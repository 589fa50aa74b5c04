"""Snapshot comparison by (city, subject), with a colour per event and a trail of old values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendra.functions import classify
from kalendra.functions.times import normalise_clock
from kalendra.session import cut_lineage

KEYS = ["city", "subject"]
# Compared columns in order, with the names used in the trail.
COMPARED = {
    "start_date": "Start Date",
    "start_time": "Start Time",
    "end_date": "End Date",
    "end_time": "End Time",
    "location": "Location",
    "category": "Category",
}


def with_normal_clocks(df: DataFrame) -> DataFrame:
    return df.withColumn("start_time", normalise_clock(F.col("start_time"))).withColumn(
        "end_time", normalise_clock(F.col("end_time"))
    )


def _differences() -> Column:
    """Texts of the columns in which `o_` differs from `n_`; a NULL on either side is no change."""
    texts = [
        F.when(
            F.col(f"o_{c}") != F.col(f"n_{c}"),
            F.concat(F.lit(f"\nOriginal {label}: "), F.col(f"o_{c}").cast("string")),
        )
        for c, label in COMPARED.items()
    ]
    return F.concat(*[F.coalesce(text, F.lit("")) for text in texts])


def _old_effects(base: DataFrame, old: DataFrame, id_column: str) -> DataFrame:
    """Per base row: the colour set last by an old row, and the trail of all changed old values.

    Pairs without effect end at the join; only what the result contains is gathered.
    """
    o = old.select(
        *KEYS,
        F.col("row_seq").alias("old_seq"),
        F.col("colour").alias("o_colour"),
        *[F.col(c).alias(f"o_{c}") for c in COMPARED],
    )
    n = base.select(*KEYS, id_column, *[F.col(c).alias(f"n_{c}") for c in COMPARED])
    changed = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(f"o_{c}") != F.col(f"n_{c}"), F.lit(False)) for c in COMPARED],
    )
    keeps_four = F.coalesce(F.col("o_colour") == classify.MULTIPLE, F.lit(False))
    return (
        n.join(o, KEYS)
        .filter(keeps_four | changed)
        .select(
            id_column,
            "old_seq",
            F.when(keeps_four, F.lit(classify.MULTIPLE))
            .otherwise(F.lit(classify.CHANGED))
            .alias("effect"),
            F.when(~keeps_four, _differences()).alias("trail"),
        )
        .groupBy(id_column)
        .agg(
            F.max_by("effect", "old_seq").alias("last_effect"),
            F.sort_array(
                F.collect_list(F.when(F.col("trail").isNotNull(), F.struct("old_seq", "trail")))
            ).alias("trails"),
        )
        .select(
            id_column,
            "last_effect",
            F.array_join(F.transform("trails", lambda x: x["trail"]), "").alias("trail"),
        )
    )


def _final(colour: Column) -> Column:
    settled = colour.isin(classify.MULTIPLE, classify.CHANGED, classify.DELETED)
    return F.when(settled, colour).otherwise(F.lit(classify.UNCHANGED))


def _apply(base: DataFrame, effects: DataFrame, id_column: str) -> DataFrame:
    trailed = F.concat(F.coalesce("description", F.lit("")), "trail")
    return (
        base.join(effects, id_column, "left")
        .withColumn("colour", _final(F.coalesce("last_effect", "colour")).cast("int"))
        .withColumn(
            "description", F.when(F.length("trail") > 0, trailed).otherwise(F.col("description"))
        )
        .drop("last_effect", "trail")
    )


def deleted_events(new: DataFrame, old: DataFrame) -> DataFrame:
    """Old rows whose (city, subject) is gone from the new snapshot."""
    known = cut_lineage(new.select(*KEYS).dropna().distinct())  # so that a frequent key can be split
    return old.dropna(subset=["city"]).join(known, KEYS, "left_anti")


def appeared_events(new: DataFrame, old: DataFrame) -> DataFrame:
    known = cut_lineage(old.select(*KEYS).dropna().distinct())
    return new.dropna(subset=["city"]).join(known, KEYS, "left_anti")


def diff_by_subject(new: DataFrame, old: DataFrame, label_new: bool = False) -> DataFrame:
    """Events of the new snapshot with their colour, then the deleted ones in colour 11.

    Both frames carry `row_seq`, their order, and `colour`. Of several deleted rows with one key
    the first is reported and the later ones only add to its trail. With `label_new` every deleted
    row is reported by itself and new events without an old namesake get colour 7.
    """
    columns = list(new.columns)
    new = with_normal_clocks(new).dropna(subset=["city"])
    old = with_normal_clocks(old).dropna(subset=["city"])
    kept = _apply(new, _old_effects(new, old, "row_seq"), "row_seq")
    gone = deleted_events(new, old).withColumn("colour", F.lit(classify.DELETED))
    if label_new:
        first_seen = appeared_events(new, old).select(F.col("row_seq"), F.lit(True).alias("_new"))
        kept = (
            kept.join(first_seen, "row_seq", "left")
            .withColumn("colour", F.when(F.col("_new"), F.lit(classify.NEW)).otherwise(F.col("colour")))
            .drop("_new")
        )
        return kept.select(*columns).unionByName(gone.select(*columns))
    return kept.select(*columns).unionByName(_folded_deletions(gone, old).select(*columns))


def _folded_deletions(gone: DataFrame, old: DataFrame) -> DataFrame:
    """One row per deleted key, with the later rows of that key folded into it.

    A missing subject equals nothing, so each such row stays by itself.
    """
    nameless = gone.filter(F.col("subject").isNull())
    named = gone.filter(F.col("subject").isNotNull())
    first = Window.partitionBy(*KEYS).orderBy("row_seq")
    heads = (
        named.withColumn("_position", F.row_number().over(first))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )
    later = old.filter(F.col("subject").isNotNull()).join(
        heads.select("row_seq"), "row_seq", "left_anti"
    )
    folded = _apply(heads, _old_effects(heads, later, "row_seq"), "row_seq")
    return folded.unionByName(nameless)
