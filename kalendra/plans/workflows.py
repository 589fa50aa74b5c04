"""The two daily runs, from landed events to calendar entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendra.functions.dates import load_date_text
from kalendra.functions.describe import load_banner
from kalendra.operators.dedup import (
    SAME_EVENT_KEYS,
    SAME_SLOT_KEYS,
    collapse_colocated,
    drop_exact,
)
from kalendra.operators.diff_ranked import add_summary, diff_ranked
from kalendra.operators.diff_subject import diff_by_subject
from kalendra.operators.filters import noteworthy, publish_scope
from kalendra.operators.payload import entries
from kalendra.operators.similar import fuzzy_dedup
from kalendra.session import cut_lineage


def remove_duplicates(events: DataFrame, asof: Column, order: str = "row_seq") -> DataFrame:
    """Two exact passes, the fuzzy pass, then load date and description banner.

    The fuzzy pass reads its input several times, so the exact passes are stored once.
    """
    distinct = cut_lineage(
        drop_exact(drop_exact(events, SAME_EVENT_KEYS, order), SAME_SLOT_KEYS, order)
    )
    return with_banner(fuzzy_dedup(distinct, order), asof)


def with_banner(events: DataFrame, asof: Column) -> DataFrame:
    banner = load_banner(
        asof, F.col("category"), F.col("description"), F.col("city"), F.col("music_label")
    )
    return events.withColumn("load_date", load_date_text(asof)).withColumn("description", banner)


def workflow_a(today: DataFrame, previous: DataFrame, asof: Column) -> DataFrame:
    """Entries of today's cleaned events compared with yesterday's cleaned events."""
    return entries(add_summary(diff_ranked(today, previous, asof), asof), "a")


def snapshot_b(landed: DataFrame, asof: Column, order: str = "row_seq") -> DataFrame:
    """Today's snapshot: one row per cell, the noteworthy ones, with their first colour."""
    return noteworthy(collapse_colocated(landed, order=order), asof)


def workflow_b(
    new: DataFrame, old: DataFrame, run_ts: Column, city: str | None = None
) -> DataFrame:
    """Entries of a snapshot compared with the previous one, for one city or for all."""
    return entries(publish_scope(diff_by_subject(new, old), city), "b", run_ts)
