"""Snapshot comparison by (subject, rank, city): changed, deleted, unchanged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendra.functions.text import alnum_key
from kalendra.operators.filters import still_running
from kalendra.operators.numbering import join_null_equal, slot_ranks
from kalendra.session import cut_lineage

CARRIED = [
    "subject", "location", "start_date", "end_date", "start_time", "end_time",
    "description", "city", "music_label",
]
DIFF_COLUMNS = [*CARRIED, "updated_description", "status"]
JOIN_KEYS = ["subject_key", "event_rank", "city"]
# Rows of one key that one task may join, and how many ways rows that meet nothing are scattered.
ROWS_PER_PIECE = 100_000
MATCHLESS_PIECES = 1024
# Copies of one pair of rows that one task writes out.
RUN_BITS = 16


def _keyed_rows(
    today: DataFrame, previous: DataFrame, asof: Column, normalise_key: bool
) -> DataFrame:
    """Running events of both snapshots with `side`, join key, and the key's rows per side.

    Ranks and key sizes are worked out on counted cells and come back to the rows in one join. The
    joins are NULL-equal so that all branches keep the same input and share its shuffle.
    """
    rows = still_running(today.select(F.lit("t").alias("side"), *CARRIED), asof).unionByName(
        still_running(previous.select(F.lit("p").alias("side"), *CARRIED), asof)
    )
    slot = ["side", "subject", "start_date", "start_time"]
    cells = rows.groupBy(*slot, "city").agg(F.count(F.lit(1)).alias("n"))
    ranks = slot_ranks(cells, ["side", "subject"], ["start_date", "start_time"], "n")
    subject = F.col("subject")
    keyed = join_null_equal(cells, ranks, slot).withColumn(
        "subject_key", alnum_key(subject) if normalise_key else subject
    )
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in JOIN_KEYS])
    sizes = keyed.groupBy(*JOIN_KEYS).agg(
        *[F.sum(F.when(complete & (F.col("side") == s), F.col("n"))).alias(f"n_{s}") for s in "tp"]
    )
    placed = join_null_equal(keyed, sizes, JOIN_KEYS).drop("n")
    return join_null_equal(rows, placed, [*slot, "city"])


def _spread(rows: DataFrame, side: str) -> DataFrame:
    """One side of the join, with frequent keys cut into pieces.

    A key with many rows is cut on its own side and repeated for every piece of the other side, so
    that each pair of rows still meets exactly once.
    """
    mine, other = ("t", "p") if side == "t" else ("p", "t")

    def pieces(s: str) -> Column:
        return F.coalesce(F.ceil(F.col(f"n_{s}") / F.lit(ROWS_PER_PIECE)), F.lit(1)).cast("int")

    matchless = F.col("n_t").isNull() | F.col("n_p").isNull()
    own_pieces = F.when(matchless, F.lit(MATCHLESS_PIECES)).otherwise(pieces(mine))
    piece = F.pmod(F.xxhash64(*CARRIED), own_pieces).cast("int")
    repeats = F.when(matchless, F.lit(1)).otherwise(pieces(other))
    return (
        rows.filter(F.col("side") == side)
        .withColumn(f"piece_{mine}", piece)
        .withColumn(f"piece_{other}", F.explode(F.sequence(F.lit(0), repeats - 1)))
        .select(
            *JOIN_KEYS,
            "piece_t",
            "piece_p",
            (~matchless).alias(f"{side}_meets"),
            *[F.col(c).alias(f"{side}_{c}") for c in CARRIED if c != "city"],
            F.col("city").alias(f"{side}_city"),
            *([F.col("copies").alias(f"{side}_copies")] if "copies" in rows.columns else []),
        )
    )


def _told(t: str, p: str) -> tuple[Column, Column]:
    """(updated description, status). A comparison with NULL counts as no change."""
    description = F.col(f"{t}_description")

    def differs(name: str) -> Column:
        return F.col(f"{t}_{name}") != F.col(f"{p}_{name}")

    gone = F.col(f"{t}_subject").isNull() & F.col(f"{p}_subject").isNotNull()
    # The wording appended to descriptions.
    old_day = F.date_format(F.col(f"{p}_start_date"), "dd.MM.yyyy")
    old_time, old_place = F.col(f"{p}_start_time"), F.col(f"{p}_location")
    updated = (
        F.when(gone, F.concat(F.col(f"{p}_description"), F.lit(" | event deleted")))
        .when(
            differs("location"), F.concat(description, F.lit(" | previous location: "), old_place)
        )
        .when(
            differs("start_date") & differs("start_time"),
            F.concat(
                description, F.lit(" | previous date : "), old_day, F.lit(" at: "), old_time
            ),
        )
        .when(
            differs("start_date"), F.concat(description, F.lit(" | previous date: "), old_day)
        )
        .when(
            differs("start_time"), F.concat(description, F.lit(" | previous time: "), old_time)
        )
        .otherwise(description)
    )
    changed = differs("location") | differs("start_date") | differs("start_time")
    status = (
        F.when(gone, F.lit("deleted")).when(changed, F.lit("changed")).otherwise(F.lit("unchanged"))
    )
    return updated, status


def diff_ranked(
    today: DataFrame, previous: DataFrame, asof: Column, normalise_key: bool = True
) -> DataFrame:
    """Full outer comparison of two snapshots on (subject key, rank, city).

    Keys with a NULL match nothing. In an equi-join a key either meets on both sides or is alone
    with all its rows; keys alone are scattered, since the adaptive planner cannot split a full outer
    join. Keys that meet and are frequent are joined apart, on counted rows.
    """
    rows = _keyed_rows(today, previous, asof, normalise_key)
    frequent = (F.col("n_t") > ROWS_PER_PIECE) | (F.col("n_p") > ROWS_PER_PIECE)
    frequent = F.col("n_t").isNotNull() & F.col("n_p").isNotNull() & frequent
    rare = rows.filter(~F.coalesce(frequent, F.lit(False)))
    t, p = _spread(rare, "t"), _spread(rare, "p")
    paired = t.join(p, [*JOIN_KEYS, "piece_t", "piece_p"], "full_outer").filter(
        ~F.coalesce("t_meets", F.lit(False)) & ~F.coalesce("p_meets", F.lit(False))
        | (F.col("t_meets") & F.col("p_meets"))
    )
    return _compared(paired).unionByName(_frequent_pairs(rows.filter(frequent)))


def _compared(paired: DataFrame, *more: Column) -> DataFrame:
    updated, status = _told("t", "p")
    return paired.select(
        *[F.coalesce(f"t_{c}", f"p_{c}").alias(c) for c in CARRIED],
        updated.alias("updated_description"),
        status.alias("status"),
        *more,
    )


def _frequent_pairs(rows: DataFrame) -> DataFrame:
    """The pairs of keys that are frequent on a side and meet on the other.

    Equal rows are counted first, so that they lie in one piece as one row; each pair of different
    rows is compared once, and its copies, as many as the product of both counts, are written out in
    runs that are dealt to all tasks.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    t, p = _spread(counted, "t"), _spread(counted, "p")
    paired = t.join(p, [*JOIN_KEYS, "piece_t", "piece_p"])
    told = _compared(paired, (F.col("t_copies") * F.col("p_copies")).alias("copies"))
    last = F.shiftright(F.col("copies") - 1, RUN_BITS)
    runs = told.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    left = F.least(F.lit(1 << RUN_BITS), F.col("copies") - F.shiftleft("run", RUN_BITS))
    dealt = runs.withColumn("left", left).repartition(*DIFF_COLUMNS, "run")
    return dealt.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), "left"))).select(*DIFF_COLUMNS)


def run_counts(diffed: DataFrame) -> DataFrame:
    def of(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return diffed.agg(
        F.count(F.lit(1)).alias("total"),
        of("deleted").alias("deleted"),
        of("changed").alias("changed"),
        of("unchanged").alias("unchanged"),
    )


def summary_row(diffed: DataFrame, asof: Column) -> DataFrame:
    """One row telling how many events there are and what became of them."""
    # The wording of the summary.
    told = F.format_string(
        "Gesamtzahl der Veranstaltungen: %d. \n"
        "Anzahl der gelöschten Veranstaltungen: %d.\n"
        "Anzahl der geänderten Veranstaltungen: %d.\n"
        "Anzahl der unveränderten/neuen Veranstaltungen: %d.",
        "total", "deleted", "changed", "unchanged",
    )
    title = F.concat(
        F.lit("Zusammenfassung der heutigen Veranstaltungen vom "),
        F.date_format(asof, "dd.MM.yyyy"),
    )
    place = "You can only see this here. Neumünster, Wyk, Kiel, Heide, Husum, Hamburg, Lübeck"
    return run_counts(diffed).select(
        title.alias("subject"),
        F.lit(place).alias("location"),
        asof.alias("start_date"),
        asof.alias("end_date"),
        F.lit(None).cast("string").alias("start_time"),
        F.lit(None).cast("string").alias("end_time"),
        told.alias("description"),
        F.lit("nowhere").alias("city"),
        F.lit(False).alias("music_label"),
        told.alias("updated_description"),
        F.lit("unchanged").alias("status"),
    )


def add_summary(diffed: DataFrame, asof: Column) -> DataFrame:
    """The comparison and its summary as one more row. It is stored first, as both read it."""
    diffed = cut_lineage(diffed)
    return diffed.withColumn("is_summary", F.lit(False)).unionByName(
        summary_row(diffed, asof).withColumn("is_summary", F.lit(True))
    )
