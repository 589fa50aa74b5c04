"""The smallest publish: only what differs between the wanted entries and the published ones.

Both sides are summed into a tree of digests: entries by the hash of their key into 65 536 leaves, and
256 leaves to a branch. Only leaves whose digests differ are opened. Inside them equal entries stay as
they are, entries left over on both sides under one key become updates, and the rest is inserted or
deleted. An entry keeps its id as long as it is published, and what has been applied is not called
for again, so a run that broke goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendra.operators.numbering import dense_number
from kalendra.session import cut_lineage

LEAF_BITS, BRANCH_BITS = 16, 8
#: Copies of one entry, or entries of one key, that one task numbers.
PIECE_BITS = 16
BATCH_SIZE = 580


def identified(
    entries: DataFrame, key: list[str], body: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Key, body and kept columns with `key_id`, `body_id` (hashes of key and body) and `leaf`."""
    key_id, body_id = hash_of(key), hash_of(body)
    return entries.select(
        *keep, *key, *body, key_id.alias("key_id"), body_id.alias("body_id"), leaf_of(key_id).alias("leaf")
    )


def hash_of(columns: list[str]) -> Column:
    """128 bits as bytes; as text they would be twice as long wherever they go."""
    return F.unhex(F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 32))


def leaf_of(key_id: Column) -> Column:
    return F.conv(F.hex(F.substring(key_id, 1, LEAF_BITS // 8)), 16, 10).cast("int")


def branch_of(leaf: Column) -> Column:
    return F.shiftright(leaf, LEAF_BITS - BRANCH_BITS)


def leaf_digests(rows: DataFrame) -> DataFrame:
    """(`leaf`, `n`, `a`, `b`): sums of two hashes of every entry of a leaf, whatever their order. One
    row per leaf, so never more than 65 536."""

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), "key_id", "body_id").cast("decimal(20, 0)"))

    return rows.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b")
    )


def branch_digests(leaves: DataFrame) -> DataFrame:
    """The digests one level up: sums of those of a branch's leaves."""
    sums = [F.sum(c).cast("decimal(38, 0)").alias(c) for c in ("n", "a", "b")]
    return leaves.groupBy(branch_of(F.col("leaf")).alias("branch")).agg(*sums)


def _differing(left: DataFrame, right: DataFrame, on: str) -> list[int]:
    same = F.lit(True)
    for c in ("n", "a", "b"):
        same = same & left[c].eqNullSafe(right[c])
    found = left.join(right, left[on] == right[on], "full_outer").filter(~same)
    return sorted(r[0] for r in found.select(F.coalesce(left[on], right[on])).collect())


def differing_leaves(wanted: DataFrame, published: DataFrame) -> list[int]:
    """Leaves whose digests differ, found from the branches down."""
    branches = _differing(branch_digests(wanted), branch_digests(published), "branch")
    if not branches:
        return []
    below = branch_of(F.col("leaf")).isin(branches)
    return _differing(wanted.filter(below), published.filter(below), "leaf")


def _numbered(rows: DataFrame, sizes: DataFrame, group: list[str], spread: str, out: str) -> DataFrame:
    """1, 2, … inside each group, in any order. A large group is cut into pieces of about 2**16 rows by
    a hash of `spread`, which must differ from row to row; `sizes` (`group`, `_size`) tells how large each is."""
    if (sizes.agg(F.max("_size")).first()[0] or 0) < 1 << PIECE_BITS:
        return cut_lineage(rows.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(spread))))
    pieces = F.shiftright(F.col("_size"), PIECE_BITS) + 1
    inside = Window.partitionBy(*group, "_piece").orderBy(spread)
    # Rows are dealt out once; the counts of the pieces come from what that stored.
    cut = cut_lineage(
        rows.join(sizes, group)
        .withColumn("_piece", F.pmod(F.xxhash64(spread), pieces))
        .withColumn("_no", F.row_number().over(inside))
        .drop("_size")
    )
    counts = cut.groupBy(*group, "_piece").agg(F.max("_no").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        cut.join(offsets, [*group, "_piece"])
        .withColumn(out, F.col("_no") + F.col("_before"))
        .drop("_no", "_before", "_piece")
    )


def calls_between(wanted: DataFrame, published: DataFrame, key: list[str], body: list[str]) -> DataFrame:
    """(`action`, `entry_id`, `slot`, key, body): what turns the published entries into the wanted ones.

    Both sides are `identified`, `published` with `slot`. A new entry gets the next free slot of its
    key; its id is the key's hash and the slot. The body of a deleted entry is its last. Entries are
    counted first; only those with more or fewer copies than wanted are numbered and paired.
    """
    names, same, of_key = [*key, *body], ["key_id", "body_id"], ["key_id"]
    asked = wanted.groupBy(*same).agg(F.count(F.lit(1)).alias("asked"), *[F.any_value(c).alias(c) for c in names])
    there = published.groupBy(*same).agg(F.count(F.lit(1)).alias("there"))
    differ = cut_lineage(
        asked.join(there, same, "full_outer")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("asked", "there")})
        .filter("asked <> there")
    )
    left, spare = F.greatest(F.col("asked") - F.col("there"), F.lit(0)), F.greatest(F.col("there") - F.col("asked"), F.lit(0))
    sizes = cut_lineage(differ.groupBy(*of_key).agg(F.sum(left).alias("left"), F.sum(spare).alias("spare")))
    most = differ.agg(F.max(left).alias("left"), F.max(spare).alias("spare")).first()
    ours = _missing(differ.withColumn("left", left).filter("left > 0"), most.left or 0, sizes, names)
    paired = ours.withColumn("w", F.lit(True)).withColumn("held", F.lit(None).cast("long"))
    if most.spare:
        theirs = _superfluous(published, differ.filter("there > asked"), sizes, names)
        theirs = theirs.select(*of_key, "no", F.col("slot").alias("held"), *[F.col(c).alias(f"p_{c}") for c in names])
        paired = paired.drop("held").join(theirs, [*of_key, "no"], "full_outer")
        here = [F.when(F.col("w"), F.col(c)).otherwise(F.col(f"p_{c}")).alias(c) for c in names]
        paired = paired.select(*of_key, "no", "w", "held", *here)
    tops = published.groupBy(*of_key).agg(F.max("slot").alias("top"))
    tops = sizes.select(*of_key, "spare").join(tops, of_key, "left")
    paired = paired.join(tops, of_key)
    fresh = F.coalesce(F.col("top") + 1, F.lit(0)) + F.col("no") - F.col("spare") - 1
    action = F.when(F.col("w").isNull(), "delete").when(F.col("held").isNull(), "insert").otherwise("update")
    slot = F.coalesce("held", fresh).cast("long")
    return paired.select(action.alias("action"), entry_id(F.col("key_id"), slot).alias("entry_id"), slot.alias("slot"), *names)


def _missing(short: DataFrame, most: int, sizes: DataFrame, names: list[str]) -> DataFrame:
    """`key_id`, `no` and names: the copies that are `left` of each entry, numbered by key; `most` of one."""
    # Many copies of one entry are written out in runs, which are dealt out before they become rows.
    runs = short.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("left") - 1, PIECE_BITS))))
    first = F.shiftleft(F.col("run"), PIECE_BITS)
    last = F.least(F.col("left"), first + (1 << PIECE_BITS)) - 1
    if most > 1 << PIECE_BITS:
        runs = runs.repartition("key_id", "body_id", "run")
    copies = runs.withColumn("one", F.explode(F.sequence(first, last)))
    copies = copies.select("key_id", *names, F.struct("body_id", "one").alias("_tell"))
    sized = sizes.select("key_id", F.col("left").alias("_size"))
    return _numbered(copies, sized, ["key_id"], "_tell", "no").drop("_tell")


def _superfluous(published: DataFrame, over: DataFrame, sizes: DataFrame, names: list[str]) -> DataFrame:
    """`key_id`, `slot`, names and `no`: the published copies beyond those wanted, numbered by key."""
    same = ["key_id", "body_id"]
    rows = published.select(*same, "slot", *names).join(over.select(*same, "asked"), same)
    counts = over.select(*same, F.col("there").alias("_size"))
    copies = _numbered(rows, counts, same, "slot", "copy").filter(F.col("copy") > F.col("asked"))
    sized = sizes.select("key_id", F.col("spare").alias("_size"))
    return _numbered(copies.select("key_id", "slot", *names), sized, ["key_id"], "slot", "no")


def entry_id(key_id: Column, slot: Column) -> Column:
    return F.concat(F.lower(F.hex(key_id)), F.lit("-"), slot.cast("string"))


def applied(published: DataFrame, calls: DataFrame, key: list[str], body: list[str], parts: int) -> DataFrame:
    """The published entries (`slot`, key, body, `leaf`, `branch`) after some or all of the calls, dealt by
    branch and `parts` of it and sorted so. Key and slot tell an entry, so its id need not travel."""
    names = ["slot", *key, *body]
    rank = F.when(F.col("action") == "delete", 2).otherwise(1).alias("rank")
    both = published.select(*names, F.lit(0).alias("rank")).unionByName(calls.select(*names, rank))
    leaf = leaf_of(hash_of(key))
    placed = both.withColumn("leaf", leaf).withColumns(
        {"branch": branch_of(F.col("leaf")).cast("string"), "part": F.pmod("leaf", F.lit(parts))}
    )
    newest = Window.partitionBy("branch", "part", "leaf", *key, "slot").orderBy(F.desc("rank"))
    return (
        placed.repartition("branch", "part")
        .withColumn("newest", F.row_number().over(newest))
        .filter("newest = 1 and rank < 2")
        .select(*names, "leaf", "branch")
    )


def with_call_batches(calls: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Number the calls and the batches a client may send at once."""
    ordered = calls.withColumn("_order", F.xxhash64("entry_id"))
    numbered = dense_number(ordered, "_order", "call_no").drop("_order")
    return numbered.withColumn("batch_no", F.floor((F.col("call_no") - 1) / F.lit(size)).cast("int"))
