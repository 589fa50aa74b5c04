"""Mixing sources to target weights by exact budgets of words.

Documents are counted by source and exact size. Each source's target is met by whole passes over all
its documents and, for the rest, by a number of further documents of each size: first the same share
of every size, then the largest that fit, and for the last stretch a bounded-knapsack table of
reachable sums picks sizes that meet the budget, or come nearest below it. Which documents of a size
are taken follows a seeded hash; of rows with one hash, as copies have, just as many as are wanted.
"""

from __future__ import annotations

from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendra.session import cut_lineage

WEIGHTS = (1, 2, 3)
#: How often a document is taken at most.
MOST_TIMES = 3
#: Words of a budget that the table of reachable sums covers.
TABLE_WORDS = 1 << 15
#: Units of the table in which long documents are picked anew, and bits of its steps in memory.
LONG_TABLE, TABLE_BITS = 1 << 22, 1 << 31
#: Parts that the documents of one source and size are ranked in, so that none is ranked as a whole.
RANK_PARTS = 256
SPACE = r"[\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    pieces = F.size(F.split(text, SPACE + "+", -1))
    first, last = text.rlike("^" + SPACE), text.rlike(SPACE + r"\z")
    n = F.when(F.length(text) == 0, 0).otherwise(pieces - first.cast("int") - last.cast("int"))
    return F.coalesce(F.greatest(n, F.lit(0)), F.lit(0)).cast("long")


def _places(sources: DataFrame) -> DataFrame:
    """Adds `place`: the sources' numbers from 0 by code point, null last. Sorted ranges are counted, so
    no task sees more than a range of them."""
    lying = cut_lineage(
        sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    ).withColumn("range", F.shiftright("at", 33))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        lying.groupBy("range")
        .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
        .select("range", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    place = F.col("before") + F.col("at") - F.col("first")
    return lying.join(ranges, "range").select(*sources.columns, place.alias("place"))


def targets(sources: DataFrame) -> DataFrame:
    """Adds `target` to (`source`, `source_size`): shares of all words by weight, none above MOST_TIMES
    its source's words; what a source cannot take is shared again among the others by weight. Each
    round of sharing is one aggregate, and only its sums reach the driver."""
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod("place", F.lit(len(WEIGHTS))).cast("int") + 1)
    limit, weight = F.col("source_size") * MOST_TIMES, F.col("weight")
    weighed = cut_lineage(_places(sources).withColumn("weight", weights.cast("double")).drop("place"))
    everything = weighed.agg(F.sum("source_size")).first()[0] or 0
    full, share, closed = F.lit(False), F.lit(0.0), -1
    while True:
        sums = weighed.agg(
            F.sum(F.when(full, limit).otherwise(0)).alias("limits"),
            F.sum(F.when(full, 0.0).otherwise(weight)).alias("weights"),
            F.count_if(full).alias("closed"),
        ).first()
        if not sums.weights or sums.closed <= closed:
            break
        closed = sums.closed
        share = F.lit(float(everything - sums.limits)) * weight / F.lit(sums.weights)
        full = share >= limit
    target = F.when(full, limit.cast("double")).otherwise(share)
    return weighed.select("source", "source_size", target.alias("target"))


def _fill(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size (descending) reach the largest sum up to the budget; the
    reachable sums are the bits of one number per size, counts split in powers of two."""
    reach, steps = 1, []
    everything = (1 << (budget + 1)) - 1
    for i, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        part, count = 1, min(count, budget // size)
        while count > 0 and not reach >> budget & 1:
            some = min(part, count)
            steps.append((i, some, reach))
            reach |= (reach << (some * size)) & everything
            count -= some
            part *= 2
    left, taken = reach.bit_length() - 1, [0] * len(sizes)
    for i, some, before in reversed(steps):
        if not before >> left & 1:
            left -= some * sizes[i]
            taken[i] += some
    return taken


def _reconsidered(sizes: list[int], taken: list[int], left: list[int], gap: int) -> list[int]:
    """`taken` with its long documents picked anew, where that comes nearer to the budget.

    sizes: descending. Documents are put back, the largest first, and a table decides over these and
    what is left. Its unit is the common step of their sizes, or more where they are many or very
    long; sizes are then rounded up, so the budget holds.
    """
    kept, free = list(taken), gap
    for i, size in enumerate(sizes):
        if size:
            back = min(kept[i], max(int(free == gap), (LONG_TABLE - free) // size))
            kept[i] -= back
            free += back * size
    open_ = [(i, taken[i] - kept[i] + left[i]) for i, s in enumerate(sizes) if 0 < s <= free]
    open_ = [(i, min(n, free // sizes[i])) for i, n in open_ if n]
    best, most = taken, free - gap
    # A spread of the sizes often meets the budget at a fine unit; else all of them decide.
    for some in (open_[:: max(1, len(open_) // 256)], open_) if open_ else ():
        steps = sum(n.bit_length() for _, n in some)
        unit = gcd(*(sizes[i] for i, _ in some))
        bits = max(TABLE_WORDS, min(LONG_TABLE, TABLE_BITS // steps))
        unit *= -(-free // (unit * bits))
        scaled = [-(-sizes[i] // unit) for i, _ in some]
        again = _fill(scaled, [n for _, n in some], free // unit)
        total = sum(sizes[i] * k for (i, _), k in zip(some, again, strict=True))
        if total > most:
            best, most = list(kept), total
            for (i, _), k in zip(some, again, strict=True):
                best[i] += k
        if most == free:
            break
    return best


def plan(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size to take, at most counts[i], for a sum near the budget."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    sizes_, left = [sizes[i] for i in order], [counts[i] for i in order]
    total = sum(s * c for s, c in zip(sizes_, left, strict=True))
    if total <= 0 or budget <= 0:
        return [0] * len(sizes)
    taken = [min(c, c * budget // total) if s else 0 for s, c in zip(sizes_, left, strict=True)]
    budget -= sum(s * k for s, k in zip(sizes_, taken, strict=True))
    left = [c - k for c, k in zip(left, taken, strict=True)]
    for i, size in enumerate(sizes_):  # the largest first, down to what the table covers
        more = min(left[i], max(0, budget - TABLE_WORDS // 2) // size) if size else 0
        taken[i] += more
        left[i] -= more
        budget -= more * size
    if budget > TABLE_WORDS:  # only where documents larger than that are left
        for i, size in enumerate(sizes_):
            more = min(left[i], budget // size) if size else 0
            taken[i] += more
            left[i] -= more
            budget -= more * size
    small = [i for i, s in enumerate(sizes_) if 0 < s <= budget and left[i] > 0]
    if small and budget <= TABLE_WORDS:
        for i, more in zip(
            small, _fill([sizes_[i] for i in small], [left[i] for i in small], budget), strict=True
        ):
            taken[i] += more
            budget -= more * sizes_[i]
            left[i] -= more
    if budget and any(left):
        taken = _reconsidered(sizes_, taken, left, budget)
    out = [0] * len(sizes)
    for i, k in zip(order, taken, strict=True):
        out[i] = k
    return out


def _plans(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows of one source by size, with its target: `passes` over all documents and `extra` more."""
    frame = frame.sort_values("size").reset_index(drop=True)
    sizes, counts = frame["size"].tolist(), frame["n"].tolist()
    total, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
    passes = min(MOST_TIMES, int(target // total)) if total else 0
    rest = round(target) - passes * total if passes < MOST_TIMES else 0
    return frame.assign(passes=passes, extra=plan(sizes, counts, rest))[
        ["source", "size", "source_size", "target", "passes", "extra"]
    ]


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """`docs` with the size, seeded hash and rank part of each row."""
    turn = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.lit(seed))
    return docs.withColumns(
        {
            "__size": word_count(F.col("text")),
            "__turn": turn,
            "__part": F.pmod(turn, F.lit(RANK_PARTS)).cast("int"),
        }
    )


def _same(left: DataFrame, right: DataFrame):
    """Join condition on source (null equals null), size and part."""
    same = left["source"].eqNullSafe(right["of_source"]) & (left["__size"] == right["of_size"])
    return same & (left["__part"] == right["of_part"])


def decisions(light: DataFrame) -> DataFrame:
    """What is taken of each source, size and part: (`of_source`, `of_size`, `of_part`,
    `source_size`, `target`, `passes`, `last`, `wanted`, `ties`): all documents `passes` times, and once
    more those whose hash is below `last` and `wanted` of the `ties` that have it.

    light: (source, __size, __turn, __part). A source is planned in one task from one row per
    distinct size. Only a part that is taken in part is ranked, by counted hashes, and parts hold a
    small share of the hashes of one size.
    """
    keys = ["source", "__size", "__part"]
    parts = cut_lineage(light.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    counted = parts.groupBy("source", F.col("__size").alias("size")).agg(F.sum("n").alias("n"))
    by_source = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    shared = targets(by_source).withColumnRenamed("source", "of_source")
    made = cut_lineage(
        counted.join(shared, counted["source"].eqNullSafe(shared["of_source"]))
        .select("source", "size", "n", "source_size", "target")
        .groupBy("source")
        .applyInPandas(
            _plans,
            "source string, size long, source_size long, target double, passes long, extra long",
        )
        .withColumnsRenamed({"source": "of_source", "size": "of_size"})
    )
    before = Window.partitionBy("source", "__size").orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    running = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    more = F.greatest(F.lit(0), F.least("n", F.col("extra") - F.col("before")))
    wanted = cut_lineage(
        running.join(
            made,
            running["source"].eqNullSafe(made["of_source"]) & (running["__size"] == made["of_size"]),
        ).select(
            "of_source", "of_size", F.col("__part").alias("of_part"), "source_size", "target",
            "passes", more.alias("more"), "n",
        )
    )
    partly = wanted.filter((F.col("more") > 0) & (F.col("more") < F.col("n")))
    part = ["of_source", "of_size", "of_part"]
    so_far = Window.partitionBy(*part).orderBy("__turn").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        light.join(partly, _same(light, partly))
        .groupBy(*part, "more", "__turn")
        .agg(F.count(F.lit(1)).alias("ties"))
        .withColumn("wanted", F.col("more") - F.sum("ties").over(so_far) + F.col("ties"))
        .filter((F.col("wanted") > 0) & (F.col("wanted") <= F.col("ties")))
        .select(*part, F.col("__turn").alias("last"), "wanted", "ties")
    )
    most, none = F.lit((1 << 63) - 1), F.lit(0).cast("long")
    columns = [*part, "source_size", "target", "passes"]
    whole = wanted.filter((F.col("more") == 0) | (F.col("more") == F.col("n"))).select(
        *columns, F.when(F.col("more") > 0, most).alias("last"), none.alias("wanted"), none.alias("ties")
    )
    a, b = partly.alias("a"), cut.alias("b")
    same = F.col("a.of_source").eqNullSafe(F.col("b.of_source"))
    for c in ("of_size", "of_part"):
        same &= F.col(f"a.{c}") == F.col(f"b.{c}")
    split = a.join(b, same).select(*[f"a.{c}" for c in columns], "b.last", "b.wanted", "b.ties")
    return cut_lineage(whole.unionByName(split))


def _numbered(tied: DataFrame) -> DataFrame:
    """Adds `__nth`, from 1, to rows of one hash. They are numbered where they lie, a file's share in a
    task, and each share goes on from those before it."""
    lying = cut_lineage(tied.withColumn("__at", F.monotonically_increasing_id()))
    lying = lying.withColumns(
        {"__share": F.shiftright("__at", 33), "__of": F.coalesce("source", F.lit("")), "__null": F.col("source").isNull()}
    )
    group = ["__of", "__null", "__size", "__part"]
    earlier = Window.partitionBy(*group).orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        lying.groupBy(*group, "__share")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*group, "__share", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    )
    nth = F.row_number().over(Window.partitionBy(*group, "__share").orderBy("__at"))
    numbered = lying.withColumn("__nth", nth).join(shares, [*group, "__share"])
    return numbered.withColumn("__nth", F.col("__nth") + F.col("__before")).select(*tied.columns, "__nth")


def _with_times(rows: DataFrame, decided: DataFrame) -> DataFrame:
    joined = rows.join(decided, _same(rows, decided))
    tied = F.coalesce(F.col("__turn") == F.col("last"), F.lit(False)) & (F.col("wanted") < F.col("ties"))
    again = F.coalesce(F.col("__turn") <= F.col("last"), F.lit(False)).cast("long")
    if decided.filter("wanted < ties").isEmpty():
        return joined.withColumn("__times", F.col("passes") + again)
    more = (F.col("__nth") <= F.col("wanted")).cast("long")
    settled = joined.filter(~tied).withColumn("__times", F.col("passes") + again)
    picked = _numbered(joined.filter(tied)).withColumn("__times", F.col("passes") + more).drop("__nth")
    return settled.unionByName(picked)


def mix(docs: DataFrame, seed: int = 11) -> DataFrame:
    """(`doc_id`, `size`, `source_size`, `target`, `taken`) of every document.

    Sources by code point, null last, weigh 1, 2, 3, repeating. A document is taken at most three
    times; a document without words is taken with 0 words. A null doc_id is one like any other, and of
    repeated rows as many are taken as the budget asks. No rows give no rows. Needs doc_id, text and
    source; other columns are ignored.
    """
    light = cut_lineage(_keyed(docs.select("doc_id", "text", "source"), seed).drop("text"))
    return _with_times(light, decisions(light)).select(
        "doc_id", F.col("__size").alias("size"), "source_size", "target",
        (F.col("__times") * F.col("__size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, seed: int = 11) -> DataFrame:
    """Every document as often as the mix takes it; a document without words is left out. The
    columns are those of `docs`."""
    keyed = _keyed(docs.select(F.struct("*").alias("__row"), "doc_id", "text", "source"), seed)
    light = cut_lineage(keyed.select("doc_id", "source", "__size", "__turn", "__part"))
    rows = keyed.select("__row", "source", "__size", "__turn", "__part")
    taken = _with_times(rows, decisions(light)).filter((F.col("__times") > 0) & (F.col("__size") > 0))
    copies = F.explode(F.sequence(F.lit(1), F.col("__times")))
    return taken.select("__row", copies.alias("__copy")).select("__row.*")
