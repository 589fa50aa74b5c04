"""Prefix trie of conversations: what they share turn by turn, with totals of every subtree.

A node is a sequence of first turns. It is known by its depth and four polynomial prefix hashes modulo
2**31 - 1, which can be worked out piece by piece, so that a conversation of any length may lie in
many tasks. Totals of subtrees come from depth bands of fixed height: inside a band a conversation
passes what it holds to its ancestors of that band, the roots of the bands form a tree that is lower
by the height of a band and is treated the same way, and the complete totals of the roots go to their
ancestors in the band above. With bands of 16 turns and a deepest conversation of 16**k turns there
are k rounds, and no turn is passed to more than 16 nodes in each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendra.session import cut_lineage

#: Height of a band of depths.
BAND = 16
#: A conversation is rebuilt from at most this many first turns of its group's first one.
MOST_HEADS = 5
#: Conversations that end at a node are joined to text in runs of 2**RUN_BITS consecutive numbers.
RUN_BITS = 8
#: Characters of role and text by which rows of equal turn are ordered; after that a hash decides.
TIE_CHARS = 64

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 747_796_405, 1_664_525_239, 2_023_564_877)
LANES = range(len(BASES))
NO_MEMBER_ENDS = hashlib.sha256(b"").hexdigest()


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo PRIME."""
    result, square, left = np.ones(len(exponents), np.int64), base % PRIME, exponents.copy()
    while left.any():
        result = np.where(left & 1, result * square % PRIME, result)
        square, left = square * square % PRIME, left >> 1
    return result


_SCANNED = "conv_id long, piece int, i long, chars long, " + ", ".join(
    f"s{k} long, q{k} long" for k in LANES
)


def _scan(batches):
    """Number the sorted turns of each conversation inside this piece, with the prefix hashes up to
    each turn (`s`) and before it (`q`)."""
    piece = TaskContext.get().partitionId()
    last, count, carry = None, 0, [0] * len(BASES)
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        conv = batch.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
        goes_on = last is not None and conv[0] == last
        i = np.arange(1, n + 1) - starts[run] + np.where(run == 0, count if goes_on else 0, 0)
        columns = [pa.array(conv), pa.array(np.full(n, piece, np.int32)), pa.array(i), batch.column("chars")]
        for k in LANES:
            half = batch.column("t1" if k < 2 else "t2").to_numpy()
            content = (half >> (31 * (k % 2)) & PRIME) % PRIME
            value = content * _power(BASES[k], i) % PRIME
            sums = np.cumsum(value)
            before = (sums - value)[starts]
            before[0] -= carry[k] if goes_on else 0
            prefix = (sums - before[run]) % PRIME
            columns += [pa.array(prefix), pa.array((prefix - value) % PRIME)]
            carry[k] = int(prefix[-1])
        last, count = conv[-1], int(i[-1])
        names = [c.split()[0] for c in _SCANNED.split(", ")]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _carries(pieces: pd.DataFrame) -> pd.DataFrame:
    """What a conversation that lies in several pieces brings into each of them: turns before it,
    the power of the base they stand for, and their prefix hash."""
    pieces = pieces.sort_values("piece")
    before = pieces["n"].cumsum().to_numpy() - pieces["n"].to_numpy()
    out = {"conv_id": pieces["conv_id"], "piece": pieces["piece"], "turns_before": before}
    for k in LANES:
        out[f"w{k}"] = _power(BASES[k], before)
        part = out[f"w{k}"] * pieces[f"s{k}"].to_numpy() % PRIME
        out[f"c{k}"] = (np.cumsum(part) - part) % PRIME
    return pd.DataFrame(out)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(`conv_id`, `i`, `chars`, `s0`..`s3`, `q0`..`q3`): each turn's number in its conversation, the
    code points of its text, and the prefix hashes up to it and before it.

    Turns are sorted into ranges of (conversation, turn), so the turns of one conversation may fill
    many tasks. A range continues at most one conversation of the range before, so the table of what
    is carried over has at most one row for each range.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = cut_lineage(
        conversations.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.substring(role, 1, TIE_CHARS).alias("role"),
            F.substring(text, 1, TIE_CHARS).alias("text"),
            F.length(text).cast("long").alias("chars"),
            F.xxhash64(F.lit(1), role, text).alias("t1"),
            F.xxhash64(F.lit(2), text, role).alias("t2"),
        )
    )
    order = ["conv_id", "turn", "role", "text", "t1", "t2"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The row's place tells equal rows apart, so that even they need not meet in one range.
    dealt = slim.withColumn("place", F.monotonically_increasing_id())
    found = cut_lineage(
        dealt.repartitionByRange(ranges, *order, "place")
        .sortWithinPartitions(*order)
        .select("conv_id", "chars", "t1", "t2")
        .mapInArrow(_scan, _SCANNED)
    )
    sums = [F.max_by(f"s{k}", "i").alias(f"s{k}") for k in LANES]
    ends = cut_lineage(found.groupBy("conv_id", "piece").agg(F.max("i").alias("n"), *sums))
    spread = ends.groupBy("conv_id").agg(F.count(F.lit(1)).alias("pieces")).filter("pieces > 1")
    kinds = ", ".join(f"w{k} long, c{k} long" for k in LANES)
    carried = ends.join(spread, "conv_id", "left_semi").groupBy("conv_id")
    carried = carried.applyInPandas(_carries, f"conv_id long, piece int, turns_before long, {kinds}")
    joined = found.join(F.broadcast(carried.filter("turns_before > 0")), ["conv_id", "piece"], "left")

    def whole(lane: str, k: int) -> Column:
        moved = (F.col(f"c{k}") + F.col(f"w{k}") * F.col(lane)) % PRIME
        return F.coalesce(moved, F.col(lane)).alias(lane)

    return cut_lineage(
        joined.select(
            "conv_id",
            (F.col("i") + F.coalesce("turns_before", F.lit(0))).alias("i"),
            "chars",
            *[whole(f"{lane}{k}", k) for k in LANES for lane in "sq"],
        )
    )


def _packed(lanes: list[Column], name: str) -> list[Column]:
    """The four lanes as two whole numbers."""
    two = [F.shiftleft(lanes[k].cast("long"), 31) + lanes[k + 1] for k in (0, 2)]
    return [two[0].alias(f"{name}1"), two[1].alias(f"{name}2")]


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(`conv_id`, `p`, `k1`, `k2`, `pk1`, `pk2`, `chars`, `is_end`): for each rebuilt conversation
    and each p from 0 to its length the node of its first p turns, that node's parent, the code points
    of turn p, and whether the conversation ends there."""
    turns = numbered_turns(conversations)
    lanes = [f"s{k}" for k in LANES]
    early = F.when(F.col("i") <= MOST_HEADS, F.struct("i", "chars", *lanes))
    convs = cut_lineage(
        turns.groupBy("conv_id").agg(
            F.max("i").alias("n"), F.array_sort(F.collect_list(early)).alias("heads")
        )
    )
    bases = convs.filter(F.col("conv_id") % 100 == 0).select(
        F.col("conv_id").alias("base"), F.col("heads").alias("given")
    )
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEADS + 1)
    known = (
        convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
        .join(bases, "base", "left")
        .withColumn("h", taken)
        .withColumn("given", F.slice(F.coalesce("given", F.array()), F.lit(1), F.col("h").cast("int")))
        .withColumn("nb", F.size("given"))
    )
    zero = F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("chars"),
                    *[F.lit(0).cast("long").alias(x) for x in lanes])
    known = cut_lineage(
        known.select(
            "conv_id", "n", "h", "nb", "given",
            F.when(F.col("nb") > 0, F.element_at("given", -1)).otherwise(zero).alias("start"),
            F.when((F.col("h") > 0) & (F.col("n") >= F.col("h")), F.get("heads", (F.col("h") - 1).cast("int")))
            .otherwise(zero).alias("own"),
        )
    )
    steps = F.concat(F.array(zero), F.col("given"))
    heads = known.select(
        "conv_id", "n", "h", "nb", steps.alias("steps"), F.explode(F.sequence(F.lit(0), F.col("nb"))).alias("at")
    ).select(
        "conv_id", F.col("at").cast("long").alias("p"), F.get("steps", F.col("at")).alias("now"),
        F.get("steps", F.greatest(F.col("at") - 1, F.lit(0))).alias("was"),
        ((F.col("at") == F.col("nb")) & (F.col("n") <= F.col("h"))).alias("is_end"),
    )
    first = heads.select(
        "conv_id", "p", *_packed([F.col(f"now.{x}") for x in lanes], "k"),
        *_packed([F.col(f"was.{x}") for x in lanes], "pk"), F.col("now.chars").alias("chars"), "is_end",
    )
    shift = F.col("h") - F.col("nb")

    def moved(lane: str, k: int) -> Column:
        """The prefix hash of the rebuilt turns: the given ones, then the own ones after the first h,
        moved down by as many places as there are fewer given ones."""
        down = pow(BASES[k], -1, PRIME)
        factor = F.get(F.array(*[F.lit(pow(down, s, PRIME)).cast("long") for s in range(MOST_HEADS + 1)]), shift.cast("int"))
        own = F.pmod(F.col(f"{lane}{k}") - F.col(f"own.s{k}"), F.lit(PRIME).cast("long"))
        return (F.col(f"start.s{k}") + own * factor) % PRIME

    # Both sides are stored, so the planner can split the turns of a long conversation.
    later = turns.join(known.drop("given"), "conv_id").filter(F.col("i") > F.col("h")).select(
        "conv_id", (F.col("i") - shift).alias("p"), *_packed([moved("s", k) for k in LANES], "k"),
        *_packed([moved("q", k) for k in LANES], "pk"), "chars", (F.col("i") == F.col("n")).alias("is_end"),
    )
    return cut_lineage(first.unionByName(later))


def _subtree_totals(rows: DataFrame, depth: int, band: int) -> DataFrame:
    """(`p`, `k1`, `k2`, `leaves`, `saved`): for every node the sums of `leaves` and `saved` over the
    rows of its subtree that are not 0.

    `rows` holds the whole path of each conversation; `rep` marks one conversation of each node, by
    which the complete total of a band's root reaches the band above.
    """
    of_band = F.floor(F.col("p") / band).cast("long")
    upwards = Window.partitionBy("conv_id", "band").orderBy(F.desc("p"))
    passed = rows.withColumn("band", of_band).withColumns(
        {c: F.sum(c).over(upwards) for c in ("leaves", "saved")}
    )
    if depth >= band:
        roots = cut_lineage(
            passed.filter(F.col("p") % band == 0).select(
                "conv_id", F.col("band").alias("p"), "k1", "k2", "rep", "leaves", "saved"
            )
        )
        above = _subtree_totals(roots, depth // band, band)
        sent = (
            roots.filter(F.col("rep") & (F.col("p") > 0))
            .select("conv_id", "p", "k1", "k2")
            .join(above, ["p", "k1", "k2"])
            .select(
                "conv_id", (F.col("p") - 1).alias("band"),
                F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"),
            )
        )
        passed = passed.join(cut_lineage(sent), ["conv_id", "band"], "left")
        for c in ("leaves", "saved"):
            passed = passed.withColumn(c, F.col(c) + F.coalesce(f"more_{c}", F.lit(0)))
    some = passed.filter((F.col("leaves") > 0) | (F.col("saved") > 0))
    return cut_lineage(
        some.groupBy("p", "k1", "k2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )


def _digests(batches):
    """SHA-256 of the comma-joined runs of each node, which arrive in order, one batch at a time."""
    node, digest = None, None
    done: list[tuple] = []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("p", "k1", "k2")), strict=True)
        for key, run in zip(keys, batch.column("ids").to_pylist(), strict=True):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(run.encode())
        if len(done) >= 10_000:
            yield _rows(done)
            done = []
    if node is not None:
        done.append((*node, digest.hexdigest()))
    if done:
        yield _rows(done)


def _rows(done: list[tuple]) -> pa.RecordBatch:
    p, k1, k2, digest = zip(*done, strict=True)
    columns = [pa.array(c, pa.int64()) for c in (p, k1, k2)] + [pa.array(digest, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["p", "k1", "k2", "ends_sha256"])


def end_digests(paths: DataFrame) -> DataFrame:
    """(`p`, `k1`, `k2`, `ends_sha256`): SHA-256 of the ascending numbers of the conversations that
    end at a node. Runs of 256 numbers become one text first, so the task that hashes a node's text,
    which can only be done in order, sees few rows and holds one batch of them."""
    run = F.shiftright("conv_id", RUN_BITS)
    ids = F.array_sort(F.collect_list("conv_id")).cast("array<string>")
    runs = (
        paths.filter("is_end")
        .groupBy("p", "k1", "k2", run.alias("run"))
        .agg(F.array_join(ids, ",").alias("ids"))
    )
    ordered = runs.repartition("p", "k1", "k2").sortWithinPartitions("p", "k1", "k2", "run")
    return ordered.select("p", "k1", "k2", "ids").mapInArrow(
        _digests, "p long, k1 long, k2 long, ends_sha256 string"
    )


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: `conv_id` (its smallest member), `depth`, `parent_conv_id` (null at the
    root), `n_convs`, `n_children`, `n_leaves`, `saved_tokens`, `ends_sha256`.

    Conversation c is rebuilt from the first crc32(c) % 6 turns of conversation c - c % 100 (the
    remainder has the sign of c) and its own turns after as many. Turns are ordered by `turn`, nulls
    first; rows of equal turn by the first 64 characters of role and text, then by a hash of both, and
    repeated rows are turns of their own. A null role or text is empty; rows without conv_id belong to
    no conversation and are left out. An empty table has no node, not even the root. Columns other
    than conv_id, turn, role and text are ignored, whatever their names. Texts of any length are one
    hash each, and a conversation of any length is spread over tasks.
    """
    paths = rebuilt_paths(conversations.select("conv_id", "turn", "role", "text"))
    key = ["p", "k1", "k2"]
    found = cut_lineage(
        paths.groupBy(*key).agg(
            F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"),
            F.min("chars").alias("chars"), F.min("pk1").alias("pk1"), F.min("pk2").alias("pk2"),
        )
    )
    children = (
        found.filter("p > 0")
        .groupBy((F.col("p") - 1).alias("p"), F.col("pk1").alias("k1"), F.col("pk2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = cut_lineage(found.join(children, key, "left").fillna(0, ["n_children"]))
    own = nodes.select(
        F.col("rep").alias("conv_id"), "p", F.lit(True).alias("rep"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    rows = paths.select("conv_id", *key).join(own, ["conv_id", "p"], "left")
    rows = rows.withColumn("rep", F.col("rep").isNotNull()).fillna(0, ["leaves", "saved"])
    depth = nodes.agg(F.max("p")).first()[0] or 0
    totals = _subtree_totals(rows, depth, band)
    parents = nodes.select(
        (F.col("p") + 1).alias("p"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"),
        F.col("rep").alias("parent_conv_id"),
    )
    # The nodes are stored, so the many children of one node can be split in this join.
    return (
        nodes.join(totals, key, "left")
        .join(end_digests(paths), key, "left")
        .join(parents, ["p", "pk1", "pk2"], "left")
        .select(
            F.col("rep").alias("conv_id"), F.col("p").alias("depth"),
            F.when(F.col("p") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
            F.coalesce("leaves", F.lit(0)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_MEMBER_ENDS)).alias("ends_sha256"),
        )
    )


#: The same rows in SQL; crc32 is spelled out on the decimal digits, and a node is its list of turns.
ORACLE = """
    with crc_table as (
        select list(list_reduce(list_prepend(n, range(8)),
               lambda x, _: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) order by n) as t
        from (select unnest(range(256)) as n)),
    convs as (
        select conv_id, list_reduce(
                   list_prepend(4294967295::bigint, list_transform(
                       string_split(cast(conv_id as varchar), ''), lambda c: ord(c)::bigint)),
                   lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])) as reduced
        from (select distinct conv_id from conversations where conv_id is not null), crc_table),
    known as (select conv_id, xor(reduced, 4294967295) % 6 as h from convs),
    turns as (
        select conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} as said,
               row_number() over (partition by conv_id order by turn nulls first, role, text) as i
        from conversations where conv_id is not null),
    rebuilt as (
        select k.conv_id, 0 as part, t.i, t.said
        from known k join turns t on t.conv_id = k.conv_id - k.conv_id % 100 and t.i <= k.h
        union all
        select k.conv_id, 1, t.i, t.said from known k join turns t on t.conv_id = k.conv_id and t.i > k.h),
    whole as (
        select k.conv_id, coalesce(list(r.said order by r.part, r.i) filter (where r.i is not null), []) as said
        from known k left join rebuilt r using (conv_id) group by k.conv_id),
    paths as (
        select conv_id, d, md5(cast(said[1:d] as varchar) || d) as node, md5(cast(said[1:d-1] as varchar) || (d - 1)) as up,
               coalesce(length(said[d].t), 0) as chars, d = len(said) as is_end
        from (select conv_id, said, unnest(range(len(said) + 1)) as d from whole)),
    nodes as (
        select d, node, min(conv_id) as conv_id, any_value(up) as up, count(*) as n_convs, min(chars) as chars,
               sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where is_end), '')) as ends
        from paths group by d, node),
    counted as (
        select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.d = n.d + 1 and c.up = n.node) as n_children
        from nodes n left join nodes p on p.d = n.d - 1 and p.node = n.up),
    totals as (
        select p.d, p.node, sum(case when c.n_children = 0 then 1 else 0 end) as n_leaves,
               sum((c.n_convs - 1) * c.chars) as saved
        from counted c join paths p on p.conv_id = c.conv_id and p.d <= c.d group by p.d, p.node)
    select c.conv_id, cast(c.d as bigint) as depth, c.parent_conv_id, c.n_convs, c.n_children,
           cast(t.n_leaves as bigint) as n_leaves, cast(t.saved as bigint) as saved_tokens, c.ends as ends_sha256
    from counted c join totals t using (d, node)
"""
