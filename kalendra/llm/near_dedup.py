"""MinHash near-dedup by an LSH forest.

Each text's distinct five-word shingles give a MinHash sketch. Texts with the same set are one node.
A forest holds the nodes in several sorted orders of different stretches of the sketch; in each
order, neighbours that share the longest prefixes are candidates, and how deep a prefix two
neighbours share adapts to how crowded their region is: among few similar texts three values bring
two of them together, in a crowd the order itself goes on to deeper values. Neighbours whose sketches
look alike form candidate groups. A group's texts meet once, and links are confirmed there on full
sets, so the estimate decides only who meets, never who is linked.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendra.llm.graph import components
from kalendra.llm.words import Words, distinct_sets, mix, pieces, shingles, text_bytes
from kalendra.session import cut_lineage

#: MinHash values of a sketch, two bytes each.
HASHES = 96
#: Sorted orders, the values each sorts by, and the step from one order's first value to the next.
TREES, DEPTH, STEP = 16, 12, 6
#: Values two neighbours share at least, and how far back along an order neighbours are compared.
LEAST_PREFIX, NEIGHBOURS = 3, 16
#: Sketch values compared for the estimate, and the chance that two texts of the least similarity
#: agree in fewer of them than are asked for.
COMPARED, MISSED = 64, 3e-5
#: Members and shingles of a part of a candidate group that meets others in one task.
PART_MEMBERS, PART_SHINGLES = 1024, 2_000_000

_SALTS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_FACTORS = mix(_SALTS) | np.uint64(1)


def agreeing(least_percent: int) -> int:
    """How many of the compared values agree at least, e.g. 42 for 85 percent."""
    p, below, k = min(least_percent, 100) / 100, 0.0, 0
    while k < COMPARED:
        below += comb(COMPARED, k) * p**k * (1 - p) ** (COMPARED - k)
        if below > MISSED:
            break
        k += 1
    return k


def _sketch(values: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for a in range(0, len(values), 1024):
        x = (values[a : a + 1024, None] ^ _SALTS[None, :]) * _FACTORS[None, :]
        np.minimum(least, x.min(axis=0), out=least)
    return (least >> np.uint64(20)).astype(">u2")


def _sets(column) -> list[np.ndarray]:
    words = Words(*text_bytes(column), fold=True)
    return list(distinct_sets(*shingles(words), len(column)))


def _profiles(batches):
    for whole in batches:
        for batch in pieces(whole, "text"):
            sizes, digests, sketches = [], [], []
            for values in _sets(batch.column("text")):
                sizes.append(len(values))
                with np.errstate(over="ignore"):
                    sums = np.array([len(values), values.sum(), mix(values).sum()], np.uint64)
                digests.append(sums.tobytes())
                sketches.append(_sketch(values).tobytes() if len(values) else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "sketch"],
            )


def profiles(docs: DataFrame) -> DataFrame:
    """(`doc_id`, `n_shingles`, `digest` of the shingle set, `sketch`) of every document."""
    return docs.select("doc_id", "text").mapInArrow(
        _profiles, "doc_id long, n_shingles long, digest binary, sketch binary"
    )


def orders(nodes: DataFrame) -> DataFrame:
    """Every node once for each order: (`tree`, `prefix` sorted by, `doc_id`, `sketch`)."""
    ring = F.concat("sketch", F.substring("sketch", 1, 2 * DEPTH))
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    return nodes.select("doc_id", ring.alias("ring"), tree.alias("tree")).select(
        F.col("tree").cast("tinyint").alias("tree"),
        F.substring(F.col("ring"), 1 + 2 * STEP * F.col("tree"), F.lit(2 * DEPTH)).alias("prefix"),
        "doc_id",
        F.substring("ring", 1, 2 * COMPARED).alias("sketch"),
    )


def _binary(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _neighbours(least: int):
    """Pairs that connect all neighbours whose sketches agree in `least` values.

    A row hangs below the nearest earlier row that looks like it; it is given out with the head of
    its chain. Of its other likes only those count that lead from one chain to another, and they are
    given out as pairs of heads.
    """

    def run(batches):
        tail = None
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            prefix = _binary(batch.column("prefix"), 2 * DEPTH)
            sketch = np.ascontiguousarray(_binary(batch.column("sketch"), 2 * COMPARED)[:, 1::2])
            key = batch.column("tree").to_numpy(zero_copy_only=False).astype(np.uint64)
            for k in range(2 * LEAST_PREFIX):
                key = (key << np.uint64(8)) | prefix[:, k].astype(np.uint64)
            old = 0
            if tail is not None:
                old = len(tail[0])
                ids, sketch, key = (np.concatenate([t, x]) for t, x in zip(tail, (ids, sketch, key)))
            n = len(ids)
            lefts, rights = [], []
            chain = np.arange(n)
            for lag in range(1, min(NEIGHBOURS, n - 1) + 1):
                at = np.flatnonzero(key[lag:] == key[:-lag]) + lag
                at = at[at >= old]
                alike = (sketch[at] == sketch[at - lag]).sum(axis=1) >= least
                at = at[alike]
                lefts.append(at - lag)
                rights.append(at)
                free = at[chain[at] == at]
                chain[free] = free - lag
            hung = np.flatnonzero(chain != np.arange(n))
            while True:
                up = chain[chain]
                if (up == chain).all():
                    break
                chain = up
            left = np.concatenate(lefts) if lefts else np.empty(0, np.int64)
            right = np.concatenate(rights) if rights else np.empty(0, np.int64)
            bridge = chain[left] != chain[right]
            a, b = chain[left[bridge]], chain[right[bridge]]
            _, one = np.unique(np.minimum(a, b) * n + np.maximum(a, b), return_index=True)
            left = np.concatenate([chain[hung], chain[left[bridge][one]]])
            right = np.concatenate([hung, chain[right[bridge][one]]])
            tail = (ids[-NEIGHBOURS:], sketch[-NEIGHBOURS:], key[-NEIGHBOURS:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[left], pa.int64()), pa.array(ids[right], pa.int64())], names=["a", "b"]
            )

    return run


def candidate_edges(nodes: DataFrame, least_percent: int) -> DataFrame:
    """(`a`, `b`): neighbours in some order that look alike. The orders are cut by range, so a crowd
    is spread over tasks; a pair that a cut separates still meets in the other orders."""
    columns = ["tree", "prefix", "doc_id"]
    return (
        orders(nodes)
        .repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .mapInArrow(_neighbours(agreeing(least_percent)), "a long, b long")
        .distinct()
    )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all intersections, by products over blocks of shared shingles."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if m else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(m), sizes)
    _, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = seen[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    column = np.cumsum(np.r_[0, np.diff(column) > 0]) if len(column) else column
    total = np.zeros((m, m), np.float32)
    width = max(256, (16 << 20) // max(4 * m, 1))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        block = np.zeros((m, width), np.float32)
        block[owner[a:b], column[a:b] - first] = 1
        total += block @ block.T
    both = total.astype(np.int64)
    np.fill_diagonal(both, sizes)
    return both


def linked_stars(ids: np.ndarray, sets: list[np.ndarray], least_percent: int):
    """(member, least member) of each connected part of texts linked on their full sets."""
    both = overlaps(sets)
    sizes = np.diagonal(both)
    link = 100 * both >= least_percent * (sizes[:, None] + sizes[None, :] - both)
    open_, found = np.ones(len(ids), bool), []
    for i in range(len(ids)):
        if not open_[i]:
            continue
        part = np.zeros(len(ids), bool)
        edge = np.array([i])
        part[i] = True
        while len(edge):
            near = link[edge].any(axis=0) & ~part
            part |= near
            edge = np.flatnonzero(near)
        open_ &= ~part
        members = ids[part]
        found += [(x, members.min()) for x in members if x != members.min()]
    return found


def _confirm(least_percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        found = linked_stars(ids, _sets(table.column("text")), least_percent)
        return pa.table(
            {
                "a": pa.array([x for x, _ in found], pa.int64()),
                "b": pa.array([x for _, x in found], pa.int64()),
            }
        )

    return run


def confirmed_edges(docs: DataFrame, groups: DataFrame, least_percent: int) -> DataFrame:
    """(`a`, `b`): links on full sets that connect all linked texts of each candidate group.

    groups: (`node`, `root`, `n_shingles`). A large group is cut into parts; every two parts meet in
    a task of their own, so a task's memory is bounded and no link between parts is lost.
    """
    parts = F.greatest(
        F.ceil(F.count(F.lit(1)) / PART_MEMBERS), F.ceil(F.sum("n_shingles") / PART_SHINGLES)
    )
    sizes = cut_lineage(groups.groupBy("root").agg(parts.cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    members = cut_lineage(
        groups.join(sizes, "root")
        .select("node", "root", "parts", part.alias("part"))
        .select("node", "root", "parts", "part", other.alias("other"))
        .filter((F.col("part") != F.col("other")) | (F.col("parts") == 1))
        .select(
            F.col("node").alias("doc_id"),
            "root",
            F.least("part", "other").alias("i"),
            F.greatest("part", "other").alias("j"),
        )
    )
    return (
        docs.select("doc_id", "text")
        .join(members, "doc_id")
        .groupBy("root", "i", "j")
        .applyInArrow(_confirm(least_percent), "a long, b long")
        .distinct()
    )


def near_dups(docs: DataFrame, least_percent: int = 85) -> DataFrame:
    """One row per document: (`doc_id`, `n_shingles`, `component_id`, `kept`).

    Words are what stands between ASCII white space, with A-Z as a-z. Texts are linked where
    100 * shared shingles >= least_percent * shingles of either; `component_id` is the least doc_id
    reachable over links, and the document that bears it is kept. A text without words is linked
    with nothing. Rows that share a doc_id count as one document. A row whose doc_id is null has a
    null component and is kept. Other columns of `docs` are ignored.
    """
    all_docs = cut_lineage(profiles(docs))
    nodes = cut_lineage(
        all_docs.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        )
    )
    groups = components(candidate_edges(nodes, least_percent), "a", "b")
    sized = groups.join(
        nodes.groupBy(F.col("doc_id").alias("node")).agg(F.sum("n_shingles").alias("n_shingles")),
        "node",
    )
    edges = cut_lineage(confirmed_edges(docs, cut_lineage(sized), least_percent))
    roots = cut_lineage(components(edges, "a", "b"))
    heads = cut_lineage(
        nodes.select("digest", "doc_id")
        .join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("digest", F.coalesce("root", "doc_id").alias("component_id"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        all_docs.select("doc_id", "n_shingles", "digest")
        .join(heads, "digest", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_near_dups(docs: DataFrame, least_percent: int = 85) -> DataFrame:
    """The documents without those that repeat an earlier one; the columns are those of `docs`."""
    gone = near_dups(docs, least_percent).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
