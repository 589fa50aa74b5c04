"""Ranked lexical search over whole documents with a length-stratified index.

All documents of one normaliser m form a stratum. Inside a stratum the part of a score that depends on
the document is a function of how often the term occurs in it (tf) alone, so a term's postings are
grouped by tf and that function is worked out once for each tf. The highest tf of each term bounds what
any document of the stratum can score for an item; a task visits its strata for an item in falling order
of that bound and stops below the item's floor, the score that its last place is already known to have.
Scores are whole numbers, so nothing is lost by it.

The items are taken in blocks of bounded size against all documents. Each block costs one pass over the
texts, which keeps of each document the block's terms alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalendra.llm.words import ALPHANUMERIC, Words, pieces, text_bytes
from kalendra.session import cut_lineage

PLACES = 50
#: A block of items ends before it holds more items or more terms than these; an item with more
#: terms is a block of its own.
BLOCK_ITEMS, BLOCK_TERMS = 1 << 14, 1 << 19
#: A stratum is visited in parts of at most so many documents and occurring terms; a task holds
#: parts of at most SHELF occurring terms (12 bytes each) at a time.
PART_DOCS, PART_TERMS, SHELF = 1 << 11, 1 << 19, 1 << 22
#: About so many documents, drawn by a hash, give each item its first floor. That only spares
#: visits; which documents they are does not change a result.
FLOOR_DOCS = 1 << 14
#: Merging the places of many tasks passes through so many groups of an item first.
MERGE_GROUPS = 64


def _terms(batch: pa.RecordBatch) -> Words:
    return Words(*text_bytes(batch.column("text")), ALPHANUMERIC, fold=True)


@dataclass
class Block:
    """A block of items: the sorted hashes of its terms, and for each item its terms' places in them."""

    numbers: np.ndarray
    terms: np.ndarray
    flat: np.ndarray
    first: np.ndarray


def _item_terms(batches):
    for whole in batches:
        for batch in pieces(whole, "text"):
            words = _terms(batch)
            pair = np.unique(np.stack([words.text_of().astype(np.uint64), words.hashes]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").take(pa.array(pair[0].astype(np.int64))),
                    pa.array(pair[1].astype(np.int64)),
                ],
                names=["item", "term"],
            )


def _blocks(items: DataFrame) -> Iterator[Block]:
    """The items that have a term in blocks, one block at a time on the driver."""
    held: list[tuple[int, np.ndarray]] = []
    size = 0
    for row in items.orderBy("item").toLocalIterator():
        terms = np.unique(np.array(row.terms, np.int64).astype(np.uint64))
        if held and (len(held) >= BLOCK_ITEMS or size + len(terms) > BLOCK_TERMS):
            yield _block(held)
            held, size = [], 0
        held.append((row.item, terms))
        size += len(terms)
    if held:
        yield _block(held)


def _block(held: list[tuple[int, np.ndarray]]) -> Block:
    terms = np.unique(np.concatenate([t for _, t in held]))
    flat = np.concatenate([np.searchsorted(terms, t) for _, t in held])
    first = np.concatenate([[0], np.cumsum([len(t) for _, t in held])])
    return Block(np.array([n for n, _ in held], np.int64), terms, flat, first)


def _occurrences(terms: np.ndarray):
    """Of each text the number of its terms, and which of `terms` occur how often."""

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                words = _terms(batch)
                at = np.minimum(np.searchsorted(terms, words.hashes), max(len(terms) - 1, 0))
                known = terms[at] == words.hashes if len(terms) else np.zeros(len(at), bool)
                pair, tf = np.unique(words.text_of()[known] * max(len(terms), 1) + at[known], return_counts=True)
                text, term = np.divmod(pair, max(len(terms), 1))
                cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
                spans = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(words.counts(), pa.int64()),
                        pa.array([term[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
                        pa.array([tf[a:b].astype("<i8").tobytes() for a, b in spans], pa.binary()),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return run


def _seen(n_terms: int):
    """How many documents of a batch hold each term."""

    def run(batches):
        for batch in batches:
            held = [np.frombuffer(x, "<u4") for x in batch.column("terms").to_pylist()]
            total = np.bincount(np.concatenate(held), minlength=n_terms) if held else np.zeros(0, np.int64)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["term", "n"]
            )

    return run


def _impact(tf: np.ndarray, m: int) -> np.ndarray:
    """What a term that occurs tf times adds for each unit of its weight. A text of 2 GB holds fewer
    than 2**31 terms, so the product stays inside 64 bits."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


@dataclass
class Part:
    """Documents of one m: their ids, and postings sorted by (term, tf) with the documents' places."""

    docs: np.ndarray
    no_id: np.ndarray
    terms: np.ndarray
    first: np.ndarray
    places: np.ndarray
    values: np.ndarray  # impact of each posting times the term's weight
    highest: np.ndarray  # of each term


def _part(rows: list[tuple], m: int, weights: np.ndarray) -> Part:
    terms = np.concatenate([r[1] for r in rows]).astype(np.int64)
    tfs = np.concatenate([r[2] for r in rows])
    places = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    order = np.lexsort((-tfs, terms))
    terms, tfs, places = terms[order], tfs[order], places[order]
    kinds, of_kind = np.unique(tfs, return_inverse=True)
    values = weights[terms] * _impact(kinds, m)[of_kind]
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.empty(0, np.int64)
    docs = np.array([0 if r[0] is None else r[0] for r in rows], np.int64)
    no_id = np.array([r[0] is None for r in rows])
    return Part(docs, no_id, terms[first], np.append(first, len(terms)), places, values, values[first])


class Searcher:
    """Places of each item among the documents one task has seen so far."""

    def __init__(self, block: Block, weights: np.ndarray, floors: np.ndarray, places: int):
        self.block, self.weights, self.floors, self.places = block, weights, floors.copy(), places
        self.found: list[list[np.ndarray]] = [[] for _ in block.numbers]

    def visit(self, shelf: list[Part]) -> None:
        """All parts of a shelf for all items, for each item the part of the highest bound first."""
        block, n_terms = self.block, len(self.block.terms)
        bounds = np.zeros((len(block.numbers), len(shelf)), np.int64)
        where = np.full((len(shelf), n_terms), -1, np.int32)
        for k, part in enumerate(shelf):
            where[k, part.terms] = np.arange(len(part.terms))
            highest = np.zeros(n_terms, np.int64)
            highest[part.terms] = part.highest
            bounds[:, k] = np.add.reduceat(highest[block.flat], block.first[:-1])
        for item in np.flatnonzero((bounds >= np.maximum(self.floors, 1)[:, None]).any(axis=1)):
            terms = block.flat[block.first[item] : block.first[item + 1]]
            for k in np.argsort(-bounds[item], kind="stable"):
                if bounds[item, k] < max(self.floors[item], 1):
                    break
                self._score(item, shelf[k], where[k, terms])

    def _score(self, item: int, part: Part, held: np.ndarray) -> None:
        scores = np.zeros(len(part.docs), np.int64)
        for t in held[held >= 0]:
            a, b = part.first[t], part.first[t + 1]
            scores[part.places[a:b]] += part.values[a:b]
        good = np.flatnonzero(scores >= max(self.floors[item], 1))
        if not len(good):
            return
        rows = np.stack([scores[good], part.no_id[good].astype(np.int64), part.docs[good]], axis=1)
        best = np.concatenate([*self.found[item], rows])
        if len(best) > self.places:
            best = best[np.lexsort((best[:, 2], best[:, 1], -best[:, 0]))][: self.places]
        if len(best) == self.places:
            self.floors[item] = max(self.floors[item], best[:, 0].min())
        self.found[item] = [best]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for item, number in enumerate(self.block.numbers):
            for best in self.found[item]:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(best), number)),
                        pa.array(best[:, 2], pa.int64(), mask=best[:, 1] == 1),
                        pa.array(best[:, 0], pa.int64()),
                    ],
                    names=["item", "doc_id", "score"],
                )


def _search(block: Block, weights: np.ndarray, floors: np.ndarray, places: int):
    """Rows arrive by ascending m; strata are cut into parts, and parts fill shelves."""

    def run(batches):
        searcher = Searcher(block, weights, floors, places)
        shelf, rows, m, in_part, on_shelf = [], [], None, 0, 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("m", "doc_id", "terms", "tfs"))
            for at, doc, terms, tfs in zip(*columns, strict=True):
                size = len(terms) // 4
                if rows and (at != m or len(rows) >= PART_DOCS or in_part + size > PART_TERMS):
                    shelf.append(_part(rows, m, weights))
                    on_shelf += in_part + len(block.terms) // 8
                    rows, in_part = [], 0
                    if on_shelf >= SHELF:
                        searcher.visit(shelf)
                        shelf, on_shelf = [], 0
                rows.append((doc, np.frombuffer(terms, "<u4"), np.frombuffer(tfs, "<i8")))
                m, in_part = at, in_part + size
        if rows:
            shelf.append(_part(rows, m, weights))
        if shelf:
            searcher.visit(shelf)
        yield from searcher.rows()

    return run


def _best(rows: DataFrame, places: int) -> DataFrame:
    """The `places` best rows of each item with their rank, through groups of an item first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    group = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_GROUPS))
    in_group = Window.partitionBy("item", "group").orderBy(*order)
    few = rows.withColumn("group", group).withColumn("rank", F.row_number().over(in_group))
    few = few.filter(F.col("rank") <= places).drop("group", "rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= places)


def _search_block(docs: DataFrame, block: Block, places: int) -> DataFrame:
    occurring = cut_lineage(
        docs.mapInArrow(_occurrences(block.terms), "doc_id long, n long, terms binary, tfs binary")
    )
    some = occurring.filter("n > 0")
    total = some.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_words = total.docs, total.terms or 0
    seen = np.zeros(len(block.terms), np.int64)
    counts = some.select("terms").mapInArrow(_seen(len(block.terms)), "term int, n long")
    for row in counts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        seen[row.term] = row.n
    weights = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in seen], np.int64)
    # 50 * n * N may leave 64 bits.
    share = F.expr(f"cast((cast(50 * n as decimal(38, 0)) * {n_docs}) div {max(n_words, 1)} as long)")
    held = some.filter(F.length("terms") > 0).withColumn("m", 50 + share)
    search = "item long, doc_id long, score long"
    # The row's place tells repeated rows apart, so that even they need not meet in one range.
    held = held.drop("n").withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
    sampled = F.pmod("place", F.lit(1 << 40)) < F.lit(FLOOR_DOCS * (1 << 40) // max(n_docs, 1))
    no_floors = np.zeros(len(block.numbers), np.int64)
    first = held.filter(sampled).sortWithinPartitions("m").mapInArrow(_search(block, weights, no_floors, places), search)
    lasts = _best(first, places).filter(F.col("rank") == places).select("item", "score").collect()
    floors = {r.item: r.score for r in lasts}
    floors = np.array([floors.get(int(n), 0) for n in block.numbers], np.int64)
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strata = held.repartitionByRange(ranges, "m", "place").sortWithinPartitions("m")
    return cut_lineage(_best(strata.mapInArrow(_search(block, weights, floors, places), search), places))


def ranked(docs: DataFrame, items: DataFrame, places: int = PLACES) -> DataFrame:
    """(`item_id`, `rank`, `doc_id`, `score`): for each item its `places` best documents with a score
    above 0, equal scores by ascending doc_id, null ones last.

    A null or empty text has no term: such a document counts nowhere and such an item has no row, nor
    has any item where there is no document with a term. Rows of `items` that share an item_id (null
    too) are one item with the terms of all; rows of `docs` that share a doc_id are ranked each for
    itself. Terms are told apart by 64-bit hashes. Very long texts are read whole. Of `docs` only doc_id and
    text are used, of `items` only item_id and text.
    """
    spark = docs.sparkSession
    numbers = items.select("item_id").distinct().select("item_id", F.xxhash64("item_id").alias("item"))
    texts = items.select(F.xxhash64("item_id").alias("item"), "text")
    found = texts.mapInArrow(_item_terms, "item long, term long")
    held = cut_lineage(found.groupBy("item").agg(F.collect_set("term").alias("terms")))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    result = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for block in _blocks(held):
        result = result.unionByName(_search_block(slim, block, places))
    return result.join(numbers, "item").select("item_id", "rank", "doc_id", "score")


#: The same rows in SQL.
ORACLE = r"""
    with folded as (
        select doc_id, row_number() over () as no, regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
    docs as (select doc_id, no, terms, len(terms) as n from folded where len(terms) > 0),
    total as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from docs),
    sized as (select no, any_value(doc_id) as doc_id, 50 + any_value((50 * n * n_docs) // n_terms) as m
              from docs, total group by no),
    tf as (select no, term, count(*) as tf from (select no, unnest(terms) as term from docs) group by no, term),
    weights as (select term, cast(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) as bigint) as w
                from tf, total group by term),
    wanted as (
        select distinct item_id, term from (
            select item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)),
    scored as (
        select item_id, no, any_value(doc_id) as doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
        from wanted join weights using (term) join tf using (term) join sized using (no) group by item_id, no)
    select item_id, cast(rank as integer) as rank, doc_id, score from (
        select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
        from scored where score > 0)
    where rank <= 50
"""
