"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Every pair of neighbouring words of the test items is counted over all documents, and an item's
rarest pairs are its seeds, those that occur nowhere first. How many are taken follows from the score
a copy must reach: a copy of that score has lost at most so many of the item's pairs, so one of the
seeds is left in it, whatever was changed. Phrases that many items share are frequent and are no seeds
of items that have enough words of their own. A passage meets an item where it holds one of its
seeds; it must hold as many of all its pairs as the score asks, and then a local alignment of words
scores how much of the item it holds, also where words were changed, added or left out.

Documents are read twice and never shuffled: bit tables of fixed size tell which pairs can be seeds,
and only these and the passages around them leave a task.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendra.llm.words import ALPHANUMERIC, Words, mix, pieces, text_bytes
from kalendra.session import cut_lineage

#: Words of an n-gram. A copy may have a word put in after every second one and still score half.
GRAM = 2
#: An alignment counts from so many words on, or from the whole of a shorter item.
LEAST_WORDS = 4
#: Bits of the table that is sent to all tasks: its size does not depend on the items. With more
#: n-grams than bits it lets more through, and the joins do the rest.
TABLE_BITS = 1 << 23
MATCH, MISMATCH, GAP = 1, -1, -1
#: Share of an item's greatest possible score from which a document counts as contaminated.
LEAST_SCORE = 0.5
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def _lower(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.lower("text").alias("text"))


def _words(batch: pa.RecordBatch) -> Words:
    return Words(*text_bytes(batch.column("text")), table=ALPHANUMERIC)


def needed_score(n: int, least_score: float) -> int:
    """The local score, in words, from which a copy of an item of n words counts."""
    return max(ceil(least_score * n - 1e-9), min(n, LEAST_WORDS))


def _grams(words: Words, singles: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of every n-gram that lies in one text, and of every word if `singles`."""
    h, n = words.hashes, len(words.hashes) - GRAM + 1
    grams, at = np.empty(0, np.uint64), np.empty(0, np.int64)
    if n > 0:
        fold = h[:n].copy()
        for k in range(1, GRAM):
            fold *= _FOLD
            fold += h[k : n + k]
        text = words.text_of()
        at = np.flatnonzero(text[:n] == text[GRAM - 1 :])
        grams = mix(fold[at])
    if singles:
        grams, at = np.concatenate([grams, mix(h ^ _FOLD)]), np.concatenate([at, np.arange(len(h))])
        order = np.argsort(at, kind="stable")
        grams, at = grams[order], at[order]
    return grams, at


def _short(hashes: np.ndarray) -> np.ndarray:
    """Words as 32-bit numbers, for the alignment."""
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _item_rows(batches):
    for batch in batches:
        words = _words(batch)
        grams, at = _grams(words, True)
        single = np.isin(grams, mix(words.hashes ^ _FOLD))
        counts, cuts = words.counts(), np.searchsorted(at, words.first)
        tokens = _short(words.hashes)
        found = []
        for i in range(batch.num_rows):
            own = slice(cuts[i], cuts[i + 1])
            found.append(np.unique(grams[own][single[own] == (counts[i] < GRAM)].view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(
                    [tokens[words.first[i] : words.first[i + 1]] for i in range(batch.num_rows)],
                    pa.list_(pa.int32()),
                ),
                pa.array(found, pa.list_(pa.int64())),
            ],
            names=["id", "words", "grams"],
        )


def items_of(benchmark: DataFrame) -> DataFrame:
    """(`item_id`, `words`, `grams`) of the items that have a word; that word is the n-gram of an item
    which has no other. Rows that share an item_id are items of their own."""
    return (
        _lower(benchmark, "item_id")
        .mapInArrow(_item_rows, "id long, words array<int>, grams array<long>")
        .filter(F.size("grams") > 0)
        .select(F.monotonically_increasing_id().alias("item"), F.col("id").alias("item_id"), "words", "grams")
    )


def _bit_table(grams: DataFrame) -> np.ndarray:
    """The bit table of a column `gram`, gathered as at most TABLE_BITS / 64 numbers."""
    place = F.shiftrightunsigned("gram", 41)
    rows = (
        grams.select((place / 64).cast("int").alias("at"), (place % 64).cast("int").alias("bit"))
        .distinct()
        .groupBy("at")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .collect()
    )
    table = np.zeros(TABLE_BITS // 64, np.uint64)
    for row in rows:
        table[row["at"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return table


def _possible(grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    place = grams >> np.uint64(41)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _count(table: np.ndarray, singles: bool):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                words = _words(batch)
                grams, at = _grams(words, singles)
                hit = _possible(grams, table)
                owner = words.text_of()[at[hit]].astype(np.uint64)
                once = np.unique(np.stack([owner, grams[hit]], axis=1), axis=0)
                found, n = np.unique(once[:, 1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["gram", "n"]
                )

    return run


def _most_lost(n: Column, least_score: float) -> Column:
    """How many n-grams of an item of n words a copy that counts can have lost: a word changed or left
    out costs two of them and two of the score, a word put in one and one, a word cut off one and one."""
    needed = F.greatest(F.ceil(least_score * n - 1e-9), F.least(n, F.lit(LEAST_WORDS)))
    return n - needed


def seeds_of(items: DataFrame, docs: DataFrame, singles: bool, least_score: float) -> DataFrame:
    """(`gram`, `item`, `n_words`): of each item one n-gram more than a copy can have lost, the rarest
    ones by the number of documents that hold them; those of them that occur."""
    grams = cut_lineage(
        items.select("item", F.size("words").alias("n_words"), F.explode("grams").alias("gram"))
    )
    table = _bit_table(grams.select("gram"))
    seen = docs.mapInArrow(_count(table, singles), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counted = grams.join(seen, "gram", "left").fillna(0, ["n"])
    # An item's n-grams fit in a row, so a window over them is small.
    rank = F.row_number().over(Window.partitionBy("item").orderBy("n", "gram"))
    return (
        counted.withColumn("rank", rank)
        .filter(F.col("rank") <= _most_lost(F.col("n_words"), least_score) + 1)
        .filter("n > 0")
        .select("gram", "item", "n_words")
    )


def _reach_class(n_words: Column) -> Column:
    """Items of about one length are looked for together."""
    return F.ceil(F.log2(n_words)).cast("int")


def _tables(seeds: DataFrame) -> list[tuple[int, int, np.ndarray]]:
    """(class, words to either side of a seed, bit table) of each class of items; at most 32."""
    lengths = seeds.groupBy("class").agg(F.max("n_words").alias("n")).collect()
    out = []
    for row in sorted(lengths, key=lambda r: r["class"]):
        own = seeds.filter(F.col("class") == row["class"])
        # An item of n words whose copy scores half has at most n / 2 words put in.
        out.append((row["class"], row.n + row.n // 2 + 1, _bit_table(own.select("gram"))))
    return out


def _passages(tables: list[tuple[int, int, np.ndarray]], singles: bool):
    """Passages around possible seeds: as many words to either side as the class of items asks, merged
    where they meet."""
    whole_table = np.bitwise_or.reduce([t for _, _, t in tables]) if tables else np.zeros(TABLE_BITS // 64, np.uint64)

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                words = _words(batch)
                every, places = _grams(words, singles)
                hit = _possible(every, whole_table)
                every, places = every[hit], places[hit]
                if not len(places):
                    continue
                tokens, ids = _short(words.hashes), batch.column("id")
                text_of = words.text_of()
                doc, kind, first, seeds, passage = [], [], [], [], []
                for number, reach, table in tables:
                    hit = _possible(every, table)
                    grams, at = every[hit].view(np.int64), places[hit]
                    if not len(at):
                        continue
                    owner = text_of[at]
                    apart = (np.diff(at) > 2 * reach) | (np.diff(owner) != 0)
                    starts = np.flatnonzero(np.concatenate([[True], apart]))
                    stops = np.append(starts[1:], len(at))
                    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                        text = int(owner[a])
                        low = max(int(words.first[text]), int(at[a]) - reach)
                        high = min(int(words.first[text + 1]), int(at[b - 1]) + GRAM + reach)
                        doc.append(text)
                        kind.append(number)
                        first.append(low - int(words.first[text]))
                        seeds.append(np.unique(grams[a:b]))
                        passage.append(tokens[low:high])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(doc, pa.int64())),
                        pa.array(kind, pa.int32()),
                        pa.array(first, pa.int64()),
                        pa.array(seeds, pa.list_(pa.int64())),
                        pa.array(passage, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "class", "first_word", "seeds", "passage"],
                )

    return run


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """(best local score, place in the passage where it ends). A row of the table at a time; gaps
    along the row follow from a running maximum."""
    n = len(passage)
    ramp = np.arange(n + 1) * GAP
    above, best, end = np.zeros(n + 1, np.int64), 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        row = np.zeros(n + 1, np.int64)
        row[1:] = np.maximum(0, np.maximum(above[:-1] + step, above[1:] + GAP))
        row = np.maximum.accumulate(row - ramp) + ramp
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, cuts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _word_pairs(tokens: np.ndarray) -> np.ndarray:
    wide = tokens.astype(np.int64)
    return np.unique((wide[:-1] << 32) | (wide[1:] & 0xFFFFFFFF))


def _scores(least_score: float):
    """The pairs of an item and a passage that reach the item's score."""

    def run(batches):
        for batch in batches:
            kept, best, ends, size = [], [], [], []
            items, passages = _lists(batch.column("words")), _lists(batch.column("passage"))
            for k, (item, passage) in enumerate(zip(items, passages, strict=True)):
                needed = needed_score(len(item), least_score)
                own = _word_pairs(item)
                shared = np.isin(own, _word_pairs(passage), assume_unique=True).sum()
                if shared < len(own) - (len(item) - needed):
                    continue  # too little is left of the item
                score, end = align(item, passage)
                if score >= needed * MATCH:
                    kept.append(k)
                    best.append(score)
                    ends.append(end)
                    size.append(len(item))
            some = pa.array(kept, pa.int64())
            first = batch.column("first_word").take(some).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(some),
                    batch.column("item_id").take(some),
                    pa.array(np.array(best, float) / (np.array(size, float) * MATCH), pa.float64()),
                    pa.array(first + np.array(ends, np.int64), pa.int64()),
                ],
                names=["doc_id", "item_id", "score", "end_word"],
            )

    return run


def candidates(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """(`doc_id`, `item_id`, `first_word`, `words`, `passage`): the passages of documents that hold a
    seed of an item, each with that item, and the words of both as numbers."""
    known = _lower(docs, "doc_id").filter(F.col("id").isNotNull() & F.col("text").isNotNull())
    items = cut_lineage(items_of(benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())))
    singles = not items.filter(F.size("words") < GRAM).isEmpty()
    seeds = seeds_of(items, known, singles, least_score)
    seeds = cut_lineage(seeds.withColumn("class", _reach_class(F.col("n_words"))))
    found = known.mapInArrow(
        _passages(_tables(seeds), singles),
        "doc_id long, class int, first_word long, seeds array<long>, passage array<int>",
    )
    passages = cut_lineage(found.withColumn("place", F.monotonically_increasing_id()))
    met = (
        passages.select("place", "class", F.explode("seeds").alias("gram"))
        .join(seeds.select("gram", "class", "item"), ["gram", "class"])
        .select("place", "item")
        .distinct()
    )
    return (
        met.join(passages.select("place", "doc_id", "first_word", "passage"), "place")
        .join(items.select("item", "item_id", "words"), "item")
        .select("doc_id", "item_id", "first_word", "words", "passage")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """(`doc_id`, `item_id`, `score`, `end_word`): documents that hold an item, or an edited copy
    of one, each pair once with its best score and, of the passages with that score, the last place
    where one ends in the document.

    Words are runs of letters and digits, in lower case. No copy of a score from `least_score` on is
    missed; the score must also come to LEAST_WORDS words, so an item of fewer words must stand there
    whole. A null or empty text holds nothing and is no item, and a row without doc_id or item_id takes
    no part. Rows that share a doc_id are read each for itself and give one row for each item; so do
    repeated items. Very long texts are read whole; only passages of them travel. Where a table is empty
    the result is. Other columns of either table are ignored.
    """
    scored = candidates(docs, benchmark, least_score).mapInArrow(
        _scores(least_score), "doc_id long, item_id long, score double, end_word long"
    )
    return (
        scored.groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("score", "end_word")).alias("best"))
        .select("doc_id", "item_id", "best.score", "best.end_word")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE
) -> DataFrame:
    """The documents that hold no item; the columns are those of `docs`. A row goes by its text, so
    also where its doc_id is null or is another row's, too."""
    key = "_text_key"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.xxhash64(F.lower("text")))
    slim = keyed.select(F.col(key).alias("doc_id"), "text")
    found = contaminated(slim, benchmark, least_score).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(found, key, "left_anti").select(*docs.columns)
