"""Line dedup by a deletion-neighbourhood join.

Lines are compared as sequences of words, with an edit bound of one word changed, added or left out.
A line's variants are itself and the line without each one of its words. Two lines of one length are
within the bound where they agree without the word at the same place; two lines whose lengths differ
by one are where the shorter equals the longer without some word. Variants travel as hashed keys,
each key is reduced to its earliest line, so no pairs within a key are formed, and the link that a
line ends with is verified on its words.

Equal lines are one line first. And since one edit leaves at least one half of a line as it is, only
lines that share a half with another line give out variants; the others have nobody to meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendra.llm.words import Words, mix, pieces, text_bytes
from kalendra.session import cut_lineage

#: Lines of fewer words are only compared as a whole, unless a caller asks for less: one word of so few
#: is more than an edit.
LEAST_WORDS = 5
_BASE = np.uint64(0xC6A4A7935BD1E995)
_INVERSE = np.uint64(pow(0xC6A4A7935BD1E995, -1, 1 << 64))


class Lines:
    """The lines of a batch that have a word, with hashes of any stretch of their words."""

    def __init__(self, column):
        data, offsets = text_bytes(column)
        words = Words(data, offsets)
        breaks = np.flatnonzero(data == 0x0A)
        text = words.text_of()
        line = np.searchsorted(breaks, words.starts)
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(line)) if len(line) else self.first
        self.text = text[self.first]
        self.number = line[self.first] - np.searchsorted(breaks, offsets[self.text])
        n = len(line)
        up, down = np.full(n + 1, _BASE), np.full(n + 1, _INVERSE)
        up[0] = down[0] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words.hashes * np.multiply.accumulate(up)[:n], out=self.sums[1:])
        self.words = words.hashes
        self.data, self.starts, self.ends = data, words.starts, words.ends

    def stretch(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words from a to b, wherever they stand."""
        return (self.sums[b] - self.sums[a]) * self.down[a]

    def line(self, i: int) -> bytes:
        """Line i from its first word to its last."""
        return self.data[self.starts[self.first[i]] : self.ends[self.last[i] - 1]].tobytes()

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each line; both agree only for equal lines."""
        h = self.stretch(self.first, self.last)
        n = (self.last - self.first).astype(np.uint64)
        second = mix(self.words ^ _BASE)
        if not len(h):
            return h, h
        place = np.arange(len(second)) - np.repeat(self.first, self.last - self.first)
        factors = mix(place.astype(np.uint64)) | np.uint64(1)
        return mix(h + n), np.add.reduceat(second * factors, self.first)


def _half_keys(lines: Lines) -> np.ndarray:
    """For each line the hashes of its beginning and end that a line of its own length shares, and
    those that a line shorter by one word shares."""
    n = lines.last - lines.first
    keys = []
    for base in (n, n - 1):
        half = np.maximum((base - 1) // 2, 0)
        salt = mix(base.astype(np.uint64))
        for side, (a, b) in enumerate(
            ((lines.first, lines.first + half), (lines.last - half, lines.last))
        ):
            keys.append(mix(lines.stretch(a, b) ^ salt) + np.uint64(side))
    return np.stack(keys, axis=1)


def _line_rows(batches):
    for whole in batches:
        for batch in pieces(whole, "text"):
            lines = Lines(batch.column("text"))
            a, b = lines.whole()
            keys = _half_keys(lines).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()).take(pa.array(lines.text)),
                    pa.array(lines.number, pa.int64()),
                    pa.array(lines.last - lines.first, pa.int64()),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    *[pa.array(keys[:, k]) for k in range(4)],
                ],
                names=["doc_id", "line_no", "n_words", "a", "b", "k0", "k1", "k2", "k3"],
            )


_LINE = "doc_id long, line_no long, n_words long, a long, b long"
_KEYS = "k0 long, k1 long, k2 long, k3 long"


def _first_lines(lines: DataFrame) -> DataFrame:
    """The earliest of each set of equal lines, and whether there are `more`."""
    place = F.struct("doc_id", "line_no", "n_words", "k0", "k1", "k2", "k3")
    found = lines.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    return found.select("a", "b", "first.*", (F.col("n") > 1).alias("more"))


def _with_partner(firsts: DataFrame, least_words: int) -> DataFrame:
    """(`doc_id`, `line_no`, `a`, `same`, `other`): lines that share a half with another line of
    their length (`same`) or of a length that differs by one (`other`)."""
    own = [F.struct(F.col(k).alias("key"), F.lit(0).alias("longer")) for k in ("k0", "k1")]
    shorter = [F.struct(F.col(k).alias("key"), F.lit(1).alias("longer")) for k in ("k2", "k3")]
    of_shorter = F.when(F.col("n_words") > least_words, F.array(*shorter)).otherwise(
        F.array().cast("array<struct<key:long,longer:int>>")
    )
    keyed = firsts.filter(F.col("n_words") >= least_words).select(
        "doc_id", "line_no", "a", F.inline(F.concat(F.array(*own), of_shorter))
    )
    equal = F.sum(F.lit(1) - F.col("longer"))
    met = cut_lineage(
        keyed.groupBy("key")
        .agg(equal.alias("n0"), F.sum("longer").alias("n1"))
        .filter((F.col("n0") > 1) | ((F.col("n0") > 0) & (F.col("n1") > 0)))
    )
    return (
        keyed.join(met.hint("merge"), "key")  # what grows with the input is never broadcast
        .groupBy("doc_id", "line_no", "a")
        .agg(
            F.max((F.col("longer") == 0) & (F.col("n0") > 1)).alias("same"),
            F.max(F.when(F.col("longer") == 0, F.col("n1")).otherwise(F.col("n0")) > 0).alias("other"),
        )
        .filter("same or other")
    )


_SAME, _FULL, _LESS, _LINE_ITSELF = 0, 1, 2, 3
_VARIANT = "key long, kind int, doc_id long, line_no long, line string, b long"


def _variant_rows(batches):
    """Keys of the wanted lines: without each word and its place; whole; without each word. And each such
    line itself, with `a` (as its key) and `b`, so that neither its text nor these are fetched again."""
    for whole in batches:
        for batch in pieces(whole, "text", 1 << 20):
            lines = Lines(batch.column("text"))
            signed, second = (h.view(np.int64) for h in lines.whole())
            wanted = [{w["a"]: w for w in ws} for ws in batch.column("wanted").to_pylist()]
            ids = batch.column("doc_id").to_pylist()
            keys, kinds, docs, numbers, sizes, held, at_line = [], [], [], [], [], [], []
            for i, (text, number) in enumerate(zip(lines.text.tolist(), lines.number.tolist())):
                w = wanted[text].get(int(signed[i]))
                if w is None or w["line_no"] != number:
                    continue
                first, last = int(lines.first[i]), int(lines.last[i])
                n = last - first
                at = np.arange(first, last)
                before = lines.stretch(np.full(n, first), at)
                after = lines.stretch(at + 1, np.full(n, last))
                power = np.full(n, _BASE)
                power[:1] = 1
                less = mix((before + after * np.multiply.accumulate(power)) + np.uint64(n - 1))
                if w["same"]:
                    keys.append(mix(less ^ (at - first + 1).astype(np.uint64)))
                    kinds.append(np.full(n, _SAME))
                if w["other"]:
                    keys += [signed[i : i + 1].view(np.uint64), less]
                    kinds += [np.full(1, _FULL), np.full(n, _LESS)]
                docs.append(ids[text])
                numbers.append(number)
                sizes.append(n * w["same"] + (n + 1) * w["other"])
                held.append(lines.line(i))
                at_line.append(i)
            if keys:
                n = sum(sizes)
                keys.append(signed[at_line].view(np.uint64))
                kinds.append(np.full(len(held), _LINE_ITSELF))
                of = np.array(docs, np.int64), np.array(numbers, np.int64)
                line = pa.array(held, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(np.concatenate(kinds), pa.int32()),
                        *[pa.array(np.concatenate([np.repeat(x, sizes), x])) for x in of],
                        pa.concat_arrays([pa.nulls(n, pa.string()), line]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(second[at_line])]),
                    ],
                    names=["key", "kind", "doc_id", "line_no", "line", "b"],
                )


def _wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the documents that hold wanted lines, each with its list of them."""
    lists = wanted.groupBy("doc_id").agg(
        F.collect_list(F.struct("line_no", "a", "same", "other")).alias("wanted")
    )
    # Texts are dealt out once whatever the size of the lists, so what a run writes grows with its input.
    return docs.select("doc_id", "text").join(lists.hint("merge"), "doc_id")


def _links(variants: DataFrame) -> DataFrame:
    """(`doc_id`, `line_no`, `near`): each line with the earliest line that one of its keys names."""
    place = F.struct("doc_id", "line_no")
    same = F.col("kind") == _SAME
    family = F.when(same, F.lit(0)).otherwise(F.lit(1)).alias("family")
    rows = variants.select("key", family, "kind", place.alias("place"))
    least = cut_lineage(
        rows.groupBy("key", "family").agg(
            F.min(F.when(F.col("kind") != _LESS, F.col("place"))).alias("whole"),
            F.min(F.when(F.col("kind") != _FULL, F.col("place"))).alias("less"),
            F.count(F.lit(1)).alias("n"),
        ).filter("n > 1")
    )
    near = F.when(F.col("kind") == _FULL, F.col("less")).otherwise(F.col("whole"))
    return (
        rows.join(least.hint("merge"), ["key", "family"])
        .select("place", near.alias("near"))
        .filter(F.col("near") < F.col("place"))
        .groupBy("place")
        .agg(F.min("near").alias("near"))
        .select("place.*", "near")
    )


def within_one(a: Column, b: Column) -> Column:
    """Whether two arrays differ by one element changed, added or left out at most."""
    shorter = F.least(F.size(a), F.size(b))
    places = F.sequence(F.lit(0), shorter)
    split = F.aggregate(
        places,
        F.lit(0),
        lambda n, i: F.when((n == i) & (i < shorter) & (F.get(a, i) == F.get(b, i)), n + 1).otherwise(n),
    )
    rest_a, rest_b = F.size(a) - split, F.size(b) - split
    tail = F.least(rest_a, rest_b) - F.when(rest_a == rest_b, 1).otherwise(0)
    end_a, end_b = F.slice(a, F.size(a) - tail + 1, tail), F.slice(b, F.size(b) - tail + 1, tail)
    return (a == b) | ((F.abs(F.size(a) - F.size(b)) <= 1) & ((tail <= 0) | (end_a == end_b)))


def _verified(lines: DataFrame, links: DataFrame) -> DataFrame:
    """Links whose lines (`doc_id`, `line_no`, `line`) are within one edit on their words."""
    ends = links.select("doc_id", "line_no").unionByName(links.select("near.doc_id", "near.line_no"))
    lines = lines.join(ends.distinct(), ["doc_id", "line_no"], "left_semi")
    words = F.filter(F.split("line", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    texts = cut_lineage(lines.select("doc_id", "line_no", words.alias("words")).distinct())
    left = texts.select("doc_id", "line_no", F.col("words").alias("left"))
    right = texts.select(F.struct("doc_id", "line_no").alias("near"), F.col("words").alias("right"))
    return (
        links.join(left, ["doc_id", "line_no"])
        .join(right, "near")
        .filter(within_one(F.col("left"), F.col("right")))
        .select("doc_id", "line_no", "near")
        .distinct()
    )


def repeated_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(`doc_id`, `line_no`, `like_doc_id`, `like_line_no`, `edits`): every line that is within one
    edit of an earlier line, with the earliest such line; `edits` is 0 for an equal one.

    Lines end at line feeds and count from 0; words stand between ASCII white space, and a line
    without words is no line. Order is by doc_id, then by line. A line of fewer than `least_words`
    words is only matched by an equal one. Texts of any length are read whole, and a text's lines are
    compared wherever they are many. An empty table has no lines. A null text has no lines, rows without doc_id take no
    part, and rows that share a doc_id count as one document. Other columns are ignored.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    )
    lines = cut_lineage(known.mapInArrow(_line_rows, f"{_LINE}, {_KEYS}"))
    firsts = cut_lineage(_first_lines(lines))
    wanted = cut_lineage(_with_partner(firsts, least_words))
    given = cut_lineage(_wanted_texts(known, wanted).mapInArrow(_variant_rows, _VARIANT))
    itself = F.col("kind") == _LINE_ITSELF
    held = given.filter(itself).select("doc_id", "line_no", "line")
    near = _verified(held, cut_lineage(_links(given.filter(~itself).drop("line", "b"))))
    place = F.struct("doc_id", "line_no").alias("equal")
    hashes = given.filter(itself).select("doc_id", "line_no", F.col("key").alias("a"), "b")
    # Only lines that have an equal or a near one are looked up by the others.
    targets = cut_lineage(
        firsts.filter("more").select("a", "b", place, F.lit(None).cast("struct<doc_id:long,line_no:long>").alias("near"))
        .unionByName(near.join(hashes, ["doc_id", "line_no"]).select("a", "b", place, "near"))
        .groupBy("a", "b").agg(F.min("equal").alias("equal"), F.min("near").alias("near"))
    )
    like = F.least("equal", "near")  # the null of a line without near lines is passed over
    return (
        lines.select("a", "b", "doc_id", "line_no")
        .join(targets, ["a", "b"])
        .select("doc_id", "line_no", like.alias("like"), (like < F.col("equal")).cast("int").alias("edits"))
        .filter(F.col("like") < F.struct("doc_id", "line_no"))
        .select(
            "doc_id", "line_no", F.col("like.doc_id").alias("like_doc_id"),
            F.col("like.line_no").alias("like_line_no"), "edits",
        )
        .distinct()
    )


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """`docs` with the repeated lines taken out of their texts."""
    gone = repeated_lines(docs, least_words).groupBy("doc_id").agg(F.collect_set("line_no").alias("__gone"))
    kept = F.filter(
        F.split("text", "\n", -1), lambda line, i: ~F.array_contains("__gone", i.cast("long"))
    )
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return docs.join(gone, "doc_id", "left").withColumn("text", text).select(*docs.columns)
