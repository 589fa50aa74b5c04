"""Quality classifier: histogram gradient-boosted trees over statistics of a document's text.

Every text is read once and whole, and becomes a fixed number of statistics. The trees are learned from
a bounded sample of labelled documents, whose statistics are sorted into at most 64 bins each, so that
a split is chosen from sums over bins. All trees are kept in three arrays (statistic, threshold, value
of each place of a full binary tree), and a batch of documents goes down all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendra.llm.words import Words, pieces, shingles, text_bytes
from kalendra.session import cut_lineage

#: Labelled documents of each label that the trees are learned from, at most: those of the smallest
#: hashes, repeated rows counted once and weighted, so that each label keeps its share among all
#: labelled documents.
SAMPLE_PER_LABEL = 8192
TREES, DEPTH, BINS = 60, 4, 64
RATE, RIDGE, LEAST_WEIGHT = 0.2, 1.0, 1.0
#: Score of every document where nothing could be learned.
UNKNOWN_SCORE = 0.5


def _bytes_of(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


def _set_of(letters: str) -> np.ndarray:
    return _bytes_of(*((ord(c), ord(c)) for c in letters))


UPPER, LOWER, DIGIT = _bytes_of((65, 90)), _bytes_of((97, 122)), _bytes_of((48, 57))
#: Shares of a text's bytes that are statistics.
CLASSES = {
    "upper": UPPER,
    "digit": DIGIT,
    "beyond_ascii": _bytes_of((128, 255)),
    "space": _bytes_of((9, 13), (32, 32)),
    "control": _bytes_of((0, 8), (14, 31), (127, 127)),
    "stops": _set_of(".?!"),
    "exclamations": _set_of("!?"),
    "commas": _set_of(",;:"),
    "brackets": _set_of("()[]{}<>"),
    "symbols": _set_of("#*$%&|<>=+~^_@/\\"),
    "bars": _set_of("|"),
    "quotes": _set_of("\"'`"),
}
STATISTICS = [
    *CLASSES, "log_bytes", "log_words", "log_lines", "word_bytes", "word_bytes_spread", "longest_word",
    "words_a_line", "distinct_words", "commonest_word", "repeated_shingles", "letterless_words",
    "capital_words", "short_words", "words_ending_in_letter", "lines_ending_in_stop", "repeated_lines",
    "blank_lines", "same_as_next_byte", "byte_entropy",
]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the flags of each span between offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each owner how many distinct hashes it has, and how often the commonest occurs."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])])) if len(o) else []
    runs = np.diff(np.append(new, len(o))).astype(np.int64)
    distinct, most = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if len(runs):
        at = o[new]
        np.add.at(distinct, at, 1)
        np.maximum.at(most, at, runs)
    return distinct, most


def _entropy(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if b > a:
            p = np.bincount(data[a:b], minlength=256) / (b - a)
            p = p[p > 0]
            out[i] = -(p * np.log2(p)).sum()
    return out


NEWLINE = ~_bytes_of((10, 10))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text."""
    n, size = len(offsets) - 1, np.diff(offsets).astype(float)
    words, lines = Words(data, offsets), Words(data, offsets, NEWLINE)
    count, n_lines = words.counts().astype(float), lines.counts().astype(float)
    owner, length = words.text_of(), (words.ends - words.starts).astype(float)
    letters = np.concatenate([[0], np.cumsum(UPPER[data] | LOWER[data] | (data >= 128))])
    lows = np.concatenate([[0], np.cumsum(LOWER[data])])
    lettered = letters[words.ends] > letters[words.starts]
    last = data[words.ends - 1] if len(length) else data[:0]
    in_letter = UPPER[last] | LOWER[last] | (last >= 128)
    capital = lettered & (lows[words.ends] == lows[words.starts]) & (length > 1)
    spread = _sums(length**2, words.first) / np.maximum(count, 1) - _share(_sums(length, words.first), count) ** 2
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    kinds, most = _distinct(owner, words.hashes, n)
    grams, gram_owner = shingles(words)
    gram_kinds, _ = _distinct(gram_owner, grams, n)
    n_grams = np.bincount(gram_owner, minlength=n)
    line_kinds, _ = _distinct(lines.text_of(), lines.hashes, n)
    line_last = data[lines.ends - 1] if len(lines.ends) else data[:0]
    same = np.zeros(len(data), bool)
    same[:-1] = data[1:] == data[:-1]
    same[offsets[1:][size > 0] - 1] = False  # a text's last byte has no next one
    breaks = _sums(data == 10, offsets)
    columns = [_share(_sums(table[data], offsets), size) for table in CLASSES.values()]
    columns += [
        np.log1p(size), np.log1p(count), np.log1p(n_lines), _share(_sums(length, words.first), count),
        np.sqrt(np.maximum(spread, 0)), np.log1p(longest), _share(count, n_lines), _share(kinds, count),
        _share(most, count), 1 - _share(gram_kinds, n_grams), _share(_sums(~lettered, words.first), count),
        _share(_sums(capital, words.first), count), _share(_sums(length <= 3, words.first), count),
        _share(_sums(in_letter, words.first), count),
        _share(_sums(_set_of(".?!\"'")[line_last], lines.first), n_lines), 1 - _share(line_kinds, n_lines),
        _share(np.maximum(breaks + 1 - n_lines, 0), breaks + 1), _share(_sums(same, offsets), size),
        _entropy(data, offsets),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class Trees:
    """`feature`, `threshold` (of each inner place) and `value` (of each leaf) of full binary trees,
    a row each; a document goes right where its statistic is above the threshold."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each row, all trees at once."""
        n, trees = len(x), np.arange(len(self.feature))
        at = np.zeros((n, len(trees)), np.int64)
        rows = np.arange(n)[:, None]
        for _ in range(DEPTH):
            up = x[rows, self.feature[trees, at]] > self.threshold[trees, at]
            at = 2 * at + 1 + up
        margin = self.base + self.value[trees, at - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def _edges(column: np.ndarray) -> np.ndarray:
    """Up to BINS - 1 thresholds between values of a statistic."""
    quantiles = np.quantile(column, np.arange(1, BINS) / BINS, method="lower")
    edges = np.unique(quantiles.astype(np.float32))
    return edges[edges < column.max()]


def learn(x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Trees:
    """Boosted trees by Newton steps on the logistic loss; a place whose split gains nothing sends
    every document to the left."""
    n, width = x.shape
    edges = [_edges(x[:, f]) for f in range(width)]
    bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature = np.zeros((TREES, inner), np.int64)
    threshold = np.full((TREES, inner), np.inf, np.float32)
    value = np.zeros((TREES, leaves))
    mean = (weights * labels).sum() / weights.sum()
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(n, base)
    slot = np.arange(width) * BINS
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = weights * (p - labels), weights * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            cells = ((at - first) * (width * BINS))[:, None] + slot + bins
            sums = [
                np.bincount(cells.ravel(), np.repeat(v, width), nodes * width * BINS)
                .reshape(nodes, width, BINS).cumsum(axis=2)
                for v in (g, h)
            ]
            whole_g, whole_h = sums[0][:, :1, -1:], sums[1][:, :1, -1:]
            right_g, right_h = whole_g - sums[0], whole_h - sums[1]
            gain = sums[0] ** 2 / (sums[1] + RIDGE) + right_g**2 / (right_h + RIDGE)
            gain = gain - whole_g**2 / (whole_h + RIDGE)
            gain[(sums[1] < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = -np.inf
            best = gain.reshape(nodes, -1).argmax(axis=1)
            f, b = np.divmod(best, BINS)
            good = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            for k in np.flatnonzero(good):
                feature[t, first + k] = f[k]
                threshold[t, first + k] = edges[f[k]][b[k]]
            up = good[at - first] & (bins[np.arange(n), f[at - first]] > b[at - first])
            at = 2 * at + 1 + up
        leaf = at - inner
        steps = np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        value[t] = -RATE * steps
        margin += value[t][leaf]
    return Trees(base, feature, threshold, value)


def held_out(doc_id: Column) -> Column:
    """Documents of one remainder in three take no part in learning; a null number has no remainder
    and no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _measured(batches):
    for whole in batches:
        for batch in pieces(whole, "text", 1 << 20):
            x = statistics(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["doc_id", "x"],
            )


def measured(docs: DataFrame) -> DataFrame:
    """(`doc_id`, `x`): the statistics of each whole text; a null text is an empty one."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(_measured, "doc_id long, x binary")


def train(found: DataFrame, labels: DataFrame, may_learn: Column) -> Trees | None:
    """Trees from the statistics of documents that have a label and may be learned from; None where
    one of the two labels is missing. A document labelled more than once has the label it has more
    often, 1 if both as often."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.avg(F.when(F.col("quality") != 0, 1.0).otherwise(0.0)) >= 0.5).alias("good")
    )
    # Stored, so that the rows of a frequent doc_id can be split in the join.
    labelled = cut_lineage(
        found.filter(may_learn)
        .join(cut_lineage(known), "doc_id")
        .select("good", "x", F.xxhash64("doc_id", "x").alias("turn"))
    )
    counts = labelled.groupBy("good").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("turn").alias("different")
    )
    counts = {r.good: r for r in counts.collect()}
    if len(counts) < 2:
        return None
    x, y, w = [], [], []
    for good, count in sorted(counts.items()):
        # About twice as many as wanted pass the bound on the hash, and repeated rows are counted.
        bound = min(1 << 40, 2 * SAMPLE_PER_LABEL * (1 << 40) // max(count.different, 1))
        few = labelled.filter((F.col("good") == good) & (F.pmod("turn", F.lit(1 << 40)) < bound))
        few = few.groupBy("turn", "x").agg(F.count(F.lit(1)).alias("n"))
        some = few.orderBy(F.pmod("turn", F.lit(1 << 40)), "turn", "x").limit(SAMPLE_PER_LABEL).collect()
        if not some:
            return None
        times = np.array([r.n for r in some], float)
        x += [np.frombuffer(bytes(r.x), np.float32) for r in some]
        y += [float(good)] * len(some)
        w.append(times * (count.n / times.sum()))
    weights = np.concatenate(w)
    return learn(np.stack(x), np.array(y), weights * (len(weights) / weights.sum()))


def _scored(trees: Trees | None):
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if trees is None:
                score = np.full(batch.num_rows, UNKNOWN_SCORE)
            else:
                x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32)
                score = trees.scores(x.reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"]
            )

    return run


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(`doc_id`, `held_out`, `score`, `predicted`): learn from the labelled documents that are not
    held out and score all.

    `score` depends on the text alone; a null text counts as an empty one, and both get the score that
    the trees give to a text without words. Rows that share a doc_id each get a row, and all of them
    have its label; a null doc_id is neither held out nor learned from. Where `labels` has not both
    labels every score is 0.5. An empty table gives an empty result. Very long texts are read whole, in
    segments. Of `docs` only doc_id and text are used, of `labels` only doc_id and quality.
    """
    found = cut_lineage(measured(docs))
    out = held_out(F.col("doc_id"))
    trees = train(found, labels.select("doc_id", "quality"), ~out)
    scored = found.mapInArrow(_scored(trees), "doc_id long, score double")
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
