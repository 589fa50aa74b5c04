"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character n-grams of one to three code points are hashed to a fixed number of features. Document
frequencies are counted over all training documents. The weights come from follow-the-regularised-
leader steps with elastic-net penalties on a bounded sample of labelled documents, and a temperature
found on documents that the steps did not use turns scores into probabilities. Every text is used
whole, in counting and in prediction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendra.llm.words import pieces, text_bytes
from kalendra.session import cut_lineage

FEATURES = 1 << 15
ORDERS = (1, 2, 3)
#: Labelled documents of each language that the weights are learned from, at most, and languages.
#: These bound what the driver holds, with MOST_SAMPLED for all languages together; the counts of
#: documents cover all of them.
SAMPLE_PER_LANGUAGE, MOST_LANGUAGES, MOST_SAMPLED = 600, 256, 1 << 14
#: Of five sampled documents one is kept for the temperature.
CALIBRATION_FOLDS = 5
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
UNKNOWN = "und"
LETTER = r"\p{L}"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features + 1 (a constant) by languages
    temperature: float


def _points(text_data: np.ndarray, offsets: np.ndarray):
    """(lower-case code points, owner's first place) of a batch of texts."""
    whole = text_data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
    lead = (text_data & 0xC0) != 0x80
    first = np.concatenate([[0], np.cumsum(lead)])[offsets]
    points = np.where((points >= 65) & (points <= 90), points + 32, points)
    high = (points >= 0xC0) & (points <= 0xDE) & (points != 0xD7)
    return np.where(high, points + 32, points).astype(np.uint32), first


def features(data: np.ndarray, offsets: np.ndarray):
    """For each text (sorted features, how often each occurs)."""
    points, first = _points(data, offsets)
    grams = []
    for size in ORDERS:
        h = np.full(len(points), np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF))
        for k in range(size):
            h[: len(points) - k] = (h[: len(points) - k] ^ points[k:]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        grams.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(17))
    out = []
    for i in range(len(offsets) - 1):
        a, b = int(first[i]), int(first[i + 1])
        counts = np.zeros(FEATURES, np.int64)
        for size, h in zip(ORDERS, grams, strict=True):
            if b - a >= size:
                counts += np.bincount(h[a : b - size + 1], minlength=FEATURES)
        at = np.flatnonzero(counts)
        out.append((at, counts[at]))
    return out


def _vector(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def _seen(batches):
    """How many documents of each batch hold each feature, and how many documents there are."""
    for whole in batches:
        total = np.zeros(FEATURES + 1, np.int64)
        for batch in pieces(whole, "text", 1 << 20):
            for at, _ in features(*text_bytes(batch.column("text"))):
                total[at] += 1
                total[FEATURES] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["feature", "n"]
        )


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each feature, over all given texts. The table that
    reaches the driver has one row per feature at most, whatever the number of texts."""
    counted = texts.select("text").mapInArrow(_seen, "feature int, n long")
    rows = counted.groupBy("feature").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(FEATURES + 1)
    for row in rows:
        seen[row.feature] = row.n
    return np.log((1 + seen[FEATURES]) / (1 + seen[:FEATURES])) + 1


def _sparse(batches):
    for whole in batches:
        for batch in pieces(whole, "text", 1 << 20):
            got = features(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("lang"),
                    batch.column("turn"),
                    pa.array([a.astype("<u2").tobytes() for a, _ in got], pa.binary()),
                    pa.array([c.astype("<u4").tobytes() for _, c in got], pa.binary()),
                ],
                names=["doc_id", "lang", "turn", "at", "counts"],
            )


def _sample(labelled: DataFrame) -> DataFrame:
    """Up to SAMPLE_PER_LANGUAGE documents of each language, those of the smallest hashes.

    The rows with small hashes are found in two steps, so that no task sees all rows of a language.
    """
    turn = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    keyed = labelled.select("lang", "doc_id", turn.alias("turn"), F.pmod(turn, F.lit(64)).alias("part"))
    in_part = Window.partitionBy("lang", "part").orderBy("turn")
    in_all = Window.partitionBy("lang").orderBy("turn")
    few = keyed.withColumn("k", F.row_number().over(in_part)).filter(F.col("k") <= SAMPLE_PER_LANGUAGE)
    few = few.withColumn("k", F.row_number().over(in_all)).filter(F.col("k") <= SAMPLE_PER_LANGUAGE)
    return few.select("doc_id", "lang", "turn", "k").dropDuplicates(["doc_id"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _learn(vectors, labels: np.ndarray, n_languages: int) -> np.ndarray:
    """Weights by per-coordinate FTRL-proximal steps (McMahan et al. 2013)."""
    z = np.zeros((FEATURES + 1, n_languages))
    n = np.zeros_like(z)

    def weights(at):
        zi, ni = z[at], n[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    shuffle = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in shuffle.permutation(len(vectors)):
            at, x = vectors[i]
            w = weights(at)
            p = _softmax(x @ w)
            p[labels[i]] -= 1
            g = x[:, None] * p[None, :]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(FEATURES + 1))


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search on its log."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, may_learn: Column) -> Model | None:
    """A model from the texts and labels of the documents where `may_learn` holds and neither is
    null; None where there are none."""
    labelled = docs.filter(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.filter(F.col("text").rlike(LETTER))
    idf = inverse_frequencies(labelled)
    chosen = cut_lineage(_sample(labelled))
    known = chosen.select("lang").distinct().count()
    if known > MOST_LANGUAGES:
        raise ValueError(f"{known} languages; the model is meant for {MOST_LANGUAGES}")
    wanted = chosen.filter(F.col("k") <= MOST_SAMPLED // max(known, 1)).select("doc_id", "turn")
    # Of rows that share a doc_id one is taken, so that no more rows come than were chosen.
    found = (
        labelled.join(wanted, "doc_id")
        .select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "turn")
        .mapInArrow(_sparse, "doc_id string, lang string, turn long, at binary, counts binary")
        .groupBy("doc_id")
        .agg(F.min(F.struct("turn", "lang", "at", "counts")).alias("row"))
    )
    rows = found.select("row.*").collect()
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    rows.sort(key=lambda r: (r.turn, r.lang, bytes(r.at)))
    vectors, labels = [], np.array([languages.index(r.lang) for r in rows])
    for r in rows:
        at = np.frombuffer(bytes(r.at), "<u2").astype(np.int64)
        x = _vector(at, np.frombuffer(bytes(r.counts), "<u4"), idf)
        vectors.append((np.append(at, FEATURES), np.append(x, 1.0)))
    held = np.arange(len(rows)) % CALIBRATION_FOLDS == 0
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
    weights = _learn([vectors[i] for i in fit], labels[fit], len(languages))
    logits = np.array([x @ weights[at] for (at, x), h in zip(vectors, held, strict=True) if h])
    return Model(languages, idf, weights, _temperature(logits, labels[held]))


def _judge(model: Model | None, batch: pa.RecordBatch) -> tuple[list[str], list[float]]:
    """Language and score of each text of a batch whose last column says whether it has a letter."""
    lang, score = [], []
    letters = batch.column(batch.num_columns - 1).to_pylist()
    for (at, counts), letter in zip(
        features(*text_bytes(batch.column("text"))), letters, strict=True
    ):
        if model is None or not letter:
            lang.append(UNKNOWN)
            score.append(0.0)
            continue
        z = _vector(at, counts, model.idf) @ model.weights[at] + model.weights[FEATURES]
        p = _softmax(z / model.temperature)
        lang.append(model.languages[int(p.argmax())])
        score.append(float(p.max()))
    return lang, score


def _predictions(model: Model | None):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                lang, score = _judge(model, batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()),
                        pa.array(lang, pa.string()),
                        pa.array(score, pa.float64()),
                    ],
                    names=["doc_id", "lang_pred", "score"],
                )

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(`doc_id`, `lang_pred`, `score`) from the text alone. A text that is null or has no letter
    is `und` with score 0, and so is every text where nothing could be learned."""
    letter = F.coalesce(F.col("text").rlike(LETTER), F.lit(False))
    return docs.select("doc_id", "text", letter.alias("has_letter")).mapInArrow(
        _predictions(model), "doc_id long, lang_pred string, score double"
    )


def held_out(doc_id: Column) -> Column:
    """One document of five, by its number, takes no part in learning; a null number takes part in
    neither learning nor the held-out fifth."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(`doc_id`, `held_out`, `lang_pred`, `score`): learn from the documents that are not held out
    and predict all. Needs doc_id, text and lang; other columns are ignored. Rows with equal doc_id
    each get a row, and one of them may be learned from; a null doc_id is not learned from. A null or
    empty text is `und`. Very long texts are read whole; an empty table gives an empty result."""
    out = held_out(F.col("doc_id"))
    model = train(docs.select("doc_id", "text", "lang"), ~out & F.col("doc_id").isNotNull())
    found = predict(docs, model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def _kept(model: Model | None, least: float, columns: list[str]):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                lang, score = _judge(model, batch)
                keep = [x != UNKNOWN and s >= least for x, s in zip(lang, score, strict=True)]
                yield batch.filter(pa.array(keep, pa.bool_())).select(columns)

    return run


def keep_identified(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The documents whose language is found with at least `least_score`; the columns are those of
    `docs`. A document without letters is not kept."""
    out = held_out(F.col("doc_id"))
    model = train(docs.select("doc_id", "text", "lang"), ~out & F.col("doc_id").isNotNull())
    letter = F.coalesce(F.col("text").rlike(LETTER), F.lit(False))
    return docs.select(*docs.columns, letter.alias("__has_letter")).mapInArrow(
        _kept(model, least_score, docs.columns), docs.schema
    )
