"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of the characters that keys are written in. A forest over length, character
transitions, dictionary coverage, path and neighbouring words tells keys from long words, numbers,
paths and other runs. It is trained from labelled findings; where none are given they are made by
strict rules from candidates that leave no doubt. All of it is built-in functions and the forest of
Spark's machine-learning library; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendra.session import cut_lineage

#: A run may follow '=' directly, as in NAME=value; padding is '=' at the end of a value only.
RUN = r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=\-]))?"
#: Characters before a candidate that its neighbouring words are looked for in.
CONTEXT = 48
#: Labelled findings of each kind that the forest is trained on, at most.
MOST_LABELLED = 5000
#: A word of the corpus counts as one of the dictionary from so many occurrences on.
DICTIONARY_COUNT = 5
TREES, DEPTH, SEED = 24, 6, 17
LEAST_SCORE = 0.5

# Words in the names that keys are assigned to.
KEY_NAMES = "api|apikey|auth|bearer|credential|key|passphrase|passwd|password|private|pwd|secret|token"

FEATURES = [
    "length", "digit_share", "upper_share", "sign_share", "transitions", "distinct_share", "hex",
    "coverage", "in_path", "assigned", "named", "quoted",
]


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def candidates(docs: DataFrame) -> DataFrame:
    """(`doc_id`, `nth`, `token`, `before`, `after`): every candidate of every whole text with what
    stands before and after it; what stands before may be a candidate, too, such as the name of a
    key. A null text has none."""

    def before(tokens: Column, around: Column, i: Column) -> Column:
        earlier = [F.coalesce(F.get(x, i - 1), F.lit("")) for x in (around, tokens)]
        return F.right(F.concat(*earlier, F.get(around, i)), F.lit(CONTEXT))

    def paired(tokens: Column, around: Column) -> Column:
        return F.transform(
            tokens,
            lambda t, i: F.struct(
                i.alias("nth"),
                t.alias("token"),
                before(tokens, around, i).alias("before"),
                F.left(F.get(around, i + 1), F.lit(1)).alias("after"),
            ),
        )

    found = _let(
        F.struct(
            F.regexp_extract_all("text", F.lit(RUN), F.lit(0)).alias("tokens"),
            F.split("text", RUN, -1).alias("around"),
        ),
        lambda x: paired(x["tokens"], x["around"]),
    )
    return docs.filter(F.col("text").rlike(RUN)).select("doc_id", F.inline(found))


def _share(token: Column, others: str) -> Column:
    """Share of characters that are left when `others` are taken out."""
    return F.length(F.regexp_replace(token, others, "")) / F.length(token)


def described(found: DataFrame) -> DataFrame:
    """Candidates with every feature but `coverage`."""
    token, before = F.col("token"), F.col("before")
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kinds = F.translate(token, digits + lower + upper, "0" * 10 + "a" * 26 + "A" * 26)
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    as_number = {
        "hex": token.rlike("^[0-9a-fA-F]+$"),
        "in_path": token.contains("/") | before.rlike(r"(://\S*|[/\\.@])$"),
        "assigned": before.rlike(r"[:=]\s*[\"']?$"),
        "named": before.rlike(rf"(?i)({KEY_NAMES})[\w\-]*[\"']?\s*[:=]\s*[\"']?$|(?i)bearer\s+$"),
        "quoted": before.rlike(r"[\"']$") & F.col("after").isin('"', "'"),
    }
    return found.select(
        "*",
        F.length(token).cast("double").alias("length"),
        _share(token, "[^0-9]").alias("digit_share"),
        _share(token, "[^A-Z]").alias("upper_share"),
        _share(token, "[A-Za-z0-9]").alias("sign_share"),
        ((runs - 1) / F.length(token)).alias("transitions"),
        (F.size(F.array_distinct(F.split(token, ""))) / F.length(token)).alias("distinct_share"),
        *[F.coalesce(value, F.lit(False)).cast("double").alias(k) for k, value in as_number.items()],
    )


def dictionary(docs: DataFrame) -> DataFrame:
    """(`word`): words of four letters and more that the documents use again and again, counted
    over all of them outside the candidates, so that a copied secret makes no words."""
    plain = F.lower(F.regexp_replace("text", RUN, " "))
    word = F.explode(F.split(plain, r"[^\p{L}]+", -1)).alias("word")
    words = docs.select(word).filter(F.length("word") >= 4)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= DICTIONARY_COUNT
    ).select("word")


def with_coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds `coverage`: the share of a candidate's characters in runs of letters that are words."""
    tokens = found.select("token").distinct()
    run = F.explode(F.regexp_extract_all(F.lower("token"), F.lit(r"[a-z]{4,}"), F.lit(0)))
    covered = (
        tokens.select("token", run.alias("word"))
        .join(words, "word")
        .groupBy("token")
        .agg(F.sum(F.length("word")).alias("covered"))
    )
    share = F.coalesce(F.col("covered") / F.length("token"), F.lit(0.0))
    return found.join(covered, "token", "left").withColumn("coverage", share).drop("covered")


def sure_findings(found: DataFrame) -> DataFrame:
    """Labelled findings by strict rules: 1 where a mixed run stands in the place of a named key, 0
    for runs of letters only, digits only, dictionary words and paths without such a place, and for
    calls made of dictionary words; the rest has no label."""
    mixed = (F.col("digit_share") > 0.1) & (F.col("digit_share") < 0.95) & (F.col("transitions") > 0.2)
    secret = mixed & (F.col("named") == 1) & (F.col("coverage") == 0)
    one_kind = F.col("token").rlike("^[0-9]+$|^[A-Za-z]+$")
    other_place = (F.col("named") == 0) | ((F.col("after") == "(") & (F.col("digit_share") == 0))
    plain = (one_kind & (F.col("named") == 0)) | ((F.col("coverage") >= 0.6) & other_place)
    path = (F.col("in_path") == 1) & (F.col("named") == 0) & (F.col("coverage") > 0.3)
    label = F.when(secret, 1.0).when(plain | path, 0.0)
    return found.withColumn("label", label).filter(F.col("label").isNotNull())


def _bounded(labelled: DataFrame) -> DataFrame:
    """At most MOST_LABELLED different findings of each label, those of the smallest hashes."""
    parts = []
    for label in (0.0, 1.0):
        own = labelled.filter(F.col("label") == label).select("label", "token", *FEATURES)
        own = own.withColumn("turn", F.xxhash64("token", *FEATURES)).distinct()
        parts.append(own.orderBy("turn", "token").limit(MOST_LABELLED).drop("turn", "token"))
    return parts[0].unionByName(parts[1])


def judged(found: DataFrame, labelled: DataFrame) -> DataFrame:
    """Candidates with `score`, the forest's share of votes for a secret; null where the labelled
    findings do not hold both kinds."""
    sample = cut_lineage(_bounded(labelled))
    if sample.select("label").distinct().count() < 2:
        return found.withColumn("score", F.lit(None).cast("double"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label",
        probabilityCol="votes", rawPredictionCol="raw", predictionCol="side",
    )
    model = forest.fit(assembler.transform(sample))
    voted = model.transform(assembler.transform(found))
    score = F.get(vector_to_array("votes"), F.lit(1)).alias("score")
    return voted.select(*found.columns, score)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(`doc_id`, `nth`, `length`, `fingerprint`, `named`, `score`): the candidates that the forest
    takes for secrets.

    A secret is shown by its SHA-256 only. `labelled` has the columns of FEATURES, `token` and
    `label`; without it the sure findings of the documents themselves are used. Where nothing can be
    learned every candidate is kept with a null score. A null or empty text gives no rows, a null
    doc_id is carried along, and repeated rows give repeated findings. Other columns are ignored.
    """
    texts = docs.select("doc_id", "text")
    found = cut_lineage(described(candidates(texts)))
    found = cut_lineage(with_coverage(found, dictionary(texts)))
    voted = judged(found, sure_findings(found) if labelled is None else labelled)
    kept = voted.filter(F.coalesce(F.col("score") >= LEAST_SCORE, F.lit(True)))
    return kept.select(
        "doc_id", "nth", F.length("token").alias("length"), F.sha2("token", 256).alias("fingerprint"),
        (F.col("named") == 1).alias("named"), "score",
    )
