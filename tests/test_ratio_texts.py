"""The ratio of long and of missing texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalendra.functions import similarity


def test_ratio_of_long_texts_and_of_missing_ones(spark):
    """300 pairs of 2 000 letters: a table of letters by letters would hold 4 000 000 cells a pair."""
    a, b = F.col("a"), F.col("b")
    long_ones = spark.range(300).select(F.repeat(F.lit("ab"), 1000).alias("a"), F.repeat(F.lit("b"), 2000).alias("b"))
    assert [tuple(r) for r in long_ones.select(similarity.ratio(a, b)).distinct().collect()] == [(0.5,)]
    rows = [(None, "x"), ("x", None), (None, ""), ("", "x"), ("", ""), ("kitten", "sitting")]
    found = spark.createDataFrame(rows, "a string, b string").select(
        similarity.lcs_length_batched(a, b).alias("lcs"), similarity.lcs_length(a, b).alias("folded"),
        F.round(similarity.ratio(a, b), 6),
    )
    assert [tuple(r) for r in found.collect()] == [
        (None, None, 0.0), (None, None, 0.0), (0, 0, 0.0), (0, 0, 0.0), (0, 0, 1.0), (4, 4, 0.615385)
    ]
