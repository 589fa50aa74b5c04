"""The sample that the language model learns from is bounded by rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalendra.llm import language_id


def test_rows_that_share_a_doc_id_stay_bounded(spark, monkeypatch):
    seen = []
    learn = language_id._learn
    monkeypatch.setattr(
        language_id, "_learn", lambda v, y, n: (seen.append(len(v)), learn(v, y, n))[1]
    )
    rows = [(1, f"the one and the other {k}", "en") for k in range(3000)]
    rows += [(k, "der eine und der andere", "de") for k in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs, F.lit(True))
    assert model.languages == ["de", "en"] and seen[0] <= 39


def test_all_languages_share_one_bound(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_SAMPLED", 20)
    seen = []
    learn = language_id._learn
    monkeypatch.setattr(
        language_id, "_learn", lambda v, y, n: (seen.append(len(v)), learn(v, y, n))[1]
    )
    rows = [(100 * k + j, f"{'abcdefghij'[k] * 5} word{j}", f"l{k}") for k in range(10) for j in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(language_id.train(docs, F.lit(True)).languages) == 10 and seen[0] <= 20
