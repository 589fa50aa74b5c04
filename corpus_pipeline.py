"""The corpus pipeline: documents through five stages, each stored and read again by the next.

1. language: documents without letters or without a sure language go (`keep_identified`).
2. near_dedup: one document of each group of near copies stays.
3. decontaminate: documents that hold a benchmark item go.
4. mix: documents stay as often as their source's target asks, at most three times.
5. tokens: token-id files are written; the result is their digest, a row per document.

Rows are what a stage keeps or drops, so extra columns and repeated rows go through all stages but the
last. A null or empty text has no language and ends in the first stage; a null doc_id is read like any
other, though the language model does not learn from it. Texts are read whole, and an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kalendra.llm import decontaminate, language_id, mixing, near_dedup, token_file
from kalendra.llm.queries import query, table, tokenizer_path
from kalendra.session import cut_lineage

#: Percent of shingles that near copies share in the second stage.
NEAR_PERCENT = 80
#: The rows depend on learned weights and on a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_dups(docs, NEAR_PERCENT)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_file.encode_and_read_back(docs, tokenizer_path(), special_ids=True)


STAGES = [
    ("language", language),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmark_items),
    ("mix", mix),
    ("tokens", tokens),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
