"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kalendra.llm import (
    decontaminate,
    language_id,
    lexical_search,
    licenses,
    line_dedup,
    main_text,
    mixing,
    near_dedup,
    prefix_trie,
    quality,
    quality_model,
    secrets,
    token_file,
)

#: A file of the public vocabularies; their folder is a parameter of the environment.
TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_near_dedup")
def op3_near_dedup(spark, sf_dir):
    return near_dedup.near_dups(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query("op6_token_file")
def op6_token_file(spark, sf_dir):
    return token_file.encode_and_read_back(
        table(spark, sf_dir, "documents"), tokenizer_path(), special_ids=True
    )


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@query("op9_mixing")
def op9_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op1_decontaminate")
def op1_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query("op8_quality_rules", quality.oracle())
def op8_quality_rules(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


@query("op7_main_text")
def op7_main_text(spark, sf_dir):
    return main_text.extract(table(spark, sf_dir, "pages"))


@query("op5_line_dedup")
def op5_line_dedup(spark, sf_dir):
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents"))


@query("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_prefix_trie", prefix_trie.ORACLE)
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("op12_lexical_search", lexical_search.ORACLE)
def op12_lexical_search(spark, sf_dir):
    return lexical_search.ranked(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query("op13_quality_model")
def op13_quality_model(spark, sf_dir):
    return quality_model.quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
