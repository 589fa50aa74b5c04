"""Registered queries over the smallest test tables, and the pipeline stage by stage."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from compare import connect, ordered
from kalendra.llm.queries import ORACLES, QUERIES, table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = connect(SF_DIR).execute(ORACLES[name])
    oracle = ordered([d[0] for d in cursor.description], cursor.fetchall())
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == oracle


def test_every_operator_has_its_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            left = {r.doc_id for r in docs.select("doc_id").collect()}
            assert left <= ids
            if name in ("near_dedup", "mix"):
                assert len(left) < len(ids)
            ids = left
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r.doc_id for r in docs.collect()} == ids
