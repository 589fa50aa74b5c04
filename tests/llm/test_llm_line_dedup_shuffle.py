"""Texts are dealt out once, and the lines they held are verified from there."""

from __future__ import annotations

from kalendra.llm import line_dedup


def test_texts_are_joined_by_shuffles_at_any_size(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d x")], "doc_id long, text string")
    wanted = spark.createDataFrame(
        [(1, 0, 5, True, False)], "doc_id long, line_no long, a long, same boolean, other boolean"
    )
    plan = line_dedup._wanted_texts(docs, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_lines_with_inner_space_and_other_letters(spark):
    docs = spark.createDataFrame(
        [(1, "größe der  alten\tstadt heute\n\nx"), (2, "x\n  größe der alten burg heute \r\nx"), (2, "y y"), (3, None)],
        "doc_id long, text string",
    )
    found = {tuple(r) for r in line_dedup.repeated_lines(docs).collect()}
    assert found == {(2, 1, 1, 0, 1), (2, 0, 1, 2, 0), (2, 2, 1, 2, 0)}
