"""Lines of very long documents, and a smaller least length."""

from __future__ import annotations

from kalendra.llm import line_dedup


def test_fifty_thousand_near_lines_in_one_document(spark):
    """A text is split once, whatever the number of its lines that have a partner."""
    lines = [f"this line differs in number {k} only and in nothing else" for k in range(50_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "another one")], "doc_id long, text string")
    found = line_dedup.repeated_lines(docs)
    assert found.count() == 49_999
    assert found.filter("like_line_no <> 0 or edits <> 1").isEmpty()


def test_short_lines_where_asked_for(spark):
    docs = spark.createDataFrame([(1, "good day\ngood night\nday\nbad night\ngood day sir")], "doc_id long, text string")
    assert line_dedup.repeated_lines(docs).count() == 0
    got = {(r.line_no, r.like_line_no) for r in line_dedup.repeated_lines(docs, 2).collect()}
    assert got == {(1, 0), (3, 1), (4, 0)}
    assert line_dedup.repeated_lines(docs.limit(0), 2).count() == 0
