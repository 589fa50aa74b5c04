"""What the last joins of the line dedup read: only lines with an equal or a near one, without their texts."""

from __future__ import annotations

from kalendra.llm import line_dedup as L


def test_lines_that_are_looked_up(spark):
    text = "one two three four five six\nonly here and nowhere else at all\none two three four five seven"
    docs = spark.createDataFrame([(1, text), (2, "one two three four five six\nshort")], "doc_id long, text string")
    lines = docs.mapInArrow(L._line_rows, f"{L._LINE}, {L._KEYS}")
    firsts = L._first_lines(lines)
    assert {(r.doc_id, r.line_no): r.more for r in firsts.collect()} == {
        (1, 0): True, (1, 1): False, (1, 2): False, (2, 1): False,
    }
    given = L._wanted_texts(docs, L._with_partner(firsts, 5)).mapInArrow(L._variant_rows, L._VARIANT)
    itself = {(r.doc_id, r.line_no): (r.key, r.b, r.line) for r in given.filter(f"kind = {L._LINE_ITSELF}").collect()}
    hashes = {(r.doc_id, r.line_no): (r.a, r.b) for r in firsts.collect()}
    assert set(itself) == {(1, 0), (1, 2)} and all(itself[p][:2] == hashes[p] for p in itself)
    found = {tuple(r) for r in L.repeated_lines(docs).collect()}
    assert found == {(1, 2, 1, 0, 1), (2, 0, 1, 0, 0)}
