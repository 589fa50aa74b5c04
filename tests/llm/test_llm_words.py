"""Hashed words and shingles against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kalendra.llm import words as W


@pytest.mark.parametrize("segment", [7, 64, 1 << 20])
def test_words_and_shingles(monkeypatch, segment):
    monkeypatch.setattr(W, "SEGMENT", segment)
    rng = random.Random(segment)
    pool = ["a", "b", "été", "x" * 40, "ß", "Aa", "aA", "1-2", " ", "日本"]
    gaps = [" ", "\t", "\n", "  ", "\x0b", "\x0c", "\r\n"]
    texts = ["", " ", "a", None, "a b c d", "a b c d e", "x" * 300]
    texts += [
        "".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randrange(30))) for _ in range(40)
    ]
    data, offsets = W.text_bytes(pa.array(texts))
    found = W.Words(data, offsets)
    plain = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert found.counts().tolist() == [len(x) for x in plain]
    spelled = [bytes(data[s:e]).decode() for s, e in zip(found.starts, found.ends, strict=True)]
    assert spelled == [w for x in plain for w in x]
    by_word: dict[str, set] = {}
    for w, h in zip(spelled, found.hashes.tolist(), strict=True):
        by_word.setdefault(w, set()).add(h)
    assert all(len(x) == 1 for x in by_word.values())
    assert len({h for x in by_word.values() for h in x}) == len(by_word)
    sizes = [len(s) for s in W.distinct_sets(*W.shingles(found), len(texts))]
    expected = [
        len({tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))}) if x else 0 for x in plain
    ]
    assert sizes == expected


def test_folding_and_slices():
    column = pa.array(["zz", "The THE the É é", "q"]).slice(1, 1)
    data, offsets = W.text_bytes(column)
    found = W.Words(data, offsets, fold=True)
    assert len(set(found.hashes.tolist())) == 3
    assert len(set(W.Words(data, offsets).hashes.tolist())) == 5


def test_pieces_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (0, 50, 5, 5, 200, 0, 1)]})
    parts = list(W.pieces(batch, "text", 60))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(sum(map(len, p.column("text").to_pylist())) for p in parts if p.num_rows > 1) <= 60
    assert list(W.pieces(batch.slice(0, 0), "text")) == []


def test_span_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"abcXabcYYabc", np.uint8)
    h = W.span_hashes(data, np.array([0, 4, 9]), np.array([3, 7, 12]))
    assert len(set(h.tolist())) == 1
