"""Literals of added tokens, as the tokenizer's library reads them by default."""

from __future__ import annotations

import random
import zlib

import pytest

from kalendra.llm import queries, token_file


def test_literals_of_added_tokens(spark, tmp_path):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    rng = random.Random(2)
    words = ["one", "two,", "<|endoftext|>", "x<|endoftext|>y", "<|endo", "ftext|>", "don't", "\n"]
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endo", "ftext|>", "", "plain text", "one <|endoftext|> two"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(100)]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op6_token_file(spark, str(tmp_path)).collect()
    expected, start = [], 0
    for d, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [token_file.END]
        expected.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(map(tuple, found)) == expected
