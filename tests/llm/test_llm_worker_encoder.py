"""A worker's tasks share one encoder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from kalendra.llm import queries, token_file
from kalendra.llm.words import text_bytes


def test_a_second_task_learns_nothing_anew():
    path = queries.tokenizer_path()
    one, two = (token_file.worker_encoder(path, True) for _ in range(2))
    assert one is two and one is not token_file.Encoder(path, True)
    texts = text_bytes(pa.array(["the old plate, live", None, "<|endoftext|> again", ""]))
    ids, sizes = one.encode(*texts)
    known = len(one.keys)
    again, same = two.encode(*texts)
    plain, _ = token_file.Encoder(path, True).encode(*texts)
    assert len(two.keys) == known and np.array_equal(ids, again) and np.array_equal(ids, plain)
    assert np.array_equal(sizes, same)
