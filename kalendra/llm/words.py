"""Words and word shingles of whole texts as 64-bit hashes, worked out on Arrow buffers.

A text is never turned into Python strings: words are found by a byte table, and the hash of a word
is the difference of two prefix sums, so a batch of texts costs a few passes over its bytes. Bytes
are taken in segments that end between words, so that memory follows the segment and the number of
words, also for a very long text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _flags(values) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


#: A word is a run of bytes other than the six white-space characters of ASCII.
SPACED = ~_flags([0x20, *range(0x09, 0x0E)])
#: A word is a run of ASCII letters and digits and of characters beyond ASCII.
ALPHANUMERIC = _flags([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])

_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_FOLDED = _LETTERS.copy()
_FOLDED[65:91] = _LETTERS[97:123]  # A-Z count as a-z

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n + 1, SEGMENT + 1)
        up, down = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): UTF-8 of all texts one after the other; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    kind = np.int64 if wide else np.int32
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class Words:
    """Words of a batch: `starts`, `ends` (byte positions), `hashes`, `first` (number of the first
    word of each text, and their count at the end)."""

    def __init__(self, data, offsets, table=SPACED, fold=False):
        letters = _FOLDED if fold else _LETTERS
        starts, ends, hashes = [], [], []
        a, n = 0, len(data)
        while a < n:
            b = self._segment_end(data, offsets, table, a, n)
            inside = table[data[a:b]]
            cuts = offsets[np.searchsorted(offsets, a, "right") : np.searchsorted(offsets, b)] - a
            before = np.empty_like(inside)
            before[0] = False
            before[1:] = inside[:-1]
            before[cuts] = False
            after = np.empty_like(inside)
            after[-1] = False
            after[:-1] = inside[1:]
            after[cuts[cuts > 0] - 1] = False
            s = np.flatnonzero(inside & ~before)
            e = np.flatnonzero(inside & ~after) + 1
            up, down = _power_tables(b - a)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(letters[data[a:b]] * up[: b - a], out=sums[1:])
            hashes.append(mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)))
            starts.append(s + a)
            ends.append(e + a)
            a = b
        empty = np.empty(0, np.int64)
        self.starts = np.concatenate(starts) if starts else empty
        self.ends = np.concatenate(ends) if ends else empty
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.first = np.searchsorted(self.starts, offsets)
        self.offsets = offsets

    @staticmethod
    def _segment_end(data, offsets, table, a: int, n: int) -> int:
        """The last place up to a + SEGMENT that lies in no word, or the next one after it."""
        b = a + SEGMENT
        if b >= n:
            return n
        cut = offsets[np.searchsorted(offsets, b, "right") - 1]
        gaps = np.flatnonzero(~table[data[a:b]])
        best = max(int(cut), a + int(gaps[-1]) + 1 if len(gaps) else 0)
        if best > a:
            return best
        while b < n:
            gaps = np.flatnonzero(~table[data[b : b + SEGMENT]])
            nearest = b + int(gaps[0]) if len(gaps) else min(n, b + SEGMENT)
            later = offsets[np.searchsorted(offsets, b)]
            if len(gaps) or later <= nearest:
                return min(nearest, int(later))
            b = nearest
        return n

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner): every window of `size` words, by text; a text with fewer words gives its
    whole sequence as one."""
    h = words.hashes
    n = len(h) - size + 1
    whole, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    text = words.text_of()
    if n > 0:
        fold = h[:n].copy()
        for k in range(1, size):
            fold *= _FOLD
            fold += h[k : n + k]
        inside = text[:n] == text[size - 1 :]
        whole, owner = mix(fold[inside]), text[:n][inside]
    few = np.flatnonzero((words.counts() > 0) & (words.counts() < size))
    if len(few):
        fold = words.counts()[few].astype(np.uint64)
        for k in range(size - 1):
            there = words.counts()[few] > k
            fold[there] = fold[there] * _FOLD + h[words.first[few[there]] + k]
        whole = np.concatenate([whole, mix(fold ^ _BASE)])
        owner = np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        whole, owner = whole[order], owner[order]
    return whole, owner


def distinct_sets(hashes: np.ndarray, owner: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each of n owners; `owner` ascends."""
    at = np.searchsorted(owner, np.arange(n + 1))
    for i in range(n):
        yield np.unique(hashes[at[i] : at[i + 1]])


def pieces(batch: pa.RecordBatch, text: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch cut so that no piece holds much more than `most` bytes of text, one long text
    apart."""
    if batch.num_rows == 0:
        return
    _, offsets = text_bytes(batch.column(text))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end), which ascend and do not overlap."""
    out, a = np.empty(len(starts), np.uint64), 0
    while a < len(starts):
        low = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, low + SEGMENT, "right")))
        high = int(ends[b - 1])
        up, down = _power_tables(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_LETTERS[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[a:b] - low, ends[a:b] - low
        out[a:b] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        a = b
    return out
