"""Token ids of documents in files compressed by a Re-Pair grammar.

Documents are dealt by ranges of doc_id, so files follow one another in ascending order. A file
holds blocks; a block holds some whole documents. In a block, frequent pairs of ids are replaced by
new symbols again and again; the block stores these rules, the length each expands to, the shortened
sequence, and where in it each document ends, so that one document is decoded without the others.

Files are written and committed by Spark's own writer, one row per block, so a lost executor costs
only its tasks, and any store that Spark reaches will do.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kalendra.llm.words import pieces, span_hashes, text_bytes
from kalendra.session import fresh_folder

END = 2
#: Bytes of text in a block, about; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: Rounds of replacement in a block, new symbols in a round, and how often a pair occurs at least.
ROUNDS, PAIRS_A_ROUND, LEAST_OCCURRENCES = 6, 2048, 12
#: Ids of a block, new symbols included, fit in two bytes.
SYMBOLS = 1 << 16
#: Encoded pieces of text that a worker remembers from block to block.
REMEMBERED = 3_000_000
#: Kinds of the visible characters of ASCII, and of the first byte of a Latin letter.
_KINDS = np.zeros(256, np.int8)
_KINDS[33:127] = 3
_KINDS[48:58] = 2
_KINDS[[*range(65, 91), *range(97, 123)]] = 1

BLOCKS = (
    "part int, block int, n_tokens long, doc_ids array<long>, doc_tokens binary, doc_ends binary, "
    "rules binary, lengths binary, sequence binary"
)


def _byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for
    themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return "".join(chr(b if b in shown else 256 + hidden.index(b)) for b in range(256))


class Encoder:
    """The tokenizer behind a memory of words.

    The vocabulary's splitting pattern starts a new piece at a single space between visible
    characters, makes a piece of a single line break between visible characters, and ends a piece
    where letters, digits and other signs meet, contractions apart. So a text may be cut there, and
    each distinct piece is encoded once. Cuts are looked for among ASCII and Latin letters only and
    never beside an apostrophe; what lies between is handed to the tokenizer whole. Pieces are
    recognised by 64-bit hashes. With `special_ids` the literal of an added token gets that token's
    id, as the library does by default; a text that holds one is handed over whole. Without it such
    a literal is text like any other.
    """

    def __init__(self, path: str, special_ids: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_ids
        added = self.tokenizer.get_added_tokens_decoder().values() if special_ids else ()
        self.literals = [t.content.encode() for t in added if t.content]
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size()
        self.letters = dict(enumerate(_byte_letters()))
        self._forget()

    def _forget(self):
        self.keys = np.empty(0, np.uint64)
        self.at = self.length = np.empty(0, np.int64)
        self.flat = np.array([END], np.uint32)

    @staticmethod
    def _cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start of every piece, is it one run of a kind after at most one space)."""
        n = len(data)
        kind = _KINDS[data]  # 0: not known, 1: letters, 2: digits, 3: other signs
        tail = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0))
        sign = (data[tail + 1] == 0x97) | (data[tail + 1] == 0xB7)  # the signs for times, divided by
        kind[tail] = kind[tail + 1] = np.where(sign, 3, 1)
        starts_text = np.zeros(n + 1, bool)
        starts_text[offsets] = True
        joined = ~starts_text[1:n]  # byte i and byte i + 1 belong to one text
        left = np.zeros(n, bool)
        left[1:] = (kind[:-1] > 0) & joined
        right = np.zeros(n, bool)
        right[:-1] = (kind[1:] > 0) & joined
        alone = left & right
        line = alone & (data == 0x0A)
        cut = starts_text[:n] | line | (alone & (data == 0x20))
        cut[1:] |= line[:-1]
        quote = data == 0x27
        cut[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & left[1:] & ~quote[1:] & ~quote[:-1]
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        unlike = np.zeros(n + 1, np.int64)
        np.cumsum((kind == 0) | quote, out=unlike[1:])
        changes = np.zeros(n + 1, np.int64)
        np.cumsum(kind[1:] != kind[:-1], out=changes[2:])
        body = starts + (data[starts] == 0x20)
        full = body < ends
        last = np.where(full, ends, body + 1)
        plain = full & (unlike[ends] == unlike[np.minimum(body, n)])
        plain &= changes[last.clip(max=n)] == changes[(body + 1).clip(max=n)]
        return starts, plain

    def _holding(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts hold the literal of an added token."""
        held = np.zeros(len(offsets) - 1, bool)
        whole = data.tobytes() if self.literals else b""
        for literal in self.literals:
            at = whole.find(literal)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right")) - 1
                inside = at + len(literal) <= offsets[text + 1]
                held[text] |= inside
                at = whole.find(literal, int(offsets[text + 1]) if inside else at + 1)
        return held

    def _learn(self, place, keys, data, starts, ends, plain):
        """Encode pieces that are not yet known and remember them at their places."""
        flat, length = [], np.empty(len(keys), np.int64)
        model, letters = self.model, self.letters
        for k, (s, e, simple) in enumerate(zip(starts.tolist(), ends.tolist(), plain.tolist())):
            piece = data[s:e].tobytes()
            if simple:
                ids = [t.id for t in model.tokenize(piece.decode("latin-1").translate(letters))]
            else:
                ids = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
            flat += ids
            length[k] = len(ids)
        at = len(self.flat) + np.cumsum(length) - length
        self.flat = np.concatenate([self.flat, np.array(flat, np.uint32)])
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, at)
        self.length = np.insert(self.length, place, length)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by END; number of ids of each text)."""
        if len(self.keys) > REMEMBERED:
            self._forget()
        n = len(offsets) - 1
        at, length, where = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n, np.int64)
        if len(data):
            starts, plain = self._cuts(data, offsets)
            held = self._holding(data, offsets)
            if held.any():
                owner = np.searchsorted(offsets, starts, side="right") - 1
                keep = ~held[owner] | (starts == offsets[owner])
                starts, plain = starts[keep], (plain & ~held[owner])[keep]
            ends = np.append(starts[1:], len(data))
            keys, first, which = np.unique(
                span_hashes(data, starts, ends), return_index=True, return_inverse=True
            )
            place = np.searchsorted(self.keys, keys)
            known = np.zeros(len(keys), bool)
            inside = place < len(self.keys)
            known[inside] = self.keys[place[inside]] == keys[inside]
            new = first[~known]
            if len(new):
                self._learn(place[~known], keys[~known], data, starts[new], ends[new], plain[new])
                place = np.searchsorted(self.keys, keys)
            at, length = self.at[place][which], self.length[place][which]
            where = np.searchsorted(starts, offsets[1:])
        at, length = np.insert(at, where, 0), np.insert(length, where, 1)
        last = np.cumsum(length)
        ids = self.flat[np.repeat(at - last + length, length) + np.arange(last[-1] if n else 0)]
        doc_last = last[where + np.arange(n)] if n else last
        return ids, np.diff(np.concatenate([[0], doc_last]))


def shorten(ids: np.ndarray, doc_tokens: np.ndarray, first_symbol: int):
    """(rules, sequence, end of each document in it) by rounds of Re-Pair.

    Each round replaces the most frequent pairs within documents by new symbols, left to right.
    """
    seq = ids.astype(np.uint32)
    closing = np.zeros(len(seq), bool)
    closing[np.cumsum(doc_tokens) - 1] = True
    rules, symbol = [], first_symbol
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        pairs = (seq[:-1] << np.uint32(16)) | seq[1:]
        inside = ~closing[:-1]
        ordered = np.sort(pairs[inside])
        if not len(ordered):
            break
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        seen = np.diff(np.append(edge, len(ordered)))
        often = np.flatnonzero(seen >= LEAST_OCCURRENCES)
        room = min(PAIRS_A_ROUND, SYMBOLS - symbol)
        best = often[np.argsort(-seen[often], kind="stable")[:room]]
        if not len(best):
            break
        chosen = ordered[edge[best]]
        slots = (chosen * np.uint32(2654435761)) >> np.uint32(14)
        _, one = np.unique(slots, return_index=True)  # of two pairs of one slot, one waits a round
        chosen = chosen[np.sort(one)]
        slots = (chosen * np.uint32(2654435761)) >> np.uint32(14)
        pair_at, symbol_at = np.zeros(1 << 18, np.uint32), np.zeros(1 << 18, np.uint32)
        pair_at[slots] = chosen
        symbol_at[slots] = np.arange(symbol, symbol + len(chosen))
        slot = (pairs * np.uint32(2654435761)) >> np.uint32(14)
        hits = np.flatnonzero((pair_at[slot] == pairs) & inside & (pairs > 0))
        new_run = np.concatenate([[True], np.diff(hits) != 1]) if len(hits) else np.empty(0, bool)
        run_start = hits[new_run][np.cumsum(new_run) - 1]
        hits = hits[(hits - run_start) % 2 == 0]
        seq[hits] = symbol_at[slot[hits]]
        closing[hits] = closing[hits + 1]
        keep = np.ones(len(seq), bool)
        keep[hits + 1] = False
        seq, closing = seq[keep], closing[keep]
        rules.append(np.stack([chosen >> np.uint32(16), chosen & np.uint32(0xFFFF)], axis=1))
        symbol += len(chosen)
    table = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    return table.astype("<u2"), seq.astype("<u2"), np.flatnonzero(closing) + 1


def lengths_of(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """How many ids each rule expands to; a rule uses only symbols before its own."""
    out = np.ones(first_symbol + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        out[first_symbol + k] = out[a] + out[b]
    return out[first_symbol:]


@lru_cache(maxsize=1)
def worker_encoder(path: str, special_ids: bool) -> Encoder:
    """A worker's encoder; the tasks that it runs one after another share what it has read and learnt."""
    return Encoder(path, special_ids)


def _blocks(path: str, special_ids: bool):
    def run(batches):
        encoder, part, number = worker_encoder(path, special_ids), TaskContext.get().partitionId(), 0
        if encoder.size >= SYMBOLS:
            raise ValueError(f"{encoder.size} ids leave no room for new symbols in two bytes")
        for whole in batches:
            for batch in pieces(whole, "text", BLOCK_BYTES):
                ids, doc_tokens = encoder.encode(*text_bytes(batch.column("text")))
                rules, sequence, doc_ends = shorten(ids, doc_tokens, encoder.size)
                rows = {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([number], pa.int32()),
                    "n_tokens": pa.array([int(doc_tokens.sum())], pa.int64()),
                    "doc_ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "doc_tokens": pa.array([doc_tokens.astype("<i8").tobytes()], pa.binary()),
                    "doc_ends": pa.array([doc_ends.astype("<i8").tobytes()], pa.binary()),
                    "rules": pa.array([rules.tobytes()], pa.binary()),
                    "lengths": pa.array(
                        [lengths_of(rules, encoder.size).astype("<u4").tobytes()], pa.binary()
                    ),
                    "sequence": pa.array([sequence.tobytes()], pa.binary()),
                }
                number += 1
                yield pa.RecordBatch.from_arrays(list(rows.values()), names=list(rows))

    return run


def write_token_file(
    docs: DataFrame, folder: str, tokenizer_path: str, special_ids: bool = False
) -> None:
    """Write the ids of every text, each closed by END, in ascending doc_id order (nulls first).

    A null text is empty. Rows of one doc_id follow each other in the order of their texts. Other
    columns are left out. `special_ids`: literals of added tokens get those tokens' ids.
    """
    docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions(
        "doc_id", "text"
    ).mapInArrow(_blocks(tokenizer_path, special_ids), BLOCKS).write.option("compression", "zstd").parquet(folder)


def decode(block: dict, first_symbol: int, wanted: range | None = None) -> list[np.ndarray]:
    """Ids of the documents of a block, or of those at the wanted places, from the rules, the
    lengths and their own stretch of the sequence only."""
    rules = np.frombuffer(block["rules"], "<u2").reshape(-1, 2).tolist()
    sequence = np.frombuffer(block["sequence"], "<u2").astype(np.int64)
    doc_ends = np.frombuffer(block["doc_ends"], "<i8")
    lengths = np.concatenate(
        [np.ones(first_symbol, np.int64), np.frombuffer(block["lengths"], "<u4").astype(np.int64)]
    )
    expanded: list[np.ndarray] = []

    def of(symbol: int) -> np.ndarray:
        return expanded[symbol - first_symbol] if symbol >= first_symbol else np.array([symbol])

    for a, b in rules:
        expanded.append(np.concatenate([of(a), of(b)]))
    flat = np.concatenate([np.arange(first_symbol), *expanded]).astype("<u4")
    at = np.cumsum(lengths) - lengths
    places = range(len(doc_ends)) if wanted is None else wanted
    if not places:
        return []
    low = int(doc_ends[places[0] - 1]) if places[0] else 0
    stretch = sequence[low : int(doc_ends[places[-1]])]
    size = lengths[stretch]
    last = np.cumsum(size)
    ids = flat[np.repeat(at[stretch] - last + size, size) + np.arange(last[-1])]
    cuts = [int(last[int(doc_ends[p]) - low - 1]) for p in places]
    return np.split(ids, cuts[:-1])


def _digests(first_symbol: int):
    def run(batches):
        for batch in batches:
            for block in batch.to_pylist():
                docs = decode(block, first_symbol)
                n = np.array([len(x) for x in docs], np.int64)
                size = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block["part"]] * size, pa.int32()),
                        pa.array([block["block"]] * size, pa.int32()),
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array(np.cumsum(n) - n, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in docs], pa.int64()),
                    ],
                    names=["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    return run


def token_digests(spark: SparkSession, folder: str, first_symbol: int) -> DataFrame:
    """(`doc_id`, `start`, `n_tokens`, `ids_crc32`) of every document, read back from the files."""
    blocks = spark.read.parquet(folder)
    sizes = blocks.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(before, "part").select(
        "part", "block", (F.col("before") + F.coalesce(F.sum("n_tokens").over(own), F.lit(0))).alias("at")
    )
    rows = blocks.select(
        "part", "block", "doc_ids", "doc_ends", "rules", "lengths", "sequence"
    ).mapInArrow(
        _digests(first_symbol),
        "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long",
    )
    return rows.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("at") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_and_read_back(
    docs: DataFrame, tokenizer_path: str, special_ids: bool = False
) -> DataFrame:
    """Write the token files of all documents into the shared folder and digest what they hold."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = fresh_folder(spark, "tokens")
    write_token_file(docs, folder, tokenizer_path, special_ids)
    return token_digests(spark, folder, Tokenizer.from_file(tokenizer_path).get_vocab_size())
