"""Token counts by rank-synchronous merging.

The words of a batch that are new to a task are held as ragged arrays of symbol
ids. In every round each word's lowest-rank pair is found, all words at once,
and every occurrence of it in its word is merged, until no word has a pair with
a rank; the symbols that are left are counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cratewise.llm.pretokens import SPECIAL_TOKENS, WordTable, byte_symbols
from cratewise.llm.words import small

NO_RANK = np.int64(1 << 40)
SLOT_BITS = 19


class Merger:
    """Merge table of a vocabulary file whose words end in a suffix."""

    def __init__(self, spec: str):
        model = json.loads(spec)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        names = byte_symbols()
        self.inner = np.array([vocab[c] for c in names], dtype=np.int64)
        self.final = np.array([vocab[c + end] for c in names], dtype=np.int64)
        left = np.array([vocab[a] for a, _ in model["merges"]], dtype=np.int64)
        right = np.array([vocab[b] for _, b in model["merges"]], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int64)
        self.base = int(max(vocab.values())) + 1
        keys = left * self.base + right
        self.rank = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.rank], made
        # A slot per hashed key; keys that share a slot are looked up in the sorted list.
        slot = self._slot(self.keys)
        self.slots = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        self.slots[slot] = np.arange(len(slot))
        self.crowded = np.bincount(slot, minlength=1 << SLOT_BITS) > 1

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.base + right
        slot = self._slot(keys)
        at = self.slots[slot]
        many = np.flatnonzero(self.crowded[slot])
        at[many] = np.minimum(np.searchsorted(self.keys, keys[many]), len(self.keys) - 1)
        return np.where((at >= 0) & (self.keys[at] == keys), self.rank[at], NO_RANK)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word behind the other, and the number of each word's ids."""
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum(size)
        symbol = self.inner[data]
        symbol[ends - 1] = self.final[data[ends - 1]]
        owner = np.repeat(np.arange(len(words)), size)
        done = []
        while len(symbol):
            joined = owner[1:] == owner[:-1]
            rank = np.where(joined, self.ranks(symbol[:-1], symbol[1:]), NO_RANK)
            first = np.flatnonzero(np.r_[True, ~joined])
            width = np.diff(np.r_[first, len(owner)])
            least = np.repeat(np.minimum.reduceat(np.r_[rank, NO_RANK], first), width)
            # Words without a ranked pair are done and leave the arrays.
            live = least < NO_RANK
            done.append((owner[~live], symbol[~live]))
            at = np.flatnonzero((rank < NO_RANK) & (rank == least[:-1]))
            # Of overlapping occurrences (a run of one symbol) every second one counts, from the left.
            if len(at) > 1:
                run = np.r_[True, np.diff(at) > 1]
                nth = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
                at = at[nth % 2 == 0]
            symbol[at] = self.made[rank[at]]
            live[at + 1] = False
            symbol, owner = symbol[live], owner[live]
        if not done:
            return np.zeros(0, dtype=np.int64), size
        owner, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        return symbol[order], np.bincount(owner, minlength=len(words))

    def counts(self, words: list[str]) -> list[int]:
        """The number of each word's ids: the symbols left when no pair can be merged."""
        return self.merged(words)[1].tolist()


def _counted(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(spec.value)

        def encode(words: list[str]) -> list[int]:
            plain = [w for w in words if w not in SPECIAL_TOKENS]
            counts = iter(merger.counts(plain) if plain else [])
            return [1 if w in SPECIAL_TOKENS else next(counts) for w in words]

        table = WordTable(spec.value, encode)
        for batch in small(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            tokens, values = [], np.zeros(0, dtype=np.int64)
            for own in table.rows(texts):
                if len(values) != len(table.values):
                    values = np.array(table.values, dtype=np.int64)
                tokens.append(int(values[own].sum()))
            sizes = [len(x.encode()) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text.

    ``vocabulary`` is the path of the word-BPE file; the driver reads it and
    broadcasts it (a fixed file of some 2 MB). No begin or end token is counted;
    the vocabulary's special strings inside a text are one token each. A null or
    empty text has none. One row per input row, repeated rows included; columns
    other than ``doc_id`` and ``text`` are ignored.
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_counted(spec), f"doc_id {kind}, n_bytes long, n_tokens long")
