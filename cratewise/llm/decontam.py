"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The symbols of the search are words. Every run of ``size`` consecutive words of
a benchmark item is a pattern (a shorter item is one pattern). As in Wu and
Manber's search, the last block of words at a position gives, from a shift
table, how far the search may move without missing an occurrence; a shift of
zero leads through the hash of the block to a bucket of patterns, and a direct
comparison confirms an occurrence.

The search runs inside Arrow batches: many stretches of text are walked at the
same time, each by its own shifts, so every step is one numpy operation. Tables are
compiled in tasks from bounded shares of the benchmark, and searched one after another.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.stores import written
from cratewise.llm.words import LETTERS, U, Words, mix, small, windows, word_slices

# Words, and bytes of words, in the tables of one search, which are sent to every
# executor; a larger benchmark is searched share by share, and a longer item is cut
# into pieces that overlap by a window.
WORDS_PER_SEARCH = 250_000
BYTES_PER_SEARCH = 2_500_000
# Words of a text that one lane of the search walks.
STRETCH = 128
SHIFT_BITS = 18


def _block(before: np.ndarray | None, last: np.ndarray) -> np.ndarray:
    return mix(last) if before is None else mix(before * U(0x9FB21C651E98DF25) + last)


@dataclass
class Patterns:
    """Patterns of one length with their tables."""

    length: int
    block: int
    shift: np.ndarray
    suffix: np.ndarray  # bucket keys, sorted; equal keys are one bucket
    whole: np.ndarray  # hash of the pattern, beside its bucket key
    text: list[bytes]
    items: list[list[int]]

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence in the rows of ``words``."""
        m, h = self.length, words.hashes
        counts = words.counts
        # Lanes: the end positions of a row, in stretches.
        ends = np.maximum(counts - m + 1, 0)
        lanes = -(-ends // STRETCH)
        row = np.repeat(np.arange(len(counts)), lanes)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = words.first[:-1][row] + m - 1 + nth * STRETCH
        stop = np.minimum(at + STRETCH, words.first[1:][row])
        found = []
        while len(at):
            key = _block(h[at - 1] if self.block == 2 else None, h[at])
            step = self.shift[(key >> U(64 - SHIFT_BITS)).astype(np.int64)]
            if (zero := step == 0).any():
                found.append((at[zero], key[zero]))
            at = at + np.maximum(step, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, key = (np.concatenate(x) for x in zip(*found))
        low, high = np.searchsorted(self.suffix, key), np.searchsorted(self.suffix, key, side="right")
        width = high - low
        place = np.repeat(np.arange(len(at)), width)
        pattern = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + low[place]
        start = at[place] - m + 1
        same = np.ones(len(start), dtype=bool)
        if len(start):
            spot = np.full(len(start), m, dtype=U)
            for k in range(m):
                spot = spot * U(0xD6E8FEB86659FD93) + h[start + k]
            same = mix(spot) == self.whole[pattern]
        start, pattern = start[same], pattern[same]
        sure = np.array([
            b" ".join(words.data[words.start[i] : words.end[i]].tobytes() for i in range(s, s + m)) == self.text[p]
            for s, p in zip(start, pattern)
        ], dtype=bool)
        return (start[sure], pattern[sure]) if len(start) else (start, pattern)


def _patterns(length: int, found: dict[bytes, tuple[np.ndarray, list[int]]]) -> Patterns:
    text = list(found)
    h = np.array([found[t][0] for t in text], dtype=U).reshape(len(text), length)
    block = min(2, length)
    last = _block(h[:, -2] if block == 2 else None, h[:, -1])
    order = np.argsort(last, kind="stable")
    shift = np.full(1 << SHIFT_BITS, length - block + 1, dtype=np.uint8 if length < 256 else np.int64)
    for end in range(block - 1, length):
        key = _block(h[:, end - 1] if block == 2 else None, h[:, end])
        np.minimum.at(shift, (key >> U(64 - SHIFT_BITS)).astype(np.int64), length - 1 - end)
    whole = np.array([windows(x, length)[0] for x in h], dtype=U)
    return Patterns(length, block, shift, last[order], whole[order], [text[i] for i in order], [found[text[i]][1] for i in order])


def compile_patterns(items: list[tuple[int, str]], size: int) -> list[Patterns]:
    """Search tables of the items, one set for each pattern length."""
    by_length: dict[int, dict[bytes, tuple[np.ndarray, list[int]]]] = {}
    column = pa.array([text for _, text in items], pa.string())
    for at, to, words in word_slices(column, LETTERS):
        for r in range(to - at):
            a, z = int(words.first[r]), int(words.first[r + 1])
            m = min(size, z - a)
            if not m:
                continue
            spelled = [words.data[words.start[i] : words.end[i]].tobytes() for i in range(a, z)]
            for s in range(a, z - m + 1):
                owners = by_length.setdefault(m, {}).setdefault(b" ".join(spelled[s - a : s - a + m]), (words.hashes[s : s + m], []))[1]
                if items[at + r][0] not in owners:
                    owners.append(items[at + r][0])
    return [_patterns(m, found) for m, found in sorted(by_length.items())]


def search(column: pa.Array, sets: list[Patterns]) -> Iterator[tuple[int, list[tuple[int, int]], set]]:
    """(words, spans of hit words, items) of each text."""
    for at, to, words in word_slices(column, LETTERS):
        cover = np.zeros(len(words.start) + 1, dtype=np.int64)
        items: dict[int, set] = {}
        row = words.row
        for patterns in sets:
            start, pattern = patterns.find(words)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + patterns.length, -1)
            for r, p in zip(row[start].tolist(), pattern.tolist()):
                items.setdefault(r, set()).update(patterns.items[p])
        hit = np.cumsum(cover[:-1]) > 0
        for r in range(to - at):
            a, z = int(words.first[r]), int(words.first[r + 1])
            spans = []
            if r in items:
                edge = np.flatnonzero(np.diff(np.r_[False, hit[a:z], False]))
                spans = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
            yield z - a, spans, items.get(r, set())


def _searched(tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            n, spans, items = zip(*search(batch.column(batch.num_columns - 1), tables.value)) if batch.num_rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, pa.int64()),
                 pa.array([[{"start": a, "end": z} for a, z in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array([sorted(map(str, s)) for s in items], pa.list_(pa.string()))],
                [*batch.schema.names[:-1], "n_words", "spans", "items"],
            )

    return run


def _pieces(spelled: list[bytes], size: int, most: int, widest: int) -> Iterator[tuple[int, bytes]]:
    """(words, text) of pieces of an item that together hold all of its windows: of at most
    ``most`` words and ``widest`` bytes, unless one window has more."""
    at = 0
    while True:
        end = wide = 0
        for word in spelled[at : at + max(most, size)]:
            if end >= size and wide + len(word) >= widest:
                break
            end, wide = end + 1, wide + len(word) + 1
        yield end, b" ".join(spelled[at : at + end])
        if at + end >= len(spelled):
            return
        at += end - size + 1


def _compiled(size: int, most: int, widest: int):
    """Search tables of shares of a benchmark (item_id, text), pickled."""
    def table(share: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(compile_patterns(share, size))], pa.binary())], ["tables"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, words, wide = [], 0, 0
        for batch in small(batches):
            ids = batch.column(0).to_pylist()
            for at, to, found in word_slices(batch.column(1), LETTERS):
                for r in range(to - at):
                    a, z = int(found.first[r]), int(found.first[r + 1])
                    spelled = [found.data[found.start[i] : found.end[i]].tobytes() for i in range(a, z)]
                    for n, text in _pieces(spelled, size, most, widest) if spelled else ():
                        if share and (words + n > most or wide + len(text) > widest):
                            yield table(share)
                            share, words, wide = [], 0, 0
                        share.append((ids[at + r], text.decode()))
                        words, wide = words + n, wide + len(text)
        if share:
            yield table(share)

    return run


def _searches(benchmark: DataFrame, size: int) -> tuple[int, Iterator[list[Patterns]]]:
    """How many searches a benchmark takes, at least one, and their tables, one at a time."""
    items = benchmark.filter("item_id is not null and text is not null").select("item_id", "text")
    wide = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # Few tasks for a small benchmark, so that its share is not cut without need.
    compiled = items.coalesce(-(-wide // BYTES_PER_SEARCH) or 1).mapInArrow(_compiled(size, WORDS_PER_SEARCH, BYTES_PER_SEARCH), "tables binary")
    compiled = written(compiled.select(F.monotonically_increasing_id().alias("nth"), "tables"), "searches")
    shares = [row["nth"] for row in compiled.select("nth").collect()]

    def read() -> Iterator[list[Patterns]]:
        for nth in shares:
            yield pickle.loads(compiled.filter(F.col("nth") == nth).first()["tables"])
        if not shares:
            yield []

    return max(len(shares), 1), read()


def find_overlaps(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Occurrences of benchmark word windows in whole texts.

    Returns one row per row of ``docs``: ``doc_id``, ``n_words``, ``spans``
    (start and end, exclusive, of runs of hit words) and ``items`` (benchmark
    items with an occurring window, as sorted strings). Words are runs of
    digits, letters a-z (A-Z lower-cased) and non-ASCII characters. A null text
    has no words. Items without words, text or id match nothing; equal items
    are all named; repeated rows give equal rows; an empty benchmark hits nothing.
    A benchmark above ``WORDS_PER_SEARCH`` words or ``BYTES_PER_SEARCH`` bytes is searched in
    several passes; the driver holds the tables of one of them.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<start: bigint, end: bigint>>"
    context = docs.sparkSession.sparkContext
    n, searches = _searches(benchmark, size)
    rows = docs.select("doc_id", "text")
    if n == 1:
        tables = context.broadcast(next(searches))
        return rows.mapInArrow(_searched(tables), f"doc_id {kind}, n_words long, spans {span}, items array<string>")
    parts = None
    keyed = rows.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    for sets in searches:
        tables = context.broadcast(sets)
        part = written(keyed.mapInArrow(_searched(tables), f"doc_id {kind}, h1 long, h2 long, n_words long, spans {span}, items array<string>"), "searched")
        if parts is None:
            parts, hits = part.select("doc_id", "h1", "h2", "n_words"), part.filter("size(items) > 0")
        else:
            hits = hits.unionByName(part.filter("size(items) > 0"))
        tables.unpersist()
    merged = hits.groupBy("doc_id", "h1", "h2").agg(
        F.flatten(F.collect_list("spans")).alias("all"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    # Union of the spans: sorted by start, a span that touches the last one is merged into it.
    merged = merged.withColumn("spans", F.expr("""aggregate(array_sort(all), cast(array() as array<struct<start: bigint, end: bigint>>), (acc, x) ->
        if(size(acc) > 0 and element_at(acc, -1).end >= x.start,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, x.end)))),
           concat(acc, array(named_struct('start', x.start, 'end', x.end)))))"""))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("doc_id", "h1", "h2")]
    empty = f"cast(array() as {span})"
    return parts.alias("d").join(merged.alias("m"), same, "left").select(
        "d.doc_id", "n_words", F.coalesce("spans", F.expr(empty)).alias("spans"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Digest of ``find_overlaps``: hit words, items and their SHA-256 per document."""
    found = find_overlaps(docs, benchmark, size)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of a benchmark item.

    Null and empty texts stay; repeated rows stay or go
    together; an empty benchmark removes nothing. Between the passes of a large benchmark
    the kept rows are written.
    """
    schema = docs.schema
    at = schema.names.index("text")
    n, searches = _searches(benchmark, size)
    for nth, sets in enumerate(searches, 1):
        tables = docs.sparkSession.sparkContext.broadcast(sets)

        def clean(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            for batch in small(batches):
                yield batch.filter(pa.array([not items for _, _, items in search(batch.column(at), tables.value)], pa.bool_()))

        docs = docs.mapInArrow(clean, schema)
        if nth < n:
            docs = written(docs, "clean")
            tables.unpersist()
    return docs


def items_digest(items: set) -> str:
    """The digest of the contract, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
