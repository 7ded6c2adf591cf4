"""Best-fit packing of token sequences under several capacities.

A bin (training sequence) has three capacities: tokens, documents and attention
cost (sum of squared piece lengths). Pieces are placed longest first; each goes
to the bin, among those that can take it under every capacity, whose residual
vector comes out best by a weighted norm (smallest left over) or by a weighted
dot product with the piece (largest before placing).

A piece's demand depends on its length alone, so the packing is planned on the
histogram of lengths, which has at most ``capacity`` rows whatever the corpus:
bins with equal residuals are one entry with a multiplicity. Spark then numbers
the pieces of each length (in salted groups, so a length that a third of all
pieces share is spread) and looks each number up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cratewise.llm.pretokens import SPECIAL_TOKENS, WordTable
from cratewise.llm.stores import written
from cratewise.llm.token_counts import Merger
from cratewise.llm.words import small

# Fixed value: the id that closes a document.
END_ID = 1
# Pieces of one length that are numbered together, at least; grows so that there are at most GROUPS groups.
GROUP, GROUPS = 256, 1_000_000


@dataclass
class Limits:
    """Capacities of a sequence and the weights of the residuals (tokens, documents, cost)."""

    tokens: int = 4096
    documents: int = 4096
    cost: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"  # or "dot"


@dataclass
class _Open:
    """Bins that look alike: residuals, how many there are, and their first bin number."""

    residual: np.ndarray = field(default_factory=lambda: np.zeros((0, 3), dtype=np.int64))
    count: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    first: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))

    def add(self, residual: np.ndarray, count: int, first: int) -> None:
        self.residual = np.vstack([self.residual, residual])
        self.count, self.first = np.append(self.count, count), np.append(self.first, first)


def plan_bins(histogram: dict[int, int], limits: Limits) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from_rank, to_rank, first_bin, per_bin, offset): the pieces of a
    length with ranks in [from, to) go, ``per_bin`` at a time, to consecutive bins
    from ``first_bin`` on, the first of a bin at ``offset``."""
    if limits.rule not in ("norm", "dot"):
        raise ValueError("rule is 'norm' or 'dot'")
    full = np.array([limits.tokens, limits.documents, limits.cost], dtype=np.int64)
    weight = np.array(limits.weights)
    bins, made, rows = _Open(), 0, []
    for length in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length], dtype=np.int64)
        if (need > full).any() or length < 1:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        left, rank = histogram[length], 0
        while left:
            fits = np.flatnonzero((bins.residual >= need).all(axis=1) & (bins.count > 0))
            if len(fits):
                rest = bins.residual[fits]
                if limits.rule == "norm":
                    score = ((((rest - need) / full) ** 2) * weight).sum(axis=1)
                else:
                    score = -((rest / full) * (need / full) * weight).sum(axis=1)
                pick = int(fits[np.argmin(score)])
                residual, count, first = bins.residual[pick].copy(), int(bins.count[pick]), int(bins.first[pick])
            else:
                pick, residual, count, first = -1, full.copy(), left, made
            # Least left over: a bin stays the best of its like until it can take no more.
            # Largest product: the next piece goes to the next bin of its like.
            room = min(int((residual // need).min()), left)
            per_bin = room if limits.rule == "norm" or pick < 0 else 1
            used = min(count, left // per_bin)
            if pick >= 0:
                bins.count[pick] -= used
                bins.first[pick] += used
            else:
                made += used
            rows.append((length, rank, rank + used * per_bin, first, per_bin, int(limits.tokens - residual[0])))
            bins.add(residual - per_bin * need, used, first)
            rank, left = rank + used * per_bin, left - used * per_bin
        keep = (bins.count > 0) & (bins.residual[:, 0] > 0) & (bins.residual[:, 1] > 0)
        bins.residual, bins.count, bins.first = bins.residual[keep], bins.count[keep], bins.first[keep]
    return rows


def _pieces(spec, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(spec.value)

        def encode(words: list[str]) -> list[bytes]:
            plain = [w for w in words if w not in SPECIAL_TOKENS]
            ids, sizes = merger.merged(plain) if plain else (np.zeros(0), np.zeros(0, dtype=int))
            data, ends = ids.astype("<u4").tobytes(), np.r_[0, 4 * np.cumsum(sizes)].tolist()
            coded = iter([data[a:z] for a, z in zip(ends, ends[1:])])
            return [table.tokenizer.token_to_id(w).to_bytes(4, "little") if w in SPECIAL_TOKENS else next(coded) for w in words]

        table = WordTable(spec.value, encode)
        closing, step = END_ID.to_bytes(4, "little"), 4 * capacity
        for batch in small(batches):
            row, start, length, crc, ids = [], [], [], [], []
            for i, own in enumerate(table.rows([x or "" for x in batch.column(1).to_pylist()])):
                data = b"".join(map(table.values.__getitem__, own.tolist())) + closing
                for at in range(0, len(data), step):
                    part = data[at : at + step]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            columns = {
                "doc_id": batch.column(0).take(pa.array(row, pa.int64())), "piece": pa.array([s // capacity for s in start], pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """Token pieces of whole texts: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).

    A text's ids are those of the vocabulary without added tokens, then the
    closing id; more than ``capacity`` ids are cut into full pieces and a rest.
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(_pieces(spec, capacity, with_ids), schema)


def number_pieces(pieces: DataFrame, histogram: DataFrame, total: int) -> DataFrame:
    """Add ``rank``: 0, 1, ... among the pieces of equal length, in salted groups."""
    group = max(GROUP, total // GROUPS)
    salts = histogram.select(F.col("length").alias("of"), F.ceil(F.col("n") / group).alias("salts"))
    # At most one row for each possible length.
    dealt = pieces.join(F.broadcast(salts), F.col("length") == F.col("of")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "salts")
    )
    counts = written(dealt.groupBy("length", "salt").agg(F.count("*").alias("n")), "salted")
    before = counts.select(
        F.col("length").alias("l"), F.col("salt").alias("s"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"),
    )
    before = written(before, "before")
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    dealt = dealt.withColumn("place", place)
    met = dealt.join(before, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s")))
    return met.withColumn("rank", F.col("before") + F.col("place") - 1).drop("of", "salts", "salt", "l", "s", "before", "place")


def place_pieces(pieces: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Give each piece (written table with ``doc_id, piece, length, ids_crc32``) its
    ``sequence_id`` and ``offset`` in the sequence."""
    limits = limits or Limits()
    spark = pieces.sparkSession
    histogram = written(pieces.groupBy("length").agg(F.count("*").alias("n")), "lengths")
    # At most ``limits.tokens`` rows.
    found = {r["length"]: r["n"] for r in histogram.collect()}
    plan = spark.createDataFrame(
        plan_bins(found, limits), "of_length long, from_rank long, to_rank long, first_bin long, per_bin long, at long"
    )
    ranked = number_pieces(pieces, histogram, sum(found.values()))
    in_row = F.col("rank") - F.col("from_rank")
    return ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")),
    ).select(
        *pieces.columns, (F.col("first_bin") + F.floor(in_row / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(in_row, F.col("per_bin")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, vocabulary: str, limits: Limits | None = None, with_ids: bool = False) -> DataFrame:
    """Pack whole texts into sequences.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset`` and, if asked for, the ``ids``. A null or empty text is
    the closing id alone. Repeated rows are packed once each; ties of length are
    dealt by a hash of the piece. An empty table gives no rows. Other columns are
    ignored. The plan is made on the driver from at most ``limits.tokens`` counts.
    """
    limits = limits or Limits()
    pieces = written(cut_pieces(docs, vocabulary, limits.tokens, with_ids), "pieces")
    return place_pieces(pieces, limits)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and its ``ids`` in order, from a packing with ids."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
