"""Toxicity by nearest labelled examples.

Every word of the examples is a dimension of a TF-IDF space; no word is left
out. A word's weight is its idf over all texts times how much its presence says
about the label, so words that say little are quiet. The examples are held in
an index of blocks: postings of rare words are summed first, which is exact;
words that many examples have are kept as dense blocks with the largest weight
of each word in a block. Sum and maxima bound the cosine of every example in a
block; blocks are scored in the order of that bound until it is below the k-th
neighbour found, so the neighbours are exact (in single precision). Their votes,
weighted by closeness, are calibrated by what the examples' own neighbours say
about them.

The examples are a bounded sample (``max_examples`` labelled rows), and the
words are those of the sample. Document frequencies are counted over all texts.
The index is compiled in tasks, in parts of bounded size; the driver passes one
part at a time on to the executors and holds none of them.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.stores import written
from cratewise.llm.words import LETTERS, U, small, word_slices

BLOCK = 32
# A word that more than one in so many examples has is held in dense blocks.
COMMON = 16
POSTING = np.dtype([("row", np.int32), ("weight", np.float32)])
# Postings in a part of the index, but that a word's are never divided.
ENTRIES_PER_PART = 1_000_000


def held_out(doc_id="doc_id"):
    """Rows that labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word hashes of each text, with counts."""
    for batch in small(batches):
        terms, counts = [], []
        for at, to, words in word_slices(batch.column(2), LETTERS):
            for r in range(to - at):
                t, c = np.unique(words.hashes[words.first[r] : words.first[r + 1]], return_counts=True)
                terms.append(t.view(np.int64))
                counts.append(c)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))],
            ["doc_id", "toxic", "terms", "counts"],
        )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of each entry of a list column."""
    row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
    return row, column.flatten().to_numpy(zero_copy_only=False)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part of a batch and word: examples with the word, and toxic ones among them."""
    for batch in small(batches):
        row, term = _flat(batch.column(1))
        term, place, n = np.unique(term, return_inverse=True, return_counts=True)
        toxic = np.bincount(place, weights=batch.column(0).to_numpy(zero_copy_only=False)[row], minlength=len(term))
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64()), pa.array(toxic.astype(np.int64))], ["term", "n", "t"])


def _placed(shared):
    """Per example its heaviest word, how many it has, their places in the vocabulary and its unit vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small(batches):
            places, weights, heads = [], [], []
            ends = np.r_[0, np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))]
            place = np.searchsorted(model.vocabulary, batch.column(2).flatten().to_numpy(zero_copy_only=False).view(U))
            count = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            for a, z in zip(ends[:-1], ends[1:]):
                by = np.argsort(place[a:z])
                places.append(place[a:z][by].astype(np.int32))
                weights.append(model.vector(places[-1], count[a:z][by]).astype(np.float32) if z > a else np.zeros(0, np.float32))
                heads.append(int(places[-1][np.argmax(weights[-1])]) if z > a else -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, pa.int32()), pa.array(np.diff(ends), pa.int32()),
                 pa.array(places, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))],
                ["doc_id", "toxic", "head", "size", "places", "weights"],
            )

    return run


def _known(column: pa.Array, vocabulary: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per text with any: (row, places in the vocabulary, counts)."""
    if not len(vocabulary):
        return
    for at, _, words in word_slices(column, LETTERS):
        # Each distinct word of the slice is looked up once, in order.
        found, nth = np.unique(words.hashes, return_inverse=True)
        place = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
        hit = np.flatnonzero((vocabulary[place] == found)[nth])
        pair, count = np.unique(words.row[hit] * len(vocabulary) + place[nth[hit]], return_counts=True)
        row, term = pair // len(vocabulary), pair % len(vocabulary)
        edge = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else []
        for a, z in zip(edge, [*edge[1:], len(row)]):
            yield at + int(row[a]), term[a:z], count[a:z]


def _frequencies(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        df, texts = np.zeros(len(vocabulary), dtype=np.int64), 0
        for batch in small(batches):
            texts += batch.num_rows
            for _, term, _ in _known(batch.column(0), vocabulary):
                df[term] += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, used], pa.int32()), pa.array(np.r_[texts, df[used]], pa.int64())], ["term", "n"])

    return run


class Part:
    """Postings of a range of terms as they are searched: of rare terms as they are, of common ones for the dense blocks."""

    def __init__(self, n: np.ndarray, rows: np.ndarray, weight: np.ndarray, examples: int):
        """From postings in the order of terms, ``n`` of each term."""
        self.n, self.examples = n.astype(np.int32), examples
        dense = self._dense()
        self.common = rows[dense].astype(np.int32), weight[dense]
        postings = np.empty(len(rows) - int(dense.sum()), dtype=POSTING)
        postings["row"], postings["weight"] = rows[~dense], weight[~dense]
        # As plain numbers, which are copied faster than records.
        self.postings = postings.view(U)

    def _dense(self) -> np.ndarray:
        return np.repeat(self.n.astype(np.int64) * COMMON > self.examples, self.n)

    def __getstate__(self):
        """With narrow row numbers: each executor keeps a file of them."""
        dense, rare = self._dense(), self.postings.view(POSTING)
        rows, weight = np.empty(len(dense), dtype=np.min_scalar_type(self.examples)), np.empty(len(dense), dtype=np.float32)
        rows[dense], weight[dense], rows[~dense], weight[~dense] = *self.common, rare["row"], rare["weight"]
        return self.n, rows, weight, self.examples

    def __setstate__(self, state):
        self.__init__(*state)


def index_order(ids: list, heads: list[int], sizes: list[int]) -> list[int]:
    """Examples whose heaviest word is the same lie together, so that block maxima are tight."""
    return sorted(range(len(ids)), key=lambda i: (heads[i], sizes[i], ids[i]))


class BlockMaxIndex:
    """Examples by term: postings of rare terms; dense blocks, with the largest weight in each, of common ones."""

    def __init__(self, ids: list, toxic: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int):
        order = index_order(ids, [int(t[np.argmax(w)]) for t, w in vectors], [len(t) for t, _ in vectors])
        self._examples([ids[i] for i in order], np.asarray(toxic)[order])
        rows = np.repeat(np.arange(len(order), dtype=np.int32), [len(vectors[i][0]) for i in order])
        term = np.concatenate([vectors[i][0] for i in order] or [np.zeros(0)]).astype(np.int32)
        weight = np.concatenate([vectors[i][1] for i in order] or [np.zeros(0)]).astype(np.float32)
        by = np.argsort(term, kind="stable")
        self.fill([Part(np.bincount(term, minlength=terms), rows[by], weight[by], len(order))])

    @classmethod
    def without_parts(cls, ids: list, toxic: np.ndarray) -> BlockMaxIndex:
        """Of examples in their order; ``fill`` makes it searchable."""
        index = cls.__new__(cls)
        index._examples(ids, toxic)
        return index

    def _examples(self, ids: list, toxic: np.ndarray) -> None:
        self.ids, self.toxic, self.parts = ids, toxic, None
        self.blocks = -(-len(ids) // BLOCK)

    def fill(self, parts: list[Part]) -> None:
        """Takes the parts, which lie one behind the other, unless it has them."""
        if self.parts is not None:
            return
        self.parts = parts
        n = np.concatenate([np.zeros(0, dtype=np.int32), *(p.n for p in parts)])
        common = n.astype(np.int64) * COMMON > len(self.ids)
        self.place = np.where(common, np.cumsum(common) - 1, -1).astype(np.int32)
        self.dense = np.zeros((self.blocks, int(common.sum()), BLOCK), dtype=np.float32)
        at = 0
        for part in parts:
            to, (rows, weight) = at + len(part.n), part.common
            place = self.place[at:to]
            self.dense[rows // BLOCK, np.repeat(place[place >= 0], part.n[place >= 0]), rows % BLOCK] = weight
            at = to
        self.top = np.ascontiguousarray(self.dense.max(axis=2, initial=0).T)
        # Postings of rare term t: start[t] to start[t + 1], counted through all parts; each part's first.
        self.start = np.r_[0, np.cumsum(np.where(common, 0, n))].astype(np.int32)
        self.first = np.cumsum([0, *(len(p.postings) for p in parts)])

    def __getstate__(self):
        """Examples and parts."""
        return self.ids, self.toxic, self.parts

    def __setstate__(self, state):
        ids, toxic, parts = state
        self._examples(ids, toxic)
        if parts is not None:
            self.fill(parts)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, but: list[int] = ()) -> list[tuple[float, int]]:
        """The k examples, none of ``but``, with the largest cosine above 0: (cosine, example). Ties by example. ``term`` rises."""
        if not self.blocks:
            return []
        weight, place = weight.astype(np.float32), self.place[term]
        rare = place < 0
        begin, end = self.start[term[rare]], self.start[term[rare] + 1]
        # A term's postings lie one behind the other: they are copied as slices, not gathered entry by entry.
        found, edge = [np.zeros(0, dtype=U)], [*np.searchsorted(begin, self.first[:-1]), len(begin)]
        for part, first, i, j in zip(self.parts, self.first, edge, edge[1:]):
            postings = part.postings
            found += [postings[a:z] for a, z in zip((begin[i:j] - first).tolist(), (end[i:j] - first).tolist())]
        found = np.concatenate(found).view(POSTING)
        share = np.repeat(weight[rare], end - begin) * found["weight"]
        part = np.bincount(found["row"], weights=share, minlength=self.blocks * BLOCK).astype(float, copy=False)
        part[list(but)] = -np.inf
        best = np.maximum.reduceat(part, np.arange(0, len(part), BLOCK))
        part = part.reshape(self.blocks, BLOCK)
        place, weight = place[~rare], weight[~rare]
        # A little more than the sum, against rounding.
        bound = (best + weight @ self.top[place]) * (1 + 1e-5)
        order = np.argsort(-bound, kind="stable")
        flat = self.dense.reshape(self.blocks * self.dense.shape[1], BLOCK)
        score, example, least, step = np.zeros(0), np.zeros(0, dtype=np.int64), 0.0, 4
        while len(order):
            take, order = order[:step], order[step:]
            take = take[(bound[take] > 0) & (bound[take] >= least)]
            if not len(take):
                break
            scores = part[take] + weight @ flat.take(take[:, None] * self.dense.shape[1] + place, axis=0)
            scores = scores.ravel()
            hit = np.flatnonzero(scores >= least if least > 0 else scores > 0)
            score = np.concatenate([score, scores[hit]])
            example = np.concatenate([example, take[hit // BLOCK] * BLOCK + hit % BLOCK])
            if len(score) > k:
                # Only those up to the k-th, with all that are equal to it, are put in order.
                best = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
                score, example = score[best], example[best]
            best = np.lexsort((example, -score))[:k]
            score, example = score[best], example[best]
            least = score[-1] if len(score) == k else 0.0
            step = min(2 * step, 64)
        return list(zip(score.tolist(), example.tolist()))


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray
    worth: np.ndarray  # weight of each word
    index: BlockMaxIndex
    base: float  # share of toxic examples
    without: float  # the same among examples without a word
    steps: tuple[np.ndarray, np.ndarray]  # calibration: votes and probabilities
    k: int = 15
    parts: list[Broadcast] = field(default_factory=list)  # of the index, which the driver doesn't hold
    shared: Broadcast | None = None  # this model on the executors, but for its steps and parts

    def __getstate__(self):
        return self.__dict__ | {"shared": None, "parts": []}

    def on_executors(self, context: SparkContext) -> Broadcast:
        self.shared = self.shared or context.broadcast(self)
        return self.shared

    def vector(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(count)) * self.worth[term]
        return weight / math.sqrt(float((weight**2).sum()))

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Toxic share of the neighbours, weighted by closeness, with the base rate as half a vote."""
        weight = np.array([s * s for s, _ in near])
        label = self.index.toxic[[i for _, i in near]] if near else np.zeros(0)
        return float(((weight * label).sum() + 0.5 * self.base) / (weight.sum() + 0.5))

    def probability(self, vote: float) -> float:
        """Calibrated; the vote itself decides between equal probabilities."""
        return float(0.99 * np.interp(vote, *self.steps) + 0.01 * vote)

    def score(self, term: np.ndarray, count: np.ndarray) -> tuple[float, list[tuple[float, int]]]:
        near = self.index.nearest(term, self.vector(term, count), self.k)
        return (self.probability(self.vote(near)) if near else self.without), near


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step means of y over x (pool adjacent violators), as points to interpolate."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum, count, sum of x
    for a, b in zip(x[order], y[order]):
        pools.append([float(b), 1.0, float(a)])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


def worths(n: np.ndarray, toxic: np.ndarray, base: float, idf: np.ndarray) -> np.ndarray:
    """Weight of words that ``n`` examples have, ``toxic`` of them toxic: never 0.

    The idf is multiplied by the logarithm of the toxic share over the base rate
    (drawn to 0 by four examples more) and by how many deviations the toxic count
    is from what chance would give.
    """
    if not 0 < base < 1:
        return idf
    lift = np.log((toxic + 4 * base) / ((n + 4) * base))
    z = (toxic - n * base) / np.sqrt(n * base * (1 - base) + 1)
    return idf * (np.abs(lift * z) + 0.01)


def _entries(shared):
    """Postings of a part of a batch by part of the index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, nth, rows = shared.value
        for batch in small(batches):
            row, term = _flat(batch.column(1))
            row = rows[np.searchsorted(nth, batch.column(0).to_numpy(zero_copy_only=False))][row]
            part = np.searchsorted(cuts, term, side="right") - 1
            by = np.argsort(part, kind="stable")
            columns = [x[by] for x in (term, row, batch.column(2).flatten().to_numpy(zero_copy_only=False))]
            found, first = np.unique(part[by], return_index=True)
            ends = pa.array(np.r_[first, len(by)], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.float32()))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *lists], ["part", "terms", "rows", "weights"])

    return run


def _compiled(cuts: list[int], examples: int):
    """A part of the index, pickled."""
    def run(table: pa.Table) -> pa.Table:
        nth = table["part"][0].as_py()
        term, rows, weight = (np.concatenate([c.flatten().to_numpy() for c in table[x].chunks]) for x in ("terms", "rows", "weights"))
        by = np.lexsort((rows, term))
        n = np.bincount(term - cuts[nth], minlength=cuts[nth + 1] - cuts[nth])
        part = pickle.dumps(Part(n, rows[by], weight[by], examples))
        return pa.table([pa.array([nth], pa.int32()), pa.array([part], pa.binary())], ["part", "postings"])

    return run


def _parts(worded: DataFrame, nth: list[int], n: np.ndarray) -> list[Broadcast]:
    """The parts of the index on the executors. ``nth`` are the examples in their order, ``n`` how many have each term."""
    context = worded.sparkSession.sparkContext
    at = (np.cumsum(n) - n) // ENTRIES_PER_PART
    cuts = [*np.flatnonzero(np.diff(at, prepend=-1)).tolist(), len(n)]
    by = np.argsort(nth)
    shared = context.broadcast((np.array(cuts[:-1]), np.array(nth)[by], by.astype(np.int32)))
    entries = worded.select("nth", "places", "weights").mapInArrow(_entries(shared), "part int, terms array<int>, rows array<int>, weights array<float>")
    compiled = written(entries.groupBy("part").applyInArrow(_compiled(cuts, len(nth)), "part int, postings binary"), "parts")
    shared.destroy()
    # One after the other: the driver holds one.
    return [context.broadcast(pickle.loads(compiled.filter(F.col("part") == i).first()["postings"])) for i in range(len(cuts) - 1)]


def _votes(shared, parts: list[Broadcast]):
    """Vote of each example's neighbours, itself left out, beside its label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, own = shared.value, {}
        model.index.fill([p.value for p in parts])
        for n, i in enumerate(model.index.ids):
            own.setdefault(i, []).append(n)
        for batch in small(batches):
            votes = []
            for i, place, weight in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                place, weight = (x.values.to_numpy(zero_copy_only=False) for x in (place, weight))
                votes.append(model.vote(model.index.nearest(place, weight, model.k, own[i])))
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), batch.column(1)], ["vote", "toxic"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 20_000) -> ToxicityModel:
    """Train on labelled rows that are not held out.

    A sample by hash of the ids of about ``max_examples`` labelled rows is used, with
    every word of it. A document labelled more than once is toxic if any label says
    so; null labels are none.
    """
    context = docs.sparkSession.sparkContext
    labelled = written(
        labels.filter("toxic is not null and doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labelled"
    )
    share = min(1.0, max_examples / max(labelled.count(), 1))
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    kind = docs.schema["doc_id"].dataType.simpleString()
    examples = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    examples = written(
        examples.mapInArrow(_terms, f"doc_id {kind}, toxic int, terms array<long>, counts array<long>"), "examples"
    )
    total, toxic = examples.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = toxic / total if total else 0.0
    seen = examples.select("toxic", "terms").mapInArrow(_seen, "term long, n long, t long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    # The words of at most max_examples texts.
    seen = [c.to_numpy() for c in seen.toArrow().columns]
    by = np.argsort(seen[0].view(U))
    vocabulary, counts, bad = seen[0].view(U)[by], seen[1][by], seen[2][by]
    del seen, by

    df = np.zeros(len(vocabulary))
    shared = context.broadcast(vocabulary)
    # One row per word at most, summed.
    counted = docs.select("text").mapInArrow(_frequencies(shared), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    term, n = [c.to_numpy() for c in counted.toArrow().columns]
    texts = int(n[term < 0].sum())
    df[term[term >= 0]] = n[term >= 0]
    shared.destroy()
    worth = worths(counts, bad, base, np.log((texts + 1) / (df + 1)) + 1).astype(np.float32)
    del counted, term, n, df, bad

    model = ToxicityModel(vocabulary, worth, BlockMaxIndex([], np.zeros(0), [], 0), base, base, (np.array([0.0]), np.array([base])))
    shared = context.broadcast(model)
    placed = examples.mapInArrow(_placed(shared), f"doc_id {kind}, toxic int, head int, size int, places array<int>, weights array<float>")
    placed = written(placed.select(F.monotonically_increasing_id().alias("nth"), "*"), "placed")
    shared.destroy()
    bare, bad = placed.filter("size = 0").agg(F.count("*"), F.sum("toxic")).first()
    model.without = bad / bare if bare else base
    worded = placed.filter("size > 0")
    # At most max_examples rows, without their words.
    table = worded.select("nth", "doc_id", "toxic", "head", "size").toArrow()
    if table.num_rows:
        nth, ids, label, heads, sizes = (c.to_pylist() for c in table.columns)
        order = index_order(ids, heads, sizes)
        model.index = BlockMaxIndex.without_parts([ids[i] for i in order], np.array(label)[order])
        model.parts = _parts(worded, [nth[i] for i in order], counts)
        votes = worded.select("doc_id", "toxic", "places", "weights").mapInArrow(_votes(model.on_executors(context), model.parts), "vote double, toxic int").toArrow()
        model.steps = isotonic(votes["vote"].to_numpy(), votes["toxic"].to_numpy().astype(float))
    return model


def _scored(shared, parts: list[Broadcast], steps: tuple[np.ndarray, np.ndarray], with_text: bool, at: int):
    """Rows with score and evidence, or (``with_text``) only rows below one half."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = replace(shared.value, steps=steps), {}
        model.index.fill([p.value for p in parts])
        for batch in small(batches):
            score = np.full(batch.num_rows, model.without)
            evidence = [""] * batch.num_rows
            for row, term, count in _known(batch.column(at), model.vocabulary):
                key = hashlib.blake2b(term.tobytes() + count.tobytes(), digest_size=16).digest()
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                    s, near = model.score(term, count)
                    known[key] = s, ",".join(f"{model.index.ids[i]}:{model.index.toxic[i]}:{c:.4f}" for c, i in near[:3])
                score[row], evidence[row] = known[key]
            if with_text:
                yield batch.filter(pa.array(score < 0.5))
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(evidence)], ["doc_id", "score", "evidence"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Score of each whole text: ``doc_id, held_out, score, predicted, evidence`` (nearest
    examples as id:label:cosine).

    The score is a function of the text and the model alone. A null, empty or
    unrelated text gets the toxic share of the examples without any word (or of all);
    without labels every score is 0. One row per input row.
    """
    shared = model.on_executors(docs.sparkSession.sparkContext)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_scored(shared, model.parts, model.steps, False, 1), f"doc_id {kind}, score double, evidence string")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    shared = model.on_executors(docs.sparkSession.sparkContext)
    return docs.mapInArrow(_scored(shared, model.parts, model.steps, True, docs.columns.index("text")), docs.schema)
