"""Secret scans: fixed forms, and random-looking tokens by two character Markov models.

One model is of random strings, one of ordinary identifiers; both are character
bigrams. They are trained on samples that Spark counts over the whole corpus:
values of the fixed forms are random; words too short to be judged, and longer
tokens that many rows have, are ordinary. Identifiers are words put together, so the
ordinary model also knows how words begin and end: it spells them in other cases and
joins them by separators, digits and capitals.
A token whose log-likelihood ratio, summed over its characters, is high enough,
and that no fixed form covers, is reported as a ``random`` span. Any token of
eight characters or more is judged, whatever characters it has.

Long tokens are found in the bytes of a whole Arrow batch at once; only texts
that hold a key word or a long enough run meet a regular expression.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.stores import written
from cratewise.llm.words import slices, small, text_bytes

# The forms of the contract; a match that is too short is dropped.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex")

# What the summed log-likelihood ratio must reach.
THRESHOLD = 10.0
# A token that may train the ordinary model if many rows have it: a number, or digits at its end at most.
ORDINARY = re.compile(rb"[A-Za-z+/_=-]+[0-9]{0,4}|[0-9+/_=-]+").fullmatch
# Characters of a token; every other byte ends it.
_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *map(ord, "+/_=-")]] = True
# Place of each token character in the models.
SYMBOLS = np.flatnonzero(_TOKEN)
_PLACE = np.zeros(256, dtype=np.int64)
_PLACE[SYMBOLS] = np.arange(len(SYMBOLS))


def fixed_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the fixed forms, in order."""
    low = text.lower() if text.isascii() else text.translate(_ASCII_LOWER)
    spans = []
    if any(word in low for word in KEYWORDS):
        spans += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m.start() + 4) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if _LONG_HEX.search(text):
        spans += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(spans)


_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32}")


def runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of runs of ``member`` bytes, within rows, of ``least`` bytes or more."""
    inside = member[data]
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    opens = inside & np.r_[True, ~inside[:-1]] if n else inside
    closes = inside & np.r_[~inside[1:], True] if n else inside
    opens |= inside & edge[:-1]
    closes |= inside & edge[1:]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = end - start >= least
    return start[long], end[long]


def _scan(column: pa.Array, least: int, models: MarkovModels | None = None, threshold: float = 0.0) -> Iterator[tuple[int, str | None, list, np.ndarray, np.ndarray, np.ndarray]]:
    """Per row: its text and fixed spans if any form may be there, and byte ranges of its long tokens
    (with ``models``, of those that score ``threshold`` or more) with the bytes they are in."""
    data, offsets = text_bytes(column)
    for at, to in slices(offsets):
        own = offsets[at : to + 1] - offsets[at]
        part = data[offsets[at] : offsets[to]]
        start, end = runs(part, own, _TOKEN, least)
        # A run of hexadecimal digits or an access key is within such a token.
        wide = np.searchsorted(start[end - start >= 16], own)
        if models is not None and len(start):
            likely = models.sums(part, start, end) >= threshold
            start, end = start[likely], end[likely]
        first = np.searchsorted(start, own)
        raw = part.tobytes()
        low = raw.lower()
        maybe = any(w.encode() in low for w in KEYWORDS) or b"AKIA" in raw
        for r in range(to - at):
            a, z = int(first[r]), int(first[r + 1])
            lo, hi = int(own[r]), int(own[r + 1])
            form = wide[r + 1] > wide[r] or (maybe and (any(low.find(w.encode(), lo, hi) >= 0 for w in KEYWORDS) or raw.find(b"AKIA", lo, hi) >= 0))
            text = raw[lo:hi].decode() if form or z > a else None
            yield at + r, text, fixed_spans(text) if form else [], start[a:z] - lo, end[a:z] - lo, part[lo:hi]


def _outside(text: str, spans: list, start: np.ndarray, end: np.ndarray, data: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Tokens that overlap no fixed span: (start, end) in code points, and bytes."""
    if not len(start):
        return []
    if len(text) == len(data):
        places = list(zip(start.tolist(), end.tolist()))
    else:
        before = np.cumsum((data & 0xC0) != 0x80)
        places = [(int(before[a]) - 1, int(before[a]) - 1 + int(z - a)) for a, z in zip(start, end)]
    return [
        (a, z, data[s:e].tobytes()) for (a, z), s, e in zip(places, start, end)
        if not any(x[0] < z and a < x[2] for x in spans)
    ]


# Codes of the counts: pairs, then first and last characters.
CODES = len(SYMBOLS) ** 2 + 2 * len(SYMBOLS)


def _bigrams(tokens: list[bytes]) -> np.ndarray:
    counts = np.zeros(CODES, dtype=np.int64)
    if tokens:
        joined = np.frombuffer(b"\n".join(tokens), dtype=np.uint8)
        pair = _TOKEN[joined[:-1]] & _TOKEN[joined[1:]]
        code = _PLACE[joined[:-1]] * len(SYMBOLS) + _PLACE[joined[1:]]
        counts += np.bincount(code[pair], minlength=len(counts))
    return counts


def _short(column: pa.Array, least: int) -> np.ndarray:
    """Bigrams, first and last characters of the words that are shorter than ``least``, and of tokens without letters."""
    n, counts = len(SYMBOLS), np.zeros(CODES, dtype=np.int64)
    data, offsets = text_bytes(column)
    for at, to in slices(offsets):
        part = data[offsets[at] : offsets[to]]
        start, end = runs(part, offsets[at : to + 1] - offsets[at], _TOKEN, 2)
        letters = np.r_[0, np.cumsum(((part | 0x20) >= 0x61) & ((part | 0x20) <= 0x7A))]
        below = (end - start < least) | (letters[end] == letters[start])
        start, end = start[below], end[below]
        size = end - start - 1
        pair = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        counts[: n * n] += np.bincount(_PLACE[part[pair]] * n + _PLACE[part[pair + 1]], minlength=n * n)
        counts[n * n : -n] += np.bincount(_PLACE[part[start]], minlength=n)
        counts[-n:] += np.bincount(_PLACE[part[end - 1]], minlength=n)
    return counts


def _sampled(least: int):
    """Codes (label, code, n) of the random samples and of short words, and rows that have a longer token (token, n)."""
    names = ["label", "code", "token", "n"]

    def listed(rows: Counter) -> pa.RecordBatch:
        none = pa.nulls(len(rows), pa.int32())
        return pa.RecordBatch.from_arrays([none, none, pa.array([t.decode() for t in rows], pa.string()), pa.array(list(rows.values()), pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((2, CODES), dtype=np.int64), Counter()
        for batch in small(batches):
            random = []
            total[1] += _short(batch.column(0), least)
            for _, text, spans, start, end, data in _scan(batch.column(0), least):
                if text is not None:
                    random += [text[s[3] : s[2]].strip("\"'").encode() for s in spans]
                    rows.update({t for _, _, t in _outside(text, spans, start, end, data) if len(t) <= 64 and ORDINARY(t)})
                if len(rows) > 200_000:
                    yield listed(rows)
                    rows.clear()
            total[0] += _bigrams(random)
        yield listed(rows)
        label, code = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(code, pa.int32()), pa.nulls(len(label), pa.string()), pa.array(total[label, code], pa.int64())], names)

    return run


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigrams, first and last characters of tokens, each as often as rows have it."""
    symbols, total = len(SYMBOLS), np.zeros(CODES, dtype=np.int64)
    for batch in small(batches):
        for token, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            place = _PLACE[np.frombuffer(token.encode(), dtype=np.uint8)]
            np.add.at(total, place[:-1] * symbols + place[1:], n)
            total[symbols**2 + place[0]] += n
            total[symbols**2 + symbols + place[-1]] += n
    code = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(code)), pa.int32()), pa.array(code, pa.int32()), pa.array(total[code], pa.int64())], ["label", "code", "n"])


def bigram_counts(docs: DataFrame, least: int = 8, often: int = 5) -> DataFrame:
    """(label, code, n): character bigrams, first and last characters of random (0) and ordinary (1) samples of the whole corpus.

    Ordinary are words shorter than ``least``, numbers of any length (phone numbers, dates) and tokens that ``often`` or more rows have."""
    counted = docs.select("text").mapInArrow(_sampled(least), "label int, code int, token string, n long")
    counted = written(counted.groupBy("label", "code", "token").agg(F.sum("n").alias("n")), "samples")
    tokens = counted.filter(F.col("token").isNotNull() & (F.col("n") >= often)).select("token", "n")
    tokens = tokens.mapInArrow(_weighted, "label int, code int, n long")
    return counted.filter("token is null").select("label", "code", "n").unionByName(tokens).groupBy("label", "code").agg(F.sum("n").alias("n"))


def joined_words(pairs: np.ndarray, first: np.ndarray, last: np.ndarray, share: float = 0.1) -> np.ndarray:
    """Bigrams of identifiers made of words with these bigrams, first and last characters: ``share`` of the
    words again in capitals, with one capital, and next to a separator, a digit or a capital."""
    small_letters, capitals, digits, marks = (np.array([c in group for c in map(chr, SYMBOLS)]) for group in (
        "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_=-"))
    low, up, dig, sep = map(np.flatnonzero, (small_letters, capitals, digits, marks))
    within = sum(pairs[np.ix_(a, b)] for a in (low, up) for b in (low, up))
    starts, ends = first[low] + first[up], last[low] + last[up]
    opening = within * (starts / np.maximum(within.sum(axis=1), 1))[:, None]
    beginning = starts / max(starts.sum(), 1)
    made = np.zeros_like(pairs)
    made[np.ix_(up, up)] += within
    made[np.ix_(up, low)] += opening
    for case in (low, up):
        made[np.ix_(case, sep)] += ends[:, None] / len(sep)
        made[np.ix_(sep, case)] += starts[None, :] / len(sep) / 2
        made[np.ix_(case, dig)] += ends[:, None] / len(dig) / 5
        made[np.ix_(dig, case)] += beginning[None, :] * last[dig][:, None] / 20
    made[np.ix_(low, up)] += ends[:, None] * beginning[None, :] / 2
    made[np.ix_(dig, sep)] += last[dig][:, None] / len(sep)
    made[np.ix_(sep, dig)] += starts.sum() / len(sep) / len(dig) / 5
    return share * made


@dataclass
class MarkovModels:
    """Log-likelihood ratio of each bigram, random against ordinary."""

    ratio: np.ndarray

    @classmethod
    def fit(cls, counts: np.ndarray, backing: float = 20.0, uniform: float = 0.5) -> MarkovModels:
        """``counts``: 2 x CODES. Pairs are backed by single characters (each seen half a time
        more than it was); the random model is mixed with a uniform one, so that an alphabet that
        no sample has is not held against a token; the ordinary one has words joined to identifiers."""
        n = len(SYMBOLS)
        pairs = counts[:, : n * n].reshape(2, n, n).astype(float)
        pairs[1] += joined_words(pairs[1], counts[1, n * n : -n], counts[1, -n:])
        single = pairs.sum(axis=1) + 0.5
        single /= single.sum(axis=1, keepdims=True)
        p = (pairs + backing * single[:, None, :]) / (pairs.sum(axis=2, keepdims=True) + backing)
        random = (1 - uniform) * p[0] + uniform / n
        return cls(np.log(random) - np.log(p[1]))

    def sums(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of each token data[start:end]."""
        place = _PLACE[data]
        upto = np.r_[0.0, np.cumsum(self.ratio[place[:-1], place[1:]])]
        return upto[end - 1] - upto[start]


def _found(models, least: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for _, text, spans, start, end, data in _scan(batch.column(1), least, models.value, threshold):
                extra = []
                if text is not None:
                    extra = [(a, len(KINDS), z) for a, z, _ in _outside(text, spans, start, end, data)]
                named = [(s[0], s[1], f"{KINDS[s[1]]}:{s[0]}:{s[2]}") for s in spans]
                base = ",".join(x[2] for x in named)
                every = sorted(named + [(a, k, f"random:{a}:{z}") for a, k, z in extra])
                count = [sum(s[1] == k for s in spans) for k in range(len(KINDS))]
                rows.append((*count, hashlib.sha256(base.encode()).hexdigest(), ",".join(x[2] for x in every)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], *[pa.array(c, pa.string()) for c in columns[3:]]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def find_secrets(docs: DataFrame, least: int = 8, threshold: float = THRESHOLD, samples: DataFrame | None = None) -> DataFrame:
    """Secret spans of each whole text.

    Returns one row per row of ``docs``: ``doc_id``, ``n_assign``, ``n_access``,
    ``n_hex``, ``base_sha256`` (digest of the fixed forms' spans) and ``spans`` (all,
    as kind:start:end by start, then kind; ``random`` is the models' kind). Places
    are code points, the end is exclusive. The models judge every token of ``least``
    or more characters; the log-likelihood ratio summed over a token must reach
    ``threshold``, so a short token must be unlikelier per character. ``samples`` gives other
    counts (label, code, n); by default the corpus is counted first: two reads.
    A null or empty text has no spans; repeated rows get equal results; an empty
    table gives no rows; other columns are ignored.
    """
    counts = np.zeros((2, CODES), dtype=np.int64)
    # At most 2 x CODES rows.
    for row in (samples if samples is not None else bigram_counts(docs)).collect():
        counts[row["label"], row["code"]] = row["n"]
    models = docs.sparkSession.sparkContext.broadcast(MarkovModels.fit(counts))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _found(models, least, threshold), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
