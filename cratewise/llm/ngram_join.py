"""N-gram Jaccard join by vertical partitioning.

Sets are the distinct word n-grams of whole texts, as 64-bit hashes. The global
order of n-grams (their hash order) is cut into fragments; what two sets share
is counted fragment by fragment and summed per pair.

1. *Sets.* One numpy pass per Arrow batch yields each text's sorted n-gram
   hashes, their number, and a 128-bit class id: texts with equal sets are one
   class from here on, so copies are never paired.
2. *Leading fragments.* A set of n n-grams lacks at most ``n - ceil(t n)`` of
   them in a partner. Only the leading part of the order is looked at: a class
   with too few n-grams there that occur in another text cannot have a partner
   and is dropped. N-grams repeated inside a batch are credited on the spot and
   sent once, so a frequent one costs a row per batch, not per text.
3. *Candidates.* For the classes that stay, exact document frequencies give the
   usual prefix (rarest first): partners share an n-gram of both prefixes. Each
   class is paired with one pivot per prefix n-gram, never all with all.
4. *Partial overlaps.* Pairs meet the segments of both sides; overlaps are
   counted per fragment and summed per pair.
5. *The rest.* Prefix groups that still hold several components are searched
   again, equal groups once. A pair survives only if the size bound and a parity
   bitmap (popcount of the xor never exceeds the symmetric difference) allow the
   similarity; both are safe, so no link between different components is lost.
   Members of a large group carry their segments: a task counts the partial
   overlaps of two blocks, unites what it links, and returns less links than the
   blocks have members. First blocks by themselves, then, for groups that are
   still apart, blocks with each other. Of what is then left, the allowed pairs
   of a small group (a bounded number) are counted as in step 4.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.stores import components, free_name, written
from cratewise.llm.words import NOT_SPACE, U, mix, small, windows, word_slices

# The leading part of the order, as a share of all hashes.
LEAD = 0.375
LEAD_END = int(LEAD * 2**64)
# N-grams that one task holds at a time.
PER_TASK = 1_000_000
# Fragments of the overlap count, bits of a bitmap.
FRAGMENTS, BITS = 4, 2048
# Step 5: members of a small group, members and n-grams of a block, pairs verified at a time.
SMALL, BLOCK, BLOCK_GRAMS, AT_ONCE = 32, 1024, 1 << 22, 64


def grams_of(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes) of each text; a shorter text is one n-gram."""
    for at, to, words in word_slices(column, NOT_SPACE):
        full = windows(words.hashes, size)
        for r in range(to - at):
            a, z = int(words.first[r]), int(words.first[r + 1])
            if z - a >= size:
                found = np.sort(full[a : z - size + 1])
                yield at + r, found[np.r_[True, found[1:] != found[:-1]]]
            else:
                yield at + r, windows(words.hashes[a:z], z - a) if z > a else np.zeros(0, dtype=U)


def class_id(grams: np.ndarray) -> bytes:
    """128 bits that depend on the set alone."""
    salts = U(0x243F6A8885A308D3), U(0x13198A2E03707344)
    return b"".join(int(mix(grams ^ s).sum(dtype=U)).to_bytes(8, "big") for s in salts)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            n, cid, node, lead = [], [], [], []
            for _, grams in grams_of(batch.column(1), size):
                key = class_id(grams) if len(grams) else None
                n.append(len(grams))
                cid.append(key)
                node.append(int.from_bytes(key[:8], "big", signed=True) if key else None)
                lead.append(grams[: np.searchsorted(grams, U(LEAD_END))].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cid, pa.binary()), pa.array(node, pa.int64()),
                 pa.array([len(x) // 8 for x in lead], pa.int64()), pa.array(lead, pa.binary())],
                ["doc_id", "n", "cid", "node", "n_lead", "lead"],
            )

    return run


def gram_sets(docs: DataFrame, size: int) -> DataFrame:
    """One row per text: ``doc_id``, set size ``n``, class ``cid``, and the leading hashes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _sets(size), f"doc_id {kind}, n long, cid binary, node long, n_lead long, lead binary"
    )


def _lead_pieces(fragments: int):
    """Send each n-gram of a batch to its fragment: with its text if it occurs in
    one text of the batch, once and without texts if in several."""
    def pieces(nodes: np.ndarray, grams: np.ndarray, owner: np.ndarray) -> pd.DataFrame:
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        edge = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        count = np.diff(np.r_[edge, len(grams)])
        many = np.repeat(count > 1, count)
        credit = np.bincount(owner[many], minlength=len(nodes)).astype(np.uint32)
        one, one_owner, seen = grams[~many], owner[~many].astype(np.uint32), grams[edge[count > 1]]
        cuts = np.array([LEAD_END * f // fragments for f in range(1, fragments)], dtype=U)
        a, b = np.r_[0, np.searchsorted(one, cuts), len(one)], np.r_[0, np.searchsorted(seen, cuts), len(seen)]
        share = np.arange(len(nodes)) % fragments
        rows = []
        for f in range(fragments):
            part = one_owner[a[f] : a[f + 1]]
            used, local = np.unique(part, return_inverse=True)
            own = np.flatnonzero((share == f) & (credit > 0))
            rows.append((
                f, one[a[f] : a[f + 1]].tobytes(), local.astype(np.uint16).tobytes(), nodes[used].tobytes(),
                seen[b[f] : b[f + 1]].tobytes(), nodes[own].tobytes(), credit[own].tobytes(),
            ))
        return pd.DataFrame(rows, columns=["fragment", "one", "owner", "nodes", "seen", "own", "credit"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.drop_duplicates("node")
            sizes, start = np.cumsum(frame["n_lead"].to_numpy()), 0
            while start < len(frame):
                base = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, base + PER_TASK, side="right")))
                stop = min(stop, start + (1 << 16))
                part = frame.iloc[start:stop]
                grams = np.frombuffer(b"".join(part["lead"]), dtype=U)
                if len(grams):
                    owner = np.repeat(np.arange(len(part)), part["n_lead"].to_numpy())
                    yield pieces(part["node"].to_numpy(np.int64), grams, owner)
                start = stop

    return run


def _shared_in_fragment(fragments: int):
    """Per text, its n-grams of the fragment that some other text has too, in as many
    packed rows as there are fragments at most."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        ids, counts = _fragment_counts(frame)
        to = (mix(ids.view(U)) % U(fragments)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        ids, counts, to = ids[order], counts[order], to[order]
        edge = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, dtype=int)
        return pd.DataFrame(
            [(int(to[a]), ids[a:z].tobytes(), counts[a:z].tobytes()) for a, z in zip(edge, [*edge[1:], len(to)])], columns=["part", "nodes", "counts"]
        )

    return run


def _sum_shared(frame: pd.DataFrame) -> pd.DataFrame:
    nodes = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in frame["nodes"]])
    counts = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in frame["counts"]])
    ids, place = np.unique(nodes, return_inverse=True)
    return pd.DataFrame({"node": ids, "shared": np.bincount(place, weights=counts).astype(np.int64)})


def _fragment_counts(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    one = [np.frombuffer(x, dtype=U) for x in frame["one"]]
    nodes = [np.frombuffer(x, dtype=np.int64) for x in frame["nodes"]]
    owner = [names[np.frombuffer(x, dtype=np.uint16)] for names, x in zip(nodes, frame["owner"])]
    grams, owner = np.concatenate(one), np.concatenate(owner)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    double = np.zeros(len(grams), dtype=bool)
    if len(grams):
        same = grams[1:] == grams[:-1]
        double[1:] |= same
        double[:-1] |= same
        seen = np.unique(np.concatenate([np.frombuffer(x, dtype=U) for x in frame["seen"]]))
        if len(seen):
            at = np.minimum(np.searchsorted(seen, grams), len(seen) - 1)
            double |= seen[at] == grams
    ids, counts = np.unique(owner[double], return_counts=True)
    own = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in frame["own"]])
    credit = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in frame["credit"]])
    return np.r_[ids, own], np.r_[counts, credit].astype(np.int64)


def shared_leading(sets: DataFrame) -> DataFrame:
    """(node, shared): how many leading n-grams of a class other texts have, at least."""
    total = sets.agg(F.sum("n_lead")).first()[0] or 0
    fragments = max(1, math.ceil(total / PER_TASK))
    return (
        sets.filter("n > 0").select("node", "n_lead", "lead")
        .mapInPandas(_lead_pieces(fragments), "fragment int, one binary, owner binary, nodes binary, seen binary, own binary, credit binary")
        .groupBy("fragment").applyInPandas(_shared_in_fragment(fragments), "part int, nodes binary, counts binary")
        .groupBy("part").applyInPandas(_sum_shared, "node long, shared long")
    )


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            cid, n, grams = [], [], []
            wanted = batch.column(0).to_pylist()
            for row, found in grams_of(batch.column(1), size):
                if len(found) and class_id(found) == wanted[row]:
                    cid.append(wanted[row])
                    n.append(len(found))
                    grams.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cid, pa.binary()), pa.array(n, pa.int64()), pa.array(grams, pa.binary())], ["cid", "n", "grams"])

    return run


def _each_once(frame: pd.DataFrame) -> pd.DataFrame:
    """Repeated rows of the table yield a class more than once; equal classes share a batch."""
    return frame.drop_duplicates("cid").sort_values("cid")


def _batch_grams(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of a batch in a fixed order: distinct n-grams, their counts, and where each n-gram is."""
    grams = np.frombuffer(b"".join(frame["grams"]), dtype=U)
    return np.unique(grams, return_inverse=True, return_counts=True)


def _counts(fragments: int):
    cuts = np.array([(1 << 64) * f // fragments for f in range(1, fragments)], dtype=U)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        distinct, _, count = _batch_grams(_each_once(frame))
        at = np.r_[0, np.searchsorted(distinct, cuts), len(distinct)]
        batch = int(frame["batch"].iloc[0])
        return pd.DataFrame(
            [(f, batch, distinct[at[f] : at[f + 1]].tobytes(), count[at[f] : at[f + 1]].astype(np.int64).tobytes()) for f in range(fragments)],
            columns=["fragment", "batch", "grams", "counts"],
        )

    return run


def _sum_counts(frame: pd.DataFrame) -> pd.DataFrame:
    """Add the counts of a fragment and give each batch the sums of its own n-grams."""
    grams = [np.frombuffer(x, dtype=U) for x in frame["grams"]]
    counts = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in frame["counts"]])
    distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
    sums = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(sums, place, counts)
    ends = np.cumsum([0] + [len(x) for x in grams])
    return pd.DataFrame({
        "batch": frame["batch"], "fragment": frame["fragment"],
        "freq": [sums[place[a:z]].tobytes() for a, z in zip(ends, ends[1:])],
    })


def _prefixes(percent: int):
    cuts = np.array([(1 << 64) * f // FRAGMENTS for f in range(1, FRAGMENTS)], dtype=U)

    def run(frame: pd.DataFrame, freq: pd.DataFrame) -> pd.DataFrame:
        frame = _each_once(frame)
        if frame.empty:
            return pd.DataFrame(columns=["cid", "n", "shared", "prefix", "bitmap", "segments"])
        _, place, _ = _batch_grams(frame)
        df = np.frombuffer(b"".join(freq.sort_values("fragment")["freq"]), dtype=np.int64)[place]
        rows, at = [], 0
        for cid, n, grams in zip(frame["cid"], frame["n"], frame["grams"]):
            own, often = np.frombuffer(grams, dtype=U), df[at : at + n]
            at += n
            shared = int((often > 1).sum())
            prefix = []
            if 100 * shared >= percent * n:
                size = n + (-percent * n) // 100 + 1
                first = np.lexsort((own, often))[:size]
                prefix = own[first[often[first] > 1]].view(np.int64).tolist()
            bits = np.bincount(((own >> U(20)) & U(BITS - 1)).astype(np.int64), minlength=BITS) & 1
            ends = np.r_[0, np.searchsorted(own, cuts), n]
            rows.append((cid, n, shared, prefix, np.packbits(bits.astype(bool)).tobytes(), [own[a:z].tobytes() for a, z in zip(ends, ends[1:])]))
        return pd.DataFrame(rows, columns=["cid", "n", "shared", "prefix", "bitmap", "segments"])

    return run


def _with_prefixes(full: DataFrame, percent: int) -> DataFrame:
    total = full.agg(F.sum("n")).first()[0] or 0
    # As many batches as fragments at most: the pieces between them stay large at first and few per batch.
    batches, fragments = max(1, math.ceil(2 * total / PER_TASK)), max(1, math.ceil(total / PER_TASK))
    dealt = full.withColumn("batch", F.pmod(F.xxhash64("cid"), F.lit(batches)).cast("int"))
    freq = (
        dealt.groupBy("batch").applyInPandas(_counts(fragments), "fragment int, batch int, grams binary, counts binary")
        .groupBy("fragment").applyInPandas(_sum_counts, "batch int, fragment int, freq binary")
    )
    return dealt.groupBy("batch").cogroup(freq.groupBy("batch")).applyInPandas(
        _prefixes(percent), "cid binary, n long, shared long, prefix array<long>, bitmap binary, segments array<binary>"
    )


def _partial_overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        count = [
            len(np.intersect1d(np.frombuffer(x, dtype=U), np.frombuffer(y, dtype=U), assume_unique=True))
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(count, pa.int64())], ["a", "b", "na", "nb", "common"])


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b, na, nb) whose overlap, summed over the fragments, reaches the similarity."""
    # Only sets with a prefix n-gram are in a pair; the others need not move.
    sets = sets.filter(F.size("prefix") > 0)
    left = sets.select(F.col("cid").alias("a"), F.col("segments").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("segments").alias("y"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", F.inline(F.arrays_zip("x", "y")))
    return (
        met.mapInArrow(_partial_overlap, "a binary, b binary, na long, nb long, common long")
        .groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
        .filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common")))
        .select("a", "b", "common", (F.col("na") + F.col("nb") - F.col("common")).alias("union"))
    )


class _Side:
    """Members of a prefix group as arrays."""

    def __init__(self, members: list):
        self.cid = [m["cid"] for m in members]
        self.n = np.array([m["n"] for m in members], dtype=np.int64)
        self.shared = np.array([m["shared"] for m in members], dtype=np.int64)
        self.bits = np.frombuffer(b"".join(m["bitmap"] for m in members), dtype=U).reshape(len(members), -1)
        self.component = [m["component"] for m in members]

    def allowed(self, one: "_Side", i: int, among: np.ndarray, percent: int) -> np.ndarray:
        """Those of ``among`` that may be similar to member ``i`` of ``one``."""
        size = one.n[i] + self.n[among]
        fits = (100 + percent) * np.minimum(one.shared[i], self.shared[among]) >= percent * size
        among, size = among[fits], size[fits]
        apart = np.bitwise_count(self.bits[among] ^ one.bits[i]).sum(axis=1, dtype=np.int64)
        # |x ^ y| <= (100 - t) / (100 + t) (|x| + |y|) is the same as Jaccard >= t %.
        return among[(100 + percent) * apart <= (100 - percent) * size]


def _overlaps(own: list[bytes], others: list[list[bytes]]) -> np.ndarray:
    """What a set shares with each of the others, counted fragment by fragment and summed."""
    total = np.zeros(len(others), dtype=np.int64)
    for f, segment in enumerate(own):
        mine = np.frombuffer(segment, dtype=U)
        if not len(mine):
            continue
        grams = np.frombuffer(b"".join(o[f] for o in others), dtype=U)
        hit = mine[np.minimum(np.searchsorted(mine, grams), len(mine) - 1)] == grams
        ends = np.cumsum([0] + [len(o[f]) // 8 for o in others])
        total += np.diff(np.r_[0, np.cumsum(hit)][ends])
    return total


def _united(percent: int):
    """Links between two blocks of a large group, enough to connect what is similar; at most one
    less than the components that the members had before."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for one, two, same in zip(frame["one"], frame["two"], frame["same"]):
                left, right = _Side(one), _Side(two)
                numbers = {c: i for i, c in enumerate(sorted({*left.component, *right.component}))}
                here = np.array([numbers[c] for c in left.component])
                there = here if same else np.array([numbers[c] for c in right.component])
                segments, rows = [m["segments"] for m in two], []
                for i in range(len(one)):
                    later = np.arange(i + 1 if same else 0, len(two))
                    among = right.allowed(left, i, later[there[later] != here[i]], percent)
                    while len(among):
                        part = among[:AT_ONCE]
                        common = _overlaps(one[i]["segments"], [segments[j] for j in part])
                        union = left.n[i] + right.n[part] - common
                        for j in part[100 * common >= percent * union]:
                            if there[j] != here[i]:
                                rows.append((left.cid[i], right.cid[j]))
                                gone = there[j]
                                there[there == gone] = here[i]
                                here[here == gone] = here[i]
                        among = among[len(part):]
                        among = among[there[among] != here[i]]
                yield pd.DataFrame(rows, columns=["a", "b"])

    return run


def _small_pairs(percent: int):
    """Pairs of a small group, in different components, that both bounds allow."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for members in frame["members"]:
                side = _Side(sorted(members, key=lambda m: m["cid"]))
                for i in range(len(members)):
                    later = [j for j in range(i + 1, len(members)) if side.component[j] != side.component[i]]
                    for j in side.allowed(side, i, np.array(later, dtype=np.int64), percent):
                        rows.append((side.cid[i], side.cid[j], side.n[i], side.n[j]))
            yield pd.DataFrame(rows, columns=["a", "b", "na", "nb"]).drop_duplicates(["a", "b"])

    return run


def _pivot_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    pivots = written(
        buckets.groupBy("gram").agg(F.min(F.struct("cid", "n", "shared")).alias("p"), F.count("*").alias("size")).filter("size > 1"), "pivots"
    )
    bound = (100 + percent) * F.least("shared", "p.shared") >= percent * (F.col("n") + F.col("p.n"))
    return (
        buckets.join(pivots, "gram").filter(F.col("cid") != F.col("p.cid")).filter(bound)
        .select(F.col("p.cid").alias("a"), F.col("cid").alias("b"), F.col("p.n").alias("na"), F.col("n").alias("nb")).distinct()
    )


def _open_groups(buckets: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members with their components, the prefix groups that hold several (equal groups once),
    and the links in short: every class and the least of its component."""
    found = written(components(links), "found")
    named = buckets.join(found.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = written(named, "named")
    groups = (
        named.groupBy("gram").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"), F.sum("n").alias("grams"),
            F.bit_xor(F.xxhash64("cid")).alias("x"), F.sum(F.xxhash64(F.lit(1), "cid").cast("decimal(20,0)")).alias("y"),
        ).filter("low <> high").groupBy("size", "grams", "x", "y").agg(F.min("gram").alias("gram")).select("gram", "size", "grams")
    )
    return named, written(groups, "open"), found.select(F.col("id").alias("a"), F.col("component").alias("b")).filter("a <> b")


def _large_links(named: DataFrame, groups: DataFrame, sets: DataFrame, percent: int, across: bool) -> DataFrame:
    """Links inside the blocks of large groups, or ``across`` the blocks of groups with several."""
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    wanted = groups.filter(F.col("size") > SMALL).select("gram", blocks.alias("blocks")).filter("blocks > 1" if across else "true")
    members = (
        named.join(wanted, "gram").join(sets.select("cid", "bitmap", "segments"), "cid")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        .groupBy("gram", "block").agg(F.collect_list(F.struct("cid", "component", "n", "shared", "bitmap", "segments")).alias("members"))
    )
    if across:
        members = written(members, "blocks")
        one = members.select("gram", F.col("block").alias("p"), F.col("members").alias("one"))
        two = members.select("gram", F.col("block").alias("q"), F.col("members").alias("two"))
        met = one.join(two, "gram").filter("p < q").select("one", "two", F.lit(False).alias("same"))
    else:
        met = members.select(F.col("members").alias("one"), F.col("members").alias("two"), F.lit(True).alias("same"))
    return written(met.mapInPandas(_united(percent), "a binary, b binary"), "large-links")


def _small_links(named: DataFrame, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the small groups that are still open."""
    members = (
        named.join(groups.filter(F.col("size") <= SMALL).select("gram"), "gram").join(sets.select("cid", "bitmap"), "cid")
        .groupBy("gram").agg(F.collect_list(F.struct("cid", "component", "n", "shared", "bitmap")).alias("members"))
    )
    pairs = members.select("members").mapInPandas(_small_pairs(percent), "a binary, b binary, na long, nb long").distinct()
    return written(linked(pairs, sets, percent).select("a", "b"), "small-links")


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Groups of texts whose word n-gram sets are linked by Jaccard >= ``percent`` %.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Returns one
    row per input row: ``doc_id``, ``n_shingles`` (set size), ``component_id``
    (the smallest doc_id reachable by links, itself included) and ``copies``
    (rows with an equal set).

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer
    than ``size`` words is one n-gram; a null, empty or blank text has none and
    is linked with nothing. Repeated rows are copies of each other. A doc_id on
    several texts is a member of each text's component and takes the smallest
    component id of its own row's text. An empty table gives no rows. Null
    doc_ids belong to their text's component and never name one (null only if
    no member has an id).
    """
    sets = written(gram_sets(docs, size), "sets")
    classes = written(
        sets.filter("n > 0").groupBy("cid").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("node").alias("node"),
            F.first("n_lead").alias("n_lead"), F.count("*").alias("copies"),
        ), "classes"
    )
    lacks = F.expr(f"n - ceil({percent} * n / 100)")
    stay = (
        classes.join(shared_leading(sets), "node", "left")
        .filter(F.coalesce("shared", F.lit(0)) >= F.col("n_lead") - lacks).select("cid", "rep")
    )
    texts = docs.select("doc_id", "text").join(stay.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("rep")))
    full = written(texts.select("cid", "text").mapInArrow(_full_sets(size), "cid binary, n long, grams binary"), "full")
    ready = written(_with_prefixes(full, percent), "ready")
    buckets = written(ready.select(F.explode("prefix").alias("gram"), "cid", "n", "shared"), "buckets")

    pairs = _pivot_pairs(buckets, percent)
    links = written(linked(pairs, ready, percent), "pivot-links")
    links = links.select("a", "b")
    named, groups, links = _open_groups(buckets, links)
    for across in (False, True):
        found = _large_links(named, groups, ready, percent, across)
        if not found.isEmpty():
            named, groups, links = _open_groups(buckets, links.unionByName(found))
    final = components(links.unionByName(_small_links(named, groups, ready, percent)))

    named = written(
        classes.join(final.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid")), "named-classes"
    )
    ids = written(named.groupBy("component").agg(F.min("rep").alias("component_id")), "component-ids")
    members = written(named.join(ids, "component").select("cid", "component_id", "copies"), "members")
    return sets.select("doc_id", "n", "cid").join(members, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with one row of each component: the smallest doc_id's, once.

    Rows without words are linked with nothing and stay, one of equal ones. Other
    columns, whatever their names, are returned as they are.
    """
    found = jaccard_components(docs, size, percent)
    name, digest = free_name(docs, "keep_id"), free_name(docs, "text_digest")
    keep = written(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct(), "keep")
    kept = docs.join(keep, docs["doc_id"].eqNullSafe(F.col(name)), "left_semi")
    return kept.withColumn(digest, F.sha2("text", 256)).dropDuplicates(["doc_id", digest]).drop(digest)
