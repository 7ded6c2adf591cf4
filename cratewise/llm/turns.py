"""Conversation structure repair as a shortest path, found by an auction.

A conversation of n rows spans a lattice: node (i, s) stands for "i rows used,
last role s", and each edit (Delete, Insert, Keep, Rerole) is an arc with an
integer cost. The auction keeps a price per node, never above the cost of an arc
plus the price behind it. A path grows from its origin: its last node either
takes its best arc (extension), or, if its price is too low for that, raises the
price and is given up (contraction). Origins are taken from the last layer to
the first and the prices stay, so a path ends as soon as it meets a node that is
settled. Then every price is the exact distance to the end, the arcs whose cost
equals the fall in price are the tight ones, and following the least letter
among them gives the ASCII-least of the cheapest edit strings.

Rows are sorted over ranges of (conversation, turn), so a conversation of any
length is spread over tasks and cut into blocks of bounded size. One that lies
in one block, off the edges of its range, is repaired on the spot. The others
are repaired block by block: each block's prices for each way out are found in
parallel, short rows with these numbers are chained backwards for the true
prices at the cuts, each block is traced from each way in, and a last ordered
pass streams the blocks of a conversation through one running SHA-256. Nothing
holds more than a block of a conversation's rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cratewise.llm.stores import written
from cratewise.llm.words import small

# Rows and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 1024, 1 << 20

# Fixed values of the task: white space, end marks, costs, legal neighbours.
BLANKS, END_MARKS = " \t\n\x0b\x0c\r", ".!?"
DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5
LEGAL = {"su", "ua", "au"}

# Last role so far: none, system, user, assistant. What may follow, and its state.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {NONE: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
KEPT = {("s", NONE): SYSTEM, ("u", NONE): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
# Exits that each state can still reach, the cost of closing a conversation in it, and the letters for that.
AHEAD = {NONE: (NONE, SYSTEM, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT), USER: (USER, ASSISTANT), ASSISTANT: (USER, ASSISTANT)}
CLOSE = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
CLOSING = [INSERT * len(CLOSE[s]) for s in STATES]
NEVER = 1 << 60


def symbol(initial: str, fault: str) -> str:
    """What the lattice needs of a row: ``d`` for a row that must go, else its role's initial
    (``o`` for any other role), in capitals for a truncated row."""
    if fault in ("blank", "duplicate"):
        return "d"
    known = initial if initial in ("s", "u", "a") else "o"
    return known.upper() if fault == "truncated" else known


@lru_cache(maxsize=None)  # nine symbols
def arcs(of: str) -> list[list[tuple[str, int, int, int]]]:
    """Arcs (letter, cost, rows used, next state) out of each state before a row, letters ascending."""
    out = []
    for state in STATES:
        found = [("D", DELETE, 1, state), ("I", INSERT, 0, NEXT[state][1])]
        if of != "d":
            extra = UNFINISHED if of.isupper() else 0
            if (of.lower(), state) in KEPT:
                found.append(("K", extra, 1, KEPT[of.lower(), state]))
            found.append(("R", REROLE + extra, 1, NEXT[state][1]))
        out.append(found)
    return out


def converge(symbols: str, exits: list[int]) -> list[list[int]]:
    """Converged prices of all nodes: the distance to the end, where leaving in state s costs exits[s]."""
    n = len(symbols)
    open_states = [any(exits[e] < NEVER for e in AHEAD[s]) for s in STATES]
    price = [[0 if open_states[s] else NEVER for s in STATES] for _ in range(n)] + [list(exits)]
    settled = [[not open_states[s] for s in STATES] for _ in range(n)] + [[True] * 4]
    for i in range(n - 1, -1, -1):
        for origin in STATES:
            path = [(i, origin)]
            while not settled[i][origin]:
                at, state = path[-1]
                best, rows, to = min((cost + price[at + rows][to], rows, to) for _, cost, rows, to in arcs(symbols[at])[state])
                if best >= NEVER:
                    price[at][state], settled[at][state] = NEVER, True
                    path = path[:-1] or path
                elif price[at][state] < best:
                    price[at][state] = best
                    path = path[:-1] or path
                else:
                    path.append((at + rows, to))
                    if settled[at + rows][to]:
                        for layer, done in path:
                            settled[layer][done] = True
    return price


def trace(symbols: str, price: list[list[int]], state: int) -> tuple[str, int]:
    """The least letters along tight arcs from the first layer to the last, and the state there."""
    at, letters = 0, []
    while at < len(symbols):
        for letter, cost, rows, to in arcs(symbols[at])[state]:
            if price[at][state] == cost + price[at + rows][to]:
                letters.append(letter)
                at, state = at + rows, to
                break
    return "".join(letters), state


@lru_cache(maxsize=1 << 14)
def cheapest(symbols: str) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a whole conversation."""
    price = converge(symbols, CLOSING)
    letters, state = trace(symbols, price, NONE)
    return price[0][NONE], letters + CLOSE[state]


class Report:
    """Counts, edits and digest of one conversation, whose rows arrive in order."""

    def __init__(self) -> None:
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = self.cost = 0
        self.low = self.high = self.last = None
        self.state, self.audit, self.digest, self.empty = NONE, [], hashlib.sha256(), True

    def rows(self, turns: list, roles: list[str], faults: list[str]) -> None:
        for turn, role, fault in zip(turns, roles, faults):
            if fault:
                self.faults[fault] += 1
            if self.last is not None and self.last + role[:1] not in LEGAL:
                self.illegal += 1
            self.last = role[:1]
            if turn is not None:
                self.turns += turn != self.high
                self.low = turn if self.low is None else self.low
                self.high = turn

    def edit(self, letters: str, roles: list[str], texts: list[str]) -> None:
        self.audit.append(letters)
        at = 0
        for letter in letters:
            text = "" if letter == "I" else texts[at]
            if letter == "K":
                role, self.state = roles[at], KEPT[roles[at][:1], self.state]
            elif letter != "D":
                role, self.state = NEXT[self.state]
            if letter != "D":
                self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
                self.empty = False
            at += letter != "I"

    def result(self) -> tuple:
        gaps = 0 if self.low is None else int(self.high - self.low + 1 - self.turns)
        return (gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with planted faults, chosen by crc32 of ``conv_id:turn``
    modulo 20: 0 drops the row, 1 empties its text, 2 removes its end marks, 3 repeats it, 4 makes it a user's.

    A null is one space, in the key as in role and text; conv_id and turn stay null in the row.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    rows = conversations.select("conv_id", "turn", shown[2].alias("role"), shown[3].alias("text"), (F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", END_MARKS, "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1).cast("int"))
    return rows.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _own_fault(text: Column) -> Column:
    """What is wrong with a row by itself: blank, truncated or nothing."""
    seen = F.rtrim(text, F.lit(BLANKS))
    return F.when(seen == "", "blank").when(~F.right(seen, F.lit(1)).isin(*END_MARKS), "truncated").otherwise("")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Runs of a batch with the same first column: (it, rows without it). A long conversation comes in several runs."""
    for batch in small(batches, 256):
        columns = [c.to_pylist() for c in batch.columns]
        start = 0
        for i in range(1, batch.num_rows + 1):
            if i == batch.num_rows or columns[0][i] != columns[0][start]:
                yield columns[0][start], list(zip(*[c[start:i] for c in columns[1:]]))
                start = i


def _emit(kind: pa.Schema) -> Callable[[list[tuple]], pa.RecordBatch]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind.types)], schema=kind)

    return batch


def _arrow(schema: str) -> tuple[str, pa.Schema]:
    return schema, to_arrow_schema(StructType.fromDDL(schema))


def _repair_or_cut(emit: Callable[[list[tuple]], pa.RecordBatch]):
    """Repair conversations that lie in one block inside the range; cut the others into blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, done = TaskContext.get().partitionId(), 0, []
        key, rows, chars, whole = None, [], 0, False  # the first one may have begun in the range before

        def block() -> tuple:
            turns, roles, texts, own = map(list, zip(*rows))
            return (key, *[None] * 8, part, number, turns, roles, texts, own)

        def finished() -> tuple:
            turns, roles, texts, own = map(list, zip(*rows))
            seen, faults = set(), []
            for role, text, fault in zip(roles, texts, own):
                faults.append("duplicate" if fault != "blank" and (role, text) in seen else fault)
                seen.add((role, text))
            report = Report()
            report.rows(turns, roles, faults)
            report.cost, letters = cheapest("".join(symbol(r[:1], f) for r, f in zip(roles, faults)))
            report.edit(letters, roles, texts)
            return (key, *report.result(), *[None] * 6)

        for own_key, run_rows in _runs(batches):
            for row in run_rows:
                ends = rows and own_key != key
                full = rows and (len(rows) == BLOCK_ROWS or chars + len(row[2]) > BLOCK_CHARS)
                if ends and whole:
                    done.append(finished())
                elif ends or full:
                    yield emit([block()])
                if ends or full:
                    number, rows, chars, whole = number + 1, [], 0, bool(ends)
                key = own_key
                rows.append(row)
                chars += len(row[2])
                if len(done) >= 1024:
                    yield emit(done)
                    done = []
        if rows:  # the last one may go on in the next range
            yield emit([block()])
        if done:
            yield emit(done)

    return run


def _weigh(emit: Callable[[list[tuple]], pa.RecordBatch]):
    """Each block's faults, symbols, and the distance from each way in to each way out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, part, number, roles, own, firsts in zip(*[c.to_pylist() for c in batch.columns]):
                first = set(firsts or ())
                faults = [f if f == "blank" or i in first else "duplicate" for i, f in enumerate(own)]
                symbols = "".join(symbol(r[:1], f) for r, f in zip(roles, faults))
                ways = [converge(symbols, [0 if e == out_state else NEVER for e in STATES])[0] for out_state in STATES]
                out.append((conv, part, number, faults, symbols, [ways[e][s] for s in STATES for e in STATES]))
            if out:
                yield emit(out)

    return run


def _chain_back(emit: Callable[[list[tuple]], pa.RecordBatch]):
    """From the last block of a conversation to its first: the prices behind each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, exits = object(), CLOSING
        for own_key, rows in _runs(batches):
            if own_key != key:
                key, exits = own_key, CLOSING
            out = []
            for part, number, ways in rows:
                out.append((part, number, exits))
                exits = [min(NEVER, *(ways[4 * s + e] + exits[e] for e in STATES)) for s in STATES]
            yield emit(out)

    return run


def _traced(emit: Callable[[list[tuple]], pa.RecordBatch]):
    """Each block's edits, end and cost from each way in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, number, symbols, faults, exits in zip(*[c.to_pylist() for c in batch.columns]):
                price = converge(symbols, exits)
                found = [trace(symbols, price, s) if price[0][s] < NEVER else ("", s) for s in STATES]
                out.append((part, number, faults, [a for a, _ in found], [e for _, e in found], price[0]))
            if out:
                yield emit(out)

    return run


def _chain_forth(emit: Callable[[list[tuple]], pa.RecordBatch]):
    """From the first block to the last: counts, edits and the running digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, report = None, None

        def done() -> pa.RecordBatch:
            report.edit(CLOSE[report.state], [], [])
            return emit([(key, *report.result())])

        for own_key, rows in _runs(batches):
            if report is not None and own_key != key:
                yield done()
                report = None
            for turns, roles, texts, faults, letters, ends, costs in rows:
                if report is None:
                    key, report = own_key, Report()
                    report.cost = costs[NONE]
                entered = report.state
                report.rows(turns, roles, faults)
                report.edit(letters[entered], roles, texts)
                assert report.state == ends[entered]
        if report is not None:
            yield done()

    return run


def _repair_blocks(blocks: DataFrame, kind: str) -> DataFrame:
    """Results of the conversations that were cut into blocks."""
    where = ["part", "number"]
    # The first row of each role and text in a conversation: by digest, counted down to one row per task.
    said = blocks.select("conv_id", *where, F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "row"))
    same = F.sha2(F.concat_ws("\x00", F.length("row.roles"), "row.roles", "row.texts"), 256)
    firsts = (
        said.groupBy("conv_id", same.alias("same")).agg(F.min(F.struct(*where, "pos")).alias("at"))
        .groupBy("at.part", "at.number").agg(F.collect_list("at.pos").alias("firsts"))  # at most a block's rows
    )
    schema, arrow = _arrow(f"conv_id {kind}, part int, number long, faults array<string>, symbols string, ways array<long>")
    weighed = written(
        blocks.select("conv_id", *where, "roles", "own").join(firsts, where, "left").select("conv_id", *where, "roles", "own", "firsts")
        .mapInArrow(_weigh(_emit(arrow)), schema), "weighed"
    )
    schema, arrow = _arrow("part int, number long, exits array<long>")
    exits = (
        weighed.select("conv_id", *where, "ways").repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("part").desc(), F.col("number").desc()).mapInArrow(_chain_back(_emit(arrow)), schema)
    )
    schema, arrow = _arrow("part int, number long, faults array<string>, letters array<string>, ends array<int>, costs array<long>")
    traced = (
        weighed.join(exits, where).select(*where, "symbols", "faults", "exits").mapInArrow(_traced(_emit(arrow)), schema)
    )
    schema, arrow = _arrow(f"conv_id {kind}, {RESULT}")
    return (
        blocks.select("conv_id", *where, "turns", "roles", "texts").join(traced, where).repartition("conv_id")
        .sortWithinPartitions("conv_id", *where)
        .select("conv_id", "turns", "roles", "texts", "faults", "letters", "ends", "costs")
        .mapInArrow(_chain_forth(_emit(arrow)), schema)
    )


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``): the faults
    found, the cheapest edits that give the role order ``(s?(ua)+)?`` and the repaired text's digest.

    Other columns are ignored. Null role or text is one space; a null conv_id is
    a conversation of its own; null turns come first and are not counted for
    gaps. Rows of one turn are ordered by role and by SHA-256 of the text, so
    repeated rows are neighbours and the later ones duplicates. Empty or blank
    text is the fault ``blank``. A role's initial is its first character; roles
    other than s..., u... and a... can only be deleted or reroled. An empty
    table gives no rows.

    Columns: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost`` (longs), ``audit`` (initials of the edits in order, the
    ASCII-least of the cheapest), ``repaired_sha256`` (of ``role:text`` lines).
    """
    kind, turn_kind = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    text = F.coalesce(F.col("text"), F.lit(" "))
    ready = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"), _own_fault(text).alias("own"),
        F.sha2(text, 256).alias("tie"), F.monotonically_increasing_id().alias("place"),
    )
    order = ["conv_id", "turn", "role", "tie"]
    schema, arrow = _arrow(
        f"conv_id {kind}, {RESULT}, part int, number long, turns array<{turn_kind}>, roles array<string>, texts array<string>, own array<string>"
    )
    # The place parts equal rows only: even they need not share a task.
    cut = written(
        ready.repartitionByRange(*order, "place").sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "own")
        .mapInArrow(_repair_or_cut(_emit(arrow)), schema), "conversations"
    )
    results = [c.split()[0] for c in RESULT.split(", ")]
    finished = cut.filter("part is null").select("conv_id", *results)
    return finished.unionByName(_repair_blocks(cut.filter("part is not null"), kind))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """``repair`` of the ``damaged`` rows, one row for every conv_id of ``conversations``; one that
    lost all its rows has zeros, an empty audit and the digest of the empty string."""
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    found = repair(damaged(conversations))
    joined = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zero = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return joined.select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, zero.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns[1:]]
    )
