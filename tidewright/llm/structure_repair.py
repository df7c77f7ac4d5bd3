"""Repair of damaged conversations by auction shortest paths.

A conversation's rows and the role grammar ``(s?(ua)+)?`` span a lattice of nodes (rows consumed, grammar state) with
integer arc costs: Keep 0, Rerole 2, Delete 3, Insert 2, and 1 more for a truncated row that stays. The auction
algorithm solves it: every node has a price; the path from the origin is extended along the arc that is tight at the current prices,
and where none is, the price of its last node rises to the cheapest offer and the path contracts. Prices start from the costs
that no edit avoids and persist from one origin to the next. At the end the price of the origin is the least cost
and every cheapest path consists of tight arcs (cost = difference of prices), so the edits that read
ASCII-least are traced greedily over the tight arcs that still reach the end.

Conversations may be of any length. Rows are numbered in range partitions and cut into blocks of ``BLOCK`` rows. Of longer
conversations every block gives the least costs between its entry and exit states (the same auction, one goal
after the other); these are the arcs of a small lattice per conversation, whose prices are then the exit prices
of each block. Blocks are traced apart, from each state that a cheapest path may enter them in. Equal blocks
are solved once a task. The texts of a conversation are only read in order, row by row, for the digest.

Null role or text counts as one space, and so do nulls in the key of the damage. Rows of one turn are ordered by their
content keys, so reruns agree. A role of no characters keeps the grammar state and adds no initial; other unknown
initials must be reroled or deleted. Conversations without rows give zeros, no edits and the digest of nothing; rows without
conv_id form one conversation. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewright.llm.common import saved, small_batches
from tidewright.llm.turns import content_keys, numbered

WHITE = " \t\n\x0b\x0c\r"
#: Rows of a block; solved blocks that a task keeps.
BLOCK, KEPT = 64, 20_000
KEEP, REROLE, DELETE, INSERT, STUMP = 0, 2, 3, 2, 1
OK, TRUNCATED, BLANK, DUPLICATE = "o", "t", "b", "d"

#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES, START, ENDS = 4, 0, (0, 3)
EXPECTED = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
KEPT_STATE = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2} | {(q, "e"): q for q in range(STATES)}
LEGAL = {"su", "ua", "au"}
SINK = -1


class Lattice:
    """Edits of one block. ``initials`` has s, u, a, x (other) or e (none) a row, ``faults`` o, t, b or d.

    ``exits`` are the costs from each state behind the block to the goal, None where there is no way. Without
    ``tail`` no insertion stands behind the last row; it then belongs to the block that follows.
    """

    def __init__(self, initials: str, faults: str, exits: tuple, tail: bool):
        self.n, self.exits = len(initials), exits
        n, size = self.n, STATES * (self.n + 1)
        arcs: list[list[tuple[str, int, int]]] = [[] for _ in range(size)]
        for i, (initial, fault) in enumerate(zip(initials, faults)):
            stump = STUMP if fault == TRUNCATED else 0
            for q in range(STATES):
                node, following = STATES * i + q, STATES * (i + 1)
                arcs[node].append(("D", DELETE, following + q))
                arcs[node].append(("I", INSERT, STATES * i + EXPECTED[q]))
                if fault not in (BLANK, DUPLICATE):
                    if (q, initial) in KEPT_STATE:
                        arcs[node].append(("K", KEEP + stump, following + KEPT_STATE[q, initial]))
                    arcs[node].append(("R", REROLE + stump, following + EXPECTED[q]))
        for q in range(STATES):
            if tail:
                arcs[STATES * n + q].append(("I", INSERT, STATES * n + EXPECTED[q]))
            if exits[q] is not None:
                arcs[STATES * n + q].append(("", exits[q], SINK))
        # Arcs to nodes without any way to the goal would let prices rise for ever.
        alive = self._reach(arcs, lambda node, arc: True)
        self.arcs = [[a for a in out if a[2] == SINK or alive[a[2]]] for out in arcs]
        self.alive = alive
        # First prices: what no path avoids from here on. They meet every arc's cost, as an auction asks.
        least = min((e for e in exits if e is not None), default=0)
        self.prices = [0] * size + [0]
        for i in range(n, -1, -1):
            if i < n:
                least += DELETE if faults[i] in (BLANK, DUPLICATE) else STUMP if faults[i] == TRUNCATED else 0
            self.prices[STATES * i:STATES * (i + 1)] = [least] * STATES

    def _reach(self, arcs, usable) -> list[bool]:
        """Nodes with a way to the goal over usable arcs."""
        good = [False] * (STATES * (self.n + 1))
        for i in range(self.n, -1, -1):
            for _ in range(3):  # insertions stay within the rank: at most two in a row lead to a new state
                for node in range(STATES * i, STATES * (i + 1)):
                    good[node] = good[node] or any((a[2] == SINK or good[a[2]]) and usable(node, a) for a in arcs[node])
        return good

    def cost(self, state: int) -> int | None:
        """Least cost from ``state`` before the first row, by extending and contracting one path."""
        if not self.alive[state]:
            return None
        prices, arcs, path = self.prices, self.arcs, [state]
        while True:
            node = path[-1]
            offer, head = min((cost + prices[to], to) for _, cost, to in arcs[node])
            if prices[node] < offer:
                prices[node] = offer
                if len(path) > 1:
                    path.pop()
            elif head == SINK:
                return prices[state]
            else:
                path.append(head)

    def traces(self, states: list[int]) -> dict[int, tuple[str, int]]:
        """(edits, exit state) from each of the states, the ASCII-least of the cheapest; call after :meth:`cost`."""
        prices = self.prices

        def tight(node, arc):
            return prices[node] == arc[1] + prices[arc[2]]

        good, out = self._reach(self.arcs, tight), {}
        for state in states:
            node, letters = state, []
            while True:
                letter, _, to = min(a for a in self.arcs[node] if tight(node, a) and (a[2] == SINK or good[a[2]]))
                if to == SINK:
                    break
                letters.append(letter)
                node = to
            out[state] = "".join(letters), node % STATES
        return out


def crossing(initials: str, faults: str) -> list[int | None]:
    """Least cost from each entry to each exit state of a block, row by row; None where there is no way."""
    out: list[int | None] = [None] * (STATES * STATES)
    for goal in range(STATES):
        lattice = Lattice(initials, faults, tuple(0 if q == goal else None for q in range(STATES)), tail=False)
        for state in range(STATES):
            out[STATES * state + goal] = lattice.cost(state)
    return out


def border_prices(blocks: list[list[int | None]], last: Lattice) -> list[tuple]:
    """Exit prices of every block but the last one: what it costs from there to the end, None where no cheapest path passes.

    ``blocks`` are the crossings of all blocks but the last; their arcs form a lattice of ranks, solved by the same auction.
    """
    ends = [last.cost(q) for q in range(STATES)]
    n = len(blocks)
    prices = [[0] * STATES for _ in range(n)] + [[e if e is not None else 0 for e in ends]]
    alive = [[False] * STATES for _ in range(n)] + [[e is not None for e in ends]]
    # Ranks only lead forward: nodes with a way to the goal, and a first price from the cheapest arc of each rank.
    for k in range(n - 1, -1, -1):
        for q in range(STATES):
            alive[k][q] = any(blocks[k][STATES * q + to] is not None and alive[k + 1][to] for to in range(STATES))
        floor = min(prices[k + 1][q] for q in range(STATES) if alive[k + 1][q])
        cheapest = min(c for c in blocks[k] if c is not None)
        prices[k] = [floor + cheapest] * STATES
    path = [(0, START)]
    while path[-1][0] < n:
        k, q = path[-1]
        offer, head = min((blocks[k][STATES * q + to] + prices[k + 1][to], to) for to in range(STATES)
                          if blocks[k][STATES * q + to] is not None and alive[k + 1][to])
        if prices[k][q] < offer:
            prices[k][q] = offer
            if len(path) > 1:
                path.pop()
        else:
            path.append((k + 1, head))
    # Only nodes on cheapest paths have exact prices: follow the tight arcs from the origin.
    reached, out = {START}, []
    for k in range(n):
        reached = {to for q in reached for to in range(STATES) if blocks[k][STATES * q + to] is not None and alive[k + 1][to]
                   and prices[k][q] == blocks[k][STATES * q + to] + prices[k + 1][to]}
        out.append((k, reached, prices[k + 1]))
    good, exits = set(reached), []
    for k, reached, after in reversed(out):
        if k < n - 1:
            good = {q for q in reached if any(
                blocks[k + 1][STATES * q + to] is not None and to in good
                and after[q] == blocks[k + 1][STATES * q + to] + out[k + 1][2][to] for to in range(STATES))}
        exits.append(tuple(after[q] if q in good else None for q in range(STATES)))
    return exits[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage (conv_id, turn, role, text), with their content keys a, b."""
    space = F.lit(" ")
    spot = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.col("kind")
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(spot.cast("binary")) % 20).alias("kind")).where(kind > 0)
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", *content_keys(F.col("role"), F.col("text")), F.explode("copies").alias("copy"))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "", "e").when(first.isin("s", "u", "a"), first).otherwise("x")


def _facts(rows: DataFrame) -> DataFrame:
    """Narrow rows (conv_id, position, total, turn, initial, fault), saved."""
    read = F.rtrim(F.col("text"), F.lit(WHITE))
    last = F.substring(read, -1, 1)
    narrow = rows.select("conv_id", "turn", "a", "b", _initial(F.col("role")).alias("initial"),
                         F.when(read == "", BLANK).when(last.isin(".", "!", "?"), OK).otherwise(TRUNCATED).alias("fault"))
    local, starts = numbered(narrow, "conv_id", ["turn", "a", "b"], "damaged")
    placed = saved(_match(local, starts, ["conv_id", "part"]).withColumn("position", F.col("before") + F.col("local") - 1)
                   .drop("part", "local", "before"), "placed")
    again = placed.groupBy("conv_id", "a", "b").agg(F.min("position").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    fault = (F.when((F.col("fault") != BLANK) & (F.col("position") > F.col("first")), DUPLICATE).otherwise(F.col("fault")))
    return saved(_match(placed, again, ["conv_id", "a", "b"], "left").withColumn("fault", fault).drop("first"), "facts")


def _match(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null conv_id meets itself."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    return left.join(named, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by], how).drop(*[f"_r_{c}" for c in by])


def _kept(function, kept: int = KEPT):
    """``function`` with a bounded memory; forget it with the task."""
    memory: dict = {}

    def call(*key):
        if key not in memory:
            if len(memory) >= kept:
                memory.clear()
            memory[key] = function(*key)
        return memory[key]
    return call


def _solve(initials: str, faults: str, exits: tuple, tail: bool, states: tuple) -> list[tuple]:
    """(entry state, edits, exit state, least cost from the entry to the end) of a block."""
    lattice = Lattice(initials, faults, exits, tail)
    costs = {q: c for q in states if (c := lattice.cost(q)) is not None}
    return [(q, *found, costs[q]) for q, found in lattice.traces(list(costs)).items()]


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    solve = _kept(crossing)
    for batch in batches:
        found = [solve(i, f) for i, f in zip(batch.column("initials").to_pylist(), batch.column("faults").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))],
                                         names=[*batch.schema.names, "costs"])


def _borders(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Exit prices of the blocks of each conversation, which come in order."""
    def flush():
        *front, last = held
        end = Lattice(last[2], last[3], tuple(0 if q in ENDS else None for q in range(STATES)), tail=True)
        exits = border_prices([h[4] for h in front], end)
        return pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in front], conv_type), pa.array([h[1] for h in front], pa.int64()),
             pa.array([list(e) for e in exits], pa.list_(pa.int64()))], names=["conv_id", "block", "exits"])

    held: list = []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "block", "initials", "faults", "costs")]):
            if held and held[0][0] != row[0]:
                yield flush()
                held = []
            held.append(row)
    if held:
        yield flush()


def _traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of each block from every state it may be entered in, as ``state:exit:cost:edits`` strings."""
    solve, end = _kept(_solve), tuple(0 if q in ENDS else None for q in range(STATES))
    for batch in batches:
        ways = []
        for initials, faults, exits, block in zip(*[batch.column(c).to_pylist() for c in ("initials", "faults", "exits", "block")]):
            found = solve(initials, faults, tuple(exits) if exits else end, exits is None, (START,) if block == 0 else tuple(range(STATES)))
            ways.append([f"{q}:{to}:{cost}:{edits}" for q, edits, to, cost in found])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), batch.column("initials"), pa.array(ways, pa.list_(pa.string()))],
                                         names=["conv_id", "block", "initials", "ways"])


def _read(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Edits, cost, illegal pairs and digest of each conversation: its blocks come first, then its rows, both in order."""
    done: list[tuple] = []
    names = ["conv_id", "cost", "illegal", "audit", "repaired_sha256"]
    types = [conv_type, pa.int64(), pa.int64(), pa.string(), pa.string()]

    def batch_of():
        columns = list(zip(*done)) or [[]] * len(names)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    class Reading:
        def __init__(self, conv_id):
            self.conv_id, self.state, self.cost, self.illegal, self.last = conv_id, START, None, 0, None
            self.edits, self.at, self.audit, self.digest, self.lines, self.role_state = [], 0, None, hashlib.sha256(), 0, START

        def block(self, initials, ways):
            for way in ways:
                q, to, cost, edits = way.split(":", 3)
                if int(q) == self.state:
                    break
            self.cost = int(cost) if self.cost is None else self.cost
            self.edits.append(edits)
            self.state = int(to)
            chain = ("" if self.last is None else self.last) + initials
            self.illegal += sum(chain[i:i + 2] not in LEGAL for i in range(len(chain) - 1))
            self.last = chain[-1]

        def line(self, role, text):
            self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode())
            self.lines += 1

        def inserted(self):
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.role_state = EXPECTED[self.role_state]
                self.line(ROLES[self.role_state], "")
                self.at += 1

        def row(self, role, text):
            if self.audit is None:
                self.audit = "".join(self.edits)
            self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "R":
                self.role_state = EXPECTED[self.role_state]
                self.line(ROLES[self.role_state], text)
            elif edit == "K":
                self.role_state = KEPT_STATE[self.role_state, role[:1] if role[:1] in ("s", "u", "a") else "e"]
                self.line(role, text)

        def close(self):
            self.inserted()
            done.append((self.conv_id, self.cost, self.illegal, self.audit, self.digest.hexdigest()))

    reading = None
    for batch in batches:
        for conv_id, initials, ways, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "initials", "ways", "role", "text")]):
            if reading is None or reading.conv_id != conv_id:
                if reading is not None:
                    reading.close()
                reading = Reading(conv_id)
            if ways is not None:
                reading.block(initials, ways)
            else:
                reading.row(role, text)
        yield batch_of()
    if reading is not None:
        reading.close()
        yield batch_of()


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = damaged(conversations)
    facts = _facts(rows)
    conv_ddl = conversations.schema["conv_id"].dataType.simpleString()
    conv_type = to_arrow_type(conversations.schema["conv_id"].dataType)

    letters = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", c))), lambda s: s[c]), "")
    blocks = saved(facts.groupBy("conv_id", F.floor(F.col("position") / BLOCK).alias("block")).agg(
        letters("initial").alias("initials"), letters("fault").alias("faults"), F.max("total").alias("total")), "blocks")
    long = blocks.where(F.col("total") > BLOCK).drop("total")
    crossed = long.mapInArrow(_crossings, f"conv_id {conv_ddl}, block long, initials string, faults string, costs array<long>")
    exits = (crossed.repartition("conv_id").sortWithinPartitions("conv_id", "block")
             .mapInArrow(partial(_borders, conv_type=conv_type), f"conv_id {conv_ddl}, block long, exits array<long>"))
    traced = _match(blocks, exits, ["conv_id", "block"], "left").select("conv_id", "block", "initials", "faults", "exits").mapInArrow(
        _traces, f"conv_id {conv_ddl}, block long, initials string, ways array<string>")

    none = lambda kind: F.lit(None).cast(kind)
    small_batches(conversations)
    order = ["block", "turn", "a", "b"]
    turn_type = conversations.schema["turn"].dataType
    stream = traced.select("conv_id", F.col("block").alias("block"), none(turn_type).alias("turn"), none("long").alias("a"),
                           none("long").alias("b"), "initials", "ways", none("string").alias("role"), none("string").alias("text"))
    stream = stream.union(rows.select("conv_id", F.lit(1 << 62).alias("block"), "turn", "a", "b", none("string"), none("array<string>"), "role", "text"))
    read = (stream.repartition("conv_id").sortWithinPartitions("conv_id", *order).select("conv_id", "initials", "ways", "role", "text")
            .mapInArrow(partial(_read, conv_type=conv_type), f"conv_id {conv_ddl}, cost long, illegal long, audit string, repaired_sha256 string"))

    turns = facts.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)])
    span = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count("turn")
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(span.cast("long"), F.lit(0)).alias("gaps"), F.sum(BLANK).alias("blank"), F.sum(DUPLICATE).alias("duplicate"),
        F.sum(TRUNCATED).alias("truncated"))
    ids = conversations.select("conv_id").distinct()
    zero = F.lit(0).cast("long")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    out = _match(_match(ids, counts, ["conv_id"], "left"), read, ["conv_id"], "left")
    return out.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
