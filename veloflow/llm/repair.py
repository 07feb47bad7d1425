"""Repair of conversation structure: the cheapest edits by the auction algorithm for shortest paths.

The rows of a conversation and four states of its pattern ``(s?(ua)+)?`` span a lattice: at a row one may keep it, give it
another role or delete it, and anywhere insert a turn; each arc moves to a state that the pattern allows. Every node has an
integer price. A path grows from an origin: where the price of its last node is below the cheapest arc and price ahead, the
price rises to that and the path is cut back by a node; else the path is extended along the cheapest arc. Prices never
exceed an arc's cost plus the price behind it, so that when the path arrives, the origin's price is its exact distance and
every cheapest path runs along tight arcs only. These are traced, the least letter first.

A long conversation is solved in stretches from its last rows to its first: the exits of a stretch lead to the goal at
the prices that the stretch behind it has found. So a path is never cut back over more than one stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = "\t\n\x0b\x0c\r "
#: Rows solved at once.
STRETCH = 64
#: States of the pattern: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Role that a state asks for next, and the state after it.
NEXT = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
ENDS = (START, ASSISTANT)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
FAR = 1 << 60

#: A row in one byte: 0 to 3 its initial (s, u, a, other), 4 added if truncated; 8 if blank or a duplicate.
OTHER, TRUNCATED, BAD = 3, 4, 8
INITIALS = {"s": 0, "u": 1, "a": 2}


def state_after(state: int, initial: int) -> int | None:
    """The state after a kept row with this initial, or nothing where the pattern forbids it."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def arcs(codes: bytes, exits: tuple[int, ...]) -> list[list[tuple[str, int, int]]]:
    """(letter, cost, node) of each arc out of each node, by letter; node 4 i + state lies before row i, the last is the goal."""
    goal = STATES * (len(codes) + 1)
    out: list[list[tuple[str, int, int]]] = []
    for i in range(len(codes) + 1):
        for state in range(STATES):
            here: list[tuple[str, int, int]] = []
            if i == len(codes) and exits[state] < FAR:
                here.append(("", exits[state], goal))
            if i < len(codes):
                here.append(("D", DELETE, STATES * (i + 1) + state))
            here.append(("I", INSERT, STATES * i + NEXT[state][1]))
            if i < len(codes) and codes[i] != BAD:
                extra = 1 if codes[i] & TRUNCATED else 0
                kept = state_after(state, codes[i] & 3)
                if kept is not None:
                    here.append(("K", KEEP + extra, STATES * (i + 1) + kept))
                here.append(("R", REROLE + extra, STATES * (i + 1) + NEXT[state][1]))
            out.append(here)
    return [*out, []]


def auction(out: list[list[tuple[str, int, int]]], origin: int, goal: int, prices: list[int]) -> None:
    """Raise ``prices`` until the origin's is its distance to the goal; no price exceeds any arc's cost plus the price behind."""
    path = [origin]
    while path[-1] != goal:
        last = path[-1]
        best, to = FAR, goal
        for _, cost, node in out[last]:
            if cost + prices[node] < best:
                best, to = cost + prices[node], node
        if prices[last] < best:
            prices[last] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


@lru_cache(maxsize=1 << 14)
def entry_prices(codes: bytes, exits: tuple[int, ...]) -> tuple[int, ...]:
    """Distances from the four states before a stretch to the goal, given those behind it."""
    return tuple(solved(codes, exits)[1][:STATES])


def solved(codes: bytes, exits: tuple[int, ...]) -> tuple[list[list[tuple[str, int, int]]], list[int]]:
    out = arcs(codes, exits)
    goal = len(out) - 1
    prices = [0] * len(out)
    for origin in range(STATES):
        auction(out, origin, goal, prices)
    return out, prices


@lru_cache(maxsize=1 << 14)
def traced(codes: bytes, exits: tuple[int, ...], state: int) -> tuple[str, int]:
    """The least letters along tight arcs from a state through a stretch, and the state where they leave it."""
    out, prices = solved(codes, exits)
    goal = len(out) - 1
    tight = [[(letter, node) for letter, cost, node in out[at] if prices[at] == cost + prices[node]] for at in range(goal)]
    into: list[list[int]] = [[] for _ in range(goal + 1)]
    for at, ways in enumerate(tight):
        for _, node in ways:
            into[node].append(at)
    leads, found = {goal}, [goal]
    while found:
        for at in into[found.pop()]:
            if at not in leads:
                leads.add(at)
                found.append(at)
    letters, at = [], state
    while True:
        letter, node = next((x, n) for x, n in tight[at] if n in leads)
        if node == goal:
            return "".join(letters), at % STATES
        letters.append(letter)
        at = node


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, letters) of the cheapest edits of rows in one byte each; of equal costs the least letters."""
    cuts = [codes[i : i + STRETCH] for i in range(0, len(codes), STRETCH)] or [b""]
    exits, cost = tuple(0 if s in ENDS else FAR for s in range(STATES)), 0
    behind = []
    for part in reversed(cuts):
        behind.append(exits)
        found = entry_prices(part, exits)
        # prices behind a stretch count from the least of them, so that they rise by what one stretch costs and no more
        cost += min(found)
        exits = tuple(p - min(found) for p in found)
    state, letters = START, []
    for part in cuts:
        more, state = traced(part, behind.pop(), state)
        letters.append(more)
    return cost + exits[START], "".join(letters)


def damaged(talks: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows after damage by ``crc32(conv_id:turn) % 20``; dropped ones are marked ``gone``.

    Nulls of conv_id and turn are one space in the key; a null role or text is one space.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    role = F.when(F.col("case") == 4, F.lit("user")).otherwise(blank("role"))
    text = F.when(F.col("case") == 1, F.lit("")).when(F.col("case") == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    marked = talks.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", case.alias("case"))
    twice = F.array_repeat(F.lit(1), F.when(F.col("case") == 3, 2).otherwise(1))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("case") == 0).alias("gone"), F.explode(twice).alias("copy")).drop("copy")


def ordered(text: Column) -> Column:
    """What rows of one turn and role are ordered by, and their texts known by."""
    return F.md5(text.cast("binary"))


def _solve(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, initial, fault) in order to one row for each conversation; a row is a byte of what is held."""
    state: dict = {}

    def begin(conv) -> dict:
        return {"conv": conv, "codes": bytearray(), "low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "last": None}

    def end(s: dict) -> tuple:
        gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
        cost, audit = cheapest(bytes(s["codes"]))
        return s["conv"], min(gaps, (1 << 63) - 1), s["blank"], s["duplicate"], s["truncated"], s["illegal"], cost, audit

    for batch in batches:
        rows = []
        for conv, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not state or conv != state["conv"]:
                if state:
                    rows.append(end(state))
                state = begin(conv)
            if fault == "gone":
                continue
            if turn is not None and turn != state["high"]:
                state["low"] = turn if state["low"] is None else state["low"]
                state["high"] = turn
                state["turns"] += 1
            if fault:
                state[fault] += 1
            if state["last"] is not None and state["last"] + initial not in ("su", "ua", "au"):
                state["illegal"] += 1
            state["last"] = initial
            code = INITIALS.get(initial, OTHER)
            state["codes"].append(BAD if fault in ("blank", "duplicate") else code | TRUNCATED if fault else code)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], batch.schema.field(0).type if i == 0 else pa.string() if i == 7 else pa.int64()) for i in range(8)], names)
    if state:
        r = end(state)
        yield pa.RecordBatch.from_arrays([pa.array([r[i]], batch.schema.field(0).type if i == 0 else pa.string() if i == 7 else pa.int64()) for i in range(8)], names)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def plans(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of ``damaged`` rows.

    Texts do not travel: a row is its turn, role's initial, text's md5 and fault. A repeated text is found within (conv_id,
    role, md5), not by gathering a conversation. One task then reads a conversation's rows in order and holds a byte of each.
    """
    kept = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(F.col("gone"), "gone").when(kept == "", "blank").when(~F.right(kept, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    thin = rows.select("conv_id", "turn", "role", ordered(F.col("text")).alias("of_text"), fault.alias("fault"))
    # a row repeats an earlier one where its turn is not the first, or it is not the first of that turn
    group = ["conv_id", "role", "of_text", "gone"]
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("turn").asc_nulls_first()))
    seen = thin.withColumn("gone", F.col("fault") == "gone").withColumn("place", place)
    again = F.when(F.col("fault").isin("gone", "blank"), F.col("fault")).when(F.col("place") > 1, "duplicate").otherwise(F.col("fault"))
    lined = seen.withColumn("fault", again).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "of_text")
    names = ["conv_id", *COUNTS, "audit"]
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("audit", T.StringType())])
    return lined.select("conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "fault").mapInArrow(lambda b: _solve(b, names), schema)


class _Digest:
    """Takes a conversation's rows one by one and digests the repaired ones, joined by newlines."""

    def __init__(self, head: tuple):
        self.head, self.audit, self.at, self.state, self.hash, self.some = head, head[-1], 0, START, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.some else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.some = True

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = NEXT[self.state]
            self._put(role, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return
        if letter == "K":
            self.state = state_after(self.state, INITIALS.get(role[:1], OTHER))
        else:
            role, self.state = NEXT[self.state]
        self._put(role, text)

    def end(self) -> tuple:
        self.inserts()
        return (*self.head, self.hash.hexdigest())


def _hash(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """A plan, then the rows of its conversation in order, to the plan with the digest of what is left."""
    now = None

    def out(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        types = [key, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    key = None
    for batch in batches:
        done = []
        key = batch.schema.field(0).type
        for conv, role, text, plan in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if plan is not None:
                if now is not None:
                    done.append(now.end())
                now = _Digest((conv, *(plan[c] for c in (*COUNTS, "audit"))))
            elif now is not None:
                now.row(role, text)
        yield out(done, key)
    if now is not None:
        yield out([now.end()], key)


def repair(talks: DataFrame) -> DataFrame:
    """Damage, faults and cheapest repair of each conversation.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost (long), audit, repaired_sha256. One row per conv_id of
    the input, a null conv_id being one conversation; one that lost all rows has zeros, an empty audit and the hash of
    nothing. Rows go by turn, null turns first; rows of one turn by role and the md5 of the text. A null role or text is one
    space, so the row is blank or fits nowhere. A role counts by its first character. Gaps beyond a long are the largest
    long. Other columns are ignored. An empty table gives no rows.
    """
    rows = damaged(talks)
    plan = plans(rows)
    heads = plan.select("conv_id", F.lit(0).alias("rank"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.struct(*COUNTS, "audit").alias("plan"))
    body = rows.filter(~F.col("gone")).select("conv_id", F.lit(1).alias("rank"), "turn", "role", "text", F.lit(None).cast(heads.schema["plan"].dataType).alias("plan"))
    both = heads.unionAll(body).repartition("conv_id").sortWithinPartitions("conv_id", "rank", F.col("turn").asc_nulls_first(), "role", ordered(F.col("text")))
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    schema = T.StructType([*plan.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    return both.select("conv_id", "role", "text", "plan").mapInArrow(lambda b: _hash(b, names), schema)
