"""Best-fit packing of documents into sequences of tokens, by bin completion over the histogram of lengths.

There are at most ``capacity`` different lengths, so however many documents there are, what has to be packed is a table of
at most ``capacity`` counts. That table is the only thing the driver sees. It finds patterns (lengths of one sequence) and
how often to use each; tasks then give each piece the place that its rank among pieces of equal length stands for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloflow.llm.common import fresh, parts_for, ranked, written
from veloflow.llm.tokens import END_ID, TOKENIZER, encoder, slices, tokenizer_path

CAPACITY = 4096
#: Nodes that the search for a better packing may visit, and completions tried at a node; then the best packing so far stands.
MAX_NODES = 20_000
MAX_BRANCHES = 8
#: Pieces of one length that one task ranks.
RANK_ROWS = 50_000

#: A pattern: (length, how many of it) from the longest on; and how often it is used.
Pattern = tuple[tuple[int, int], ...]
Plan = list[tuple[Pattern, int]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: total over capacity, and for each k, pieces longer than capacity - k take one each,
    those longer than half besides them too, and what is at least k long fills only the room these leave."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    amount = np.zeros(capacity + 2, np.int64)
    for n, c in counts.items():
        amount[n] = c
    number, total = np.cumsum(amount), np.cumsum(amount * np.arange(capacity + 2))
    half = capacity // 2
    for k in range(1, half + 1):
        long = number[capacity] - number[capacity - k]
        middle = number[capacity - k] - number[half]
        room = middle * capacity - (total[capacity - k] - total[half])
        small = total[half] - total[k - 1]
        best = max(best, int(long + middle + max(0, -(-(small - room) // capacity))))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing. Sequences filled alike are one group with a count, so equal lengths are placed all at once."""
    groups: dict[int, list[list]] = {}  # room left: [pattern, how many]
    rooms = np.zeros(capacity + 1, bool)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fit = np.flatnonzero(rooms[length:])
            room = length + int(fit[0]) if len(fit) else capacity
            if len(fit):
                group = groups[room][-1]
                if group[1] <= left:
                    groups[room].pop()
                    if not groups[room]:
                        del groups[room]
                        rooms[room] = False
                used = min(group[1], left)
                group[1] -= used
                pattern, per = group[0], 1
            else:
                per = min(capacity // length, left)
                pattern, used = (), left // per
            room -= per * length
            left -= used * per
            new = (*pattern, (length, per)) if not pattern or pattern[-1][0] != length else (*pattern[:-1], (length, pattern[-1][1] + per))
            groups.setdefault(room, []).append([new, used])
            rooms[room] = room > 0
    return [(p, n) for alike in groups.values() for p, n in alike if n]


def completions(counts: np.ndarray, room: int, most: int) -> list[list[int]]:
    """Undominated fillings of ``room`` out of ``counts``, least waste first, then fewest pieces; at most ``most``.

    A piece that fits exactly dominates all other fillings, as it could be put in place of theirs. Otherwise, for each piece
    the longest mate that still fits is tried, then for the longest pieces each pair that fits beside them. A filling to
    which a piece left over could be added is dominated by that addition, so fillings are topped up from the longest on.
    """
    if room <= 0:
        return [[]]
    if counts[room]:
        return [[room]]
    here = counts[: room + 1] > 0
    sizes = np.flatnonzero(here)[::-1]
    if not len(sizes):
        return [[]]
    longest = np.maximum.accumulate(np.where(here, np.arange(room + 1), 0))  # the longest piece up to each length

    def mates(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
        left = room - sizes
        mate = longest[np.maximum(left, 0)]
        same = (mate == sizes) & (counts[sizes] < 2)
        mate = np.where(same, longest[np.maximum(mate - 1, 0)], mate)
        return mate, left - mate

    found: dict[tuple[int, ...], int] = {}
    for first in (0, *sizes[:4].tolist()):
        some = sizes[sizes <= room - first]
        if first:
            some = some[(some != first) | (counts[some] > 1)]
        mate, waste = mates(some, room - first)
        for k in np.argsort(waste, kind="stable")[:most].tolist():
            filling = sorted([x for x in (first, int(some[k]), int(mate[k])) if x], reverse=True)
            if all(counts[x] >= filling.count(x) for x in filling):
                found[tuple(filling)] = room - sum(filling)
        if found and min(found.values()) == 0:
            break
    best = sorted(found, key=lambda f: (found[f], len(f), [-x for x in f]))[:most]
    out = []
    for filling in best:
        left, more = found[filling], list(filling)
        while left and (n := int(longest[left])):
            while n and counts[n] <= more.count(n):
                n = int(longest[n - 1])
            if not n:
                break
            k = min(left // n, int(counts[n]) - more.count(n))
            more += [n] * k
            left -= n * k
        out.append((left, more))
    return [f for _, f in sorted(out, key=lambda x: (x[0], len(x[1])))]


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> Plan:
    """A packing with as few sequences as the search finds; the best-fit packing is the first incumbent.

    Depth first: each node completes a sequence around the longest remaining piece and uses that pattern as often as the
    counts allow; then the node's other fillings are tried. A branch is given up when its waste leaves no chance of fewer
    sequences than the incumbent has. The search ends at the lower bound (the packing is optimal then), when all is done,
    or after ``max_nodes``.
    """
    counts = {int(n): int(c) for n, c in counts.items() if c > 0 and n > 0}
    incumbent = best_fit(counts, capacity)
    best, least = sum(k for _, k in incumbent), lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    plan: Plan = []
    trail: list[tuple[int, Iterator[list[int]]]] = []  # the longest piece of each node and the fillings not tried yet
    used = waste = nodes = 0

    def enter() -> None:
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        trail.append((longest, iter(completions(left, capacity - longest, MAX_BRANCHES))))
        left[longest] += 1

    def undo() -> None:
        nonlocal used, waste
        pattern, times = plan.pop()
        for n, k in pattern:
            left[n] += k * times
        used -= times
        waste -= (capacity - sum(n * k for n, k in pattern)) * times

    if best > least:
        enter()
    while trail and best > least and nodes < max_nodes:
        longest, fillings = trail[-1]
        filling = next(fillings, None)
        if filling is None:
            trail.pop()
            if plan:
                undo()
            continue
        nodes += 1
        need = {n: filling.count(n) for n in filling}
        need[longest] = need.get(longest, 0) + 1
        times = min(int(left[n]) // k for n, k in need.items())
        for n, k in need.items():
            left[n] -= k * times
        plan.append((tuple(sorted(need.items(), reverse=True)), times))
        used += times
        waste += (capacity - sum(n * k for n, k in need.items())) * times
        done = not left.any()
        if done and used < best:
            incumbent, best = list(plan), used
        if done or waste > (best - 1) * capacity - total:
            undo()
        else:
            enter()
    return incumbent


def plan_table(plan: Plan) -> dict[str, np.ndarray]:
    """Places by (length, rank): runs of ranks that start at ``rank`` hold ``times`` sequences from ``sequence`` on, at ``offset`` and further."""
    rows, taken, first = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for length, per in pattern:
            rank = taken.get(length, 0)
            rows.append((length, rank, times, per, first, offset))
            taken[length] = rank + times * per
            offset += length * per
        first += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 6).T
    return dict(zip(("length", "rank", "times", "per", "sequence", "offset"), columns, strict=True))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of at most ``capacity`` ids; the end id closes each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            at = 0
            for texts in slices(x.as_py() for x in batch.column(1)):
                ids, counts = encode(texts, END_ID)
                raw, begin = memoryview(ids.astype("<u4").tobytes()), 0
                rows: list[tuple[int, int, int, int, int]] = []
                for k, n in enumerate(counts.tolist()):
                    for piece, start in enumerate(range(0, n, capacity)):
                        stop = min(n, start + capacity)
                        rows.append((k, piece, start, stop - start, zlib.crc32(raw[4 * (begin + start) : 4 * (begin + stop)])))
                    begin += n
                table = np.array(rows, np.int64).T
                keys = batch.column(0).take(pa.array(at + table[0]))
                yield pa.RecordBatch.from_arrays([keys, pa.array(table[1].astype(np.int32)), *(pa.array(c) for c in table[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])
                at += len(texts)

    columns = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return columns.mapInArrow(cut, f"doc_id {columns.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> DataFrame:
    """A place for each piece of each document, in as few sequences of ``capacity`` tokens as the search finds.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are one piece with the end id
    only; repeated rows are packed as often as they come; an empty table gives no rows. Only documents longer than the
    capacity are cut. Other columns are ignored.
    """
    path = tokenizer_path(tokenizer)
    cut = written(pieces(docs, path, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    places = plan_table(bin_completion(counts, capacity, max_nodes))
    parts = parts_for(max(counts.values(), default=1), RANK_ROWS)
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    numbered = ranked(cut, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], part, rank := fresh(cut, "rank"))
    return numbered.select(*cut.columns, rank).mapInArrow(_placed(places), cut.selectExpr("*", "0L AS sequence_id", "0L AS offset").schema)


def _placed(places: dict[str, np.ndarray]):
    """The plan goes with the tasks: each pattern uses up a length, so it has at most ``capacity`` patterns of at most
    sqrt(2 * capacity) different lengths each, however many documents there are."""
    width = 1 << 44
    starts = places["length"] * width + places["rank"]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(starts, length * width + rank, side="right") - 1
            slot, turn = np.divmod(rank - places["rank"][at], places["times"][at])
            sequence = places["sequence"][at] + turn
            offset = places["offset"][at] + slot * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return placed
