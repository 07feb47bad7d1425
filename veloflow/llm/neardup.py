"""Near-duplicates by SimHash fingerprints, linked through deletion-variant signatures.

A fingerprint has 64 bits. Of two that differ in at most 4, one of 3 segments differs in at most one bit. So each segment
is indexed once for each of its bits with that bit left out (64 keys for a fingerprint); two fingerprints with a common key
are compared in full. Equal fingerprints are taken together first, so copies of a text cost one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veloflow.llm.common import fresh, written
from veloflow.llm.components import components

SHINGLE = 4
MAX_BITS = 4
#: First bit of each segment, and the end.
SEGMENTS = (0, 21, 42, 64)
#: A bucket with more fingerprints is dealt out in blocks of this many; every two blocks meet in one task.
BLOCK = 4096
#: Keys to cut are broadcast up to this number (12 bytes each), joined otherwise.
CUT_KEYS = 20_000


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """SimHash of the lower-cased words' shingles, as an unsigned number; without words it is zero."""
    words = text.lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(whole, 42)], np.uint64)
    else:
        gaps = np.flatnonzero(np.frombuffer(whole, np.uint8) == 32)
        starts = np.concatenate([[0], gaps + 1])[: len(words) - width + 1].tolist()
        ends = np.append(gaps, len(whole))[width - 1 :].tolist()
        h = xxhash.xxh64_intdigest
        hashes = np.fromiter([h(whole[s:e], 42) for s, e in zip(starts, ends, strict=True)], np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a very long text is counted in slices
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, name: str, columns: list[str], text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``columns`` of ``docs`` and the fingerprint as a signed 64-bit number in ``name``."""
    words = fresh(docs, "text_bytes")
    keep = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).cast("binary").alias(words))
    schema = T.StructType([*keep.schema.fields[:-1], T.StructField(name, T.LongType(), False)])

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t.as_py(), width) for t in batch.column(batch.num_columns - 1)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marks.view(np.int64))], [*batch.schema.names[:-1], name])

    return keep.mapInArrow(computed, schema)


def signatures(fp: Column) -> Column:
    """Array of keys: for each bit, its segment without that bit, the bit's number above."""
    keys = []
    for low, high in zip(SEGMENTS, SEGMENTS[1:], strict=False):
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        keys += [part.bitwiseAND(F.lit(((1 << (high - low)) - 1) & ~(1 << (bit - low)))).bitwiseOR(F.lit(bit << 22)).cast("int") for bit in range(low, high)]
    return F.array(*keys)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ; counted unsigned, as numpy takes the absolute value of signed numbers first."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def spanning_links(marks: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what chains of at most MAX_BITS differing bits join: fewer than there are marks.

    One connected set after another grows from its first mark: each mark reached is compared with those not reached yet,
    and what it reaches leaves the array.
    """
    links: list[tuple[int, int]] = []
    rest = marks
    while len(rest) > 1:
        edge, rest = [rest[0]], rest[1:]
        while edge and len(rest):
            a = edge.pop()
            near = differing(rest, a) <= MAX_BITS
            if near.any():
                links += [(int(a), int(b)) for b in rest[near]]
                edge += list(rest[near])
                rest = rest[~near]
    return links


def _of_groups(group: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    """Links within each run of equal groups. Runs of one have none; runs of two, the most by far, are compared at once."""
    starts = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1]) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(group)))
    two = starts[sizes == 2]
    near = differing(marks[two], marks[two + 1]) <= MAX_BITS
    a, b = [marks[two][near]], [marks[two + 1][near]]
    for i in np.flatnonzero(sizes > 2):
        found = np.array(spanning_links(marks[starts[i] : starts[i] + sizes[i]]), np.int64).reshape(-1, 2)
        a.append(found[:, 0])
        b.append(found[:, 1])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, mark) sorted by group to links; a group may run on into the next batch."""
    group = marks = np.zeros(0, np.int64)
    for batch in batches:
        group, marks = np.concatenate([group, batch.column(0).to_numpy()]), np.concatenate([marks, batch.column(1).to_numpy()])
        over = int(np.searchsorted(group, group[-1])) if len(group) else 0
        yield _of_groups(group[:over], marks[:over])
        group, marks = group[over:], marks[over:]
    yield _of_groups(group, marks)


def links(marks: DataFrame, name: str, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints at MAX_BITS or less, enough to connect all that such links connect.

    Fingerprints with a common key meet in one task; only those that link leave it. A key with more than ``block`` of them
    is cut into blocks by hash, and every two blocks meet in a task of their own, so no task holds more than two blocks.
    The keys to cut are broadcast only where they are at most CUT_KEYS.
    """
    keyed = marks.select(F.explode(signatures(F.col(name))).alias("key"), F.col(name).alias("mark"))
    cut = written(keyed.groupBy("key").count().filter(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "cut")
    few = cut.count() <= CUT_KEYS
    own = F.pmod(F.xxhash64("mark"), F.coalesce("blocks", F.lit(1))).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda i: (F.least(i, own).cast("long") * (1 << 17) + F.greatest(i, own)) * (1 << 28) + F.col("key"))
    dealt = keyed.join(F.broadcast(cut) if few else cut, "key", "left").select(F.explode(others).alias("grp"), "mark")
    together = dealt.repartition("grp").sortWithinPartitions("grp")
    return together.mapInArrow(_linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint and component of each document.

    Columns: the key, fingerprint (16 lowercase hex digits), component_id (the smallest key that links reach, its own
    included). One row per input row; repeated rows and equal texts share a component. Null and empty texts have the zero
    fingerprint and link like others. Null keys are never a component's id unless it has no other. Other columns are ignored.
    """
    marked = written(fingerprints(docs, "_mark", [key], text), "fingerprints")
    least = written(marked.groupBy("_mark").agg(F.min(key).alias("_least")), "marks")
    joined = components(links(least, "_mark"), "a", "b")
    roots = least.join(joined, F.col("_mark") == F.col("node"), "left").select("_mark", "_least", F.coalesce("root", "_mark").alias("_root"))
    named = roots.groupBy("_root").agg(F.min("_least").alias("component_id"))
    classes = roots.join(named, "_root").select("_mark", "component_id")
    return marked.join(classes, "_mark").select(key, F.lpad(F.lower(F.hex("_mark")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose key names their component, each once, with all their columns.

    A component without a key (all null) keeps a row with the smallest fingerprint. Of repeated keys within a component one row stays.
    """
    mark, row, root, least = (fresh(docs, name) for name in ("mark", "row_no", "root_mark", "least_key"))
    marked = fingerprints(docs, mark, docs.columns, text)
    classes = written(marked.groupBy(mark).agg(F.min(key).alias("least")), "marks").withColumnRenamed(mark, "m")
    joined = components(links(classes, "m"), "a", "b")
    roots = classes.join(joined, F.col("m") == F.col("node"), "left").select("m", "least", F.coalesce("root", "m").alias("root"))
    first = roots.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "m")).alias("x")).select(F.col("x.m").alias(root), F.col("x.least").alias(least))
    kept = marked.join(first, (F.col(mark) == F.col(root)) & F.col(key).eqNullSafe(F.col(least))).drop(root, least)
    each = Window.partitionBy(mark, key).orderBy(F.lit(1))
    return kept.withColumn(row, F.row_number().over(each)).filter(F.col(row) == 1).drop(mark, row)
