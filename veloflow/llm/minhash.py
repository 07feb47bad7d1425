"""Near-duplicates by MinHash: one permutation, optimal densification, banded buckets, star-shaped candidate edges.

A document is the set of its word shingles, each known by a 64-bit hash. The hash's first bits choose one of 128 bins and
the least hash of a bin is its value, so one hash function gives the whole sketch. An empty bin takes the value of a bin
that it picks by hashing its own number until it meets one with a value; two sketches then agree in a bin with the
probability of the sets' Jaccard similarity, also for sets smaller than the sketch. Four bins make a band, 32 bands the
keys of a set: two sets of similarity 0.8 share none of them with probability (1 - 0.8 ** 4) ** 32, about 5e-8.

Sets with a common key form a bucket. First each member is held against the bucket's least one, a star, and what is similar
in full is linked and contracted. Only buckets whose other members still lie in several components are looked at again:
there members of different components are compared in full, each pair in the first bucket it shares. So a group of copies
costs a comparison or so for each, pairs are never listed, and every pair of one bucket is linked if it is similar.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veloflow.llm.common import fresh, written
from veloflow.llm.components import components

SHINGLE = 4
#: Bins of a sketch, a power of two, and how many of them make a band.
BINS, ROWS = 128, 4
BANDS = BINS // ROWS
#: Bins that an empty bin asks before it takes the first that has a value.
PROBES = 2048
#: Members of the sets of a bucket that one task compares; a larger bucket is cut, and every two parts meet in a task.
BLOCK = 1 << 18
#: Members handed on in one batch.
BATCH = 1 << 20


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of words with A-Z in lower case, each once, sorted. Fewer words are one shingle, none have none."""
    words = text.lower().split()
    whole = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([h(whole)] if words else [], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(whole, np.uint8) == 32)
    starts = np.concatenate([[0], gaps + 1])[: len(words) - width + 1].tolist()
    ends = np.append(gaps, len(whole))[width - 1 :].tolist()
    return np.unique(np.fromiter([h(whole[s:e]) for s, e in zip(starts, ends, strict=True)], np.uint64, len(starts)))


def mark_of(members: np.ndarray) -> int:
    """A signed 64-bit number for a set: equal sets have equal ones."""
    return int(np.uint64(xxhash.xxh64_intdigest(members.tobytes(), 7)).astype(np.int64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers whose results look random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
#: Row by row the bin that each bin asks next.
ASKED = (mixed(np.arange(1, PROBES * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BINS)).astype(np.int64).reshape(PROBES, BINS)


def sketch(members: np.ndarray) -> np.ndarray:
    """The value of each bin of a set that is not empty; bins are ranges of the sorted hashes, so their first is the least."""
    starts = np.searchsorted(members, EDGES)
    filled = np.append(starts[1:], len(members)) > starts
    source = np.arange(BINS)
    empty = np.flatnonzero(~filled)
    for low, high in ((0, 16), (16, 256), (256, PROBES)):
        if not len(empty):
            break
        asked = ASKED[low:high, empty]
        hit = filled[asked]
        found = hit.any(axis=0)
        source[empty[found]] = asked[hit.argmax(axis=0), np.arange(len(empty))][found]
        empty = empty[~found]
    source[empty] = np.flatnonzero(filled)[0]  # nothing in PROBES questions: the first bin with a value
    return members[starts[source]]


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A signed key for each band of each sketch, sketches being the rows."""
    values = sketches.reshape(len(sketches), BANDS, ROWS)
    key = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(sketches), BANDS))
    for i in range(ROWS):
        key = mixed(key ^ values[:, :, i])
    return key.view(np.int64)


def lists(parts: list[np.ndarray]) -> pa.Array:
    """An array of lists of longs."""
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.view(np.int64)))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of 4/5 or more, of sorted sets: 9 times the common members are 4 times both sizes or more."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def sketched(docs: DataFrame, key: str, text: str, sets: Callable[[bytes], np.ndarray], extra: dict[str, Callable[[np.ndarray], int]] | None = None) -> DataFrame:
    """A written table (k, h, mark, n, bands) with a row for each document, and a long for each of ``extra``.

    ``h`` is the text's hash, ``mark`` a number of its set and ``n`` the set's size. The sets themselves are not stored.
    """
    more = extra or {}
    keyed = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    tail = "mark long, n int, bands array<long>" + "".join(f", {name} long" for name in more)
    schema = T.StructType([*keyed.schema.fields[:2], *T._parse_datatype_string(tail).fields])

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, sizes, sketches, others = [], [], [], {name: [] for name in more}
            for t in batch.column(2):
                found = sets(t.as_py())
                marks.append(mark_of(found))
                sizes.append(len(found))
                if len(found):
                    sketches.append(sketch(found))
                for name, f in more.items():
                    others[name].append(f(found))
            keys = iter(band_keys(np.array(sketches, np.uint64).reshape(-1, BINS)))
            bands = lists([next(keys) if n else np.zeros(0, np.int64) for n in sizes])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.int64()), pa.array(sizes, pa.int32()), bands, *(pa.array(v, pa.int64()) for v in others.values())], schema.names)

    return written(keyed.mapInArrow(computed, schema), "sketches")


def distinct_sets(sketches: DataFrame) -> DataFrame:
    """(mark, h, least): one text of each distinct set, and the least key of its documents."""
    return written(sketches.groupBy("mark").agg(F.min("h").alias("h"), F.min("k").alias("least")), "sets")


def full_sets(docs: DataFrame, text: str, sets: Callable[[bytes], np.ndarray], firsts: DataFrame, marks: DataFrame) -> DataFrame:
    """A written table (mark, bands, members) of the sets in ``marks``; one text of each is read and shingled again.

    The documents meet the hashes of the texts wanted in a shuffle, at every size alike; no set is stored that nothing asks for.
    """
    wanted = written(firsts.join(marks, "mark", "left_semi").select("h"), "wanted")
    texts = docs.select(F.xxhash64(text).alias("h"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")).join(wanted.hint("shuffle_hash"), "h", "left_semi").distinct()

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["mark", "bands", "members"]
        pack = lambda found: pa.RecordBatch.from_arrays([pa.array([mark_of(s) for s in found], pa.int64()), lists(list(band_keys(np.array([sketch(s) for s in found], np.uint64).reshape(-1, BINS)))), lists(found)], names)
        for batch in batches:
            found, held = [], 0
            for t in batch.column(1):
                found.append(sets(t.as_py()))
                held += len(found[-1])
                if held >= BATCH:
                    yield pack(found)
                    found, held = [], 0
            yield pack(found)

    return written(texts.mapInArrow(shingled, "mark long, bands array<long>, members array<long>"), "compared-sets")


def confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar in full."""

    def true(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            yes = pa.array([similar(x[i].values.to_numpy(), y[i].values.to_numpy()) for i in range(batch.num_rows)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(yes), batch.column(1).filter(yes)], ["a", "b"])

    left, right = (full.select(F.col("mark").alias(c), F.col("members").alias(f"of_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(true, "a long, b long")


def links_across(key: np.ndarray, side: np.ndarray, comp: np.ndarray, bands: np.ndarray, members: list[np.ndarray]) -> list[tuple[int, int]]:
    """Places of similar sets in one group that lie in different components; what is joined by then is not compared.

    Only pairs of one bucket are compared, in the first bucket they share. Where the group is two parts of a bucket (sides 0
    and 1), only pairs between the parts are.
    """
    sizes = np.array([len(m) for m in members])
    names, root = np.unique(comp, return_inverse=True)
    links: list[tuple[int, int]] = []
    apart = len(names)
    for y in range(1, len(members)):
        if apart == 1:
            break
        x = np.flatnonzero((root[:y] != root[y]) & (key[:y] == key[y]) & ((side[:y] < 0) | (side[:y] != side[y])))
        x = x[5 * np.minimum(sizes[x], sizes[y]) >= 4 * np.maximum(sizes[x], sizes[y])]
        if not len(x):
            continue
        shared = bands[x] == bands[y]
        x = x[bands[y][shared.argmax(axis=1)] == key[y]]
        if not len(x):
            continue
        own, others = members[y], np.concatenate([members[i] for i in x])
        at = np.minimum(np.searchsorted(own, others), len(own) - 1)
        common = np.add.reduceat((own[at] == others).astype(np.int64), np.concatenate([[0], np.cumsum(sizes[x])[:-1]]))
        for i in x[9 * common >= 4 * (sizes[x] + sizes[y])]:
            if root[i] != root[y]:
                links.append((int(i), y))
                root[root == root[i]] = root[y]
                apart -= 1
    return links


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (grp, key, side, comp, mark, bands, members) sorted by group to links between marks; a group may fill several batches."""
    held: list[pa.RecordBatch] = []

    def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        key, side, comp, mark = (table.column(i).to_numpy() for i in (1, 2, 3, 4))
        bands = np.concatenate([c.flatten().to_numpy() for c in table.column(5).chunks]).reshape(-1, BANDS)
        members = [s.values.to_numpy().view(np.uint64) for s in table.column(6)]
        found = np.array(links_across(key, side, comp, bands, members), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(mark[found[:, 0]]), pa.array(mark[found[:, 1]])], ["a", "b"])

    for batch in batches:
        grp = batch.column(0).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(grp[1:] != grp[:-1]) + 1, [len(grp)]]) if len(grp) else []
        for low, high in zip(cuts, cuts[1:], strict=False):
            if held and held[-1].column(0)[0].as_py() != grp[low]:
                yield done(held)
                held = []
            held.append(batch.slice(low, high - low))
    if held:
        yield done(held)


def similar_links(docs: DataFrame, text: str, sets: Callable[[bytes], np.ndarray], sketches: DataFrame, firsts: DataFrame, more: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between marks of similar sets, enough to connect all that such links of one bucket connect.

    ``more`` holds candidate pairs (a, b) from elsewhere; they are confirmed in full together with the stars' edges.
    """
    own = sketches.filter("n > 0").dropDuplicates(["mark", "h"]).join(firsts.select("mark", "h"), ["mark", "h"], "left_semi")
    keyed = written(own.select(F.explode("bands").alias("key"), "mark", "n"), "keys")
    shared = keyed.groupBy("key").agg(F.min("mark").alias("centre"), F.count(F.lit(1)).alias("width")).filter("width > 1")
    buckets = written(keyed.join(shared, "key"), "buckets")
    edges = buckets.filter("mark <> centre").select(F.col("centre").alias("a"), F.col("mark").alias("b"))
    star = written((edges if more is None else edges.unionAll(more.select("a", "b"))).distinct(), "stars")
    full = full_sets(docs, text, sets, firsts, star.select(F.col("a").alias("mark")).unionAll(star.select(F.col("b").alias("mark"))))
    first = written(confirmed(star, full), "star-links")

    roots = written(components(first, "a", "b"), "star-roots")
    placed = buckets.filter("mark <> centre and width > 2").join(roots, F.col("mark") == F.col("node"), "left").select("key", "mark", "n", F.coalesce("root", "mark").alias("comp"))
    placed = written(placed, "placed")
    open_keys = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.sum("n").alias("total")).filter("low <> high")
    parts = open_keys.select("key", F.ceil(F.col("total") / block).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("mark"), F.col("parts")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(F.xxhash64("key", F.least(i, own), F.greatest(i, own)).alias("grp"), F.when(i == own, -1).when(own < i, 0).otherwise(1).alias("side")))
    dealt = placed.join(parts, "key").select(F.explode(pair).alias("p"), "key", "comp", "mark").select("p.*", "key", "comp", "mark")
    across = dealt.join(full, "mark").select("grp", "key", "side", "comp", "mark", "bands", "members").repartition("grp").sortWithinPartitions("grp").mapInArrow(_across, "a long, b long")
    return written(first.unionAll(across), "links")


def classes(firsts: DataFrame, links: DataFrame) -> DataFrame:
    """(mark, root, least, lead): the component of each distinct set, its least key, and the least key of the component."""
    joined = components(links, "a", "b")
    roots = firsts.join(joined, F.col("mark") == F.col("node"), "left").select("mark", "least", F.coalesce("root", "mark").alias("root"))
    return roots.join(roots.groupBy("root").agg(F.min("least").alias("lead")), "root")


def min_hash_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """The component of each document under links of Jaccard similarity 0.8 or more between shingle sets.

    Columns: the key, n_shingles (long), component_id (the least key that links reach, its own included), kept (the key is
    the component's). One row per input row. Repeated rows and equal sets share a component. Null, empty and blank texts
    have the empty set, link with nothing, and are components of their own. A null key is a component's id only where the
    component has no other; such a row is kept. Other columns are ignored. An empty table gives no rows.
    """
    sets = partial(shingles, width=width)
    sketches = sketched(docs, key, text, sets)
    firsts = distinct_sets(sketches)
    found = classes(firsts, similar_links(docs, text, sets, sketches, firsts)).select("mark", "lead")
    joined = sketches.select("k", "mark", "n").join(found, "mark")
    lead = F.when(F.col("n") > 0, F.col("lead")).otherwise(F.col("k"))
    name = fresh(docs, "component_id") if key == "component_id" else "component_id"
    return joined.select(F.col("k").alias(key), F.col("n").cast("long").alias("n_shingles"), lead.alias(name), F.col("k").eqNullSafe(lead).alias("kept"))
