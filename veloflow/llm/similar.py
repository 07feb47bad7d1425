"""One document of each group of similar ones: SimHash links and MinHash stars as candidates, similarity checked in full.

Two texts of similarity 0.8 differ in some ten bits of a SimHash, where keys of few segments no longer tell texts apart. So
the links within four bits come from deletion-variant signatures, and the rest from the banded buckets of ``minhash``. Both
are candidates only: documents are linked where their sets of shingles have a Jaccard similarity of 0.8 or more.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veloflow.llm import minhash, neardup
from veloflow.llm.common import fresh

SHINGLE = 5


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """As ``minhash.shingles``, with all letters in lower case."""
    return minhash.shingles(text if text.isascii() else text.decode("utf-8", "replace").lower().encode(), width)


def sim_hash(members: np.ndarray) -> int:
    """Signed SimHash of a set: a bit is 1 if it is set in over half the members."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(members), 1 << 16):
        counts += np.unpackbits(members[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(members), bitorder="little").view(np.int64)[0])


def sim_hash_candidates(sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) of marks: those of one fingerprint against its least mark, and least marks of fingerprints that link."""
    prints = sketches.filter("n > 0").select("print", "mark").distinct()
    least = prints.groupBy("print").agg(F.min("mark").alias("centre"))
    same = prints.join(least, "print").filter("mark <> centre").select(F.col("centre").alias("a"), F.col("mark").alias("b"))
    of = [least.select(F.col("print").alias(f"print_{c}"), F.col("centre").alias(c)) for c in "ab"]
    near = neardup.links(least, "print").select(F.col("a").alias("print_a"), F.col("b").alias("print_b"))
    return same.unionAll(near.join(of[0], "print_a").join(of[1], "print_b").select("a", "b"))


def keep_one_similar(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of documents linked by a similarity of 4/5 or more: the one with the smallest key.

    Shingles are five lower-cased words; texts without words are equal. All columns stay. A component without a key (all
    null) keeps a row with the smallest mark. Of repeated keys with equal sets one row stays.
    """
    row = fresh(docs, "row_no")
    sketches = minhash.sketched(docs, key, text, shingles, {"print": sim_hash})
    firsts = minhash.distinct_sets(sketches)
    links = minhash.similar_links(docs, text, shingles, sketches, firsts, sim_hash_candidates(sketches))
    roots = minhash.classes(firsts, links)
    best = roots.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "mark")).alias("x")).select("x.mark", "x.least")
    own = sketches.select("mark", "k", "h").join(best, "mark").filter(F.col("k").eqNullSafe(F.col("least")))
    picked = own.groupBy("mark", "k").agg(F.min("h").alias("h")).select(F.col("k").alias("picked_key"), F.col("h").alias("picked_hash"))
    match = docs[key].eqNullSafe(F.col("picked_key")) & (F.xxhash64(docs[text]) == F.col("picked_hash"))
    kept = docs.join(picked.hint("shuffle_hash"), match, "left_semi")
    each = Window.partitionBy(key, F.xxhash64(text)).orderBy(F.lit(1))
    return kept.withColumn(row, F.row_number().over(each)).filter(F.col(row) == 1).drop(row)
