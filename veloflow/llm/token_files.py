"""Token ids in files, compressed by Re-Pair grammars.

A file is Parquet with one row per block of documents. A block holds a grammar (rules of two symbols each), the length that
each rule expands to, and the documents' ids as a row of symbols. With the lengths a reader finds the symbols of any range
of ids without expanding what comes before. Symbols have 16 bits where the tokenizer leaves room for rules, else 32.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veloflow.llm.common import new_path
from veloflow.llm.tokens import END_ID, TOKENIZER, encoder, slices, tokenizer_path

#: Ids of a block, about; a longer document is a block by itself.
BLOCK_IDS = 1 << 20
#: Bytes of text that a shard (one task, one file) holds, about.
SHARD_BYTES = 32 << 20
#: Pairs replaced in a round at most (others wait for the next round), and the least count that pays for a rule.
PAIRS, LEAST = 2048, 12


def re_pair(ids: np.ndarray, first_rule: int, most_rules: int, pairs: int = PAIRS, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): the ids with frequent pairs replaced by nonterminals, again and again.

    Rule k, of two symbols, is nonterminal ``first_rule + k``. Each round counts all adjacent pairs and replaces the most
    frequent ones at once, from left to right, so that pairs that overlap are not both replaced. It ends when no pair comes
    ``least`` times or when the rules are used up. After a round that replaced all frequent pairs only pairs with a new
    nonterminal can have become frequent, so only these are counted.
    """
    # a pair is one number: of 32 bits where symbols have 16, which halves what is sorted
    half, kind, spread, bits = (16, np.uint32, 0x9E3779B1, 18) if first_rule + most_rules <= 1 << 16 else (32, np.uint64, 0x9E3779B97F4A7C15, 18)
    down, part = kind(8 * np.dtype(kind).itemsize - bits), kind((1 << half) - 1)
    symbols = ids.astype(kind)
    rules: list[np.ndarray] = []
    made, fresh = 0, 0  # only pairs with a symbol from ``fresh`` on can be frequent
    while len(symbols) >= 2 and made < most_rules:
        keys = symbols[:-1] << kind(half)
        keys |= symbols[1:]
        spots = None
        if fresh:
            new = symbols >= fresh
            spots = np.flatnonzero(new[:-1] | new[1:])
            keys = keys[spots]
            if not len(keys):
                break
        ordered = np.sort(keys)
        starts = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
        counts = np.diff(np.append(starts, len(ordered)))
        room = min(pairs, most_rules - made)
        frequent = np.flatnonzero(counts >= least)
        if not len(frequent):
            break
        complete = len(frequent) <= room
        if not complete:
            frequent = frequent[np.argsort(-counts[frequent], kind="stable")[:room]]
        chosen = ordered[starts[frequent]]
        # a table by hash tells which pairs are chosen; of two that share a place the more frequent one is kept
        place = lambda k: (k * kind(spread)) >> down
        table = np.full(1 << bits, -1, np.int16)
        at = place(chosen)[::-1]
        table[at] = np.arange(len(chosen), dtype=np.int16)[::-1]
        kept = np.unique(table[at])
        complete = complete and len(kept) == len(chosen)
        chosen = chosen[kept]
        table[:] = -1
        table[place(chosen)] = np.arange(len(chosen), dtype=np.int16)
        rule = table[place(keys)]
        hit = np.flatnonzero(rule >= 0)
        hit = hit[chosen[rule[hit]] == keys[hit]]
        which = rule[hit].astype(np.int64)
        hit = hit if spots is None else spots[hit]
        # in a run of overlapping pairs every other one is replaced
        run = np.concatenate([[True], np.diff(hit) != 1]) if len(hit) else np.zeros(0, bool)
        turn = np.arange(len(hit), dtype=np.int32)
        turn -= np.maximum.accumulate(np.where(run, turn, 0))
        hit, which = hit[turn & 1 == 0], which[turn & 1 == 0]
        symbols[hit] = first_rule + made + which
        stay = np.ones(len(symbols), bool)
        stay[hit + 1] = False
        symbols = symbols[np.flatnonzero(stay)]
        rules.append(np.stack([chosen >> kind(half), chosen & part], axis=1).astype(np.int64))
        fresh = first_rule + made if complete else 0
        made += len(chosen)
    return symbols, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def expansion_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids that each rule stands for. Rules only refer to earlier ones."""
    lengths = np.zeros(len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[k] = (1 if a < first_rule else lengths[a - first_rule]) + (1 if b < first_rule else lengths[b - first_rule])
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids of a row of symbols: nonterminals are replaced by their pairs until none is left."""
    while True:
        is_rule = symbols >= first_rule
        if not is_rule.any():
            return symbols
        sizes = 1 + is_rule
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]), symbols.dtype)
        out[ends - sizes] = np.where(is_rule, rules[np.where(is_rule, symbols - first_rule, 0), 0], symbols)
        out[ends[is_rule] - 1] = rules[symbols[is_rule] - first_rule, 1]
        symbols = out


class Block:
    """Reads any range of ids of a stored block."""

    def __init__(self, symbols: bytes, rules: bytes, lengths: bytes, first_rule: int, width: int) -> None:
        kind = f"<u{width}"
        self.symbols = np.frombuffer(symbols, kind).astype(np.int64)
        pairs = np.frombuffer(rules, kind).astype(np.int64).reshape(-1, 2)
        sizes = np.frombuffer(lengths, "<u4").astype(np.int64)
        # what each symbol stands for: ids for themselves, then the expansions of all rules in a row
        self.flat = np.concatenate([np.arange(first_rule), expand(np.arange(first_rule, first_rule + len(pairs)), pairs, first_rule)]).astype(np.uint32)
        self.size = np.concatenate([np.ones(first_rule, np.int64), sizes])
        self.begin = np.concatenate([np.arange(first_rule), first_rule + np.cumsum(sizes) - sizes])
        self.ends = np.cumsum(self.size[self.symbols])

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop`` of the block; only the symbols that cover them are expanded."""
        if stop <= start:
            return np.zeros(0, np.int64)
        a, b = np.searchsorted(self.ends, [start, stop - 1], side="right")
        before = int(self.ends[a - 1]) if a else 0
        symbols, ends = self.symbols[a : b + 1], self.ends[a : b + 1] - before
        sizes = self.size[symbols]
        ids = self.flat[np.repeat(self.begin[symbols] - (ends - sizes), sizes) + np.arange(ends[-1])]
        return ids[start - before : stop - before]


_FORMAT = "shard long, block int, n_docs int, n_ids long, key_bytes binary, counts binary, first_rule int, width int, rules binary, lengths binary, symbols binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents, an end id after each, in ascending doc_id order (null first) to ``path``.

    Shards are ranges of doc_id; rows that repeat a doc_id are told apart by a hash of their texts, so no doc_id makes a
    shard large. A task streams through its shard and holds one block.
    """
    source = tokenizer_path(tokenizer)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-size // SHARD_BYTES))
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).mapInArrow(_blocks(source, block_ids), _FORMAT).write.parquet(path)


def _blocks(source: str, block_ids: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        tool = encoder(source)
        first_rule = tool.tokenizer.get_vocab_size()
        width = 2 if first_rule < 1 << 16 else 4
        most_rules = min((1 << 8 * width) - first_rule, 1 << 16)
        number = 0
        keys: list[int | None] = []
        counts: list[np.ndarray] = []
        parts: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            nonlocal number
            ids = np.concatenate(parts)
            symbols, rules = re_pair(ids, first_rule, most_rules)
            sink = pa.BufferOutputStream()
            batch = pa.record_batch([pa.array(keys, pa.int64())], ["doc_id"])
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            kind = f"<u{width}"
            row = {
                "shard": shard, "block": number, "n_docs": len(keys), "n_ids": len(ids), "key_bytes": sink.getvalue().to_pybytes(), "counts": np.concatenate(counts).astype("<u4").tobytes(),
                "first_rule": first_rule, "width": width, "rules": rules.astype(kind).tobytes(), "lengths": expansion_lengths(rules, first_rule).astype("<u4").tobytes(), "symbols": symbols.astype(kind).tobytes(),
            }
            number += 1
            for x in (keys, counts, parts):
                x.clear()
            types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
            schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in _FORMAT.split(", ")])
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            at = 0
            for texts in slices((x.as_py() for x in batch.column(1)), 1 << 20):
                ids, n = tool.encode(texts, END_ID)
                keys += batch.column(0).slice(at, len(texts)).to_pylist()
                counts.append(n)
                parts.append(ids)
                at += len(texts)
                if sum(map(len, parts)) >= block_ids:
                    yield block()
        if keys:
            yield block()

    return blocks


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the files under ``path``.

    ``start`` is the number of ids of all documents before it. What it needs from other shards are prefix sums over one
    number for each block.
    """
    stored = spark.read.parquet(path)
    blocks = stored.select(F.col("shard").alias("s"), F.col("block").alias("b"), "n_ids")
    shards = blocks.groupBy("s").agg(F.sum("n_ids").alias("n"))  # one row for each task that wrote
    earlier = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.withColumn("inner", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(shards.select("s", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("outer")), "s")
    bases = bases.select("s", "b", (F.col("inner") + F.col("outer")).alias("base"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with pa.ipc.open_stream(row["key_bytes"]) as source:
                    keys = source.read_all().column(0).combine_chunks()
                counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                ends = np.cumsum(counts)
                block = Block(row["symbols"], row["rules"], row["lengths"], row["first_rule"], row["width"])
                raw = memoryview(block.read(0, row["n_ids"]).astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                same = lambda v: pa.array(np.full(len(counts), v, np.int64))
                yield pa.RecordBatch.from_arrays([same(row["shard"]), pa.array(np.full(len(counts), row["block"], np.int32)), keys if isinstance(keys, pa.Array) else keys.chunk(0), pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())], ["s", "b", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = stored.mapInArrow(decoded, "s long, b int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(bases, ["s", "b"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write all documents' ids into the shared folder and read them back; see ``read_token_files``.

    A null or empty text has the end id only; repeated rows are written each; an empty table gives no rows. doc_id must be a
    whole number or null. Other columns are ignored.
    """
    path = new_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer)
    return read_token_files(docs.sparkSession, path)
